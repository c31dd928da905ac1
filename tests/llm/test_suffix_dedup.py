"""Repeated strings against counting every window of every text."""

import random
from collections import Counter

import numpy as np
import pytest
from corpus import TEXTS
from hypothesis import given, settings, strategies as st

from tallyloom.llm.suffix_dedup import common_prefixes, remove_repeats, repeated_starts, segments, suffix_order


def brute(texts, length):
    windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if windows[t[i : i + length]] > 1:
                cover[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(int), [0]])))
        out.append((list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), bytes(np.frombuffer(t, np.uint8)[~cover])))
    return out


def check(frame, length):
    out = frame.collect()
    texts = [(r.row.text or "").encode() for r in out]
    for r, text, (spans, kept) in zip(out, texts, brute(texts, length), strict=True):
        assert r.n_bytes == len(text)
        assert [(s["from"], s["to"]) for s in r.spans] == spans
        assert bytes(r.kept) == kept
    return out


@pytest.mark.parametrize("most_segments", [1024, 1])
def test_edge_cases(edge_docs, most_segments):
    short = edge_docs.filter("text is null or length(text) < 5000")
    out = check(remove_repeats(short, length=20, gram=7, most_segments=most_segments), 20)
    assert len(out) == sum(len(t or "") < 5000 for _, t in TEXTS)


def test_long_texts(edge_docs):
    out = remove_repeats(edge_docs).collect()
    for r in out:
        if r.row.text and len(r.row.text) > 5000:
            # The whole of it repeats but for an own ending.
            assert bytes(r.kept) == r.row.text.encode()[len(r.row.text.rstrip("end")) - 1 :] or len(r.kept) <= 4


def test_empty(no_docs):
    assert remove_repeats(no_docs).collect() == []


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdé ") for _ in range(300))
    texts = [
        "".join(rng.choice("abc ") for _ in range(rng.randrange(200))) + passage[rng.randrange(90) :] + str(i)
        for i in range(30)
    ] + ["ab" * 150, "b" * 80, "x" + "b" * 70]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for most, limit in ((1024, 32 << 20), (3, -1)):
        check(remove_repeats(docs, length=40, gram=10, most_segments=most, bin_bytes=5000, broadcast_bytes=limit), 40)


def test_all_texts_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    check(remove_repeats(docs, length=100, gram=25), 100)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=120) | st.lists(st.sampled_from(b"ab\0"), max_size=120).map(bytes))
def test_order_is_that_of_sorting_all_suffixes(data):
    found = suffix_order(data, 16).tolist()
    assert sorted(found) == list(range(len(data)))
    assert [data[i : i + 16] for i in found] == sorted(data[i : i + 16] for i in range(len(data)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(b"ab"), min_size=6, max_size=40).map(bytes), min_size=1, max_size=5))
def test_repeated_starts(contents):
    starts = [len(c) - 5 for c in contents]
    seen = Counter(c[i : i + 6] for c, n in zip(contents, starts, strict=True) for i in range(n))
    found = repeated_starts(contents, starts, 6)
    assert [m.tolist() for m in found] == [
        [seen[c[i : i + 6]] > 1 for i in range(n)] for c, n in zip(contents, starts, strict=True)
    ]


def test_common_prefixes():
    data = b"abcabcabcabcx" + bytes(3) + b"abcabcabcabcy"
    left, right = np.array([0, 0, 3]), np.array([16, 3, 12])
    assert common_prefixes(data, left, right, 40).tolist() == [12, 9, 0]
    assert common_prefixes(data, left, right, 5).tolist() == [5, 5, 0]


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(5)
    common = rng.integers(0, 4, 200, dtype=np.uint8)
    found = []
    for size in (50, 333):
        data = np.concatenate([rng.integers(0, 4, size, dtype=np.uint8), common])
        first, n, anchor, hashes = segments(data, 60, 12)
        at = np.repeat(np.arange(len(first)), n)
        found.append([(int(anchor[at[s]]) - s, int(hashes[at[s]])) for s in range(size, size + 141)])
    assert found[0] == found[1]
