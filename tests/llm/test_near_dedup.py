"""Near groups against all pairs of shingle sets."""

import random
import re

import numpy as np
from corpus import LONG, TEXTS

from tallyloom.llm import near_dedup
from tallyloom.llm.components import components
from tallyloom.llm.near_dedup import collection_keys, keep_one_of_each, minhash_factors, near_groups, shingle_set

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    members = {}
    for i, (doc_id, _) in enumerate(rows):
        members.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        ids = [m for m in members[find(i)] if m is not None]
        least = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect()), key=repr)


def test_edge_cases(edge_docs):
    assert got(near_groups(edge_docs)) == expected(TEXTS)


def test_empty(no_docs):
    assert near_groups(no_docs).collect() == []


def family(seed, base_words, copies, changes):
    """Copies of one text, each with some words of its own, so that not all pairs are linked."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(base_words)]
    texts = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    return texts


def test_families_against_all_pairs(spark):
    texts = [t for seed in range(4) for t in family(seed, 120, 25, 8)] + family(9, 40, 20, 3)
    rows = [(100 + i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = expected(rows)
    assert got(near_groups(docs)) == want
    # Small tiles and no broadcasts take the other ways and give the same.
    assert got(near_groups(docs, tile_rows=7, broadcast_bytes=-1)) == want


def test_hot_table_keys_are_dealt_out(spark, monkeypatch):
    rows = list(enumerate(family(3, 120, 60, 8)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    plans, stage = {}, near_dedup.stage_table

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(near_dedup, "stage_table", watched)
    assert got(near_groups(docs, broadcast_bytes=-1, hot_rows=5)) == expected(rows)
    # No window takes a table key whole into one task; its rows meet the pivot share by share.
    assert "Window" not in plans["star-pairs"] and "fact_salt" in plans["star-pairs"]


def test_one_of_each_keeps_all_columns(edge_docs):
    kept = keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("one two three") == 1
    assert "another text under a used id" in texts
    assert texts.count(LONG) + texts.count(LONG + "end") == 1


def test_minhash_agreement_follows_similarity():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    left = np.concatenate([common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
    right = np.concatenate([common, rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
    factors = minhash_factors(400, 1, 3)
    agree = (collection_keys(left, factors, 1) == collection_keys(right, factors, 1)).mean()
    assert abs(agree - 300 / 400) < 0.08


def test_no_shingle_of_white_space():
    assert len(shingle_set(" \n\t")) == 0
    assert len(shingle_set("a b c d e f")) == 2


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 90)], "x bigint, y bigint")
    found = {r.node: r.component for r in components(links).collect()}
    assert all(found[i] == 1 for i in range(1, 41))
    assert found[90] == found[100] == 90
