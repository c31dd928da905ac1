"""Periodic runs against a comparison of every word with every later one."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tallyloom.llm.periodic_runs import PRIMES, find_runs, levels_for, runs_of, transform, transform_back, zero_mismatches
from tallyloom.llm.queries import op12_periodic_runs


def brute(codes, least=12):
    """All runs, by period: stretches of equal words ``p`` apart, without those of a shorter period."""
    x, out = np.asarray(codes), []
    for p in range(1, len(x) // 2 + 1):
        same = np.concatenate([[0], (x[:-p] == x[p:]).astype(int), [0]])
        for start, end in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1), strict=True):
            length = int(end - start + p)
            part = x[start : start + length]
            if length >= max(least, 2 * p) and not any(np.array_equal(part[q:], part[:-q]) for q in range(1, p)):
                out.append((int(start), length, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@st.composite
def texts(draw):
    n, kinds = draw(st.integers(0, 90)), draw(st.sampled_from([1, 2, 3, 8]))
    x = draw(st.lists(st.integers(0, kinds - 1), min_size=n, max_size=n))
    if n and draw(st.booleans()):
        a = draw(st.integers(0, n - 1))
        p = draw(st.integers(1, n - a))
        x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
    return np.array(x, dtype=np.int64)


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts(), min_size=1, max_size=5), st.sampled_from([(12, 1 << 16), (12, 4), (3, 8), (40, 1 << 16)]))
def test_runs(found, options):
    assert runs_of(found, *options) == [brute(x, options[0]) for x in found]


def test_long_texts():
    rng = np.random.default_rng(3)
    one, two = rng.integers(0, 2, 3000), rng.integers(0, 700, 5000)
    whole = [np.zeros(4000, dtype=np.int64), one, np.tile(two, 3), np.arange(9000) % 4001, np.concatenate([np.tile(one[:97], 40), two])]
    whole = [np.unique(x, return_inverse=True)[1] for x in whole]
    assert runs_of(whole) == runs_of(whole, 12, 64)
    assert runs_of(whole)[:2] == [brute(x) for x in whole[:2]]
    assert (0, 15000, 5000) in runs_of(whole)[2]
    assert (0, 9000, 4001) in runs_of(whole)[3]


@pytest.mark.parametrize(("prime", "root"), PRIMES)
def test_transform_there_and_back(prime, root):
    rows = np.random.default_rng(1).integers(0, prime, (3, 64), dtype=np.uint64)
    assert (transform_back(transform(rows, prime, root), prime, root) == rows).all()


@pytest.mark.parametrize("most", [3, 1 << 20, (1 << 30) + 7])
def test_zero_mismatches_are_exact(most):
    rng = np.random.default_rng(2)
    windows = rng.integers(0, most, (20, 40), dtype=np.uint64)
    windows[:, 10:20] = windows[:, :10]
    windows[3, 12] = most
    blocks = windows[:, :8].copy()
    want = np.array([[(w[k : k + 8] == b).all() for k in range(33)] for w, b in zip(windows, blocks, strict=True)])
    assert (zero_mismatches(blocks, windows, most) == want).all()


@pytest.mark.parametrize("least", [1, 2, 12, 100])
def test_every_period_has_one_level_whose_block_fits(least):
    seen = []
    for level in levels_for(400, least, 1 << 16):
        periods = np.flatnonzero(level.wanted) + level.low
        assert all(2 * level.size - 1 <= max(p, least - p) for p in periods.tolist())
        seen += periods.tolist()
    assert sorted(seen) == list(range(1, 201))


def test_edge_cases(spark, edge_docs, no_docs):
    rows = find_runs(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        words = (r.row.text or "").split()
        runs = [tuple(x) for x in r.runs]
        assert r.collapsed == collapsed(words, runs)
        assert r.row.n == "mine"
        if r.row.doc_id in (8, 9, 10):
            assert runs == [(0, 9000, 3)]
        else:
            assert runs == []
    assert find_runs(no_docs).count() == 0


def test_registered_query(spark, sf):
    found = {r.doc_id: r for r in op12_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        h, n = zlib.crc32(str(doc.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        _, codes = np.unique(words, return_inverse=True) if n else (None, np.empty(0, dtype=int))
        runs = brute(codes)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert tuple(found[doc.doc_id]) == (
            doc.doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        )
