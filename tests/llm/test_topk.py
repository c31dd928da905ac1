"""Exact top-k against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm.topk import top_k


def brute(rows, k, queries):
    grid = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        grid.setdefault(i, set()).add(tuple(math.floor(256.0 * x) for x in v))
    out = []
    for q in sorted(grid):
        if not queries(q):
            continue
        scores = {
            (-sum(a * b for a, b in zip(v, w)), i) for v in grid[q] for i, ws in grid.items() if i != q for w in ws
        }
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], start=1)]
    return out


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("grid", F.lit("mine"))
    out = top_k(frame, F.col("vec_id") % 5 == 0, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out)


def test_random_vectors_with_ties_and_small_blocks(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6)]) for i in range(200)]
    rows += [(200 + i, rows[7][1]) for i in range(20)]
    want = brute(rows, 5, lambda q: q % 5 == 0)
    assert found(spark, rows) == want
    assert found(spark, rows, candidate_block=30, query_block=10, pivots=3) == want


def test_edge_cases(spark):
    rows = [
        (0, [1.0, 0.5]),
        (0, [1.0, 0.5]),
        (5, [0.25]),
        (10, None),
        (15, [float("nan"), 1.0]),
        (20, [float("inf"), 1.0]),
        (25, []),
        (None, [1.0, 1.0]),
        (3, [None, 1.0]),
        (4, [-1.0, -2.0]),
    ]
    assert found(spark, rows) == brute(rows, 5, lambda q: q % 5 == 0)


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(5, [1.0])]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows) == []
