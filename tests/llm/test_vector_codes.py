"""Vector codes against plain rounds over all entries."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm.vector_codes import compress, nearest, with_group_error


def plain(rows, parts, entries, rounds, scale):
    kept = [
        (i, v) for i, v in rows if v is not None and not any(x is None or not math.isfinite(x) for x in v)
    ]
    grids = [(i, [math.floor(scale * x) for x in v]) for i, v in kept]
    width = -(-max(len(g) for _, g in grids) // parts)
    grids = [(i, g + [0] * (parts * width - len(g))) for i, g in grids]
    grids.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[g[p * width : (p + 1) * width] for _, g in grids[:entries]] for p in range(parts)]

    def assign(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = [g[p * width : (p + 1) * width] for _, g in grids]
            by = [assign(x, books[p])[1] for x in mine]
            for e in range(len(books[p])):
                own = [x for x, n in zip(mine, by, strict=True) if n == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    out = []
    for i, g in grids:
        hits = [assign(g[p * width : (p + 1) * width], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in hits), sum(d for d, _ in hits)))
    return out, books


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("grid", F.lit("mine")).repartition(3)
    coded, books = compress(frame, **options)
    assert coded.schema["row"].dataType.names == ["vec_id", "embedding", "grid"]
    return [(r.row.vec_id, r.code, r.error) for r in coded.collect()], books


def key(row):
    return (row[0] is None, row[0] or 0, row[1:])


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 5, 4), (3, 16, 6), (1, 300, 2), (7, 1, 1)])
def test_against_all_entries(spark, parts, entries, rounds):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=7)]) for i in range(120)]
    rows += [(500, rows[3][1]), (None, [0.5] * 7), (7, rows[7][1]), (7, rows[9][1]), (2, [0.25]), (1, []), (0, None)]
    rows += [(9, [float("nan")] * 7), (9, [float("inf")] * 7), (9, [None, 1.0])]
    want, books = plain(rows, parts, entries, rounds, 64)
    got, codebooks = found(spark, rows, parts=parts, entries=entries, rounds=rounds, scale=64)
    if entries > 256:  # codes are then three digits wide
        assert sorted((r[0] is None, r[0] or 0, r[2]) for r in got) == sorted((r[0] is None, r[0] or 0, r[2]) for r in want)
    else:
        assert sorted(got, key=key) == sorted(want, key=key)
    assert codebooks.entries.tolist() == books


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 4), st.integers(1, 20), st.integers(1, 30), st.integers(1, 6), st.integers(0, 10**6))
def test_nearest_with_ties(width, entries, rows, spread, seed):
    rng = np.random.default_rng(seed)
    parts, book = rng.integers(-spread, spread, (rows, width)), rng.integers(-spread, spread, (entries, width))
    number, distance = nearest(parts, book)
    every = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all()
    assert (distance == every.min(axis=1)).all()


def test_nothing_and_too_large(spark):
    got, books = found(spark, [])
    assert got == []
    assert books.entries.size == 0
    assert found(spark, [(1, None)])[0] == []
    assert found(spark, [(1, [])])[0] == [(1, "00" * 8, 0)]
    with pytest.raises(ValueError, match="too large"):
        found(spark, [(1, [3e30] * 8)])


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": 0, "hot_rows": 3}])
def test_group_errors(spark, limits):
    rows = [(i, "ab"[i % 2] if i % 3 else None, f"{i:02x}", 10 * i) for i in range(30)]
    coded = spark.createDataFrame(rows, "n int, label string, code string, error bigint")
    sums = {k: sum(r[3] for r in rows if r[1] == k) for k in ("a", "b", None)}
    out = with_group_error(coded, F.col("label"), **limits).collect()
    assert sorted((r.n, r.group_error) for r in out) == [(r[0], sums[r[1]]) for r in rows]
