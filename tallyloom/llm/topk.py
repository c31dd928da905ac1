"""Exact top-k search by inner product with pivot-table elimination."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.common import bounded_batches, broadcast_if_small, stage_table

PIVOTS = 32
# Rows of a candidate block and of a query block.
CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 512
# Candidates evaluated at once before the stopping rule is asked again.
STEP = 64
SCALE = 256


def grid_vector(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as double, in whole numbers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width``."""
    offsets = np.asarray(column.offsets, dtype=np.int64)
    values = np.asarray(column.values, dtype=np.int64)
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), _ranges(lengths)] = values[offsets[0] : offsets[-1]]
    return out


def _ranges(lengths: np.ndarray) -> np.ndarray:
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    v, p = vectors.astype(np.float64), pivots.astype(np.float64)
    squared = (v**2).sum(axis=1)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * v @ p.T
    return np.sqrt(np.maximum(squared, 0.0))


def search_block(
    queries: tuple[np.ndarray, np.ndarray, np.ndarray],
    block: tuple[np.ndarray, np.ndarray, np.ndarray],
    k: int,
) -> Iterator[tuple[int, int, int]]:
    """The best ``k`` of one block for each query; each side is (ids, vectors, pivot distances).

    ``2<q,x> = |q|^2 + |x|^2 - d(q,x)^2``, and d is at least the largest difference of the
    distances to a pivot, which bounds the product from above. Candidates are evaluated by
    falling bound until the k-th best product exceeds all bounds left.
    """
    query_ids, query_vectors, query_table = queries
    ids, vectors, table = block
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    for query_id, query, to_pivots in zip(query_ids, query_vectors, query_table, strict=True):
        lower = np.zeros(len(ids))
        for p in range(table.shape[1]):
            np.maximum(lower, np.abs(table[:, p] - to_pivots[p]), out=lower)
        own = float((query.astype(np.float64) ** 2).sum())
        # Room for rounding: distances are sums of squares in doubles.
        slack = 1.0 + 1e-6 * (own + squares)
        upper = (own + squares - np.maximum(lower - 1e-3, 0.0) ** 2) / 2 + slack
        upper[ids == query_id] = -np.inf
        order = np.argsort(-upper, kind="stable")
        if np.isneginf(upper[order[-1]]) if len(order) else False:
            order = order[: int((upper > -np.inf).sum())]
        best_scores = np.empty(0, dtype=np.int64)
        best_ids = np.empty(0, dtype=np.int64)
        at = 0
        while at < len(order) and (len(best_scores) < k or upper[order[at]] >= best_scores[-1]):
            step = order[at : at + STEP]
            best_scores = np.concatenate([best_scores, vectors[step] @ query])
            best_ids = np.concatenate([best_ids, ids[step]])
            ranked = np.lexsort((best_ids, -best_scores))[:k]
            best_scores, best_ids = best_scores[ranked], best_ids[ranked]
            at += STEP
        for score, found in zip(best_scores.tolist(), best_ids.tolist(), strict=True):
            yield int(query_id), int(found), int(score)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    pivots: int = PIVOTS,
    candidate_block: int = CANDIDATE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best rows, its own id left out.

    Components become floor(256 * x); the score is the whole-number inner product (it must
    fit 63 bits), ties go to the smaller id. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part. Shorter vectors count as padded with
    zeros. Queries that repeat a row are searched once, and of rows that repeat id and vector
    one takes part. Fewer than ``k`` other rows give fewer results; an empty table gives none.
    Other columns are not read.

    Pivots are the usable vectors with the smallest hashes, a fixed number of rows. The table
    of distances to them is computed once per row and stored with its block. Query blocks
    meet candidate blocks through a join on block numbers: every block travels as one row, so
    tasks are even and bounded in memory whatever is common among the vectors. Each pair of
    blocks leaves at most ``k`` rows per query, and a second pass ranks those.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    grid = stage_table(
        vectors.filter(F.col(f"`{id_column}`").isNotNull() & usable(F.col(f"`{vector_column}`")))
        .select(
            F.col(f"`{id_column}`").cast("bigint").alias("vec_id"),
            grid_vector(F.col(f"`{vector_column}`")).alias("grid"),
            is_query.alias("is_query"),
        )
        .distinct(),
        "grid-vectors",
    )
    facts = grid.agg(
        F.count("*").alias("rows"), F.max(F.size("grid")).alias("width"), F.sum(F.col("is_query").cast("int")).alias("queries")
    ).first()
    result = "query_id bigint, vec_id bigint, score bigint"
    if not facts["rows"] or not facts["queries"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = facts["width"]
    spread = grid.orderBy(F.xxhash64("grid"), "vec_id").limit(pivots).select("grid").collect()  # a fixed number of rows
    pivot_table = np.zeros((len(spread), width), dtype=np.int64)
    for i, row in enumerate(spread):
        pivot_table[i, : len(row.grid)] = row.grid

    def pack(frame: pa.Table) -> pa.Table:
        ids = np.asarray(frame["vec_id"], dtype=np.int64)
        matrix = _matrix(frame["grid"].combine_chunks(), width)
        table = _distances(matrix, pivot_table)
        return pa.table(
            {
                "block": pa.array([frame["block"][0].as_py()], pa.int64()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "vectors": pa.array([matrix.tobytes()], pa.binary()),
                "distances": pa.array([table.tobytes()], pa.binary()),
            }
        )

    def blocks_of(rows: DataFrame, count: int, per_block: int, name: str) -> tuple[DataFrame, int]:
        # Hash blocks of a mean size; a row's block depends on its id alone.
        number = max(1, -(-count // per_block))
        packed = (
            rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(number)))
            .groupBy("block")
            .applyInArrow(pack, "block bigint, ids binary, vectors binary, distances binary")
        )
        return stage_table(packed, name), number

    candidates, _ = blocks_of(grid, facts["rows"], candidate_block, "candidate-blocks")
    queries, n_queries = blocks_of(grid.filter("is_query"), facts["queries"], query_block, "query-blocks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(ids: bytes, rows: bytes, table: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            numbers = np.frombuffer(ids, dtype=np.int64)
            return (
                numbers,
                np.frombuffer(rows, dtype=np.int64).reshape(len(numbers), -1),
                np.frombuffer(table, dtype=np.float64).reshape(len(numbers), -1),
            )

        for batch in batches:
            for r in batch.to_pylist():
                found = list(
                    search_block(
                        side(r["query_ids"], r["query_vectors"], r["query_distances"]),
                        side(r["ids"], r["vectors"], r["distances"]),
                        k,
                    )
                )
                frame = pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    named = queries.select(
        F.col("block").alias("query_block"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("query_vectors"),
        F.col("distances").alias("query_distances"),
    )
    pairs = (
        candidates.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_queries - 1).cast("bigint"))))
        .repartition("query_block", "block")
        .join(broadcast_if_small(named, F.length("query_vectors") * 2), "query_block")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        pairs.mapInArrow(search, result)
        .dropDuplicates(["query_id", "vec_id", "score"])
        .withColumn("rank", rank)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
