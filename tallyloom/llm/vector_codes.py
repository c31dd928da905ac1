"""Vector compression by product codes, with an equal-average search for the nearest entry."""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.llm.common import BROADCAST_BYTES, HOT_ROWS, bounded_batches, join_facts, stage_table
from tallyloom.llm.topk import grid_vector, usable

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest entry of each part; ties go to the lower number.

    Entries are sorted by the sum of their components. From the place of a part's own sum the
    search goes outward, the smaller gap of sums first, and ends when the squared gap divided
    by the dimension is larger than the best distance: no entry further out can be as near.
    """
    width = parts.shape[1]
    sums = entries.sum(axis=1)
    order = np.lexsort((np.arange(len(entries)), sums))
    sorted_sums = sums[order]
    own = parts.sum(axis=1)
    right = np.searchsorted(sorted_sums, own)
    left = right - 1
    far = np.iinfo(np.int64).max
    best = np.full(len(parts), far, dtype=np.int64)
    number = np.full(len(parts), len(entries), dtype=np.int64)
    active = np.arange(len(parts))
    while len(active):
        at_left, at_right, mean = left[active], right[active], own[active]
        below = np.where(at_left >= 0, mean - sorted_sums[np.maximum(at_left, 0)], far)
        above = np.where(at_right < len(entries), sorted_sums[np.minimum(at_right, len(entries) - 1)] - mean, far)
        gap = np.minimum(below, above)
        known = best[active]
        more = gap < far
        # A first entry is always looked at; the products stay below 2^63, see ``train``.
        more &= (known == far) | (np.where(more, gap, 0) ** 2 <= np.where(known == far, 0, known) * width)
        active, take_left = active[more], (below <= above)[more]
        if not len(active):
            break
        place = np.where(take_left, left[active], right[active])
        entry = order[place]
        apart = parts[active] - entries[entry]
        distance = (apart * apart).sum(axis=1)
        better = (distance < best[active]) | ((distance == best[active]) & (entry < number[active]))
        best[active[better]], number[active[better]] = distance[better], entry[better]
        left[active[take_left]] -= 1
        right[active[~take_left]] += 1
    return number, best


@dataclass(frozen=True)
class Codebooks:
    """Entries as whole numbers, by part, entry and position in the part; ``width`` of the vectors without padding."""

    entries: np.ndarray
    width: int
    scale: int

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _padded(grid: Column, width: int) -> Column:
    """The grid with zeros up to ``width`` components."""
    return F.when(F.size(grid) == width, grid).otherwise(
        F.concat(grid, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(grid)))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, width)


def grid_rows(vectors: DataFrame, vector_column: str, scale: int) -> DataFrame:
    """Staged ``row`` and ``grid`` of the vectors that take part: floor(scale * x) of each component."""
    vector = F.col(f"`{vector_column}`")
    kept = vectors.filter(usable(vector))
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("row"), grid_vector(vector, scale).alias("grid"))
    return stage_table(rows, "code-grid")


def train(
    rows: DataFrame, id_column: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> Codebooks:
    """Codebooks of the staged ``rows`` (see ``grid_rows``).

    Each round, tasks assign the parts they hold and add them up per entry; these sums, a
    fixed number per task, are added in Spark, and one row per entry reaches the driver.
    """
    size = F.size("grid")
    largest = F.array_max(F.transform("grid", lambda x: F.abs(x)))
    facts = rows.agg(F.max(size).alias("width"), F.max(largest).alias("largest"), F.count("*").alias("n")).first()
    width, largest = facts.width or 0, facts.largest or 0
    part_width = max(1, -(-width // parts))
    if (2 * largest * part_width) ** 2 >= 1 << 63 or facts.n * largest >= 1 << 63:
        raise ValueError(f"components of up to {largest / scale:g} are too large for whole-number distances at scale {scale}")
    placed = rows.select(_padded(F.col("grid"), parts * part_width).alias("grid"), F.col(f"row.`{id_column}`").alias("id"))
    seeds = placed.orderBy(F.asc_nulls_last("id"), "grid").limit(entries).collect()  # a fixed number of rows
    books = np.array([r.grid for r in seeds], dtype=np.int64).reshape(len(seeds), parts, part_width).transpose(1, 0, 2)
    result = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("part", "entry", "n")] + [T.StructField("sums", T.ArrayType(T.LongType()))]
    )
    for _ in range(rounds if len(seeds) else 0):

        def add_up(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(books.shape[:2], dtype=np.int64)
            sums = np.zeros_like(books)
            for batch in batches:
                matrix = _matrix(batch["grid"], parts * part_width)
                for part in range(parts):
                    own = matrix[:, part * part_width : (part + 1) * part_width]
                    number, _ = nearest(own, books[part])
                    counts[part] += np.bincount(number, minlength=books.shape[1])
                    np.add.at(sums[part], number, own)
            used = [(p, e) for p, e in np.argwhere(counts).tolist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([p for p, _ in used], pa.int64()),
                    "entry": pa.array([e for _, e in used], pa.int64()),
                    "n": pa.array([int(counts[u]) for u in used], pa.int64()),
                    "sums": pa.array([sums[u].tolist() for u in used], pa.list_(pa.int64())),
                }
            )

        totals = (
            placed.select("grid")
            .mapInArrow(add_up, result)
            .groupBy("part", "entry")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(part_width)]).alias("sums"))
        )
        books = books.copy()
        for r in totals.collect():  # one row per part and entry
            books[r.part, r.entry] = np.array(r.sums, dtype=np.int64) // r.n
    return Codebooks(books, width, scale)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``row``, ``code`` (two hex digits or more per part) and ``error`` of the staged ``rows``."""
    parts, entries, part_width = books.entries.shape
    digits = max(2, len(f"{max(entries - 1, 0):x}"))
    table = books.entries

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([f"{e:0{digits}x}" for e in range(entries)])
        for batch in batches:
            matrix = _matrix(batch["grid"], parts * part_width)
            error, code = np.zeros(len(matrix), dtype=np.int64), np.full(len(matrix), "")
            for part in range(parts):
                number, distance = nearest(matrix[:, part * part_width : (part + 1) * part_width], table[part])
                error += distance
                code = np.char.add(code, names[number]) if len(matrix) else code
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(code.tolist(), pa.string()), pa.array(error, pa.int64())], ["row", "code", "error"]
            )

    fields = [rows.schema["row"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    placed = rows.select("row", _padded(F.col("grid"), parts * part_width).alias("grid"))
    return placed.mapInArrow(assign, T.StructType(fields))


def compress(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """``row`` (a struct of all input columns), ``code`` and ``error`` of every vector; the codebooks.

    Components become floor(scale * x). Vectors are cut into ``parts`` equal parts; the
    codebook of a part starts as that part of the ``entries`` smallest ids, and each round
    replaces an entry by the mean, rounded down, of the parts nearest to it; unused entries
    stay. ``code`` has the number of each part's entry, ``error`` the squared distances in all.

    Rows whose vector is null or holds null or non-finite components are left out. A null
    id comes last among the seeds; equal ids are ordered by their vectors. Fewer rows than
    ``entries`` make smaller codebooks. Vectors that are shorter than the longest one, or
    whose length the number of parts does not divide, count as padded with zeros. Repeated
    rows each count. Very long vectors only need wider parts. An empty table gives an empty
    result and codebooks without entries. Components so large that distances leave 63 bits
    raise a ValueError. Input columns, being in ``row``, clash with none made here.
    """
    bounded_batches(vectors.sparkSession)
    rows = grid_rows(vectors, vector_column, scale)
    books = train(rows, id_column, parts, entries, rounds, scale)
    return encode(rows, books), books


def with_group_error(
    coded: DataFrame, key: Column, broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``coded`` with ``group_error``: its errors summed over rows of an equal ``key``, nulls together.

    Sums are made with map-side partials. They are broadcast where they measure small, and
    joined with rows of hot keys dealt out otherwise.
    """
    keyed = stage_table(coded.withColumn("group_key", key), "coded")
    sums = stage_table(
        keyed.groupBy("group_key").agg(F.sum("error").alias("group_error"), F.count("*").alias("group_rows")), "group-errors"
    )
    width = F.coalesce(F.octet_length(F.col("group_key").cast("string")), F.lit(0)) + 24
    return join_facts(
        keyed, sums, "group_key", width, "group_rows", F.struct("code", "error"), broadcast_bytes, hot_rows
    ).drop("group_key")
