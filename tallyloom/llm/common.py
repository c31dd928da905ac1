"""Helpers shared by the corpus operators: text rules, staging, size checks, arrays in rows."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.session import shared_dir, stage_table

# A side is broadcast only where its measured content stays below this many bytes.
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of one key beyond which a shuffled join deals them out over several tasks.
HOT_ROWS = 1 << 18
# Largest Arrow batch handed to a Python worker, so that long texts cannot fill its memory.
BATCH_BYTES = 8 * 1024 * 1024

# A word is a maximal run of anything but ASCII white space (space, 0x09 to 0x0D).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = [
    "BROADCAST_BYTES", "WORD_PATTERN", "ascii_lower", "bound", "bounded_batches", "broadcast_if_small", "crc_remainder",
    "join_facts", "lower_bytes", "read_table", "shared_dir", "stage_table", "text_batches", "text_slices", "tokens_of",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    As a lambda variable it stays one, also where a filter on the result is pushed below the
    projection: an alias would be put in place of each use, inside loops over words too.
    """
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. In texts of ASCII alone ``lower`` does the same, and faster."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def lower_bytes(piece: Column) -> Column:
    """Lower-cases the bytes A-Z of a binary; no byte of a longer UTF-8 character is one of them."""
    letters = F.translate(F.decode(piece, "ISO-8859-1"), _UPPER, _UPPER.lower())
    return F.encode(letters, "ISO-8859-1")


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def broadcast_if_small(df: DataFrame, width: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if ``width``, summed over its rows, is within ``limit``.

    ``df`` has to be a staged table: it is read once more here.
    """
    size = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first().b
    return F.broadcast(df) if size <= limit else df


def join_facts(
    df: DataFrame,
    facts: DataFrame,
    key: str,
    width: Column,
    rows: str | None = None,
    spread: Column | None = None,
    limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows of ``df`` with the columns of ``facts``, a staged table of one row per ``key``; null is a key.

    ``facts`` is broadcast if it measures small. Otherwise both are shuffled; where ``facts``
    counts in ``rows`` how many rows of ``df`` a key has, those of hot keys are dealt out by
    ``spread`` and the fact is copied to each share. ``rows`` is left out of the result.
    """
    placed = broadcast_if_small(facts, width, limit)
    named = placed.withColumnRenamed(key, "fact_key")
    same = F.col(key).eqNullSafe(F.col("fact_key"))
    if placed is not facts or rows is None:
        return df.join(named, same).drop("fact_key", *([rows] if rows else []))
    salts = F.ceil(F.col(rows) / hot_rows).cast("int")
    hot = facts.filter(F.col(rows) > hot_rows).select(F.col(key).alias("hot_key"), salts.alias("salts"))
    hot = broadcast_if_small(hot, F.lit(64))  # at most one per ``hot_rows`` rows
    salt = F.coalesce(F.pmod(F.xxhash64(spread), F.col("salts")), F.lit(0).cast("bigint"))
    dealt = df.join(hot, F.col(key).eqNullSafe(F.col("hot_key")), "left").withColumn("salt", salt).drop("hot_key", "salts")
    copies = named.withColumn("fact_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(salts, F.lit(1)).cast("bigint") - 1)))
    return dealt.join(copies, same & (F.col("salt") == F.col("fact_salt"))).drop("fact_key", "salt", "fact_salt", rows)


def bounded_batches(spark: SparkSession) -> None:
    """Limits the Arrow batches of this session by bytes, unless a tighter limit is set."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        now = int(spark.conf.get(key).rstrip("bB"))
    except ValueError:
        return  # given with a unit by the user
    if now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text after lower-casing A-Z. ``bytes`` methods treat ASCII alone."""
    return text.encode().lower().split() if text else []


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``most_bytes`` of text (one text may exceed it)."""
    for batch in batches:
        lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
        start, total = 0, 0
        for row, length in enumerate(lengths.tolist()):
            if total and total + length > most_bytes:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += length
        if start < batch.num_rows:
            yield batch.slice(start)


def text_batches(
    batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = 2 << 20
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """``text_slices`` and the texts of each."""
    for part in text_slices(batches, column, most_bytes):
        yield part, part.column(column).to_pylist()
