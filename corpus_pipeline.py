"""The corpus pipeline: quality, exact dedup, near dedup, mixing and encoding of ``documents``.

Each stage takes what the one before kept, written as Parquet and read again.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm.bpe import encode_texts
from tallyloom.llm.common import crc_remainder, read_table, stage_table
from tallyloom.llm.exact_dedup import exact_groups
from tallyloom.llm.mixing import mix_sources, mixed_rows
from tallyloom.llm.near_dedup import keep_one_of_each
from tallyloom.llm.quality import THRESHOLD, quality_scores
from tallyloom.llm.queries import tokenizer_path

# What the last stage adds; input columns of these names give way to them.
ENCODED = ("n_tokens", "ids", "decoded")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; empty texts are judged like others."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    scored = quality_scores(docs, labels, crc_remainder(F.col("doc_id"), 5) != 0)
    return scored.filter(F.col("score") >= THRESHOLD).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id."""
    return exact_groups(docs).filter("kept").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled over its shards."""
    return mixed_rows(mix_sources(docs)).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their tokens, and what these decode to."""
    ours = [F.col(f"row.`{c}`") for c in docs.columns if c not in ENCODED]
    return encode_texts(docs, tokenizer_path()).select(
        *ours, F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mix", mix),
    ("encode", encode),
]

# Learnt weights, minhashes, random draws and BPE merges are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each leaves is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
