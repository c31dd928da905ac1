"""State kept as JSON documents and logs, read into the tables of this library."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.fixed_values import BOARD_SEED, STAGE_ITEMS, STAGE_SPECS
from tallyloom.operators.quarantine import split_key
from tallyloom.schemas import AUDIT, QUARANTINE, TRACKER, column_names, empty
from tallyloom.sources.json_split import json_members
from tallyloom.sources.registry import sources_of
from tallyloom.sources.store import path_exists, read_json_lines

_ENTRY = (
    "struct<filename:string,source_id:string,hash:string,size_bytes:bigint,status:string,"
    "processed_at:timestamp,loaded_at:timestamp>"
)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """A configuration document as ``(value)``; a missing file is an error."""
    return spark.read.text(path, wholetext=True)


def read_tracker(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """Tracker document ``{"files": {key: {...}}}`` as the entries of one stage, read by many tasks."""
    if not path_exists(spark, path):
        return empty(spark, TRACKER)
    member = F.concat(F.lit("{"), F.col("value"), F.lit("}"))
    return (
        json_members(spark, path, "files")
        .select(F.explode(F.from_json(member, F.lit(f"map<string,{_ENTRY}>"))).alias("file_key", "e"))
        .select(F.lit(stage).alias("stage"), "file_key", "e.*")
        .select(*column_names(TRACKER))
    )


def read_failure_log(
    spark: SparkSession, path: str, registry: DataFrame | None = None, sheets: DataFrame | None = None
) -> DataFrame:
    """Failure log in JSON lines with one key text per entry; bad lines are dropped.

    Board stages name a tab with its book. A log that knows tabs alone is translated through
    the registry: a tab becomes one key for each board book, and with ``sheets(source_id,
    sheet)`` only for books that have it, so that no key is left that no run can clear.
    """
    ddl = "script string, key string, reason string, detail string, timestamp timestamp"
    parent, child = split_key(F.col("script"), F.col("key"))
    log = (
        read_json_lines(spark, path, ddl)
        .select(
            "script",
            parent.alias("parent_key"),
            child.alias("child_key"),
            "reason",
            "detail",
            F.lit(0).cast("bigint").alias("seq"),
            F.col("timestamp").alias("ts"),
        )
        .select(*column_names(QUARANTINE))
    )
    if registry is None:
        return log
    scripts = [STAGE_ITEMS, STAGE_SPECS]
    books = sources_of(registry, BOARD_SEED).select(
        "source_id", F.explode(F.array(*[F.lit(s) for s in scripts])).alias("script")
    )
    keyed = log.filter(F.col("script").isin(scripts)).join(books, "script")
    if sheets is not None:
        there = sheets.select("source_id", F.col("sheet").alias("parent_key")).distinct()
        keyed = keyed.join(there, ["source_id", "parent_key"], "left_semi")
    translated = keyed.withColumn("parent_key", F.concat_ws("/", "source_id", "parent_key"))
    return log.filter(~F.col("script").isin(scripts)).unionByName(translated.select(*log.columns))


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    """Audit log in JSON lines."""
    ddl = AUDIT.replace("ts timestamp", "timestamp timestamp")
    return read_json_lines(spark, path, ddl).withColumnRenamed("timestamp", "ts")
