"""Change tracking: which inputs are new or changed, and what became of the others.

Entries are kept per (stage, file), so cataloging a file does not hide its change from
profiling. Both sides of every join are unique on the file key.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.fixed_values import LOADED, PENDING, PROCESSED
from tallyloom.operators.scale import keep_keys
from tallyloom.schemas import TRACKER, column_names

_COLUMNS = column_names(TRACKER)


def _status(column="status") -> Column:
    return F.coalesce(F.col(column), F.lit(PENDING))


def of_stage(tracker: DataFrame, stage: str) -> DataFrame:
    return tracker.filter(F.col("stage") == stage)


def with_state(files: DataFrame, tracker: DataFrame, force: bool = False) -> DataFrame:
    """Files with their tracked ``status`` (pending by default) and ``needs_processing``.

    ``files(file_key, hash, size_bytes, ...)`` has a null size for a file that is not there;
    it needs no processing. ``force`` selects every file, so that a missing one is reported
    again. Asking for the size and not for the hash keeps the filter that Spark pushes below
    the join from hashing all content a second time.
    """
    known = tracker.select(
        "file_key",
        F.col("hash").alias("known_hash"),
        F.col("status").alias("known_status"),
        F.lit(True).alias("tracked"),
    )
    status = _status("known_status")
    stale = (
        F.col("tracked").isNull()
        | ~F.col("hash").eqNullSafe(F.col("known_hash"))
        | ~status.isin(PROCESSED, LOADED)
    )
    needs = F.lit(True) if force else F.col("size_bytes").isNotNull() & stale
    return (
        files.join(known, "file_key", "left")
        .withColumn("status", status)
        .withColumn("needs_processing", needs)
        .drop("known_hash", "known_status", "tracked")
    )


def unprocessed(files: DataFrame, tracker: DataFrame, force: bool = False) -> DataFrame:
    """Only the files that need processing."""
    return with_state(files, tracker, force).filter("needs_processing").select(*files.columns)


def needs_loading(files: DataFrame, tracker: DataFrame) -> DataFrame:
    """Files that are processed but not loaded."""
    ready = tracker.filter(F.col("status") == PROCESSED).select("file_key")
    return files.join(ready, "file_key", "left_semi")


def status_summary(tracker: DataFrame) -> DataFrame:
    """Number of tracked files per status."""
    return tracker.groupBy(_status().alias("status")).agg(F.count(F.lit(1)).alias("n"))


def _upsert(tracker: DataFrame, stage: str, changes: DataFrame) -> DataFrame:
    """Full outer join by file; a null in ``changes`` keeps the tracked value."""
    given = [c for c in changes.columns if c != "file_key"]
    new = changes.select("file_key", *[F.col(c).alias(f"new_{c}") for c in given])
    merged = of_stage(tracker, stage).drop("stage").join(new, "file_key", "full_outer")
    columns = [
        F.coalesce(f"new_{c}", c).alias(c) if c in given else F.col(c)
        for c in _COLUMNS
        if c != "stage"
    ]
    other = tracker.filter(~F.col("stage").eqNullSafe(F.lit(stage))).select(*_COLUMNS)
    return merged.select(F.lit(stage).alias("stage"), *columns).select(*_COLUMNS).unionByName(other)


def mark_processed(
    tracker: DataFrame, stage: str, files: DataFrame, run_ts: Column, keep_loaded: bool = False
) -> DataFrame:
    """Refresh hash, size and status of ``files(file_key, filename, source_id, hash, size_bytes)``.

    Other tracked fields stay. With ``keep_loaded`` an entry that is already loaded is left
    as it is (the profile's rule).
    """
    if keep_loaded:
        loaded = of_stage(tracker, stage).filter(F.col("status") == LOADED).select("file_key")
        files = files.join(loaded, "file_key", "left_anti")
    changes = files.select(
        "file_key",
        "filename",
        "source_id",
        "hash",
        "size_bytes",
        F.lit(PROCESSED).alias("status"),
        run_ts.alias("processed_at"),
    )
    return _upsert(tracker, stage, changes)


def mark_loaded(tracker: DataFrame, stage: str, files: DataFrame, run_ts: Column) -> DataFrame:
    """Set the status only; the hash stays, and an unknown file gets an entry without one."""
    changes = files.select(
        "file_key", F.lit(LOADED).alias("status"), run_ts.alias("loaded_at")
    )
    return _upsert(tracker, stage, changes)


def reset(tracker: DataFrame, stage: str, files: DataFrame) -> DataFrame:
    """Back to pending, keeping hash and times."""
    return _upsert(tracker, stage, files.select("file_key", F.lit(PENDING).alias("status")))


def carry_forward(
    sources: DataFrame, prior: DataFrame, key: str = "source_id"
) -> tuple[DataFrame, DataFrame]:
    """Split a run: sources to process now, and prior results of the unchanged ones.

    ``sources(key, needs_processing, ...)``. An unchanged source without prior result is
    processed anyway.
    """
    unchanged = sources.filter(~F.col("needs_processing"))
    have = prior.select(key).distinct()
    spread = [c for c, t in prior.dtypes if c != key and t in ("string", "bigint", "int")] or [key]
    kept = keep_keys(prior, unchanged, [key], spread)
    again = unchanged.join(have, key, "left_anti")
    return sources.filter("needs_processing").unionByName(again), kept
