"""Catalog of sources and their sheets."""

from pyspark.sql import DataFrame, functions as F

from tallyloom.operators.sheets import TWO_CELLS, sheet_facts
from tallyloom.schemas import SHEET_KEYS


def sheet_catalog(grid: DataFrame) -> DataFrame:
    """Per sheet: total and non-empty rows, width, first row with two cells (null if none)."""
    return sheet_facts(grid, TWO_CELLS).select(
        *SHEET_KEYS, "total_rows", "non_empty_rows", "column_count", "header_row"
    )


def with_blank_sheets(catalog: DataFrame, sheets: DataFrame) -> DataFrame:
    """Catalog with an entry of zeros for each of ``sheets`` that holds no row, which a grid cannot show."""
    none = F.lit(0).cast("bigint")
    blank = sheets.select(*SHEET_KEYS).distinct().join(catalog, SHEET_KEYS, "left_anti")
    return catalog.unionByName(
        blank.select(
            *SHEET_KEYS,
            none.alias("total_rows"),
            none.alias("non_empty_rows"),
            none.alias("column_count"),
            F.lit(None).cast("bigint").alias("header_row"),
        )
    )


def source_catalog(statuses: DataFrame, sheets: DataFrame) -> DataFrame:
    """One row per registered source: status, path, size in KB and number of sheets.

    ``statuses`` is the output of ``sources.files.source_status``. The sheets stay in
    their own table (same ``source_id``) instead of one nested list per source.
    """
    counts = sheets.groupBy("source_id").agg(F.count(F.lit(1)).alias("sheet_count"))
    ok = F.col("status") == "ok"
    return statuses.join(counts, "source_id", "left").select(
        "source_id",
        "filename",
        "seed_type",
        "base_uom",
        "description",
        "status",
        "error",
        F.when(ok, F.col("file_key")).alias("path"),
        F.when(ok, F.round(F.col("size_bytes") / 1024, 1)).alias("file_size_kb"),
        F.when(ok, F.coalesce("sheet_count", F.lit(0))).alias("sheet_count"),
    )


def outcome_counts(outcomes: DataFrame, column: str = "outcome") -> DataFrame:
    """Run counters, such as processed against skipped."""
    return outcomes.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
