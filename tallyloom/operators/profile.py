"""Data-quality profile: types, nulls, duplicates and the issues that follow."""

from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.fixed_values import (
    MSG_DUPLICATES,
    MSG_EMPTY_SHEET,
    MSG_FLAG,
    MSG_FORMULAS,
    MSG_MIXED,
    MSG_NULLS,
    MSG_OK,
)
from tallyloom.functions.cells import has_filled, row_digest
from tallyloom.functions.text import trim_py
from tallyloom.operators.sheets import TWO_CELLS, data_rows, header_cells, staged_facts
from tallyloom.schemas import SHEET_KEYS
from tallyloom.session import stage_table

# Column position under which whole rows are counted, next to the real columns.
_ROW = -1
_FILLED_ROW, _EMPTY_ROW = "filled", "empty"


def profile_facts(grid: DataFrame, header_rule=TWO_CELLS) -> DataFrame:
    """Staged sheet facts under the profile's rule: the first row is header if none qualifies."""
    return staged_facts(grid, header_rule, first_if_none=True)


def cell_tallies(grid: DataFrame, facts: DataFrame, limit: int | None = None) -> DataFrame:
    """Count and first row per (sheet, column, tag) of the data rows.

    One scan that reads tags but no cell text, and one shuffle of partial counts. Each row
    also adds a tag at column -1, which gives the row counts without a second pass.
    """
    rows = data_rows(
        grid.select(*SHEET_KEYS, "row_num", F.col("cells.dtype").alias("dtypes")), facts, limit
    )
    row_tag = F.when(has_filled(F.col("dtypes")), _FILLED_ROW).otherwise(_EMPTY_ROW)
    tags = F.posexplode(F.concat(F.array(row_tag), F.col("dtypes"))).alias("pos", "dtype")
    return (
        rows.select(*SHEET_KEYS, "row_num", tags)
        .filter(F.col("dtype") != "null")
        .groupBy(*SHEET_KEYS, (F.col("pos") + _ROW).cast("bigint").alias("col_idx"), "dtype")
        .agg(F.count(F.lit(1)).alias("n"), F.min("row_num").alias("first_row"))
    )


def row_tallies(grid: DataFrame, facts: DataFrame, limit: int | None = None) -> DataFrame:
    """``cell_tallies`` and, as ``repeats``, how many rows of a record repeat an earlier one.

    One scan and one join with the facts: rows are first grouped by (sheet, digest, tags), as
    ``duplicate_rows`` needs them anyway, and the tags of each different row are then counted
    as often as it occurs. The tags travel as one short text, trailing nulls left out.
    """
    # Tags of null cells become empty; no other tag is.
    tags = F.rtrim(F.replace(F.array_join("cells.dtype", ","), F.lit("null"), F.lit("")), F.lit(","))
    rows = data_rows(
        grid.select(*SHEET_KEYS, "row_num", tags.alias("tags"), row_digest(F.col("cells")).alias("digest")), facts, limit
    )
    kinds = rows.groupBy(*SHEET_KEYS, "digest", "tags").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_num").alias("first_row")
    )
    row_tag = F.when(F.col("tags") != "", _FILLED_ROW).otherwise(_EMPTY_ROW)
    each = F.posexplode(F.concat(F.array(row_tag), F.split("tags", ","))).alias("pos", "dtype")
    return (
        kinds.select(*SHEET_KEYS, "n", "first_row", each)
        .filter(F.col("dtype") != "")
        .groupBy(*SHEET_KEYS, (F.col("pos") + _ROW).cast("bigint").alias("col_idx"), "dtype")
        .agg(
            F.sum("n").alias("n"),
            F.min("first_row").alias("first_row"),
            F.sum(F.col("n") - 1).alias("repeats"),
        )
    )


def tallied_duplicates(tallies: DataFrame) -> DataFrame:
    """What ``duplicate_rows`` gives, out of ``row_tallies``."""
    filled = tallies.filter((F.col("col_idx") == _ROW) & (F.col("dtype") == _FILLED_ROW))
    return filled.select(*SHEET_KEYS, F.col("repeats").alias("duplicate_row_count"))


def column_types(tallies: DataFrame) -> DataFrame:
    """Type distribution in long form, formula cells left out."""
    return tallies.filter((F.col("col_idx") >= 0) & (F.col("dtype") != "formula"))


def sheet_rows(tallies: DataFrame) -> DataFrame:
    """Data rows per sheet, all and non-empty."""
    return (
        tallies.filter(F.col("col_idx") == _ROW)
        .groupBy(*SHEET_KEYS)
        .agg(
            F.sum("n").alias("total_data_rows"),
            F.sum(F.when(F.col("dtype") == _FILLED_ROW, F.col("n")).otherwise(0)).alias(
                "non_empty_data_rows"
            ),
        )
    )


def column_names(
    grid: DataFrame, facts: DataFrame, limit: int | None = None, names: list[str] | None = None
) -> DataFrame:
    """Every column position of a sheet with its header text, or ``col_<i>`` where that is null.

    ``names`` are the columns of a table without header row, in place of its header.
    """
    positions = facts.filter("column_count > 0").select(
        *SHEET_KEYS, F.explode(F.sequence(F.lit(0), F.col("column_count") - 1)).alias("col_idx")
    )
    if names is not None:
        given = F.try_element_at(F.array(*[F.lit(n) for n in names]), (F.col("col_idx") + 1).cast("int"))
        return positions.withColumn("column", F.coalesce(given, F.concat(F.lit("col_"), F.col("col_idx"))))
    named = header_cells(grid, facts, limit).filter(F.col("dtype") != "null")
    return positions.join(
        named.select(*SHEET_KEYS, "col_idx", trim_py(F.col("sval")).alias("header")),
        [*SHEET_KEYS, "col_idx"],
        "left",
    ).select(
        *SHEET_KEYS,
        "col_idx",
        F.coalesce("header", F.concat(F.lit("col_"), F.col("col_idx"))).alias("column"),
    )


def column_profile(names: DataFrame, tallies: DataFrame) -> DataFrame:
    """Per column: nulls, dominant type, type distribution, formulas and consistency.

    Works on tallies, a few records per column; padding of short rows is arithmetic
    (nulls = rows - non-null cells). The distribution is a short list, one entry per tag.
    """
    plain = F.col("dtype") != "formula"
    entry = F.struct("first_row", "dtype", "n")
    per_column = (
        tallies.filter(F.col("col_idx") >= 0)
        .groupBy(*SHEET_KEYS, "col_idx")
        .agg(
            F.sum("n").alias("non_null_count"),
            F.sum(F.when(plain, 0).otherwise(F.col("n"))).alias("formula_cells"),
            F.array_sort(F.collect_list(F.when(plain, entry))).alias("types"),
            F.max_by(
                F.when(plain, F.col("dtype")),
                F.when(plain, F.struct(F.col("n"), -F.col("first_row"))),
            ).alias("dominant"),
        )
    )
    total = F.coalesce("total_data_rows", F.lit(0))
    nulls = F.col("total_data_rows") - F.col("non_null_count")
    return (
        names.join(sheet_rows(tallies), SHEET_KEYS, "left")
        .join(per_column, [*SHEET_KEYS, "col_idx"], "left")
        .withColumn("total_data_rows", total)
        .withColumn("non_null_count", F.coalesce("non_null_count", F.lit(0)))
        .select(
            *SHEET_KEYS,
            "col_idx",
            "column",
            "total_data_rows",
            nulls.alias("null_count"),
            F.when(
                F.col("total_data_rows") > 0,
                F.round(nulls / F.col("total_data_rows") * 100, 1),
            )
            .otherwise(0.0)
            .alias("null_pct"),
            "non_null_count",
            F.coalesce("dominant", F.lit("unknown")).alias("dominant_type"),
            F.coalesce("types", F.array().cast("array<struct<first_row:bigint,dtype:string,n:bigint>>")).alias(
                "types"
            ),
            F.coalesce("formula_cells", F.lit(0)).alias("formula_cells"),
        )
        .withColumn("type_distribution", F.map_from_entries(F.transform("types", lambda t: F.struct(t["dtype"], t["n"]))))
        .withColumn("type_inconsistent", F.size("types") > 1)
    )


def duplicate_rows(grid: DataFrame, facts: DataFrame, limit: int | None = None) -> DataFrame:
    """Per sheet: number of non-empty data rows that repeat an earlier one.

    Rows are grouped by (sheet, digest of the row without trailing nulls): a hot sheet
    spreads over its distinct rows, a hot row is counted map-side, and 32 bytes per row
    are shuffled instead of the row.
    """
    rows = data_rows(grid, facts, limit).filter(has_filled(F.col("cells.dtype")))
    return (
        rows.groupBy(*SHEET_KEYS, row_digest(F.col("cells")).alias("digest"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*SHEET_KEYS)
        .agg(F.sum(F.col("n") - 1).alias("duplicate_row_count"))
    )


def column_issues(columns: DataFrame) -> DataFrame:
    """Issue texts per column, in the order mixed types, nulls, formulas."""
    shown = F.array_join(
        F.transform("types", lambda t: F.printf(F.lit("'%s': %d"), t["dtype"], t["n"])), ", "
    )
    texts = F.array(
        F.when(F.col("type_inconsistent"), F.printf(F.lit(MSG_MIXED), F.col("column"), shown)),
        F.when(
            F.col("null_pct") > 50,
            F.printf(F.lit(MSG_NULLS), F.col("column"), F.col("null_pct").cast("string")),
        ),
        F.when(
            F.col("formula_cells") > 0,
            F.printf(F.lit(MSG_FORMULAS), F.col("column"), F.col("formula_cells")),
        ),
    )
    return columns.select(*SHEET_KEYS, "col_idx", F.posexplode(F.array_compact(texts)).alias("pos", "issue"))


def issue_rows(columns: DataFrame, duplicates: DataFrame) -> DataFrame:
    """All issues of a sheet, numbered by ``issue_no`` from 1: columns in order, then duplicates.

    A sheet has at most three issues per column, so the numbering window is small.
    """
    repeated = duplicates.filter("duplicate_row_count > 0").select(
        *SHEET_KEYS,
        F.lit(None).cast("bigint").alias("col_idx"),
        F.lit(0).alias("pos"),
        F.printf(F.lit(MSG_DUPLICATES), F.col("duplicate_row_count")).alias("issue"),
    )
    order = Window.partitionBy(*SHEET_KEYS).orderBy(F.col("col_idx").asc_nulls_last(), "pos")
    return (
        column_issues(columns)
        .unionByName(repeated)
        .select(*SHEET_KEYS, F.row_number().over(order).cast("bigint").alias("issue_no"), "issue")
    )


def sheet_report(
    facts: DataFrame,
    tallies: DataFrame,
    duplicates: DataFrame,
    issues: DataFrame,
    sheets: DataFrame | None = None,
) -> DataFrame:
    """One row per sheet with counts, flag and issue count.

    ``sheets`` lists sheets that may hold no row at all; those carry the error text and
    no issue count.
    """
    counts = issues.groupBy(*SHEET_KEYS).agg(F.count(F.lit(1)).alias("issue_count"))
    listed = facts.select(*SHEET_KEYS, "header_row", "column_count")
    if sheets is not None:
        listed = sheets.select(*SHEET_KEYS).join(listed, SHEET_KEYS, "left")
    empty = F.col("header_row").isNull()
    found = F.coalesce("issue_count", F.lit(0))
    return (
        listed.join(sheet_rows(tallies), SHEET_KEYS, "left")
        .join(duplicates, SHEET_KEYS, "left")
        .join(counts, SHEET_KEYS, "left")
        .select(
            *SHEET_KEYS,
            "header_row",
            "column_count",
            F.when(~empty, F.coalesce("total_data_rows", F.lit(0))).alias("total_data_rows"),
            F.when(~empty, F.coalesce("non_empty_data_rows", F.lit(0))).alias("non_empty_data_rows"),
            F.when(~empty, F.coalesce("duplicate_row_count", F.lit(0))).alias("duplicate_row_count"),
            F.when(~empty, found).alias("issue_count"),
            F.when(found == 0, MSG_OK).otherwise(F.printf(F.lit(MSG_FLAG), found)).alias("flag"),
            F.when(empty, MSG_EMPTY_SHEET).alias("error"),
        )
    )


def source_report(report: DataFrame) -> DataFrame:
    """Roll-up per source; a sheet without issue count adds none."""
    return report.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("sheet_count"),
        F.sum(F.coalesce("issue_count", F.lit(0))).alias("total_issues"),
    )


def profiled_sources(statuses: DataFrame, report: DataFrame) -> DataFrame:
    """Roll-up for every source of ``statuses``, also missing, unreadable and empty ones."""
    found = source_report(report)
    return statuses.select("source_id", "status", "error").join(found, "source_id", "left").select(
        "source_id",
        "status",
        "error",
        F.coalesce("sheet_count", F.lit(0)).alias("sheet_count"),
        F.coalesce("total_issues", F.lit(0)).alias("total_issues"),
    )


def quality_report(report: DataFrame, issues: DataFrame) -> DataFrame:
    """Report lines: one per issue, and one without text for a sheet in order."""
    return report.join(issues, SHEET_KEYS, "left").select(
        *SHEET_KEYS, "flag", "non_empty_data_rows", "issue_no", "issue"
    )


class Profile:
    """All profile tables of one grid, sharing the staged facts and tallies."""

    def __init__(
        self,
        grid: DataFrame,
        header_rule=TWO_CELLS,
        sheets: DataFrame | None = None,
        names: list[str] | None = None,
    ):
        self.facts = profile_facts(grid, header_rule)
        self.tallies = stage_table(row_tallies(grid, self.facts), "tallies")
        self.columns = stage_table(
            column_profile(column_names(grid, self.facts, names=names), self.tallies), "columns"
        )
        self.duplicates = tallied_duplicates(self.tallies)
        self.issues = issue_rows(self.columns, self.duplicates)
        self.sheets = sheet_report(self.facts, self.tallies, self.duplicates, self.issues, sheets)
        self.sources = source_report(self.sheets)
        self.report = quality_report(self.sheets, self.issues)
