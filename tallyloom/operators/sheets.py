"""Facts about whole sheets: sizes and header rows, in one aggregate over the grid."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.fixed_values import ITEM_HEADER_TOKENS, SPEC_HEADER_TOKENS
from tallyloom.functions.cells import filled_count, has_filled, has_tokens, text_count
from tallyloom.operators.scale import attach_sheet_facts
from tallyloom.schemas import SHEET_KEYS
from tallyloom.session import stage_table

TWO_CELLS = "two_cells"  # at least two non-null cells, blank text counts
TWO_TEXTS = "two_texts"  # at least two cells that are not blank
NO_HEADER = "no_header"  # a table whose rows are all data
ITEM_TOKENS = ITEM_HEADER_TOKENS
SPEC_TOKENS = SPEC_HEADER_TOKENS


def is_header(rule, dtypes: Column | None = None, svals: Column | None = None) -> Column:
    """Whether a grid row qualifies as header: a rule name, or the words it has to contain."""
    dtypes = F.col("cells.dtype") if dtypes is None else dtypes
    svals = F.col("cells.sval") if svals is None else svals
    if rule == NO_HEADER:
        return F.lit(False)
    if rule == TWO_CELLS:
        return filled_count(dtypes) >= 2
    if rule == TWO_TEXTS:
        return (filled_count(dtypes) >= 2) & (text_count(svals) >= 2)
    return has_tokens(svals, rule)


def sheet_facts(grid: DataFrame, rule=TWO_CELLS) -> DataFrame:
    """Per sheet: row range, row counts, width and ``header_row`` (null if there is none).

    All buffers are numbers, so the whole thing is one hash aggregate with map-side
    partials: a sheet with a third of all rows costs its tasks one record each. Tags and
    texts are projected first; what the rule does not use is neither read nor built.
    """
    rows = grid.select(
        *SHEET_KEYS,
        "row_num",
        F.col("cells.dtype").alias("dtypes"),
        F.col("cells.sval").alias("svals"),
    )
    dtypes, svals = F.col("dtypes"), F.col("svals")
    return rows.groupBy(*SHEET_KEYS).agg(
        F.min("row_num").alias("first_row"),
        F.max("row_num").alias("last_row"),
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(has_filled(dtypes)).alias("non_empty_rows"),
        F.coalesce(F.max(F.size(dtypes)), F.lit(0)).cast("bigint").alias("column_count"),
        F.min(F.when(is_header(rule, dtypes, svals), F.col("row_num"))).alias("header_row"),
    )


def staged_facts(grid: DataFrame, rule=TWO_CELLS, first_if_none: bool = False) -> DataFrame:
    """Facts written once for reuse; optionally the first row stands in for a missing header.

    Without any header (``NO_HEADER``) its place is before the first row, so all rows are data.
    """
    facts = sheet_facts(grid, rule)
    if rule == NO_HEADER:
        facts = facts.withColumn("header_row", F.col("first_row") - 1)
    elif first_if_none:
        facts = facts.withColumn("header_row", F.coalesce("header_row", "first_row"))
    return stage_table(facts, "sheet-facts")


def staged_headers(grid: DataFrame, rule) -> DataFrame:
    """Row range and header row only: counts that nobody reads are not computed."""
    facts = sheet_facts(grid, rule).select(*SHEET_KEYS, "first_row", "last_row", "header_row")
    return stage_table(facts, "sheet-headers")


def data_rows(rows: DataFrame, facts: DataFrame, limit: int | None = None) -> DataFrame:
    """Rows after the header of their sheet; sheets without header give none."""
    known = facts.filter(F.col("header_row").isNotNull()).select(
        *SHEET_KEYS, "first_row", "last_row", "header_row"
    )
    return attach_sheet_facts(rows, known, SHEET_KEYS, limit, part_of=facts).filter(
        F.col("row_num") > F.col("header_row")
    )


def header_cells(grid: DataFrame, facts: DataFrame, limit: int | None = None) -> DataFrame:
    """Cells of each sheet's header row, in long form.

    The largest header row number goes to the scan as a pushed filter, so row groups
    further down a sheet are not read.
    """
    known = facts.filter(F.col("header_row").isNotNull())
    deepest = known.agg(F.max("header_row").alias("r")).first().r
    rows = grid.filter(F.col("row_num") <= F.lit(-1 if deepest is None else deepest))
    places = known.select(*SHEET_KEYS, "first_row", "last_row", "header_row")
    headed = attach_sheet_facts(rows, places, SHEET_KEYS, limit, part_of=facts).filter(F.col("row_num") == F.col("header_row"))
    return headed.select(
        *SHEET_KEYS, "header_row", F.posexplode("cells").alias("pos", "cell")
    ).select(
        *SHEET_KEYS,
        "header_row",
        F.col("pos").cast("bigint").alias("col_idx"),
        F.col("cell.dtype").alias("dtype"),
        F.col("cell.sval").alias("sval"),
    )
