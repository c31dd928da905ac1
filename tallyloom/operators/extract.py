"""Header-aware extraction of item names, specifications and header lists."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.fixed_values import (
    BOARD_SUFFIX,
    FIELD_MAPPING,
    ITEMS_COL,
    SPECS_COL,
    THICKNESS_TAB,
)
from tallyloom.functions.cells import cell_text
from tallyloom.functions.specs import parse_board_spec
from tallyloom.functions.text import is_blank, title_py, trim_py
from tallyloom.operators.scale import attach_sheet_facts, fits_broadcast, with_each
from tallyloom.operators.sheets import (
    SPEC_TOKENS,
    TWO_TEXTS,
    data_rows,
    header_cells,
    staged_headers,
)
from tallyloom.schemas import SHEET_KEYS
from tallyloom.session import stage_table



def is_thickness_tab(sheet) -> Column:
    """Tab names such as ``6MM``, ``14mm`` or ``35MM `` with its blank."""
    return (F.col(sheet) if isinstance(sheet, str) else sheet).rlike(THICKNESS_TAB)


def valid_tabs(grid: DataFrame, column: str = "sheet") -> DataFrame:
    return grid.filter(is_thickness_tab(column))


def ignored_tabs(grid: DataFrame, column: str = "sheet") -> DataFrame:
    return grid.filter(~is_thickness_tab(column))


def board_name(items: Column, suffix: str = BOARD_SUFFIX) -> Column:
    return F.concat(trim_py(items), F.lit(suffix))


def glue_name(items: Column) -> Column:
    return title_py(trim_py(items))


def distinct_values(
    grid: DataFrame, facts: DataFrame, columns: dict[str, int], limit: int | None = None
) -> DataFrame:
    """Distinct non-blank values of some columns below the header, with first row and count.

    One pass serves all columns. Grouping by (sheet, column, value) combines map-side, and
    spreads a hot sheet over its values.
    """
    picked = [
        F.struct(F.lit(kind).alias("kind"), cell_text(i).alias("text"))
        for kind, i in columns.items()
    ]
    rows = grid.select(*SHEET_KEYS, "row_num", F.array(*picked).alias("picked"))
    return (
        data_rows(rows, facts, limit)
        .select(*SHEET_KEYS, "row_num", F.inline("picked"))
        .withColumn("value", trim_py(F.col("text")))
        .filter(F.length("value") > 0)
        .groupBy(*SHEET_KEYS, "kind", "value")
        .agg(F.min("row_num").alias("first_row"), F.count(F.lit(1)).alias("n"))
    )


def first_values(values: DataFrame, kind: str) -> DataFrame:
    """First value of one kind per sheet, its row, and how many different values follow.

    Partial aggregates keep one candidate per task and sheet.
    """
    return (
        values.filter(F.col("kind") == kind)
        .groupBy(*SHEET_KEYS)
        .agg(
            F.min_by("value", "first_row").alias(kind),
            F.min("first_row").alias(f"{kind}_row"),
            F.count(F.lit(1)).alias(f"{kind}_variants"),
        )
    )


def first_rows(grid: DataFrame, facts: DataFrame, limit: int | None = None) -> DataFrame:
    """First row after the header with a non-blank Items cell, with all its cells.

    The row number is found by a number-only aggregate; the row itself is then fetched,
    with the largest such number pushed to the scan.
    """
    named = data_rows(
        grid.select(*SHEET_KEYS, "row_num", cell_text(ITEMS_COL).alias("items")), facts, limit
    ).filter(~is_blank(F.col("items")))
    starts = stage_table(
        named.groupBy(*SHEET_KEYS).agg(F.min("row_num").alias("row_num")), "first-rows"
    )
    deepest = starts.agg(F.max("row_num")).first()[0]
    rows = grid.filter(F.col("row_num") <= F.lit(-1 if deepest is None else deepest))
    return rows.join(starts, [*SHEET_KEYS, "row_num"])


def spec_variants(values: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct specifications per sheet in long form; ``first_row`` gives their order."""
    specs = values.filter(F.col("kind") == "spec")
    heads = stage_table(
        specs.groupBy(*SHEET_KEYS).agg(
            F.min("first_row").alias("first_row"),
            F.max("first_row").alias("last_row"),
            F.min("first_row").alias("head_row"),
            F.count(F.lit(1)).alias("variant_count"),
        ),
        "spec-heads",
    )
    return attach_sheet_facts(specs, heads, SHEET_KEYS, limit, position="first_row").select(
        *SHEET_KEYS,
        F.col("value").alias("spec"),
        "first_row",
        "n",
        "variant_count",
        (F.col("first_row") == F.col("head_row")).alias("is_canonical"),
    )


def bad_variants(variants: DataFrame, parse=parse_board_spec) -> DataFrame:
    """Specifications after the first that cannot be parsed; reported, never stopping."""
    return (
        variants.filter(~F.col("is_canonical"))
        .withColumn("error", parse(F.col("spec"))["error"])
        .filter(F.col("error").isNotNull())
    )


class LedgerTabs:
    """Header, first item and specifications of every sheet, from two passes over the grid."""

    def __init__(self, grid: DataFrame, tokens=SPEC_TOKENS, columns: dict[str, int] | None = None):
        """``columns`` limits what is looked at; a stage that needs items alone shuffles no specifications."""
        columns = columns or {"items": ITEMS_COL, "spec": SPECS_COL}
        self.facts = staged_headers(grid, tokens)
        self.values = stage_table(distinct_values(grid, self.facts, columns), "ledger-values")

    def summary(self, name=board_name) -> DataFrame:
        """Per sheet: item, name, canonical specification, variant count, and what is missing."""
        return (
            self.facts.select(*SHEET_KEYS, "header_row")
            .join(first_values(self.values, "items").drop("items_variants"), SHEET_KEYS, "left")
            .join(first_values(self.values, "spec"), SHEET_KEYS, "left")
            .select(
                *SHEET_KEYS,
                "header_row",
                "items",
                "items_row",
                name(F.col("items")).alias("display_name"),
                "spec",
                "spec_row",
                F.coalesce("spec_variants", F.lit(0)).alias("variant_count"),
                F.when(F.col("header_row").isNull(), "no header").alias("error"),
            )
        )


def parsed_specs(summary: DataFrame, parse=parse_board_spec) -> DataFrame:
    """Canonical specification of every sheet that has one, parsed."""
    return summary.filter(F.col("spec").isNotNull()).withColumn("parsed", parse(F.col("spec")))


def header_list(grid: DataFrame, limit: int | None = None) -> DataFrame:
    """Header texts of every sheet: first row with two non-blank cells, blanks left out."""
    facts = staged_headers(grid, TWO_TEXTS)
    return (
        header_cells(grid, facts, limit)
        .filter(~is_blank(F.col("sval")))
        .select(*SHEET_KEYS, "header_row", "col_idx", trim_py(F.col("sval")).alias("header"))
    )


def field_mapping(spark) -> DataFrame:
    """The fixed mapping of supplier headers to field definitions."""
    return spark.createDataFrame(
        list(FIELD_MAPPING),
        "field_name string, field_key string, field_type string, is_required boolean",
    )


def missing_headers(headers: DataFrame, sheets: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Headers of ``expected(field_name, ...)``, by default the fixed mapping, that a sheet does not have."""
    expected = field_mapping(headers.sparkSession) if expected is None else expected
    names = stage_table(expected.select(F.col("field_name").alias("header")).distinct(), "expected-headers")
    wanted = with_each(sheets.select(*SHEET_KEYS), names, SHEET_KEYS)
    return wanted.join(headers.select(*SHEET_KEYS, "header"), [*SHEET_KEYS, "header"], "left_anti")


def mapped_fields(headers: DataFrame, mapping: DataFrame) -> DataFrame:
    """Headers found in the mapping, in sheet order (``col_idx``); matching is case-sensitive."""
    names = stage_table(mapping.withColumnRenamed("field_name", "header"), "mapping")
    return headers.join(F.broadcast(names) if fits_broadcast(names) else names, "header").select(
        *SHEET_KEYS,
        "col_idx",
        F.col("header").alias("field_name"),
        "field_key",
        "field_type",
        "is_required",
    )


def preview(grid: DataFrame, rows: int = 5) -> DataFrame:
    """First rows of each sheet."""
    return grid.filter(F.col("row_num") <= rows)
