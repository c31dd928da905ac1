"""Tab names, header rows and first data rows."""

import pytest
from books import grid, sheet
from pyspark.sql import functions as F

from tallyloom.operators import extract, sheets
from tallyloom.operators.catalog import sheet_catalog


@pytest.mark.parametrize(
    "name, valid",
    [(n, True) for n in ("6MM", "9MM", "12MM", "18MM", "20MM", "27MM", "33MM", "14mm", "35MM ", "6 mM")]
    + [(n, False) for n in ("sales form", "", "MM", "12", "6MMx", "x6MM")],
)
def test_thickness_tab(spark, name, valid):
    df = spark.createDataFrame([(name,)], "sheet string")
    assert df.select(extract.is_thickness_tab("sheet")).first()[0] is valid


HEADER_CASES = [
    ([("Date", "Items", "Specifications", "quantity")], 1),
    ([("INPUT", None, None, None, "OUTPUT"), ("Date", "Items", "Specifications", "quantity")], 2),
    ([("quantity", None), (None, "7", "x9"), (3, "Items only")], None),
    ([("DATE", " ITEMS ", "SPECIFICATIONS")], 1),
    ([("Date of items", "x"), ("items", "date", "specifications")], 2),
]


@pytest.mark.parametrize("rule", [sheets.ITEM_TOKENS, sheets.SPEC_TOKENS])
@pytest.mark.parametrize("rows, expected", HEADER_CASES)
def test_header_by_tokens(spark, rows, expected, rule):
    g = grid(spark, sheet("s", rows))
    assert sheets.sheet_facts(g, rule).first().header_row == expected


def test_three_header_rules(spark):
    rows = [("title",), (None, "  ", "x"), ("a", "b")]
    g = grid(spark, sheet("s", rows))
    assert sheets.sheet_facts(g, sheets.TWO_CELLS).first().header_row == 2
    assert sheets.sheet_facts(g, sheets.TWO_TEXTS).first().header_row == 3
    single = grid(spark, sheet("s", [("a",), (None,), ("b",)]))
    assert sheets.sheet_facts(single, sheets.TWO_CELLS).first().header_row is None
    assert sheets.staged_facts(single, first_if_none=True).first().header_row == 1


def test_catalog_metrics(spark):
    g = grid(spark, sheet("s", [("t",), (None, None), ("a", " ", None, 1), (None, 2.5)]))
    row = sheet_catalog(g).first()
    assert (row.total_rows, row.non_empty_rows, row.column_count, row.header_row) == (4, 3, 4, 3)


FIRST_CASES = [
    ([("stock of May",), ("date", "items"), (1, "21mm"), (2, "8mm")], (3, "21mm MDF")),
    ([("items", "DATE", "x"), (None, "\t"), ("y", None, 4), (5, " 3.5mm\n")], (4, "3.5mm MDF")),
    ([("Date", "Items"), (1, ""), (2, None)], None),
    ([("Date", "Items"), ("short",), ("d", "5mm")], (3, "5mm MDF")),
]


@pytest.mark.parametrize("rows, expected", FIRST_CASES)
def test_first_data_row(spark, rows, expected):
    g = grid(spark, sheet("s", rows))
    facts = sheets.staged_headers(g, sheets.ITEM_TOKENS)
    found = extract.first_rows(g, facts).select(
        "row_num", extract.board_name(F.col("cells")[1]["sval"]).alias("name")
    )
    got = found.first()
    assert (tuple(got) if got else None) == expected


@pytest.mark.parametrize("item", ["6mm", "9mm", "12mm", "18mm", "20mm", "27mm", "33mm", "14mm", "  9mm  "])
def test_board_name(spark, item):
    df = spark.createDataFrame([(item,)], "x string")
    assert df.select(extract.board_name(F.col("x"))).first()[0] == item.strip() + " MDF"


def test_variants_keep_first_seen_order(spark):
    specs = ["b*1*1", "a*1*1", "b*1*1", None, "c"]
    rows = [("Date", "Items", "Specifications")] + [("d", "x", s) for s in specs]
    tabs = extract.LedgerTabs(grid(spark, sheet("s", rows)))
    variants = extract.spec_variants(tabs.values).orderBy("first_row").collect()
    assert [(v.spec, v.first_row, v.n, v.is_canonical) for v in variants] == [
        ("b*1*1", 2, 2, True),
        ("a*1*1", 3, 1, False),
        ("c", 6, 1, False),
    ]
    summary = tabs.summary().first()
    assert (summary.spec, summary.variant_count) == ("b*1*1", 3)


def test_headers_and_mapping(spark):
    from books import supplier_sheets

    g = grid(spark, supplier_sheets(drop=("Return out",))[1])
    headers = extract.header_list(g)
    fields = extract.mapped_fields(headers, extract.field_mapping(spark)).orderBy("col_idx").collect()
    assert len(fields) == 16 and fields[1].field_key == "supplier_name"
    present = headers.select("source_id", "sheet", "sheet_idx").distinct()
    assert [r.header for r in extract.missing_headers(headers, present).collect()] == ["Return out"]
