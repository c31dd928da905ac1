"""Grids from plain Python rows, and the documented ledgers as a small fixture."""

from datetime import datetime

from tallyloom import fixed_values as fixed
from tallyloom.schemas import GRID, REGISTRY, struct_type

# filename, source_id, seed_type, base_uom, description
BOOKS = (
    ("Stock management.xlsx", "stock_management", fixed.BOARD_SEED, None, "boards"),
    ("GLUE RECORD-1.xlsx", "glue_record", fixed.GLUE_SEED, "bags", "glue"),
    ("Tree log suppliers Book.xlsx", "tree_log_suppliers", fixed.SUPPLIER_SEED, None, "logs"),
)


def registry(spark):
    return spark.createDataFrame([(*b, i) for i, b in enumerate(BOOKS)], struct_type(REGISTRY))


def tag(value):
    """Type tag of a Python value, spelled out independently of the library."""
    if value is None:
        return "null"
    if isinstance(value, datetime):
        return "datetime"
    if isinstance(value, str):
        return "formula" if value.strip().startswith("=") else "str"
    return type(value).__name__


def cell(value):
    return (tag(value), None if value is None else str(value))


def sheet(name, rows, source="book", idx=0):
    return [(source, name, idx, n, [cell(v) for v in row]) for n, row in enumerate(rows, 1)]


def grid(spark, *sheets):
    return spark.createDataFrame([r for s in sheets for r in s], struct_type(GRID))


TITLE = ("INPUT", None, None, None, "OUTPUT")
HEADER = ("Date", "Items", "Specifications", "quantity", "balance")

# tab, item, specifications
BOARD_TABS = [
    ("6MM", "6mm", ["0.6*122*244", "0.6*122*245", "0.6*122*246"]),
    ("9MM", "9mm", ["0.9*122*244"]),
    ("12MM", "12mm", ["1.2*122*244"]),
    ("18MM", "18mm", ["1.8*122*244"]),
    ("20MM", "20mm", ["0.9*122*244"]),
    ("27MM", "27mm", ["2.7*122*244"]),
    ("33MM", "33mm", ["3.3*122*244"]),
    ("35MM ", "33mm", ["3.5*122*244"]),
    ("14mm", "14mm", ["1.4*122*244"]),
]


def board_sheets(source="stock_management", tabs=BOARD_TABS):
    sheets = []
    for idx, (name, item, specs) in enumerate(tabs):
        rows = [TITLE, HEADER] + [("2025-01-01", item, s, 5, "=D3") for s in specs]
        sheets.append(sheet(name, rows, source, idx))
    sheets.append(sheet("sales form", [("Sold", "To")], source, len(tabs)))
    return sheets


def glue_sheets(source="glue_record", spec="25kg/1bag"):
    rows = [TITLE, HEADER, ("2025-01-01", " glue ", spec, 5, None)]
    return [sheet("GLUE A , B, C and D", rows, source, 0)]


def supplier_sheets(source="tree_log_suppliers", drop=()):
    from tallyloom.fixed_values import FIELD_MAPPING, SUPPLIER_SHEET

    names = [n + (" " if n == "Supplier name" else "") for n, *_ in FIELD_MAPPING if n not in drop]
    rows = [("Trucks",), (None,), (None, "  "), (None, *names, "Remarks"), (None, "2025-01-01", "A")]
    return [
        sheet("Production summary", [("a", "b")], source, 0),
        sheet(SUPPLIER_SHEET, rows, source, 1),
    ]
