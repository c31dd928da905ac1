"""Table contracts shared by all operators."""

from pyspark.sql import types as T

CELL = "struct<dtype:string,sval:string>"
GRID = f"source_id string, sheet string, sheet_idx bigint, row_num bigint, cells array<{CELL}>"
REGISTRY = (
    "filename string, source_id string, seed_type string, base_uom string, description string, "
    "source_no bigint"
)
SHEET_CATALOG = (
    "source_id string, sheet string, sheet_idx bigint, total_rows bigint, non_empty_rows bigint, "
    "column_count bigint, header_row bigint"
)
SOURCE_CATALOG = (
    "source_id string, filename string, seed_type string, base_uom string, description string, "
    "status string, error string, path string, file_size_kb double, sheet_count bigint"
)
SHEET_REPORT = (
    "source_id string, sheet string, sheet_idx bigint, header_row bigint, column_count bigint, "
    "total_data_rows bigint, non_empty_data_rows bigint, duplicate_row_count bigint, "
    "issue_count bigint, flag string, error string"
)
SOURCE_REPORT = "source_id string, status string, error string, sheet_count bigint, total_issues bigint"
COLUMN_REPORT = (
    "source_id string, sheet string, sheet_idx bigint, col_idx bigint, column string, "
    "total_data_rows bigint, null_count bigint, null_pct double, non_null_count bigint, "
    "dominant_type string, types array<struct<first_row:bigint,dtype:string,n:bigint>>, "
    "formula_cells bigint, type_distribution map<string,bigint>, type_inconsistent boolean"
)
ISSUES = "source_id string, sheet string, sheet_idx bigint, issue_no bigint, issue string"
LISTING = "file_key string, hash string, size_bytes bigint"
TRACKER = (
    "stage string, file_key string, filename string, source_id string, hash string, size_bytes bigint, "
    "status string, processed_at timestamp, loaded_at timestamp"
)
ITEMS = (
    "item_id bigint, display_name string, category string, base_uom string, "
    "reorder_threshold int, created_at timestamp, updated_at timestamp"
)
PROPERTIES = (
    "item_id bigint, property_name string, property_value decimal(12,4), created_at timestamp"
)
FIELDS = (
    "item_id bigint, field_name string, field_key string, field_type string, "
    "is_required boolean, created_at timestamp"
)
QUARANTINE = (
    "script string, parent_key string, child_key string, reason string, detail string, "
    "seq bigint, ts timestamp"
)
AUDIT = (
    "script string, material string, field string, old_value bigint, new_value bigint, "
    "action string, ts timestamp"
)
MANIFEST = (
    "script string, source_id string, mode string, loaded_at timestamp, "
    "summary map<string,bigint>"
)

SHEET_KEYS = ["source_id", "sheet", "sheet_idx"]


def struct_type(ddl: str) -> T.StructType:
    """The ``StructType`` behind one of the DDL strings above."""
    return T.StructType.fromDDL(ddl)


def column_names(ddl: str) -> list[str]:
    """Column names of a contract, known without a session."""
    return [column.split()[0] for column in ddl.split(", ")]


def empty(spark, ddl: str):
    """An empty DataFrame of a contract."""
    return spark.createDataFrame([], struct_type(ddl))
