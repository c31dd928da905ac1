"""Values that have to be exactly these for results to be comparable.

Nothing here is logic: word lists, lookup tables, patterns and message formats.
"""

# --- fixed values: sheet and header recognition -------------------------------
THICKNESS_TAB = r"(?U)^\d+\s*[Mm]{2}\s*$"
ITEM_HEADER_TOKENS = ("items", "date")
SPEC_HEADER_TOKENS = ("items", "specifications")
ITEMS_COL = 1
SPECS_COL = 2
SUPPLIER_SHEET = "Received tree logs trucks"

# --- fixed values: what Python counts as white space in str.strip -------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: master data defaults ---------------------------------------
CATEGORY = "Raw Material"
BOARD_UOM = "sheets (pcs)"
DEFAULT_UOM = "units"
BOARD_SUFFIX = " MDF"
BOARD_PROPERTIES = ("thickness", "width", "length")
GLUE_PROPERTIES = ("weight_per_bag_kg", "bags_per_unit")
GLUE_SPEC = r"(?iU)^(\d+(?:\.\d+)?)kg/(\d+)bag$"

# --- fixed values: seed types ---------------------------------------------------
BOARD_SEED = "mdf_ledger"
GLUE_SEED = "glue_ledger"
SUPPLIER_SEED = "supplier_log"

# --- fixed values: supplier header -> field key, type, required ---------------
FIELD_MAPPING = (
    ("Date", "date", "date", True),
    ("Supplier name", "supplier_name", "text", True),
    ("Plate number", "plate_number", "text", True),
    ("Log length (m)", "log_length_m", "decimal", True),
    ("Supplied Wood width (m)", "wood_width_m", "decimal", True),
    ("Supplied Wood length (m)", "wood_length_m", "decimal", True),
    ("Total cubed m3", "total_m3", "decimal", False),
    ("Unit price per m3", "unit_price_per_m3", "decimal", True),
    ("Total price", "total_price", "decimal", False),
    ("Unqualified (Rwf)", "unqualified_rwf", "decimal", False),
    ("Return out", "return_out", "decimal", False),
    ("Balance to be paid", "balance_to_be_paid", "decimal", False),
    ("Paid amount", "paid_amount", "decimal", False),
    ("Payment date", "payment_date", "date", False),
    ("Payment Mode", "payment_mode", "text", False),
    ("Cheque number", "cheque_number", "text", False),
    ("Remaining balance", "remaining_balance", "decimal", False),
)

# --- fixed values: audited field ------------------------------------------------
THRESHOLD_FIELD = "reorder_threshold"

# --- fixed values: stage tags in quarantine, audit and manifests --------------
STAGE_ITEMS = "de_1_1"
STAGE_SPECS = "de_1_2"
STAGE_FIELDS = "de_1_3"
STAGE_THRESHOLDS = "de_1_4"
STAGE_GLUE_ITEMS = "de_1_5"
STAGE_GLUE_SPECS = "de_1_6"

# --- fixed values: file status -------------------------------------------------
PENDING = "pending"
PROCESSED = "processed"
LOADED = "loaded"

# --- fixed values: column limits of the target tables -------------------------
ITEM_LENGTHS = {"display_name": 255, "category": 100, "base_uom": 50}
PROPERTY_LENGTHS = {"property_name": 100}
FIELD_LENGTHS = {"field_name": 255, "field_key": 100, "field_type": 50}
FIELD_TYPE_DEFAULT = "text"
FIELD_REQUIRED_DEFAULT = False

# --- fixed values: message formats (printf style) ------------------------------
MSG_MIXED = "Column '%s': mixed types {%s}"
MSG_NULLS = "Column '%s': %s%% null"
MSG_FORMULAS = "Column '%s': %d formula cell(s) (data_only=True may suppress values)"
MSG_DUPLICATES = "%d duplicate data row(s) detected"
MSG_FLAG = "! %d issue(s)"
MSG_OK = "OK"
MSG_EMPTY_SHEET = "empty sheet"
MSG_SEGMENTS = "Expected 3 segments separated by '*', got %d: '%s'"
MSG_NOT_NUMERIC = "Non-numeric segment in '%s'"
MSG_GLUE_FORMAT = "Unrecognised format '%s' — expected e.g. '25kg/1bag'"
MSG_NO_ITEM_HEADER = "Header row not found — no row with both 'Items' and 'Date' columns"
MSG_NO_SPEC_HEADER = "Header row not found (no Items + Specifications columns)"
MSG_NO_ITEMS = "No data rows — Items column is empty throughout"
MSG_NO_NAME = "Could not derive display_name (Items column empty)"
MSG_NO_SPECS = "No Specifications values found in tab"
MSG_NO_GLUE_HEADER = "Header row not found"
MSG_NO_GLUE_NAME = "Items column empty — cannot determine material name"
MSG_NO_GLUE_SPECS = "Specifications column empty"
MSG_CANONICAL = "Cannot parse canonical spec: %s"
MSG_VARIANT = "Variant spec unparseable: %s"
MSG_BLOCKED = "Material '%s' not found in DB — blocked on DE-1.1"
MSG_GLUE_BLOCKED = "'%s' not in DB — blocked on DE-1.5"
MSG_HEADER_MISSING = "Expected header '%s' not found in '%s'"
MSG_SHEET_MISSING = "Sheet '%s' not found in workbook"
MSG_NO_HEADERS = "Could not locate header row (no row with >= 2 non-null cells)"
MSG_CONFLICT = (
    "Conflict: field '%s' on '%s' exists with is_required=%s but mapping expects "
    "is_required=%s. Manual review required before next run."
)
MSG_THRESHOLD = "'%s': %s (must be a positive integer)"
