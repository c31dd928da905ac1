"""Registered queries: every operator over the given tables, or ledgers derived from them."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom import fixed_values as fixed
from tallyloom.functions.cells import cell_text, cells_of
from tallyloom.functions.specs import parse_board_spec, parse_glue_spec, unpivot_properties
from tallyloom.functions.text import key_of
from tallyloom.operators import (
    catalog,
    checks,
    extract,
    merge,
    profile,
    quarantine,
    sheets,
    tracking,
)
from tallyloom.plans import views
from tallyloom.schemas import PROPERTIES, SHEET_KEYS, TRACKER, column_names
from tallyloom.session import stage_table, staged_path
from tallyloom.sources import files as file_source, grid as grid_source, registry as registry_source
from tallyloom.sources.store import read_json_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = "2024-06-01 00:00:00"
STAGE = "profile"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _now() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- files -----------------------------------------------------------------------------


@query
def listed_files(spark, sf_dir):
    """Hash and size of files that hold a hundred pages each, one line per page."""
    folder = staged_path(spark, "page-files")
    line = F.concat_ws("|", F.format_string("%012d", "page_id"), "url")
    rows = _table(spark, sf_dir, "pages").select(F.floor(F.col("page_id") / 100).alias("book"), line.alias("line"))
    rows.repartition("book").sortWithinPartitions("book", "line").write.partitionBy("book").text(folder)
    listing = file_source.list_files(spark, folder, folder)
    book = F.regexp_extract("file_key", r"book=(\d+)/", 1).cast("bigint")
    return listing.select(book.alias("book"), "hash", "size_bytes", "error")


@query
def file_keys(spark, sf_dir):
    """Keys of pages as files: below the root, with and without a scheme, and elsewhere."""
    name = F.concat(F.col("page_id").cast("string"), F.lit(" #"), F.col("url"))
    roots = F.array(F.lit("file:/data/raw/"), F.lit("/data/raw/"), F.lit("/data/rawer/"), F.lit("s3://data/raw/"))
    path = F.concat(F.element_at(roots, (F.col("page_id") % 4 + 1).cast("int")), name)
    return _table(spark, sf_dir, "pages").select("page_id", file_source.file_key(path, "/data").alias("file_key"))


@query
def json_log(spark, sf_dir):
    """Conversations written as JSON lines, with a broken line after every hundredth turn, and read again."""
    folder = staged_path(spark, "turn-log")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    whole = F.to_json(F.struct("conv_id", "turn", "role", F.sha2("text", 256).alias("text_sha256")))
    broken = F.when(F.pmod("conv_id", F.lit(100)) == 0, F.concat(F.substring(whole, 1, 20), F.lit("\nnot JSON")))
    rows.select(F.explode(F.array_compact(F.array(whole, broken))).alias("line")).write.text(folder)
    return read_json_lines(spark, folder, "conv_id bigint, turn bigint, role string, text_sha256 string")


@query
def csv_documents(spark, sf_dir):
    """Documents written as CSV, line breaks and all, and read back as a grid: id, source and digest of the text."""
    folder = staged_path(spark, "document-csv")
    rows = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    kept = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(**kept).csv(folder)
    grid = grid_source.read_csv_grid(spark, folder, width=3, typed=False)
    return grid.select(
        cell_text(0).cast("bigint").alias("doc_id"), cell_text(1).alias("source"), F.sha2(cell_text(2), 256).alias("text_sha256")
    )


# --- catalog ---------------------------------------------------------------------------


@query
def sheet_catalog(spark, sf_dir):
    return catalog.sheet_catalog(views.board_grid(spark, sf_dir))


def _glue_registry(spark, sf_dir) -> DataFrame:
    """One registered glue book per nation; only some give a unit."""
    name = F.concat(F.lit("glue_"), F.col("n_nationkey"))
    return _table(spark, sf_dir, "nation").select(
        F.concat(name, F.lit(".grid")).alias("filename"),
        name.alias("source_id"),
        F.when(F.col("n_nationkey") % 6 == 5, fixed.SUPPLIER_SEED).otherwise(fixed.GLUE_SEED).alias("seed_type"),
        F.when(F.col("n_nationkey") % 2 == 0, "bags").alias("base_uom"),
        F.col("n_name").alias("description"),
    )


def _glue_statuses(spark, sf_dir) -> DataFrame:
    books = _table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(
        (F.count(F.lit(1)) * 777).alias("size_bytes"), F.max("s_suppkey").alias("last")
    )
    listing = books.select(
        F.concat(F.lit("raw/glue_"), F.col("s_nationkey"), F.lit(".grid")).alias("file_key"),
        F.sha2(F.col("last").cast("string"), 256).alias("hash"),
        "size_bytes",
    )
    errors = books.filter(F.col("s_nationkey") % 9 == 4).select(
        F.concat(F.lit("glue_"), F.col("s_nationkey")).alias("source_id"),
        F.lit("not a workbook").alias("error"),
    )
    return file_source.source_status(_glue_registry(spark, sf_dir), listing, "raw", errors)


@query
def source_status(spark, sf_dir):
    return _glue_statuses(spark, sf_dir)


@query
def source_catalog(spark, sf_dir):
    sheet_table = catalog.sheet_catalog(views.glue_grid(spark, sf_dir))
    return catalog.source_catalog(_glue_statuses(spark, sf_dir), sheet_table)


@query
def registry_sources(spark, sf_dir):
    return registry_source.sources_of(_glue_registry(spark, sf_dir), fixed.GLUE_SEED)


@query
def first_sheet_rows(spark, sf_dir):
    rows = grid_source.first_sheet(views.glue_grid(spark, sf_dir))
    return rows.groupBy("source_id", "sheet").agg(F.count(F.lit(1)).alias("n"))


@query
def missing_sheets(spark, sf_dir):
    return grid_source.missing_sheets(
        _glue_registry(spark, sf_dir), views.glue_grid(spark, sf_dir), "notes"
    )


@query
def long_cells(spark, sf_dir):
    return cells_of(views.board_grid(spark, sf_dir)).drop("source_id")


@query
def sheet_preview(spark, sf_dir):
    return cells_of(extract.preview(views.board_grid(spark, sf_dir), 5)).drop("source_id")


# --- profile ---------------------------------------------------------------------------


def _shown(columns: DataFrame) -> DataFrame:
    """Column profile with the type distribution as text, for comparison by value."""
    entries = F.transform("types", lambda t: F.concat_ws(":", t["dtype"], t["n"].cast("string")))
    return columns.withColumn("types", F.array_join(entries, ",")).drop("type_distribution")


def _columns_of(grid: DataFrame, rule=sheets.TWO_CELLS, names: list[str] | None = None) -> DataFrame:
    facts = profile.profile_facts(grid, rule)
    tallies = stage_table(profile.cell_tallies(grid, facts), "tallies")
    return profile.column_profile(profile.column_names(grid, facts, names=names), tallies)


@query
def column_types(spark, sf_dir):
    grid = views.event_grid(spark, sf_dir)
    return profile.column_types(profile.cell_tallies(grid, profile.profile_facts(grid)))


@query
def column_profile(spark, sf_dir):
    return _shown(_columns_of(views.event_grid(spark, sf_dir)))


@query
def ragged_profile(spark, sf_dir):
    """Profile of board sheets whose rows end early, each by another number of cells."""
    grid = views.board_grid(spark, sf_dir)
    width = F.greatest(F.size("cells") - (F.col("row_num") % 3).cast("int"), F.lit(0))
    return _shown(_columns_of(grid.withColumn("cells", F.slice("cells", F.lit(1), width))))


@query
def board_column_profile(spark, sf_dir):
    return _shown(_columns_of(views.board_grid(spark, sf_dir)))


@query
def named_header_profile(spark, sf_dir):
    return _shown(_columns_of(views.board_grid(spark, sf_dir), sheets.SPEC_TOKENS))


@query
def typed_table_profile(spark, sf_dir):
    names = _table(spark, sf_dir, "orders").columns
    return _shown(_columns_of(views.order_grid(spark, sf_dir), sheets.NO_HEADER, names))


@query
def duplicate_rows(spark, sf_dir):
    grid = views.event_grid(spark, sf_dir)
    return profile.duplicate_rows(grid, profile.profile_facts(grid))


@query
def document_duplicates(spark, sf_dir):
    grid = views.document_grid(spark, sf_dir)
    return profile.duplicate_rows(grid, profile.profile_facts(grid, sheets.NO_HEADER))


@query
def quality_issues(spark, sf_dir):
    return profile.Profile(views.board_grid(spark, sf_dir)).issues


@query
def sheet_report(spark, sf_dir):
    grid = views.board_grid(spark, sf_dir).unionByName(views.event_grid(spark, sf_dir))
    # Listed sheets without any row: one per region.
    blank = _table(spark, sf_dir, "region").select(
        F.lit("blank").alias("source_id"),
        F.col("r_name").alias("sheet"),
        F.col("r_regionkey").cast("bigint").alias("sheet_idx"),
    )
    listed = grid.select(*SHEET_KEYS).distinct().unionByName(blank)
    return profile.Profile(grid, sheets=listed).sheets


@query
def source_report(spark, sf_dir):
    grid = views.board_grid(spark, sf_dir).unionByName(views.event_grid(spark, sf_dir))
    return profile.Profile(grid).sources


@query
def quality_report(spark, sf_dir):
    return profile.Profile(views.event_grid(spark, sf_dir)).report


# --- change tracking -------------------------------------------------------------------


def _documents_as_files(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("file_key"),
        F.concat(F.lit("doc_"), F.col("doc_id")).alias("filename"),
        F.col("source").alias("source_id"),
        file_source.content_hash(F.col("text")).alias("hash"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
    )


def _tracker(spark, sf_dir) -> DataFrame:
    loaded_at = F.when(F.col("status") == "loaded", F.lit("2024-01-02 00:00:00").cast("timestamp"))
    state = views.view(spark, sf_dir, views.TRACKER_PREV).select(
        F.lit(STAGE).alias("stage"),
        F.col("file_key").cast("string").alias("file_key"),
        F.lit(None).cast("string").alias("filename"),
        F.lit(None).cast("string").alias("source_id"),
        "hash",
        F.lit(None).cast("bigint").alias("size_bytes"),
        "status",
        F.lit(None).cast("timestamp").alias("processed_at"),
        loaded_at.alias("loaded_at"),
    )
    return state.select(*column_names(TRACKER))


_STATE = ["file_key", "source_id", "hash", "size_bytes", "status", "processed_at", "loaded_at"]


def _not_in(spark, sf_dir, status: str) -> DataFrame:
    """Files whose tracked status is another one; unknown files are pending."""
    files = _documents_as_files(spark, sf_dir)
    known = tracking.with_state(files, _tracker(spark, sf_dir)).filter(F.col("status") != status)
    return known.select("file_key", "filename", "source_id", "hash", "size_bytes")


@query
def change_flags(spark, sf_dir):
    flagged = tracking.with_state(_documents_as_files(spark, sf_dir), _tracker(spark, sf_dir))
    return flagged.select("file_key", "status", "needs_processing")


@query
def changed_sources(spark, sf_dir):
    files = _documents_as_files(spark, sf_dir)
    return tracking.unprocessed(files, _tracker(spark, sf_dir)).select("file_key", "hash")


@query
def forced_run(spark, sf_dir):
    files = _documents_as_files(spark, sf_dir)
    return tracking.unprocessed(files, _tracker(spark, sf_dir), force=True).select("file_key")


@query
def ready_to_load(spark, sf_dir):
    files = _documents_as_files(spark, sf_dir).select("file_key", "filename")
    return tracking.needs_loading(files, _tracker(spark, sf_dir))


@query
def status_summary(spark, sf_dir):
    return tracking.status_summary(_tracker(spark, sf_dir))


@query
def tracker_upsert(spark, sf_dir):
    tracker, files = _tracker(spark, sf_dir), _documents_as_files(spark, sf_dir)
    return tracking.mark_processed(tracker, STAGE, tracking.unprocessed(files, tracker), _now()).select(*_STATE)


@query
def tracker_keep_loaded(spark, sf_dir):
    tracker, files = _tracker(spark, sf_dir), _documents_as_files(spark, sf_dir)
    return tracking.mark_processed(tracker, STAGE, files, _now(), keep_loaded=True).select(*_STATE)


@query
def tracker_loaded(spark, sf_dir):
    files = _not_in(spark, sf_dir, "loaded")
    return tracking.mark_loaded(_tracker(spark, sf_dir), STAGE, files, _now()).select(*_STATE)


@query
def tracker_reset(spark, sf_dir):
    files = _not_in(spark, sf_dir, "pending")
    return tracking.reset(_tracker(spark, sf_dir), STAGE, files).select(*_STATE)


def _incremental(spark, sf_dir) -> DataFrame:
    """Fresh sizes of changed documents, and the stored sizes of the unchanged ones."""
    files = _documents_as_files(spark, sf_dir)
    flagged = tracking.with_state(files, _tracker(spark, sf_dir)).select(
        "file_key", "size_bytes", "needs_processing"
    )
    prior = _table(spark, sf_dir, "documents").filter(F.col("doc_id") % 7 != 0).select(
        F.col("doc_id").cast("string").alias("file_key"), F.col("n_chars").alias("size")
    )
    now, kept = tracking.carry_forward(flagged, prior, "file_key")
    fresh = now.select("file_key", F.col("size_bytes").alias("size"), F.lit("processed").alias("outcome"))
    return fresh.unionByName(kept.select("file_key", "size", F.lit("skipped").alias("outcome")))


@query
def incremental_carry_forward(spark, sf_dir):
    return _incremental(spark, sf_dir)


@query
def run_counters(spark, sf_dir):
    return catalog.outcome_counts(_incremental(spark, sf_dir))


# --- extraction ------------------------------------------------------------------------


@query
def valid_tabs(spark, sf_dir):
    grid = views.board_grid(spark, sf_dir)
    kept = extract.valid_tabs(grid).withColumn("valid", F.lit(True))
    left = extract.ignored_tabs(grid).withColumn("valid", F.lit(False))
    return kept.unionByName(left).groupBy("sheet", "valid").agg(F.count(F.lit(1)).alias("n"))


@query
def header_rows(spark, sf_dir):
    grid = views.board_grid(spark, sf_dir).unionByName(views.supplier_grid(spark, sf_dir))
    rules = {
        "two_cells": sheets.TWO_CELLS,
        "two_texts": sheets.TWO_TEXTS,
        "item_tokens": sheets.ITEM_TOKENS,
        "spec_tokens": sheets.SPEC_TOKENS,
    }
    firsts = [F.min(F.when(sheets.is_header(r), F.col("row_num"))).alias(n) for n, r in rules.items()]
    return grid.groupBy(*SHEET_KEYS).agg(*firsts)


@query
def first_items(spark, sf_dir):
    grid = extract.valid_tabs(views.board_grid(spark, sf_dir))
    facts = sheets.staged_headers(grid, sheets.ITEM_TOKENS)
    return extract.first_rows(grid, facts).select(
        "sheet", "row_num", extract.board_name(F.col("cells")[1]["sval"]).alias("display_name")
    )


def _board_tabs(spark, sf_dir) -> extract.LedgerTabs:
    return extract.LedgerTabs(extract.valid_tabs(views.board_grid(spark, sf_dir)))


def _glue_tabs(spark, sf_dir) -> extract.LedgerTabs:
    return extract.LedgerTabs(grid_source.first_sheet(views.glue_grid(spark, sf_dir)))


@query
def tab_overview(spark, sf_dir):
    return _board_tabs(spark, sf_dir).summary().drop("source_id")


@query
def spec_variants(spark, sf_dir):
    return extract.spec_variants(_board_tabs(spark, sf_dir).values).drop("source_id")


@query
def bad_variants(spark, sf_dir):
    variants = extract.spec_variants(_board_tabs(spark, sf_dir).values)
    return extract.bad_variants(variants).select(
        "sheet", "spec", key_of(F.col("sheet"), F.concat(F.lit("variant_"), F.col("spec"))).alias("key"), "error"
    )


@query
def board_specs(spark, sf_dir):
    parsed = extract.parsed_specs(_board_tabs(spark, sf_dir).summary())
    return parsed.select("sheet", "display_name", "spec", "parsed.*")


def _board_properties(spark, sf_dir) -> DataFrame:
    parsed = extract.parsed_specs(_board_tabs(spark, sf_dir).summary()).filter("parsed.error is null")
    named = parsed.withColumns({"seq": F.col("sheet_idx"), "parent_key": F.col("sheet")})
    return unpivot_properties(named, "parsed", fixed.BOARD_PROPERTIES, ["seq", "parent_key", "display_name"])


@query
def board_properties(spark, sf_dir):
    return _board_properties(spark, sf_dir).withColumn("key", key_of(F.col("parent_key"), F.col("property_name")))


@query
def all_specs_parsed(spark, sf_dir):
    rows = views.view(spark, sf_dir, views.BOARD_LEDGER).filter("spec is not null")
    return rows.select("row_num", parse_board_spec(F.col("spec")).alias("p")).select("row_num", "p.*")


@query
def glue_names(spark, sf_dir):
    return _glue_tabs(spark, sf_dir).summary(extract.glue_name).select(
        "source_id", "items", "display_name", "items_row"
    )


@query
def glue_specs(spark, sf_dir):
    summary = _glue_tabs(spark, sf_dir).summary(extract.glue_name)
    return extract.parsed_specs(summary, parse_glue_spec).select("source_id", "spec", "variant_count", "parsed.*")


@query
def sheet_headers(spark, sf_dir):
    return extract.header_list(views.supplier_grid(spark, sf_dir)).drop("source_id")


@query
def missing_headers(spark, sf_dir):
    grid = views.supplier_grid(spark, sf_dir)
    tabs = catalog.sheet_catalog(grid).select(*SHEET_KEYS)
    missing = extract.missing_headers(extract.header_list(grid), tabs)
    return missing.select("sheet", "header", key_of(F.lit("header"), F.col("header"), sep="::").alias("key"))


@query
def mapped_fields(spark, sf_dir):
    headers = extract.header_list(views.supplier_grid(spark, sf_dir))
    return extract.mapped_fields(headers, extract.field_mapping(spark)).drop("source_id")


# --- validation ------------------------------------------------------------------------


def _threshold_documents(spark, sf_dir) -> DataFrame:
    """One configuration document per part, many of them wrong in some way."""
    key = F.col("p_partkey")
    value = (
        F.when(key % 6 == 0, "true")
        .when(key % 6 == 1, "1.5")
        .when(key % 6 == 2, '"5"')
        .when(key % 6 == 3, F.concat(F.lit("-"), F.col("p_size")))
        .when(key % 12 == 4, "0")
        .otherwise(F.col("p_size").cast("string"))
    )
    entry = F.concat(F.lit('{"thresholds": {"'), key, F.lit('mm MDF": '), value, F.lit("}}"))
    return _table(spark, sf_dir, "part").select(
        F.when(key % 31 == 0, "{bad")
        .when(key % 29 == 0, "[1]")
        .when(key % 37 == 0, '{"other": 1}')
        .when(key % 41 == 0, '{"thresholds": 5}')
        .otherwise(entry)
        .alias("value")
    )


@query
def threshold_errors(spark, sf_dir):
    entries = checks.threshold_entries(_threshold_documents(spark, sf_dir))
    checked = checks.checked_thresholds(entries).filter(F.col("error").isNotNull())
    return checked.groupBy("display_name", "value_text", "error").agg(F.count(F.lit(1)).alias("n"))


@query
def valid_thresholds(spark, sf_dir):
    entries = checks.threshold_entries(_threshold_documents(spark, sf_dir))
    checked = checks.checked_thresholds(entries).filter(F.col("error").isNull())
    return checked.select("display_name", "threshold")


@query
def repeated_names(spark, sf_dir):
    names = views.view(spark, sf_dir, views.BOARD_LEDGER).filter("length(trim(items)) > 0")
    tabs = names.select("tab", extract.board_name(F.col("items")).alias("display_name")).distinct()
    return checks.repeated_keys(tabs, ["display_name"])


@query
def repeated_properties(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return checks.repeated_keys(lines, ["l_orderkey", "l_suppkey"])


@query
def invalid_items(spark, sf_dir):
    key = F.col("p_partkey")
    rows = _table(spark, sf_dir, "part").select(
        key.alias("item_id"),
        F.when(key % 10 == 0, None).when(key % 10 == 1, F.repeat("p_name", 30)).otherwise(F.col("p_name")).alias("display_name"),
        F.when(key % 7 == 0, F.repeat("p_type", 10)).otherwise(F.col("p_type")).alias("category"),
        F.col("p_brand").alias("base_uom"),
    )
    return checks.invalid_rows(rows, ["display_name"], fixed.ITEM_LENGTHS).select("item_id", "error")


def _customers_left(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 3").select(F.col("c_custkey").alias("item_id"))


def _orders_as_children(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("item_id"))


@query
def orphans(spark, sf_dir):
    return checks.orphans(_orders_as_children(spark, sf_dir), _customers_left(spark, sf_dir), "item_id")


@query
def cascade_delete(spark, sf_dir):
    return checks.cascade(_orders_as_children(spark, sf_dir), _customers_left(spark, sf_dir), "item_id")


@query
def column_defaults(spark, sf_dir):
    key = F.col("s_suppkey")
    fields = _table(spark, sf_dir, "supplier").select(
        key.alias("item_id"),
        F.when(key % 2 == 0, "decimal").alias("field_type"),
        F.when(key % 3 == 0, True).alias("is_required"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    return checks.with_defaults(
        fields,
        {
            "field_type": fixed.FIELD_TYPE_DEFAULT,
            "is_required": fixed.FIELD_REQUIRED_DEFAULT,
            "created_at": _now(),
        },
    )


# --- merges ----------------------------------------------------------------------------


def _board_inputs(spark, sf_dir) -> DataFrame:
    summary = _board_tabs(spark, sf_dir).summary().withColumn("seq", F.col("sheet_idx"))
    no_header = F.col("header_row").isNull()
    error = F.when(no_header, fixed.MSG_NO_ITEM_HEADER).when(F.col("items").isNull(), fixed.MSG_NO_ITEMS)
    return stage_table(merge.board_inputs(summary.withColumn("error", error)), "board-inputs")


def _staged_target(spark, sf_dir) -> DataFrame:
    return stage_table(views.item_target(spark, sf_dir), "items")


@query
def merge_items(spark, sf_dir):
    actions = merge.item_actions(_staged_target(spark, sf_dir), _board_inputs(spark, sf_dir))
    return actions.select("seq", "parent_key", "display_name", "action", "collision", "reason")


@query
def merged_items(spark, sf_dir):
    target = _staged_target(spark, sf_dir)
    known = target.select("display_name", F.col("item_id").alias("old_id"))
    actions = stage_table(merge.item_actions(target, _board_inputs(spark, sf_dir)), "item-actions")
    merged = merge.apply_items(target, actions, _now())
    return merged.join(known, "display_name", "left").select(
        "old_id",
        "display_name",
        "category",
        "base_uom",
        "reorder_threshold",
        (F.col("updated_at") == _now()).alias("touched"),
        F.coalesce(F.col("item_id") == F.col("old_id"), F.lit(True)).alias("id_kept"),
    )


@query
def item_ids(spark, sf_dir):
    """Ids of all customers numbered anew: dense, distinct, starting after the given number."""
    from tallyloom.operators.scale import dense_ids

    numbered = dense_ids(_table(spark, sf_dir, "customer").select("c_name"), "c_name", F.lit(1000))
    return numbered.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("item_id").alias("distinct_ids"),
        F.min("item_id").alias("lowest"),
        F.max("item_id").alias("highest"),
    )


def _glue_inputs(spark, sf_dir) -> DataFrame:
    summary = _glue_tabs(spark, sf_dir).summary(extract.glue_name)
    registered = registry_source.sources_of(_glue_registry(spark, sf_dir), fixed.GLUE_SEED)
    seq = F.regexp_extract("source_id", r"(\d+)", 1).cast("bigint")
    error = F.when(F.col("header_row").isNull(), fixed.MSG_NO_GLUE_HEADER).when(
        F.col("display_name").isNull(), fixed.MSG_NO_GLUE_NAME
    )
    return (
        registered.select("source_id", "base_uom")
        .join(summary, "source_id")
        .select(
            seq.alias("seq"),
            F.col("source_id").alias("parent_key"),
            "display_name",
            F.lit(fixed.CATEGORY).alias("category"),
            "base_uom",
            error.alias("error"),
        )
    )


@query
def merge_glue_items(spark, sf_dir):
    target = _staged_target(spark, sf_dir)
    actions = merge.item_actions(target, stage_table(_glue_inputs(spark, sf_dir), "glue-inputs"))
    return actions.select("seq", "parent_key", "display_name", "base_uom", "action", "collision")


def _existing_properties(items: DataFrame) -> DataFrame:
    """Thickness of every second item: right for some, different for others."""
    return items.filter("item_id % 2 = 0").select(
        "item_id",
        F.lit("thickness").alias("property_name"),
        (F.col("item_id") + F.when(F.col("item_id") % 3 == 0, 1).otherwise(0)).cast("decimal(12,4)").alias("property_value"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
    ).select(*column_names(PROPERTIES))


def _property_merge(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    items = _staged_target(spark, sf_dir)
    existing = _existing_properties(items)
    inputs = stage_table(_board_properties(spark, sf_dir), "property-inputs")
    return existing, stage_table(merge.property_actions(items, existing, inputs), "property-actions")


@query
def merge_properties(spark, sf_dir):
    _, actions = _property_merge(spark, sf_dir)
    return actions.drop("property_value")


@query
def merged_properties(spark, sf_dir):
    existing, actions = _property_merge(spark, sf_dir)
    return merge.apply_properties(existing, actions, _now())


def _field_merge(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Fields of all supplier sheets for every customer as item; some fields are there already.

    The mapping is not the usual one: a header has another requirement, and one more is mapped,
    without type and requirement.
    """
    items = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("item_id"), F.col("c_name").alias("display_name")
    )
    usual = extract.field_mapping(spark)
    turned = usual.withColumn("is_required", F.col("is_required") != (F.col("field_key") == fixed.FIELD_MAPPING[2][1]))
    mapping = turned.unionByName(spark.createDataFrame([("Remarks", "remarks", None, None)], usual.schema))
    fields = extract.mapped_fields(extract.header_list(views.supplier_grid(spark, sf_dir)), mapping)
    every = F.array(
        *[
            F.struct(
                F.lit(n).alias("field_name"),
                F.lit(k).alias("field_key"),
                F.lit(t).alias("field_type"),
                F.lit(i).alias("pos"),
                F.lit(r).alias("expected"),
            )
            for i, (n, k, t, r) in enumerate(fixed.FIELD_MAPPING)
        ]
    )
    mark = (F.col("item_id") + F.col("pos")) % 7
    existing = (
        items.select("item_id", F.inline(every))
        .filter(mark < 3)
        .select(
            "item_id",
            "field_name",
            "field_key",
            "field_type",
            F.when(mark == 0, F.col("expected")).when(mark == 1, ~F.col("expected")).alias("is_required"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
        )
    )
    return existing, merge.field_actions(items, fields, existing)


@query
def merge_fields(spark, sf_dir):
    return _field_merge(spark, sf_dir)[1].drop("reason")


@query
def merged_fields(spark, sf_dir):
    existing, actions = _field_merge(spark, sf_dir)
    return merge.apply_fields(existing, actions, _now())


def _threshold_merge(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    items = _staged_target(spark, sf_dir)
    thresholds = (
        _table(spark, sf_dir, "part")
        .groupBy("p_size")
        .agg(F.max("p_partkey").alias("last"))
        .select(
            F.concat(F.col("p_size"), F.lit("mm MDF")).alias("display_name"),
            F.when(F.col("last") % 3 == 0, F.col("p_size") * 10).otherwise(F.col("p_size") * 7).cast("int").alias("threshold"),
        )
    )
    return items, stage_table(merge.threshold_actions(items, thresholds), "threshold-actions")


@query
def apply_thresholds(spark, sf_dir):
    return _threshold_merge(spark, sf_dir)[1]


@query
def items_after_thresholds(spark, sf_dir):
    items, actions = _threshold_merge(spark, sf_dir)
    return merge.apply_thresholds(items, actions, _now())


@query
def audit_trail(spark, sf_dir):
    _, actions = _threshold_merge(spark, sf_dir)
    return quarantine.audit_rows(actions, fixed.STAGE_THRESHOLDS, _now())


@query
def items_by_name(spark, sf_dir):
    return views.item_target(spark, sf_dir).select("item_id", "display_name").orderBy("display_name")


# --- quarantine ------------------------------------------------------------------------


def _outcomes(spark, sf_dir) -> DataFrame:
    """Every event as the outcome of some key of the run."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("script"),
        F.concat(F.lit("tab"), F.col("user_id") % 50).alias("parent_key"),
        F.concat(F.lit("p"), F.col("event_id") % 3).alias("child_key"),
        (F.col("event_id") % 4 != 0).alias("ok"),
        F.concat(F.lit("reason "), F.col("event_id") % 5).alias("reason"),
        F.concat(F.lit("event="), F.col("event_id")).alias("detail"),
        F.col("event_id").alias("seq"),
    )


def _pending(spark, sf_dir) -> DataFrame:
    """Earlier quarantine: keys of customers, some of stage level."""
    key = F.col("c_custkey")
    child = F.when(key % 5 == 0, "all").otherwise(F.concat(F.lit("p"), key % 4))
    return _table(spark, sf_dir, "customer").groupBy(
        F.element_at(F.array(F.lit("click"), F.lit("view"), F.lit("purchase")), (key % 3 + 1).cast("int")).alias("script"),
        F.concat(F.lit("tab"), key % 60).alias("parent_key"),
        child.alias("child_key"),
    ).agg(
        F.lit("earlier").alias("reason"),
        F.lit("").alias("detail"),
        F.max(-key).alias("seq"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("ts"),
    )


@query
def quarantine_delta(spark, sf_dir):
    return quarantine.settle(_pending(spark, sf_dir), _outcomes(spark, sf_dir), _now())


@query
def quarantine_by_parent(spark, sf_dir):
    script = "click"
    outcomes = _outcomes(spark, sf_dir).filter(F.col("script") == script)
    parents = outcomes.select("parent_key").distinct()
    failures = outcomes.filter(~F.col("ok")).drop("ok", "script")
    return quarantine.settle_parents(_pending(spark, sf_dir), script, parents, failures, _now())


@query
def failure_keys(spark, sf_dir):
    """Key texts of customers as failures of all stages, taken apart and put together again.

    Parents hold a dot. What follows them is each kind of child in turn, or no child at all.
    """
    number, nation, segment = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    stages = (fixed.STAGE_ITEMS, fixed.STAGE_SPECS, fixed.STAGE_FIELDS, fixed.STAGE_GLUE_SPECS)
    script = F.element_at(F.array(*[F.lit(s) for s in stages]), (number % 4 + 1).cast("int"))
    named = [F.lit(n) for n in ("all", "parse", *fixed.BOARD_PROPERTIES, *fixed.GLUE_PROPERTIES)]
    kinds = F.array(*named, segment, F.concat(F.lit("variant_"), segment, F.lit(".all"), nation))
    child = F.element_at(kinds, (nation % 9 + 1).cast("int"))
    text = F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.when(number % 4 == 2, "::").otherwise("."), child)
    rows = _table(spark, sf_dir, "customer").select("c_custkey", script.alias("script"), text.alias("key"))
    parent, child = quarantine.split_key(F.col("script"), F.col("key"))
    return rows.select("c_custkey", "script", parent.alias("parent_key"), child.alias("child_key")).withColumn(
        "key", quarantine.key_text()
    )


@query
def failed_keys(spark, sf_dir):
    return quarantine.failed_keys(_pending(spark, sf_dir), "click")


@query
def retry_tabs(spark, sf_dir):
    work = _outcomes(spark, sf_dir).select("parent_key", "seq")
    pending = quarantine.failures_of(_pending(spark, sf_dir), "view")
    chosen, skipped = quarantine.retry_parents(work, pending, ["seq"])
    return chosen.withColumn("retried", F.lit(True)).unionByName(skipped.withColumn("retried", F.lit(False)))


@query
def retry_properties(spark, sf_dir):
    work = _outcomes(spark, sf_dir).select("parent_key", "child_key", "seq")
    return quarantine.retry_children(work, quarantine.failures_of(_pending(spark, sf_dir), "purchase"))


_ITEM_ACTIONS = ["insert", "repair", "skip", "fail"]


@query
def run_summary(spark, sf_dir):
    actions = merge.item_actions(_staged_target(spark, sf_dir), _board_inputs(spark, sf_dir))
    return quarantine.action_counts(actions, _ITEM_ACTIONS)


@query
def property_counts(spark, sf_dir):
    _, actions = _property_merge(spark, sf_dir)
    return quarantine.action_counts(actions, ["insert", "skip", "blocked", "fail"], ["parent_key"])


@query
def load_manifest(spark, sf_dir):
    target = _staged_target(spark, sf_dir)
    actions = merge.item_actions(target, stage_table(_glue_inputs(spark, sf_dir), "glue-inputs"))
    counts = quarantine.action_counts(
        actions.withColumnRenamed("parent_key", "source_id"), _ITEM_ACTIONS, ["source_id"]
    )
    rows = quarantine.manifest_rows(counts, fixed.STAGE_GLUE_ITEMS, "full", _now(), ["fail"])
    return rows.select(
        "script", "source_id", "mode", "loaded_at", *[F.col("summary")[n].alias(n) for n in _ITEM_ACTIONS]
    )
