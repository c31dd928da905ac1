"""Complete runs over the documented ledgers, with stored state."""

import pytest
from books import BOARD_TABS, BOOKS, board_sheets, glue_sheets, grid, registry, supplier_sheets
from pyspark.sql import functions as F

from tallyloom import fixed_values as fixed, schemas
from tallyloom.operators import checks
from tallyloom.plans.stages import BOARDS, GLUE, Onboarding
from tallyloom.sources.store import Store

CONFIG = '{"_comment": "x", "thresholds": {"9mm MDF": 500, "6mm MDF": 300, "12mm MDF": 200}}'


def listing(spark, **hashes):
    known = {"Stock management.xlsx": "h1", "GLUE RECORD-1.xlsx": "h2", "Tree log suppliers Book.xlsx": "h3"}
    known.update(hashes)
    rows = [(f"raw/{n}", h, 2048) for n, h in known.items() if h]
    return spark.createDataFrame(rows, schemas.struct_type(schemas.LISTING))


def onboarding(spark, path, sheets=None, files=None, ts="2024-06-01 00:00:00"):
    sheets = sheets or [*board_sheets(), *glue_sheets(), *supplier_sheets()]
    return Onboarding(
        Store(spark, str(path)),
        registry(spark),
        grid(spark, *sheets),
        files if files is not None else listing(spark),
        F.lit(ts).cast("timestamp"),
        "raw",
    )


def config(spark, text=CONFIG):
    return spark.createDataFrame([(text,)], "value string")


def counts(df):
    """Counters added up over sources; other values are those of the last row."""
    out = {}
    for r in df.drop("source_id").collect():
        out = {k: out.get(k, 0) + v if isinstance(v, int) else v for k, v in r.asDict().items()}
    return out


def snapshot(run):
    names = ("inventory_item", "item_property", "batch_field", "quarantine")
    return {n: sorted(map(repr, run.table(n).collect())) for n in names}


def test_full_run_and_second_run(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    assert counts(run.catalog()) == {"outcome": "processed", "n": 3}
    assert counts(run.items(BOARDS)) == {"insert": 8, "repair": 0, "skip": 1, "fail": 0}
    assert counts(run.specs(BOARDS)) == {"insert": 24, "skip": 3, "blocked": 0, "fail": 0}
    assert counts(run.fields()) == {"insert": 136, "skip": 0, "conflict": 0, "fail": 0}
    assert counts(run.thresholds(config(spark))) == {"update": 3, "skip": 0, "blocked": 0}
    assert counts(run.items(GLUE)) == {"insert": 1, "repair": 0, "skip": 0, "fail": 0}
    assert counts(run.specs(GLUE)) == {"insert": 2, "skip": 0, "blocked": 0, "fail": 0}

    items = {r.display_name: r for r in run.table("inventory_item").collect()}
    assert set(items) == {f"{i} MDF" for _, i, _ in BOARD_TABS} | {"Glue"}
    assert sorted(r.item_id for r in items.values()) == list(range(1, 10))
    assert items["9mm MDF"].reorder_threshold == 500 and items["14mm MDF"].reorder_threshold is None
    assert items["Glue"].base_uom == "bags" and items["6mm MDF"].base_uom == fixed.BOARD_UOM
    values = {
        (r.item_id, r.property_name): str(r.property_value) for r in run.table("item_property").collect()
    }
    assert values[items["33mm MDF"].item_id, "thickness"] == "3.3000"
    assert values[items["Glue"].item_id, "weight_per_bag_kg"] == "25.0000"
    assert run.table("quarantine").count() == 0
    manifests = spark.read.parquet(run.store.path("load_manifest"))
    assert {r.script for r in manifests.collect()} == {"de_1_1", "de_1_2", "de_1_3", "de_1_4", "de_1_5", "de_1_6"}

    before = snapshot(run)
    again = onboarding(spark, tmp_path, ts="2024-07-01 00:00:00")
    assert counts(again.items(BOARDS)) == {"insert": 0, "repair": 0, "skip": 9, "fail": 0}
    assert counts(again.specs(BOARDS))["skip"] == 27
    again.items(GLUE)
    again.specs(GLUE)
    assert counts(again.thresholds(config(spark))) == {"update": 0, "skip": 3, "blocked": 0}
    assert snapshot(again) == before
    audit = again.store.read_log("audit", schemas.AUDIT).groupBy("action").count().collect()
    assert {r.action: r["count"] for r in audit} == {"update": 3, "skip": 3}
    assert again.items(BOARDS, retry=True) is None


def test_incremental_catalog_and_profile(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    run.catalog()
    run.profile()
    sheets_before = run.store.read("sheet_report", schemas.SHEET_REPORT).count()
    changed = onboarding(
        spark, tmp_path, [*board_sheets(), *glue_sheets(spec="30kg/1bag"), *supplier_sheets()],
        listing(spark, **{"GLUE RECORD-1.xlsx": "new", "Tree log suppliers Book.xlsx": None}),
    )
    outcome = {r.outcome: r.n for r in changed.catalog().collect()}
    assert outcome == {"processed": 1, "skipped": 2}
    assert {r.outcome: r.n for r in changed.profile().collect()} == outcome
    assert changed.store.read("sheet_report", schemas.SHEET_REPORT).count() == sheets_before
    hashes = {(r.stage, r.source_id): r.hash for r in changed.table("tracker").collect()}
    assert hashes["profile", "glue_record"] == "new" and hashes["catalog", "stock_management"] == "h1"
    # Forced, the vanished file is looked at again and reported missing.
    changed.catalog(force=True)
    catalog = {r.source_id: r for r in changed.store.read("source_catalog", schemas.SOURCE_CATALOG).collect()}
    assert catalog["tree_log_suppliers"].status == "missing"
    assert (catalog["glue_record"].status, catalog["glue_record"].file_size_kb, catalog["glue_record"].sheet_count) == ("ok", 2.0, 1)


def test_failures_retry_and_recovery(spark, tmp_path):
    broken = [t for t in BOARD_TABS if t[0] not in ("9MM", "12MM")]
    broken += [("9MM", "  ", ["0.9*122*244"]), ("12MM", "12mm", ["1.2*122", "x*1*2"])]
    bad_glue = glue_sheets(spec="a bag of 25")
    run = onboarding(spark, tmp_path, [*board_sheets(tabs=broken), *bad_glue, *supplier_sheets(drop=("Date",))])
    assert counts(run.items(BOARDS)) == {"insert": 7, "repair": 0, "skip": 1, "fail": 1}
    assert counts(run.specs(BOARDS))["fail"] == 2
    run.items(GLUE)
    assert counts(run.specs(GLUE)) == {"insert": 0, "skip": 0, "blocked": 0, "fail": 1}
    run.fields()
    assert counts(run.thresholds(config(spark)))["blocked"] == 1
    keys = {(r.script, r.parent_key, r.child_key) for r in run.table("quarantine").collect()}
    assert keys == {
        ("de_1_1", "stock_management/9MM", ""),
        ("de_1_2", "stock_management/9MM", "all"),
        ("de_1_2", "stock_management/12MM", "parse"),
        ("de_1_6", "glue_record", "parse"),
        ("de_1_3", "header", "Date"),
        ("de_1_4", "9mm MDF", ""),
    }
    loaded = {r.script for r in spark.read.parquet(run.store.path("load_manifest")).collect()}
    assert loaded == {"de_1_5"}

    fixed_run = onboarding(spark, tmp_path)
    assert counts(fixed_run.items(BOARDS)) == {"insert": 1, "repair": 0, "skip": 8, "fail": 0}
    retried = counts(fixed_run.specs(BOARDS))
    assert retried["insert"] == 6 and retried["fail"] == 0
    fixed_run.specs(GLUE)
    fixed_run.fields()
    assert counts(fixed_run.thresholds(config(spark))) == {"update": 1, "skip": 2, "blocked": 0}
    assert fixed_run.table("quarantine").count() == 0
    assert fixed_run.table("item_property").count() == 26


def test_conflicting_field_is_kept(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    run.items(BOARDS)
    run.fields()
    flipped = run.table("batch_field").withColumn(
        "is_required", F.when(F.col("field_key") == "date", False).otherwise(F.col("is_required"))
    )
    run.store.write("batch_field", flipped)
    assert counts(run.fields()) == {"insert": 0, "skip": 128, "conflict": 8, "fail": 0}
    assert run.table("quarantine").count() == 8
    assert run.table("batch_field").filter("field_key = 'date' and is_required").count() == 0
    assert "exists with is_required=false" in run.table("quarantine").first().reason


def test_invalid_config_changes_nothing(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    run.items(BOARDS)
    before = snapshot(run)
    with pytest.raises(checks.InvalidConfig):
        run.thresholds(config(spark, '{"thresholds": {"6mm MDF": true}}'))
    assert snapshot(run) == before
    errors = run.store.read("config_errors", "display_name string, value_text string, threshold int, error string")
    assert [r.display_name for r in errors.collect()] == ["6mm MDF"]


def test_repeated_threshold_is_an_error(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    run.items(BOARDS)
    before = snapshot(run)
    twice = config(spark).unionByName(config(spark, '{"thresholds": {"6mm MDF": 7}}'))
    with pytest.raises(checks.InvalidConfig, match="2 errors.*given 2 times"):
        run.thresholds(twice)
    assert snapshot(run) == before


def test_pending_variant_keeps_the_gate_shut(spark, tmp_path):
    tabs = [("6MM", "6mm", ["0.6*122*244", "0.6*122"])]
    run = onboarding(spark, tmp_path, [*board_sheets(tabs=tabs), *glue_sheets(), *supplier_sheets()])
    run.items(BOARDS)
    assert counts(run.specs(BOARDS))["fail"] == 0
    assert [r.child_key for r in run.table("quarantine").collect()] == ["variant_0.6*122"]
    loaded = {r.script for r in spark.read.parquet(run.store.path("load_manifest")).collect()}
    assert loaded == {"de_1_1"}
    states = {(r.stage, r.source_id or r.file_key): r.status for r in run.table("tracker").collect()}
    assert not any(stage == "de_1_2" for stage, _ in states)


def test_missing_source_is_not_counted_as_processed(spark, tmp_path):
    run = onboarding(spark, tmp_path, files=listing(spark, **{"GLUE RECORD-1.xlsx": None}))
    assert {r.outcome: r.n for r in run.catalog().collect()} == {"processed": 2, "missing": 1}


def test_mapping_of_the_caller(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    run.items(BOARDS)
    mapping = spark.createDataFrame(
        [("Date", "day", "timestamp", False), ("Remarks", "remarks", None, None), ("Crew", "crew", "text", True)],
        "field_name string, field_key string, field_type string, is_required boolean",
    )
    assert counts(run.fields(mapping=mapping)) == {"insert": 16, "skip": 0, "conflict": 0, "fail": 1}
    fields = {(r.field_name, r.field_key, r.field_type, r.is_required) for r in run.table("batch_field").collect()}
    assert fields == {("Date", "day", "timestamp", False), ("Remarks", "remarks", "text", False)}
    assert [r.child_key for r in run.table("quarantine").collect()] == ["Crew"]


def test_content_is_listed_once_per_run(spark, tmp_path):
    from tallyloom.sources.files import list_files

    (tmp_path / "raw").mkdir()
    for name, *_ in BOOKS:
        (tmp_path / "raw" / name).write_bytes(name.encode())
    run = onboarding(spark, tmp_path / "state", files=list_files(spark, str(tmp_path / "raw"), str(tmp_path)))
    assert {r.outcome: r.n for r in run.catalog().collect()} == {"processed": 3}
    # What the stages read is the staged result: no plan goes back to the files.
    for frame in (run.statuses, run.table("tracker"), run.profile()):
        assert "binaryFile" not in frame._jdf.queryExecution().toString()


def test_imported_log_selects_tabs_and_empties(spark, tmp_path):
    import json

    from tallyloom.sources.documents import read_failure_log

    entries = [("de_1_1", "6MM"), ("de_1_2", "9MM.all"), ("de_1_2", "gone.parse")]
    lines = [json.dumps({"script": s, "key": k, "timestamp": "2026-06-01T15:00:00Z"}) for s, k in entries]
    (tmp_path / "failures.log").write_text("\n".join(lines))
    run = onboarding(spark, tmp_path / "state")
    log = read_failure_log(spark, str(tmp_path / "failures.log"), run.registry, run.grid.select("source_id", "sheet"))
    run.store.write("quarantine", log)
    assert counts(run.items(BOARDS)) == {"insert": 1, "repair": 0, "skip": 8, "fail": 0}
    run.specs(BOARDS)
    assert run.table("quarantine").count() == 1  # 9MM has no item yet
    run.items(BOARDS)
    run.specs(BOARDS)
    assert run.table("quarantine").count() == 0


def test_blank_sheets_and_sources_that_cannot_be_read(spark, tmp_path):
    listed = spark.createDataFrame(
        [("stock_management", "blank", 99), ("glue_record", "GLUE A , B, C and D", 0), ("tree_log_suppliers", "x", 7)],
        "source_id string, sheet string, sheet_idx bigint",
    )
    run = onboarding(spark, tmp_path, files=listing(spark, **{"Tree log suppliers Book.xlsx": None}))
    run.sheet_list = listed
    run.catalog()
    run.profile()
    entries = {r.sheet: r for r in run.store.read("sheet_catalog", schemas.SHEET_CATALOG).collect()}
    assert (entries["blank"].total_rows, entries["blank"].header_row) == (0, None)
    assert "x" not in entries
    report = {r.sheet: r for r in run.store.read("sheet_report", schemas.SHEET_REPORT).collect()}
    assert report["blank"].error == fixed.MSG_EMPTY_SHEET and report["blank"].issue_count is None
    sources = {r.source_id: (r.status, r.sheet_count) for r in run.store.read("source_report", schemas.SOURCE_REPORT).collect()}
    assert sources == {"stock_management": ("ok", 11), "glue_record": ("ok", 1), "tree_log_suppliers": ("missing", 0)}


def test_source_without_rows_loses_its_output(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    run.catalog()
    folder = tmp_path / "processed_catalog" / "source_id=glue_record"
    assert folder.exists()
    emptied = onboarding(
        spark, tmp_path, [*board_sheets(), *supplier_sheets()], listing(spark, **{"GLUE RECORD-1.xlsx": "new"})
    )
    emptied.catalog()
    assert not folder.exists() and (tmp_path / "processed_catalog" / "source_id=stock_management").exists()


def test_old_versions_go(spark, tmp_path):
    store = Store(spark, str(tmp_path), keep_versions=2)
    for n in range(5):
        store.write("t", spark.range(n).selectExpr("cast(id as string) as source_id"))
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v00000003", "v00000004", "v00000005"]
    assert store.read("t", "source_id string").count() == 4


def test_conflict_holds_back_every_supplier_book(spark, tmp_path):
    def two_books(ts):
        run = onboarding(spark, tmp_path, ts=ts)
        extra = run.grid.filter("source_id = 'tree_log_suppliers'").withColumn("source_id", F.lit("more_suppliers"))
        run.grid = run.grid.unionByName(extra)
        first = run.registry.filter("source_id = 'tree_log_suppliers'")
        run.registry = run.registry.unionByName(first.withColumn("source_id", F.lit("more_suppliers")))
        return run

    run = two_books("2024-06-01 00:00:00")
    run.catalog()
    run.items(BOARDS)
    counted = {r.source_id: (r.insert, r.conflict, r.fail) for r in run.fields().collect()}
    assert counted == {"tree_log_suppliers": (0, 0, 0), "more_suppliers": (0, 0, 0), "*": (136, 0, 0)}
    flipped = run.table("batch_field").withColumn("is_required", F.col("is_required") & (F.col("field_key") != "date"))
    run.store.write("batch_field", flipped)
    again = two_books("2024-06-02 00:00:00")
    again.fields()
    manifest = spark.read.parquet(again.store.path("load_manifest"))
    dates = {str(r.loaded_at)[:10] for r in manifest.filter("script = 'de_1_3'").collect()}
    assert dates == {"2024-06-01"}
    assert not {r.loaded_at for r in again.table("tracker").collect() if r.loaded_at and str(r.loaded_at) > "2024-06-02"}


def test_stage_killed_at_any_write_leaves_everything_as_it_was(spark, tmp_path):
    class Killed(Exception):
        pass

    class Fragile(Store):
        left = None

        def _step(self):
            if self.left == 0:
                raise Killed
            if self.left is not None:
                self.left -= 1

        def change(self, *args):
            self._step()
            super().change(*args)

        def append(self, *args):
            self._step()
            super().append(*args)

    run = onboarding(spark, tmp_path)
    run.catalog()
    before, tracker = snapshot(run), sorted(map(repr, run.table("tracker").collect()))
    run.store = Fragile(spark, str(tmp_path))
    for writes in range(4):
        run.store.left = writes
        with pytest.raises(Killed):
            run.items(BOARDS)
        assert snapshot(run) == before
        assert sorted(map(repr, run.table("tracker").collect())) == tracker
    run.store.left = None
    assert counts(run.items(BOARDS))["insert"] == 8
    assert run.table("inventory_item").count() == 8


def test_rerun_of_a_run_adds_no_second_audit_row(spark, tmp_path):
    run = onboarding(spark, tmp_path)
    run.run_id = "june"
    run.items(BOARDS)
    run.thresholds(config(spark))
    run.thresholds(config(spark))
    assert run.store.read_log("audit", schemas.AUDIT).count() == 3
    run.run_id = "july"
    run.thresholds(config(spark))
    assert run.store.read_log("audit", schemas.AUDIT).count() == 6
