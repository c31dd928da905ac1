"""Tracker, quarantine, validation and merge rules on small cases."""

import pytest
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.operators import checks, merge, quarantine, tracking

TS = "2024-06-01 00:00:00"


def now():
    return F.lit(TS).cast("timestamp")


@pytest.fixture
def tracker(spark):
    rows = [
        ("s", "a", None, None, "h", 1, "processed", None, None),
        ("s", "b", None, None, "h", 1, "loaded", None, None),
        ("s", "c", None, None, "h", 1, "pending", None, None),
        ("s", "d", None, None, "old", 1, "loaded", None, None),
        ("s", "e", None, None, None, None, None, None, None),
        ("other", "a", None, None, "zzz", 1, "pending", None, None),
    ]
    return spark.createDataFrame(rows, schemas.struct_type(schemas.TRACKER))


@pytest.fixture
def files(spark):
    rows = [(k, f"{k}.x", "src", None if k == "gone" else "h", 7) for k in "abcdef"] + [("gone", "g", "src", None, None)]
    return spark.createDataFrame(rows, "file_key string, filename string, source_id string, hash string, size_bytes bigint")


def test_needs_processing(files, tracker):
    mine = tracking.of_stage(tracker, "s")
    flags = {r.file_key: r.needs_processing for r in tracking.with_state(files, mine).collect()}
    assert flags == {"a": False, "b": False, "c": True, "d": True, "e": True, "f": True, "gone": False}
    forced = tracking.with_state(files, mine, force=True)
    assert forced.filter("needs_processing").count() == 7
    assert sorted(r.file_key for r in tracking.unprocessed(files, mine).collect()) == ["c", "d", "e", "f"]
    assert [r.file_key for r in tracking.needs_loading(files, mine).collect()] == ["a"]
    assert {r.status: r.n for r in tracking.status_summary(mine).collect()} == {"processed": 1, "loaded": 2, "pending": 2}


def test_tracker_changes(files, tracker):
    state = tracking.mark_loaded(tracker, "s", files.filter("file_key in ('a', 'f')"), now())
    rows = {(r.stage, r.file_key): r for r in state.collect()}
    assert rows["s", "a"].status == "loaded" and rows["s", "a"].hash == "h"
    assert rows["s", "f"].status == "loaded" and rows["s", "f"].hash is None
    assert rows["other", "a"].status == "pending" and len(rows) == 7

    state = tracking.mark_processed(state, "s", files.filter("file_key in ('a', 'd')"), now())
    rows = {(r.stage, r.file_key): r for r in state.collect()}
    assert rows["s", "a"].status == "processed" and rows["s", "a"].loaded_at is not None
    assert (rows["s", "d"].hash, rows["s", "d"].size_bytes) == ("h", 7)

    kept = tracking.mark_processed(tracker, "s", files.filter("file_key in ('a', 'd')"), now(), keep_loaded=True)
    rows = {(r.stage, r.file_key): r for r in kept.collect()}
    assert rows["s", "d"].status == "loaded" and rows["s", "d"].hash == "old"

    rows = {(r.stage, r.file_key): r for r in tracking.reset(tracker, "s", files.filter("file_key = 'b'")).collect()}
    assert rows["s", "b"].status == "pending" and rows["s", "b"].hash == "h"


def _quarantine(spark, rows):
    return spark.createDataFrame(
        [(s, p, c, "r", "", 0, None) for s, p, c in rows], schemas.struct_type(schemas.QUARANTINE)
    )


def test_settle_keeps_latest_outcome(spark):
    old = _quarantine(spark, [("x", "6MM", ""), ("x", "9MM", ""), ("y", "6MM", "")])
    outcomes = spark.createDataFrame(
        [("x", "6MM", "", False, "one", "", 1), ("x", "6MM", "", True, None, "", 2), ("x", "12MM", "", True, None, "", 1), ("x", "12MM", "", False, "two", "", 3)],
        "script string, parent_key string, child_key string, ok boolean, reason string, detail string, seq bigint",
    )
    got = {(r.script, r.parent_key, r.reason) for r in quarantine.settle(old, outcomes, now()).collect()}
    assert got == {("x", "9MM", "r"), ("y", "6MM", "r"), ("x", "12MM", "two")}


def test_retry_selection(spark):
    work = spark.createDataFrame([(t, p) for t in ("6MM", "6MM1", "9MM") for p in ("a", "b")], "parent_key string, child_key string")
    pending = _quarantine(spark, [("x", "6MM", "a"), ("x", "9MM", "parse")])
    chosen, skipped = quarantine.retry_parents(work, pending, ["child_key"])
    assert chosen.count() == 4 and skipped.count() == 2
    exact = {tuple(r) for r in quarantine.retry_children(work, pending).collect()}
    assert exact == {("6MM", "a"), ("9MM", "a"), ("9MM", "b")}
    assert quarantine.run_mode(pending) == "retry"
    assert quarantine.run_mode(pending.limit(0)) == "full"
    assert quarantine.run_mode(pending.limit(0), retry=True) == "noop"


BAD_CONFIGS = [
    "{broken", "[]", "5", '{"other": {}}', '{"thresholds": [1]}', '{"thresholds": {"a": true}}',
    '{"thresholds": {"a": 1.5}}', '{"thresholds": {"a": "5"}}', '{"thresholds": {"a": 0}}',
    '{"thresholds": {"a": null}}', '{"thresholds": {"a": 5, "b": -1}}',
]


@pytest.mark.parametrize("text", BAD_CONFIGS)
def test_bad_threshold_config_stops(spark, text):
    config = spark.createDataFrame([(text,)], "value string")
    checked = checks.checked_thresholds(checks.threshold_entries(config))
    with pytest.raises(checks.InvalidConfig):
        checks.require_valid(checked)


def test_good_threshold_config(spark):
    config = spark.createDataFrame([('{"_comment": "x", "thresholds": {"9mm MDF": 500, "a": 1}}',)], "value string")
    checked = checks.checked_thresholds(checks.threshold_entries(config))
    assert {tuple(r) for r in checks.require_valid(checked).collect()} == {("9mm MDF", 500), ("a", 1)}


def test_item_merge_in_one_batch(spark):
    moment = "cast(null as timestamp)"
    target = spark.sql(
        f"select 7L as item_id, 'a' as display_name, cast(null as string) as category, 'pcs' as base_uom, 3 as reorder_threshold, {moment} as created_at, {moment} as updated_at"
        f" union all select 9L, 'full', 'c', 'u', null, {moment}, {moment}"
    )
    inputs = spark.createDataFrame(
        [(1, "t1", "a", None), (2, "t2", "new", None), (3, "t3", "new", None), (4, "t4", "full", None), (5, "t5", None, "no items"), (6, "t6", "x" * 300, None), (7, "t7", None, None)],
        "seq bigint, parent_key string, display_name string, error string",
    ).withColumns({"category": F.lit("Raw Material"), "base_uom": F.lit("sheets (pcs)")})
    result = merge.merge_items(target, inputs, now())
    actions = {r.seq: (r.action, r.collision) for r in result.actions.collect()}
    assert actions == {1: ("repair", False), 2: ("insert", False), 3: ("skip", True), 4: ("skip", False), 5: ("fail", False), 6: ("fail", False), 7: ("fail", False)}
    items = {r.display_name: r for r in result.target.collect()}
    assert set(items) == {"a", "full", "new"}
    assert (items["a"].category, items["a"].base_uom, items["a"].item_id, items["a"].reorder_threshold) == ("Raw Material", "pcs", 7, 3)
    assert items["a"].updated_at is not None and items["full"].updated_at is None
    assert items["new"].item_id == 10
    again = merge.merge_items(result.target, inputs, now())
    assert {r.action for r in again.actions.collect()} == {"skip", "fail"}
    assert sorted(map(repr, again.target.collect())) == sorted(map(repr, result.target.collect()))


@pytest.mark.parametrize("limit", [None, 0])
def test_property_merge(spark, limit):
    items = spark.createDataFrame([(1, "a"), (2, "b")], "item_id bigint, display_name string")
    existing = spark.sql("select 1L as item_id, 'thickness' as property_name, cast(3 as decimal(12,4)) as property_value, cast(null as timestamp) as created_at")
    inputs = spark.createDataFrame(
        [(1, "t1", "a", "thickness", "3"), (2, "t2", "a", "thickness", "4"), (3, "t3", "b", "thickness", "5"), (4, "t4", "b", "thickness", "6"), (5, "t5", "none", "thickness", "1"), (6, "t6", "b", "width", None)],
        "seq bigint, parent_key string, display_name string, property_name string, v string",
    ).withColumn("property_value", F.col("v").cast("decimal(12,4)")).drop("v")
    result = merge.merge_properties(items, existing, inputs, now(), limit)
    got = {r.seq: (r.action, r.value_differs) for r in result.actions.collect()}
    assert got == {1: ("skip", False), 2: ("skip", True), 3: ("insert", False), 4: ("skip", True), 5: ("blocked", False), 6: ("fail", False)}
    assert {(r.item_id, int(r.property_value)) for r in result.target.collect()} == {(1, 3), (2, 5)}


def test_table_checks(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "k bigint, name string")
    assert [tuple(r) for r in checks.repeated_keys(df, ["k"]).collect()] == [(1, 2)]
    assert [r.error for r in checks.invalid_rows(df, ["name"], {"name": 5}).collect()] == ["name is null"]
    parents = df.filter("name = 'x'").select("k")
    assert checks.orphans(df, parents, "k").count() == 1
    assert checks.cascade(df, parents, "k").count() == 2
    assert checks.with_defaults(df, {"name": "text"}).filter("name = 'text'").count() == 1
