"""Skew-safe joins and numbering give what the plain forms give."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import scale
from tallyloom.session import stage_table


@pytest.fixture
def rows(spark):
    """A third of all rows under one key, some keys unknown, some null."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 17 == 0, None).otherwise(
        F.concat(F.lit("k"), F.col("id") % 10)
    )
    return spark.range(300).select("id", key.alias("key"))


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("hot", 1)] + [(f"k{i}", i * 10) for i in range(7)] + [("unused", 5)], "key string, value int"
    )


@pytest.mark.parametrize("limit, hot_rows", [(None, None), (0, 1000), (0, 20), (0, 3)])
def test_lookup(rows, table, limit, hot_rows):
    got = scale.lookup(rows, table, ["key"], ["id"], limit, hot_rows)
    want = rows.join(table, "key", "left")
    columns = ["id", "key", "value"]
    assert {tuple(r) for r in got.select(columns).collect()} == {
        tuple(r) for r in want.select(columns).collect()
    }
    assert got.count() == 300


def test_salted_lookup_spreads_the_hot_key(spark, rows, table):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = scale.lookup(rows, table, ["key"], ["id"], limit=0, hot_rows=10)
        plan = got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")
        assert "salt" in plan
        assert got.filter("value is not null").count() == rows.join(table, "key").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [None, 0])
def test_keep_and_drop(rows, table, limit):
    keys = table.select("key").filter("key <> 'k3'")
    kept = scale.keep_keys(rows, keys, ["key"], ["id"], limit)
    dropped = scale.drop_keys(rows, keys, ["key"], ["id"], limit)
    assert kept.columns == rows.columns
    assert kept.count() == rows.join(keys, "key", "left_semi").count()
    assert dropped.count() == rows.join(keys, "key", "left_anti").count()


def test_dense_ids_are_dense_and_stable(spark):
    names = spark.range(1000).select(F.concat(F.lit("n"), F.col("id")).alias("name"))
    one = scale.dense_ids(names.repartition(1), "name", F.lit(50), buckets=16)
    seven = scale.dense_ids(names.repartition(7), "name", F.lit(50), buckets=16)
    ids = {r.name: r.item_id for r in one.collect()}
    assert sorted(ids.values()) == list(range(51, 1051))
    assert ids == {r.name: r.item_id for r in seven.collect()}


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, i int")
    assert scale.measured_bytes(df) == 3 + 2 * 32
    assert scale.measured_bytes(df.limit(0)) == 0


def test_retry_spreads_a_hot_key(spark, monkeypatch):
    """With broadcasts off, both lookups of a retry are salted, and the result is the same."""
    from tallyloom.operators import quarantine, scale

    rows = [("a", "p", i) for i in range(50)] + [("a", "q", 1), ("b", "p", 2), ("c", "all", 3)]
    work = spark.createDataFrame(rows, "parent_key string, child_key string, seq bigint")
    pending = spark.createDataFrame([("a", "p"), ("c", "all"), ("z", "p")], "parent_key string, child_key string")
    want = sorted(map(tuple, quarantine.retry_children(work, pending).collect()))
    assert len(want) == 51
    monkeypatch.setattr(scale, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(scale, "HOT_ROWS", 8)
    spread = quarantine.retry_children(work, pending)
    assert sorted(map(tuple, spread.collect())) == want
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS salt#") == 2  # one per lookup, on the side of the rows


def test_staged_tables_can_be_dropped(spark):
    from pathlib import Path

    from tallyloom.session import drop_staged, shared_dir, stage_table

    stage_table(spark.range(3), "kept-for-a-while")
    folder = Path(shared_dir(spark).removeprefix("file:")) / "tables" / spark.sparkContext.applicationId
    other = folder.parent / "an-earlier-run"
    other.mkdir(parents=True)
    drop_staged(spark, "an-earlier-run")
    assert folder.exists() and not other.exists()


@pytest.mark.parametrize("options", [{}, {"chunk": 4}, {"chunk": 4, "limit": -1}])
def test_each_row_with_each_of_a_table(spark, monkeypatch, options):
    monkeypatch.setattr(scale, "SHARE_ROWS", 7)
    rows = spark.range(30).select("id", F.lit("x").alias("name"))
    table = stage_table(
        spark.createDataFrame([(f"k{i}", None if i % 3 else i, i % 2 == 0) for i in range(23)], "key string, n int, b boolean"), "each"
    )
    got = scale.with_each(rows, table, ["id"], **options)
    assert got.columns == ["id", "name", "key", "n", "b"]
    want = sorted((r.id, "x", *map(str, t)) for r in rows.collect() for t in table.collect())
    assert sorted((r[0], r[1], *map(str, r[2:])) for r in got.collect()) == want


def test_five_thousand_field_definitions(spark):
    from tallyloom import schemas
    from tallyloom.operators import merge

    fields = spark.range(5000).select(
        F.concat(F.lit("Field "), "id").alias("field_name"), F.concat(F.lit("f"), "id").alias("field_key"),
        F.lit(None).cast("string").alias("field_type"), (F.col("id") % 2 == 0).alias("is_required"),
    )
    items = spark.range(20).select(F.col("id").alias("item_id"), F.concat(F.lit("item "), "id").alias("display_name"))
    existing = spark.createDataFrame([(3, "Field 7", "f7", "text", True, None)], schemas.struct_type(schemas.FIELDS))
    counted = merge.field_actions(items, fields, existing).groupBy("action").count().collect()
    assert {r.action: r["count"] for r in counted} == {"insert": 20 * 5000 - 1, "conflict": 1}


@pytest.mark.parametrize("broadcast_bytes", [-1, 1 << 20])
def test_fields_of_items_from_one_split_are_joined_by_many_tasks(spark, monkeypatch, broadcast_bytes):
    """A table read as one split was sorted and joined by one task, whose memory grew with it."""
    from tallyloom.operators import merge

    monkeypatch.setattr(scale, "BROADCAST_BYTES", broadcast_bytes)
    monkeypatch.setattr(scale, "JOIN_ROWS", 200, raising=False)
    fields = spark.createDataFrame([(f"Field {i}", f"f{i}", "text", i % 2 == 0) for i in range(10)], "field_name string, field_key string, field_type string, is_required boolean")
    ids = [*range(300), None, None]
    items = spark.createDataFrame([(i, f"item {i}") for i in ids], "item_id bigint, display_name string").coalesce(1)
    there = [(i, f"f{k}", (i + k) % 3 == 0) for i in range(300) for k in range(10) if (i * 7 + k) % 4 == 0]
    there += [there[0], (None, "f1", True), (5, None, True)]
    existing = spark.createDataFrame(there, "item_id bigint, field_key string, is_required boolean").coalesce(1)
    got = merge.field_actions(items, stage_table(fields, "fields"), existing).withColumn("task", F.spark_partition_id()).collect()

    want = []
    for i in ids:
        for k in range(10):
            found = [r for n, key, r in there if i is not None and (n, key) == (i, f"f{k}")]
            want += [(str(i), f"f{k}", str(r), "skip" if r == (k % 2 == 0) else "conflict") for r in found]
            want += [] if found else [(str(i), f"f{k}", "None", "insert")]
    assert sorted((str(r.item_id), r.field_key, str(r.existing_required), r.action) for r in got) == sorted(want)
    assert max(Counter(r.task for r in got).values()) < 600
