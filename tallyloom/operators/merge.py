"""Idempotent merges: each returns the new target and the action taken for every input row.

Targets are plain tables without MERGE, so the new content is computed whole and written
as the next snapshot. ``seq`` is the position of an input in the run (registry order, then
sheet order); it decides which of several inputs for one key comes first.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.fixed_values import (
    BOARD_UOM,
    CATEGORY,
    FIELD_LENGTHS,
    FIELD_REQUIRED_DEFAULT,
    FIELD_TYPE_DEFAULT,
    ITEM_LENGTHS,
    PROPERTY_LENGTHS,
)
from tallyloom.operators.checks import row_error
from tallyloom.operators.scale import dealt_join, dense_ids, first_per_key, lookup, tasks_for, with_each
from tallyloom.schemas import FIELDS, ITEMS, PROPERTIES, column_names
from tallyloom.session import stage_table


class Merge(NamedTuple):
    target: DataFrame
    actions: DataFrame


def is_complete(category: str = "category", base_uom: str = "base_uom") -> Column:
    return F.col(category).isNotNull() & F.col(base_uom).isNotNull()


def input_seq(source_no: Column, sheet_idx: Column) -> Column:
    """Position of a sheet in the run as one number."""
    return source_no * F.lit(1 << 32) + sheet_idx


def item_actions(target: DataFrame, inputs: DataFrame) -> DataFrame:
    """Insert, repair, skip or fail for ``inputs(seq, parent_key, display_name, category, base_uom, error)``.

    The first input of a name is compared with the target (unique keys on both sides);
    every later one is a skip marked ``collision``, for by then the name is complete. No
    join or window ever groups the inputs of one name.
    """
    checked = inputs.withColumn(
        "reason", F.coalesce("error", row_error(["display_name"], ITEM_LENGTHS))
    ).drop("error")
    good = checked.filter(F.col("reason").isNull())
    firsts = first_per_key(good, "display_name", "seq").withColumn("leads", F.lit(True))
    ranked = good.join(firsts, ["display_name", "seq"], "left")
    known = target.select(
        "display_name",
        F.lit(True).alias("found"),
        is_complete().alias("complete"),
    )
    leaders = ranked.filter("leads").join(known, "display_name", "left")
    action = (
        F.when(F.col("found").isNull(), "insert").when(F.col("complete"), "skip").otherwise("repair")
    )
    shape = ["seq", "parent_key", "display_name", "category", "base_uom", "reason"]
    return (
        leaders.select(*shape, action.alias("action"), F.lit(False).alias("collision"))
        .unionByName(
            ranked.filter(F.col("leads").isNull()).select(
                *shape, F.lit("skip").alias("action"), F.lit(True).alias("collision")
            )
        )
        .unionByName(
            checked.filter(F.col("reason").isNotNull()).select(
                *shape, F.lit("fail").alias("action"), F.lit(False).alias("collision")
            )
        )
    )


def _repaired(target: DataFrame, actions: DataFrame, run_ts: Column, how: str) -> DataFrame:
    """Items after repairs, all of them (``left``) or those repaired (``inner``)."""
    repairs = actions.filter(F.col("action") == "repair").select(
        "display_name",
        F.col("category").alias("new_category"),
        F.col("base_uom").alias("new_uom"),
        F.lit(True).alias("repaired"),
    )
    return target.join(repairs, "display_name", how).select(
        "item_id",
        "display_name",
        F.coalesce("category", "new_category").alias("category"),
        F.coalesce("base_uom", "new_uom").alias("base_uom"),
        "reorder_threshold",
        "created_at",
        F.when(F.col("repaired"), run_ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def _inserted(target: DataFrame, actions: DataFrame, run_ts: Column) -> DataFrame:
    highest = target.agg(F.coalesce(F.max("item_id"), F.lit(0))).scalar()
    inserts = actions.filter(F.col("action") == "insert").select("display_name", "category", "base_uom")
    return dense_ids(inserts, "display_name", highest).select(
        "item_id",
        "display_name",
        "category",
        "base_uom",
        F.lit(None).cast("int").alias("reorder_threshold"),
        run_ts.alias("created_at"),
        run_ts.alias("updated_at"),
    )


def apply_items(target: DataFrame, actions: DataFrame, run_ts: Column) -> DataFrame:
    """Target after inserts and repairs; a repair fills nulls and never overwrites."""
    kept = _repaired(target, actions, run_ts, "left")
    return kept.unionByName(_inserted(target, actions, run_ts)).select(*column_names(ITEMS))


def changed_items(target: DataFrame, actions: DataFrame, run_ts: Column) -> DataFrame:
    """The rows of ``apply_items`` that are new or repaired."""
    repaired = _repaired(target, actions, run_ts, "inner")
    return repaired.unionByName(_inserted(target, actions, run_ts)).select(*column_names(ITEMS))


def merge_items(target: DataFrame, inputs: DataFrame, run_ts: Column) -> Merge:
    actions = item_actions(target, inputs)
    return Merge(apply_items(target, actions, run_ts), actions)


def board_inputs(summary: DataFrame, key: str = "sheet", category: str = CATEGORY, base_uom: str = BOARD_UOM) -> DataFrame:
    """Merge inputs of board tabs, for ``summary`` rows with ``seq`` and ``error``."""
    return summary.select(
        "seq",
        F.col(key).alias("parent_key"),
        "display_name",
        F.lit(category).alias("category"),
        F.lit(base_uom).alias("base_uom"),
        "error",
    )


def property_actions(
    items: DataFrame, existing: DataFrame, inputs: DataFrame, limit: int | None = None
) -> DataFrame:
    """Insert, skip, blocked or fail for ``inputs(seq, parent_key, display_name, property_name, property_value)``.

    An existing value stays even if it differs, which ``value_differs`` reports; of several
    inputs for one property the first wins. A null value that reaches this point did not
    fit the column. Names and properties with very many inputs are looked up salted.
    """
    shape = ["seq", "parent_key", "display_name", "property_name", "property_value"]
    pair = ["item_id", "property_name"]
    found = lookup(
        inputs.select(*shape), items.select("display_name", "item_id"), ["display_name"],
        ["parent_key", "property_name"], limit,
    )
    reason = F.coalesce(
        F.when(F.col("property_value").isNull(), "value does not fit decimal(12,4)"),
        row_error(["property_name"], PROPERTY_LENGTHS),
    )
    # Staged: the lookup, the costliest join here, feeds four others.
    found = stage_table(found.withColumn("reason", F.when(F.col("item_id").isNotNull(), reason)), "found-properties")
    ready = found.filter(F.col("item_id").isNotNull() & F.col("reason").isNull())
    winners = (
        ready.groupBy(*pair)
        .agg(F.min("seq").alias("seq"))
        .join(existing.select(*pair), pair, "left_anti")
        .join(ready.select(*pair, "seq", "property_value"), [*pair, "seq"])
    )
    stored = (
        existing.select(*pair, F.lit(None).cast("bigint").alias("stored_seq"), F.col("property_value").alias("stored"))
        .unionByName(
            winners.select(*pair, F.col("seq").alias("stored_seq"), F.col("property_value").alias("stored"))
        )
    )
    labelled = lookup(ready, stored, pair, ["parent_key", "seq"], limit)
    won = F.coalesce(F.col("stored_seq") == F.col("seq"), F.lit(False))
    rest = found.filter(F.col("item_id").isNull() | F.col("reason").isNotNull())
    return labelled.select(
        "item_id",
        *shape,
        F.when(won, "insert").otherwise("skip").alias("action"),
        (~F.col("property_value").eqNullSafe(F.col("stored"))).alias("value_differs"),
        "reason",
    ).unionByName(
        rest.select(
            "item_id",
            *shape,
            F.when(F.col("item_id").isNull(), "blocked").otherwise("fail").alias("action"),
            F.lit(False).alias("value_differs"),
            "reason",
        )
    )


def added_properties(actions: DataFrame, run_ts: Column) -> DataFrame:
    return actions.filter(F.col("action") == "insert").select(
        "item_id", "property_name", "property_value", run_ts.alias("created_at")
    )


def apply_properties(existing: DataFrame, actions: DataFrame, run_ts: Column) -> DataFrame:
    return existing.select(*column_names(PROPERTIES)).unionByName(added_properties(actions, run_ts))


def merge_properties(
    items: DataFrame, existing: DataFrame, inputs: DataFrame, run_ts: Column, limit: int | None = None
) -> Merge:
    actions = property_actions(items, existing, inputs, limit)
    return Merge(apply_properties(existing, actions, run_ts), actions)


def field_definitions(fields: DataFrame) -> DataFrame:
    """Definitions of ``fields(field_name, field_key, field_type, is_required)``, once per key, staged."""
    first = fields.groupBy("field_key").agg(F.min(F.struct("field_name", "field_type", "is_required")).alias("d"))
    return stage_table(
        first.select(
            "d.field_name",
            "field_key",
            F.coalesce("d.field_type", F.lit(FIELD_TYPE_DEFAULT)).alias("field_type"),
            F.coalesce("d.is_required", F.lit(FIELD_REQUIRED_DEFAULT)).alias("is_required"),
        ),
        "field-definitions",
    )


def item_fields(items: DataFrame, definitions: DataFrame) -> DataFrame:
    """Every item with every field of the mapping, however many there are."""
    return with_each(items.select("item_id", "display_name"), definitions, ["item_id"])


def field_actions(items: DataFrame, fields: DataFrame, existing: DataFrame) -> DataFrame:
    """Insert, skip or conflict per item and field; only ``is_required`` is compared.

    Items are dealt over tasks before each is unfolded into its fields.
    """
    known = existing.select(
        "item_id",
        "field_key",
        F.col("is_required").alias("existing_required"),
        F.lit(True).alias("found"),
    )
    same = F.col("existing_required").eqNullSafe(F.col("is_required"))
    definitions = field_definitions(fields)
    n = items.count() * definitions.count()
    tasks = tasks_for(n)
    if tasks > 1:
        items = items.select("item_id", "display_name").repartition(tasks, "item_id", "display_name")
    wanted = item_fields(items, definitions).withColumn(
        "reason", row_error(["field_name", "field_key"], FIELD_LENGTHS)
    )
    return dealt_join(wanted, known, ["item_id", "field_key"], n).select(
        "item_id",
        "display_name",
        "field_name",
        "field_key",
        "field_type",
        "is_required",
        "existing_required",
        F.when(F.col("reason").isNotNull(), "fail")
        .when(F.col("found").isNull(), "insert")
        .when(same, "skip")
        .otherwise("conflict")
        .alias("action"),
        "reason",
    )


def added_fields(actions: DataFrame, run_ts: Column) -> DataFrame:
    added = actions.filter(F.col("action") == "insert").withColumn("created_at", run_ts)
    return added.select(*column_names(FIELDS))


def apply_fields(existing: DataFrame, actions: DataFrame, run_ts: Column) -> DataFrame:
    return existing.select(*column_names(FIELDS)).unionByName(added_fields(actions, run_ts))


def merge_fields(items: DataFrame, fields: DataFrame, existing: DataFrame, run_ts: Column) -> Merge:
    actions = field_actions(items, fields, existing)
    return Merge(apply_fields(existing, actions, run_ts), actions)


def threshold_actions(items: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Update, skip or blocked per configured name."""
    known = items.select("display_name", "item_id", F.col("reorder_threshold").alias("old_value"))
    return (
        thresholds.select("display_name", F.col("threshold").alias("new_value"))
        .join(known, "display_name", "left")
        .select(
            "display_name",
            "item_id",
            "old_value",
            "new_value",
            F.when(F.col("item_id").isNull(), "blocked")
            .when(F.col("old_value").eqNullSafe(F.col("new_value")), "skip")
            .otherwise("update")
            .alias("action"),
        )
    )


def changed_thresholds(items: DataFrame, actions: DataFrame, run_ts: Column) -> DataFrame:
    """The rows of ``apply_thresholds`` that are updated."""
    return apply_thresholds(items, actions, run_ts, "inner")


def apply_thresholds(items: DataFrame, actions: DataFrame, run_ts: Column, how: str = "left") -> DataFrame:
    """Items with updated thresholds; items not listed stay as they are (``inner``: are left out)."""
    updates = actions.filter(F.col("action") == "update").select("display_name", "new_value")
    changed = F.col("new_value").isNotNull()
    return items.join(updates, "display_name", how).select(
        "item_id",
        "display_name",
        "category",
        "base_uom",
        F.coalesce("new_value", "reorder_threshold").cast("int").alias("reorder_threshold"),
        "created_at",
        F.when(changed, run_ts).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def merge_thresholds(items: DataFrame, thresholds: DataFrame, run_ts: Column) -> Merge:
    actions = threshold_actions(items, thresholds)
    return Merge(apply_thresholds(items, actions, run_ts), actions)
