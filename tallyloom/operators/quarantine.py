"""Quarantine of failed keys, retry selection, audit trail and run summaries.

Keys are kept as (parent, child), e.g. tab and property, so that retrying everything of a
tab is an equi-join and not a prefix match.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.fixed_values import (
    BOARD_PROPERTIES,
    GLUE_PROPERTIES,
    STAGE_FIELDS,
    STAGE_GLUE_SPECS,
    STAGE_SPECS,
    THRESHOLD_FIELD,
)
from tallyloom.functions.text import key_of
from tallyloom.operators.scale import drop_keys, keep_keys, lookup
from tallyloom.schemas import AUDIT, MANIFEST, QUARANTINE, column_names

KEY = ["script", "parent_key", "child_key"]
NO_CHILD = ""
_COLUMNS = column_names(QUARANTINE)


def last_outcomes(outcomes: DataFrame) -> DataFrame:
    """Last ``seq`` and ``ok`` per key of ``outcomes(script, parent_key, child_key, ok, ..., seq)``.

    Both go into one number, so this is a hash aggregate that keeps one record per key and
    task: a key that fails over and over does not gather its history anywhere.
    """
    last = F.max(F.col("seq") * 2 + F.col("ok").cast("bigint"))
    return (
        outcomes.groupBy(*KEY)
        .agg(last.alias("last"))
        .select(
            *KEY,
            F.shiftright("last", 1).alias("seq"),
            (F.col("last").bitwiseAND(F.lit(1)) == 1).alias("ok"),
        )
    )


def last_failures(outcomes: DataFrame, last: DataFrame) -> DataFrame:
    """Reason and detail of the keys whose last outcome is a failure; only failures are looked at."""
    failed = last.filter(~F.col("ok")).select(*KEY, "seq")
    return (
        outcomes.filter(~F.col("ok"))
        .join(failed, [*KEY, "seq"])
        .groupBy(*KEY, "seq")
        .agg(F.max(F.struct("reason", "detail")).alias("text"))
        .select(*KEY, "text.reason", "text.detail", "seq")
    )


def settle(quarantine: DataFrame, outcomes: DataFrame, ts: Column) -> DataFrame:
    """Quarantine after a run: failures replace earlier entries of their key, successes remove them."""
    last = last_outcomes(outcomes)
    failed = last_failures(outcomes, last).withColumn("ts", ts)
    return (
        quarantine.join(last.select(*KEY), KEY, "left_anti")
        .select(*_COLUMNS)
        .unionByName(failed.select(*_COLUMNS))
    )


def parent_changes(
    quarantine: DataFrame, script: str, parents: DataFrame, failures: DataFrame, ts: Column
) -> tuple[DataFrame, DataFrame]:
    """What ``settle_parents`` writes anew, and the keys of what it removes or replaces."""
    done = parents.select(F.lit(script).alias("script"), "parent_key").distinct()
    outcomes = failures.withColumn("script", F.lit(script)).withColumn("ok", F.lit(False))
    failed = last_failures(outcomes, last_outcomes(outcomes)).withColumn("ts", ts)
    own = quarantine.filter(F.col("script") == script)
    return failed.select(*_COLUMNS), keep_keys(own, done, ["script", "parent_key"], ["child_key"]).select(*KEY)


def settle_parents(
    quarantine: DataFrame, script: str, parents: DataFrame, failures: DataFrame, ts: Column
) -> DataFrame:
    """As ``settle`` where parents are processed whole.

    All earlier entries of a processed parent go, also stage-level ones such as
    ``all``; what still fails comes back with ``failures``.
    """
    done = parents.select(F.lit(script).alias("script"), "parent_key").distinct()
    outcomes = failures.withColumn("script", F.lit(script)).withColumn("ok", F.lit(False))
    failed = last_failures(outcomes, last_outcomes(outcomes)).withColumn("ts", ts)
    return (
        drop_keys(quarantine, done, ["script", "parent_key"], ["child_key"])
        .join(failed.select(*KEY), KEY, "left_anti")
        .select(*_COLUMNS)
        .unionByName(failed.select(*_COLUMNS))
    )


def key_text(script="script", parent="parent_key", child="child_key") -> Column:
    """Key as one text: the parent alone, ``parent.child``, or ``parent::child`` for fields."""
    return (
        F.when(F.col(child) == NO_CHILD, F.col(parent))
        .when(F.col(script) == STAGE_FIELDS, key_of(F.col(parent), F.col(child), sep="::"))
        .otherwise(key_of(F.col(parent), F.col(child)))
    )


# What can follow the parent in a key text of the specification stages.
_CHILDREN = "|".join(["all", "parse", *BOARD_PROPERTIES, *GLUE_PROPERTIES, r"variant_[\s\S]*"])


def split_key(script: Column, key: Column) -> tuple[Column, Column]:
    """Parent and child of a key text; stages without children keep the text whole.

    A parent may hold dots: the text is cut where a known child name follows.
    """
    by_dot, by_colons = rf"^([\s\S]*?)\.({_CHILDREN})$", r"^([\s\S]*?)::([\s\S]*)$"
    specs = script.isin(STAGE_SPECS, STAGE_GLUE_SPECS) & key.rlike(by_dot)
    fields = (script == STAGE_FIELDS) & key.rlike(by_colons)

    def part(n: int) -> Column:
        return F.when(specs, F.regexp_extract(key, by_dot, n)).when(fields, F.regexp_extract(key, by_colons, n))

    return F.coalesce(part(1), key), F.coalesce(part(2), F.lit(NO_CHILD))


def failures_of(quarantine: DataFrame, script: str) -> DataFrame:
    return quarantine.filter(F.col("script") == script)


def failed_keys(quarantine: DataFrame, script: str) -> DataFrame:
    return failures_of(quarantine, script).select("parent_key", "child_key").distinct()


def run_mode(pending: DataFrame, retry: bool = False) -> str:
    """``full``, ``retry`` if keys are pending, ``noop`` if a retry was asked for and none are."""
    if not pending.isEmpty():
        return "retry"
    return "noop" if retry else "full"


def retry_parents(
    work: DataFrame, pending: DataFrame, spread_by: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Split ``work(parent_key, ...)`` into rows of pending parents, and the others (skipped)."""
    parents = pending.select("parent_key").distinct()
    return (
        keep_keys(work, parents, ["parent_key"], spread_by),
        drop_keys(work, parents, ["parent_key"], spread_by),
    )


def is_stage_level(child: Column) -> Column:
    return child.isin(NO_CHILD, "all", "parse") | child.startswith("variant_")


def retry_children(work: DataFrame, pending: DataFrame) -> DataFrame:
    """``work(parent_key, child_key, ...)`` that is pending by itself or through its parent.

    A stage-level entry of the parent releases all its children.
    """
    stage = is_stage_level(F.col("child_key"))
    parents = pending.filter(stage).select("parent_key").distinct().withColumn("by_parent", F.lit(True))
    exact = (
        pending.filter(~stage).select("parent_key", "child_key").distinct().withColumn("by_key", F.lit(True))
    )
    keys = ["parent_key", "child_key"]
    spread = [c for c in work.columns if c not in keys] or keys
    return (
        lookup(lookup(work, parents, ["parent_key"], ["child_key"]), exact, keys, spread)
        .filter(F.coalesce("by_parent", "by_key", F.lit(False)))
        .select(*work.columns)
    )


def audit_rows(actions: DataFrame, script: str, ts: Column, field: str = THRESHOLD_FIELD) -> DataFrame:
    """Audit trail of threshold actions with old and new value."""
    return actions.select(
        F.lit(script).alias("script"),
        F.col("display_name").alias("material"),
        F.lit(field).alias("field"),
        F.col("old_value").cast("bigint").alias("old_value"),
        F.col("new_value").cast("bigint").alias("new_value"),
        "action",
        ts.alias("ts"),
    ).select(*column_names(AUDIT))


def action_counts(actions: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """Number of rows per action, one column each, over all rows or per group."""
    counts = [F.count_if(F.col("action") == n).alias(n) for n in names]
    return actions.groupBy(*(by or [])).agg(*counts)


def manifest_rows(
    counts: DataFrame, script: str, mode: str, ts: Column, must_be_zero: list[str]
) -> DataFrame:
    """Load manifest of ``counts(source_id, <counter>...)``: only sources in which nothing failed."""
    names = [c for c in counts.columns if c != "source_id"]
    summary = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("bigint"))])
    clean = F.lit(True)
    for name in must_be_zero:
        clean = clean & (F.col(name) == 0)
    return counts.filter(clean).select(
        F.lit(script).alias("script"),
        "source_id",
        F.lit(mode).alias("mode"),
        ts.alias("loaded_at"),
        summary.alias("summary"),
    ).select(*column_names(MANIFEST))
