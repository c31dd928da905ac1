"""Validation of configuration and of the target tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.fixed_values import MSG_THRESHOLD
from tallyloom.operators.scale import lookup
from tallyloom.session import stage_table


def threshold_entries(config: DataFrame, column: str = "value") -> DataFrame:
    """Entries of ``{"thresholds": {name: value}}`` documents as ``(display_name, value_text)``.

    ``value_text`` is the value's JSON text. A document of another shape gives one row
    without name, whose ``error`` says what is wrong.
    """
    doc = F.try_parse_json(F.col(column))
    kind = F.schema_of_variant(doc)
    part = F.try_variant_get(doc, "$.thresholds", "variant")
    part_kind = F.schema_of_variant(part)
    error = (
        F.when(doc.isNull(), "not valid JSON")
        .when(~kind.startswith("OBJECT"), "not a JSON object at the top level")
        .when(part.isNull(), "missing required key 'thresholds'")
        .when(~part_kind.startswith("OBJECT"), "'thresholds' is not a JSON object")
    )
    entries = F.from_json(F.to_json(part), "map<string,variant>")
    rows = config.select(error.alias("error"), F.when(error.isNull(), entries).alias("entries"))
    return rows.select("error", F.explode_outer("entries").alias("display_name", "v")).filter(
        F.col("error").isNotNull() | F.col("display_name").isNotNull()
    ).select("display_name", F.to_json("v").alias("value_text"), "error")


def is_positive_integer(value_text: Column) -> Column:
    """A JSON integer above zero; ``true``, ``1.5`` and ``"5"`` are not."""
    value = F.try_parse_json(value_text)
    whole = F.schema_of_variant(value) == "BIGINT"
    return F.coalesce(whole & (value_text.try_cast("bigint") > 0), F.lit(False))


def checked_thresholds(entries: DataFrame) -> DataFrame:
    """Entries with the threshold as number and the error text of invalid ones.

    A name given more than once is an error as well, even with one value throughout: merged
    as it stands it would multiply the item's row.
    """
    ok = is_positive_integer(F.col("value_text"))
    text = F.printf(F.lit(MSG_THRESHOLD), F.col("display_name"), F.col("value_text"))
    repeated = repeated_keys(entries.filter(F.col("display_name").isNotNull()), ["display_name"])
    entries = lookup(entries, stage_table(repeated, "repeated-names"), ["display_name"], ["value_text"])
    again = F.when(F.col("n") > 1, F.printf(F.lit("'%s': given %d times"), F.col("display_name"), F.col("n")))
    return entries.select(
        "display_name",
        "value_text",
        F.when(F.col("error").isNull() & ok & again.isNull(), F.col("value_text").try_cast("int")).alias("threshold"),
        F.coalesce(
            "error", F.when(~ok, text), F.when(F.col("value_text").try_cast("int").isNull(), text), again
        ).alias("error"),
    )


class InvalidConfig(ValueError):
    """Raised before anything is written when a configuration has errors."""


def require_valid(checked: DataFrame, keep: Callable[[DataFrame], str] | None = None) -> DataFrame:
    """All or nothing: the thresholds, or an exception with the number of errors and the first.

    ``keep`` stores the full list of errors and returns the name of its table.
    """
    bad = checked.filter(F.col("error").isNotNull())
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.min("error").alias("first")).first()
    if found.n:
        where = f"; all of them are in {keep(bad)}" if keep else ""
        raise InvalidConfig(f"{found.n} errors, the first: {found['first']}{where}")
    return checked.select("display_name", "threshold")


def repeated_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def row_error(required: list[str], lengths: dict[str, int]) -> Column:
    """First not-null or length rule a row breaks, null if it keeps all."""
    rules = [F.when(F.col(c).isNull(), f"{c} is null") for c in required]
    rules += [F.when(F.length(c) > n, f"{c} longer than {n}") for c, n in lengths.items()]
    return F.coalesce(*rules, F.lit(None).cast("string"))


def invalid_rows(table: DataFrame, required: list[str], lengths: dict[str, int]) -> DataFrame:
    return table.withColumn("error", row_error(required, lengths)).filter(F.col("error").isNotNull())


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children without parent. The parents are unique on the key."""
    return children.join(parents.select(key), key, "left_anti")


def cascade(children: DataFrame, surviving: DataFrame, key: str) -> DataFrame:
    """Children that remain after parents were deleted."""
    return children.join(surviving.select(key), key, "left_semi")


def with_defaults(table: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column defaults where a value is null."""
    return table.select(
        *[
            F.coalesce(c, d if isinstance(d, Column) else F.lit(d)).alias(c) if (d := defaults.get(c)) is not None else c
            for c in table.columns
        ]
    )
