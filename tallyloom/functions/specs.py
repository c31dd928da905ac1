"""Specification strings and the typed properties in them."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.fixed_values import (
    BOARD_PROPERTIES,
    GLUE_PROPERTIES,
    GLUE_SPEC,
    MSG_GLUE_FORMAT,
    MSG_NOT_NUMERIC,
    MSG_SEGMENTS,
)
from tallyloom.functions.text import trim_py

VALUE_TYPE = "decimal(12,4)"
# Wider than the target column, so that "not a number" and "does not fit" stay apart.
_NUMBER_TYPE = "decimal(38,10)"


def to_value(number: Column) -> Column:
    """Number or numeric text as stored: rounded half up to four digits, null on overflow."""
    return number.try_cast(VALUE_TYPE)


def _is_number(text: Column) -> Column:
    return text.try_cast(_NUMBER_TYPE).isNotNull()


def _parsed(names, texts, error: Column) -> Column:
    values = [F.when(error.isNull(), to_value(t)) for t in texts]
    lost = values[0].isNull()
    for value in values[1:]:
        lost = lost | value.isNull()
    return F.struct(
        *[v.alias(n) for n, v in zip(names, values)],
        error.alias("error"),
        (error.isNull() & lost).alias("overflow"),
    )


def parse_board_spec(raw: Column) -> Column:
    """``T*W*L`` as ``struct<thickness,width,length,error,overflow>``."""
    parts = F.split(raw, r"\*", -1)
    texts = [trim_py(F.get(parts, F.lit(i))) for i in range(3)]
    numeric = _is_number(texts[0]) & _is_number(texts[1]) & _is_number(texts[2])
    error = F.when(F.size(parts) != 3, F.printf(F.lit(MSG_SEGMENTS), F.size(parts), raw)).when(
        ~numeric, F.printf(F.lit(MSG_NOT_NUMERIC), raw)
    )
    return _parsed(BOARD_PROPERTIES, texts, error)


def parse_glue_spec(raw: Column) -> Column:
    """``<weight>kg/<count>bag`` as ``struct<weight_per_bag_kg,bags_per_unit,error,overflow>``."""
    text = trim_py(raw)
    texts = [F.regexp_extract(text, GLUE_SPEC, i) for i in (1, 2)]
    error = F.when(~text.rlike(GLUE_SPEC), F.printf(F.lit(MSG_GLUE_FORMAT), raw))
    return _parsed(GLUE_PROPERTIES, texts, error)


def unpivot_properties(df: DataFrame, parsed: str, names, keep) -> DataFrame:
    """One row per property of a parsed specification; map-side fan-out only."""
    pairs = [
        F.struct(F.lit(n).alias("property_name"), F.col(f"{parsed}.{n}").alias("property_value"))
        for n in names
    ]
    return df.select(*keep, F.inline(F.array(*pairs)))
