"""Cells: typed values kept as ``struct<dtype,sval>``, and tests over a row of them."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.functions.text import is_blank, trim_py

_TAGS = (
    (T.BooleanType, "bool"),
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "int"),
    ((T.FloatType, T.DoubleType), "float"),
    (T.DecimalType, "Decimal"),
    ((T.TimestampType, T.TimestampNTZType), "datetime"),
    (T.DateType, "date"),
    (T.DayTimeIntervalType, "timedelta"),
)


def is_formula(text: Column) -> Column:
    return trim_py(text).startswith("=")


def type_tag(kind: Column, sval: Column) -> Column:
    """Tag of a decoded cell whose value kind is known; text starting with ``=`` is a formula."""
    return (
        F.when(sval.isNull() | kind.isNull() | (kind == "null"), "null")
        .when((kind == "str") & is_formula(sval), "formula")
        .otherwise(kind)
    )


def text_tag(sval: Column) -> Column:
    """Tag of a cell from a text format, where the kind has to be read off the text."""
    text = trim_py(sval)
    return (
        F.when(F.length(text) == 0, "null")
        .when(is_formula(sval), "formula")
        .when(F.lower(text).isin("true", "false"), "bool")
        .when(text.rlike(r"^[+-]?\d+$"), "int")
        .when(text.rlike(r"^[+-]?(\d+\.\d*|\.?\d+)([eE][+-]?\d+)?$"), "float")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"), "datetime")
        .when(sval.isNull(), "null")
        .otherwise("str")
    )


def make_cell(dtype, sval) -> Column:
    """One cell; a cell tagged null carries no text.

    The struct is not cast, so reading the tags of an array of cells that is built on the
    fly reduces to computing the tags.
    """
    dtype = dtype if isinstance(dtype, Column) else F.lit(dtype)
    sval = sval if isinstance(sval, Column) else F.lit(sval)
    text = F.when(dtype != "null", sval.cast("string"))
    return F.struct(dtype.alias("dtype"), text.alias("sval"))


def column_cell(field: T.StructField) -> Column:
    """Cell of a typed table column; its tag follows from the schema."""
    col = F.col(f"`{field.name}`")
    text = col.cast("string")
    if isinstance(field.dataType, (T.StringType, T.VarcharType, T.CharType)):
        return make_cell(type_tag(F.lit("str"), text), text)
    tag = next((t for kinds, t in _TAGS if isinstance(field.dataType, kinds)), None)
    if tag is None:
        tag, text = field.dataType.typeName(), F.to_json(F.struct(col))
    return make_cell(F.when(col.isNull(), "null").otherwise(tag), text)


# The tests below take the tag array alone (``cells.dtype``), so a scan that needs no
# cell text does not read it.


def filled_count(dtypes: Column) -> Column:
    """Number of non-null cells; ``array_remove`` is compiled, a lambda filter is not."""
    return F.size(F.array_remove(dtypes, "null"))


def has_filled(dtypes: Column) -> Column:
    return filled_count(dtypes) > 0


def filled_width(dtypes: Column) -> Column:
    """Position (1-based) of the last non-null cell, 0 if there is none."""
    back = F.array_position(F.transform(F.reverse(dtypes), lambda d: d != "null"), True)
    return F.when(back == 0, 0).otherwise(F.size(dtypes) - back + 1).cast("int")


def text_count(svals: Column) -> Column:
    """Number of cells with text other than white space."""
    return F.size(F.filter(svals, lambda s: ~is_blank(s)))


def has_tokens(svals: Column, tokens) -> Column:
    """All tokens occur among the stripped, lower-cased cells.

    The joined text of the row is searched first; only rows that contain every token
    somewhere pay for the exact test cell by cell.
    """
    text = F.lower(F.array_join(svals, " "))
    somewhere = text.contains(tokens[0])
    for token in tokens[1:]:
        somewhere = somewhere & text.contains(token)
    words = F.transform(svals, lambda s: F.lower(trim_py(s)))
    exact = F.size(F.array_except(F.array(*[F.lit(t) for t in tokens]), words)) == 0
    return F.when(somewhere, exact).otherwise(False)


def cell_text(col_idx: int) -> Column:
    """Text of the cell at a 0-based position, null where the row is shorter."""
    return F.get(F.col("cells.sval"), F.lit(col_idx))


def row_digest(cells: Column) -> Column:
    """Type-sensitive digest of a row, equal for rows that differ in trailing nulls only.

    Digested are the tags of the filled cells and all texts as JSON, which escapes them, so
    different rows give different strings. JSON texts end in a quote; stripping the letters
    of ``null``, commas and the bracket from the end therefore removes trailing nulls only.
    """
    tags = F.array_join(F.array_remove(cells["dtype"], "null"), ",")
    texts = F.rtrim(F.to_json(cells["sval"]), F.lit("nul,]"))
    return F.unhex(F.sha2(F.concat(tags, F.lit("|"), texts), 256))


def cells_of(grid: DataFrame) -> DataFrame:
    """Long form of a grid: one row per cell."""
    keys = [c for c in grid.columns if c != "cells"]
    return grid.select(*keys, F.posexplode("cells").alias("pos", "cell")).select(
        *keys,
        F.col("pos").cast("bigint").alias("col_idx"),
        F.col("cell.dtype").alias("dtype"),
        F.col("cell.sval").alias("sval"),
    )
