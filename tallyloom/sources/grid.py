"""Grid scans: sheets as rows of cells, with their position kept in ``row_num``."""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from tallyloom.functions.cells import column_cell, filled_width, make_cell, text_tag, type_tag
from tallyloom.schemas import CELL, GRID
from tallyloom.session import stage_table

# Facts of file splits are broadcast while they measure below this.
BROADCAST_BYTES = 32 * 1024 * 1024


def read_grid(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A grid stored under its contract, as Parquet, ORC or JSON lines."""
    return spark.read.schema(GRID).format(fmt).load(path)


def retag(grid: DataFrame) -> DataFrame:
    """Apply the type rules to a grid whose ``dtype`` holds the decoder's value kinds."""
    cells = F.transform("cells", lambda c: make_cell(type_tag(c["dtype"], c["sval"]), c["sval"]))
    return grid.withColumn("cells", cells)


def grid_from_table(
    df: DataFrame, source_id, sheet, row_num, sheet_idx=0, columns: list[str] | None = None
) -> DataFrame:
    """A typed table as a headerless grid; tags follow from the schema.

    ``row_num`` is a column of ``df`` (order is part of the contract, so it cannot be left
    out); the other position arguments are literals or columns.
    """
    names = columns or df.columns
    cells = F.array(*[column_cell(df.schema[n]) for n in names])

    def col(value, kind):
        return (value if isinstance(value, Column) else F.lit(value)).cast(kind)

    return df.select(
        col(source_id, "string").alias("source_id"),
        col(sheet, "string").alias("sheet"),
        col(sheet_idx, "bigint").alias("sheet_idx"),
        (row_num if isinstance(row_num, Column) else F.col(row_num)).cast("bigint").alias("row_num"),
        cells.alias("cells"),
    )


def _opens_quote(line: Column, sep: str, entered_quoted: bool) -> Column:
    """Whether a quoted field is open at the end of a line.

    A quote opens a field only where the field begins; anywhere else outside quotes it is
    text. Whole quoted fields are taken off the line, and what is left tells.
    """
    mark, inside = re.escape(sep), r'[^"]*+(?:""[^"]*+)*+"'
    # What follows a closing quote belongs to the same field, up to the next separator.
    rest = F.regexp_replace(line, f"^{inside}", "x") if entered_quoted else line
    left = F.regexp_replace(rest, f'(?<=^|{mark})"{inside}', "x").rlike(f'(?:^|{mark})"')
    return ~line.rlike(f"^{inside}") | left if entered_quoted else left


def _entered_quoted(splits: DataFrame, before: WindowSpec) -> DataFrame:
    """``splits`` with ``entered``: whether a split begins inside quotes.

    A split sets the state, keeps it or turns it; so the state is that of the last split
    that set it, turned by those since: running totals, as files begin outside quotes.
    """
    sets = F.col("end_plain") == F.col("end_quoted")
    turns = (~sets & F.col("end_plain")).cast("bigint")
    totals = splits.withColumn("turned", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    last = F.last(F.when(sets, F.struct(F.col("end_plain").alias("state"), F.col("turned").alias("at"))), True).over(before)
    known = totals.withColumn("last", last)
    since = F.col("turned") - F.coalesce(F.col("last.at"), F.lit(0))
    return known.withColumn("entered", F.coalesce(F.col("last.state"), F.lit(False)) != (since % 2 == 1)).drop("turned", "last")


def _split_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to the state "inside quotes", and the rows that begin in it, for either state before it."""
    at, states, begun = None, [False, True], [0, 0]

    def effect() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(
            [{"path": at[0], "split": at[1], "end_plain": states[0], "end_quoted": states[1], "n_plain": begun[0], "n_quoted": begun[1]}]
        )

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("path", "split", "plain", "quoted"))
        for path, split, plain, quoted in zip(*columns, strict=True):
            if (path, split) != at:
                if at is not None:
                    yield effect()
                at, states, begun = (path, split), [False, True], [0, 0]
            for k, inside in enumerate(states):
                begun[k] += not inside
                states[k] = quoted if inside else plain
    if at is not None:
        yield effect()


def _rows_of_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each split, whose state and row number at its start are known; a row that goes beyond it is a ``part``."""
    names = ("path", "row_num", "split", "part", "value")
    at, inside, row, lines, part = None, False, 0, [], False
    out: list[tuple] = []

    def put(is_part: bool) -> None:
        out.append((at[0], row, at[1], is_part, "\n".join(lines)))

    def flush() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("path", "split", "entered", "offset", "plain", "quoted", "value"))
        for path, split, entered, offset, plain, quoted, value in zip(*columns, strict=True):
            if (path, split) != at:
                if lines:
                    put(True)
                at, inside, row, lines, part = (path, split), entered, offset, [], entered
            if not inside:
                row, part = row + 1, False
            lines.append(value)
            inside = quoted if inside else plain
            if not inside:
                put(part)
                lines = []
        yield flush()
    if lines:
        put(True)
    yield flush()


def placed_rows(spark: SparkSession, path: str, sep: str = ",", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(path, row_num, value)``: the rows of CSV files, numbered from 1 in each file.

    Lines end with ``\\n`` or ``\\r\\n``. A line break inside a quoted field does not end a row,
    wherever the file is split. A first pass finds what each split makes of the state "inside
    quotes", and how many rows begin in it, for either state it may be entered with; a running
    composition over splits (one record each) gives the true ones. The second pass puts the
    rows together split by split, so a large file never passes through one task, and only
    rows that go beyond their split are shuffled. A quote that nothing closes makes the rest
    of its file one row.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line_id"),
        _opens_quote(F.col("value"), sep, False).alias("plain"),
        _opens_quote(F.col("value"), sep, True).alias("quoted"),
        "value",
    )
    effects = "path string, split bigint, end_plain boolean, end_quoted boolean, n_plain bigint, n_quoted bigint"
    found = stage_table(lines.select("path", "split", "plain", "quoted").mapInArrow(_split_effects, effects), "splits")
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    n = F.when(F.col("entered"), F.col("n_quoted")).otherwise(F.col("n_plain"))
    splits = stage_table(
        _entered_quoted(found, earlier).select("path", "split", "entered", F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias("offset")),
        "splits",
    )
    size = splits.agg(F.coalesce(F.sum(F.octet_length("path") + 24), F.lit(0))).first()[0]
    small = size <= broadcast_bytes
    placed = lines.join(F.broadcast(splits) if small else splits.hint("merge"), ["path", "split"], "left")
    # Both passes cut files alike; should they not, this fails instead of losing rows.
    known = F.when(F.col("offset").isNull(), F.raise_error(F.lit("file splits changed between passes"))).otherwise(F.col("offset"))
    placed = placed.withColumn("offset", known)
    if not small:
        placed = placed.sortWithinPartitions("path", "split", "line_id")
    wanted = placed.select("path", "split", "entered", "offset", "plain", "quoted", "value")
    kind = "path string, row_num bigint, split bigint, part boolean, value string"
    rows = stage_table(wanted.mapInArrow(_rows_of_splits, kind), "csv-rows")
    whole = rows.filter(~F.col("part")).select("path", "row_num", "value")
    parts = rows.filter("part").groupBy("path", "row_num").agg(F.sort_array(F.collect_list(F.struct("split", "value"))).alias("parts"))
    joined = parts.select("path", "row_num", F.array_join("parts.value", "\n").alias("value"))
    return whole.unionByName(joined).withColumn("value", F.regexp_replace("value", r"\r\z", ""))


def read_csv_grid(
    spark: SparkSession, path: str, width: int | None = None, typed: bool = True, sep: str = ","
) -> DataFrame:
    """Headerless CSV as a grid: one file is one sheet of the source named like its folder.

    Blank lines stay rows, and quoted line breaks stay in their cell (see ``placed_rows``).
    Quotes inside quoted cells are doubled. ``width`` is found from the separators if not
    given; with ``typed`` the tags are read off the text, else every filled cell is ``str``.
    """
    rows = placed_rows(spark, path, sep)
    if width is None:
        commas = F.length("value") - F.length(F.replace("value", F.lit(sep), F.lit("")))
        width = (rows.agg(F.max(commas)).first()[0] or 0) + 1
    schema = ", ".join(f"c{i} string" for i in range(width))
    row = F.from_csv("value", F.lit(schema), {"sep": sep, "escape": '"', "multiLine": "true", "lineSep": "\n"})
    texts = [F.col(f"row.c{i}") for i in range(width)]
    tag = text_tag if typed else (lambda t: type_tag(F.lit("str"), t))
    parts = F.split("path", "/")
    return (
        rows.select("path", "row_num", row.alias("row"))
        .withColumn("cells", F.array(*[make_cell(tag(t), t) for t in texts]))
        .select(
            F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit("")).alias("source_id"),
            F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "").alias("sheet"),
            F.lit(0).cast("bigint").alias("sheet_idx"),
            "row_num",
            F.slice("cells", F.lit(1), filled_width(F.col("cells.dtype")))
            .cast(f"array<{CELL}>")
            .alias("cells"),
        )
    )


def first_sheet(grid: DataFrame) -> DataFrame:
    """Rows of the first sheet of each source."""
    return grid.filter(F.col("sheet_idx") == 0)


def named_sheet(grid: DataFrame, sheet: str) -> DataFrame:
    return grid.filter(F.col("sheet") == sheet)


def missing_sheets(sources: DataFrame, sheets: DataFrame, sheet: str) -> DataFrame:
    """Sources that lack the named sheet, with the number of sheets they do have.

    Their names are in ``sheets``; they are not gathered into one list per source.
    """
    there = sheets.filter(F.col("sheet") == sheet).select("source_id").distinct()
    counts = sheets.select("source_id", "sheet", "sheet_idx").distinct().groupBy("source_id").agg(
        F.count(F.lit(1)).alias("available_sheets")
    )
    return (
        sources.select("source_id")
        .join(there, "source_id", "left_anti")
        .join(counts, "source_id", "left")
        .select(
            "source_id",
            F.lit(sheet).alias("sheet"),
            F.coalesce("available_sheets", F.lit(0)).alias("available_sheets"),
        )
    )
