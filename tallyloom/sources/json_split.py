"""Members of one JSON document, found by many tasks at once."""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyloom.session import stage_table
from tallyloom.sources.grid import BROADCAST_BYTES

_STRING = r'"[^"]*+"'
_EFFECTS = "path string, split bigint, end_plain boolean, end_quoted boolean, depth_plain bigint, depth_quoted bigint"
_RECORDS = "path string, split bigint, no bigint, from_depth bigint, to_depth bigint, part boolean, starts boolean, value string"


def _after(text: Column, entered_quoted: bool) -> tuple[Column, Column]:
    """Whether a piece of JSON ends inside a string, and by how much it changes the depth of brackets.

    Escaped characters go first, so every quote left begins or ends a string. A piece ends at a
    comma, which no escape spans.
    """
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))
    ends = (quotes % 2 == 1) != F.lit(entered_quoted)
    rest = F.when(quotes > 0, F.regexp_replace(text, r'^[^"]*+"', "")).otherwise("") if entered_quoted else text
    outside = F.regexp_replace(F.regexp_replace(rest, _STRING, ""), r'"[^"]*+$', "")
    opened = F.length(F.regexp_replace(outside, r"[^{\[]+", ""))
    closed = F.length(F.regexp_replace(outside, r"[^}\]]+", ""))
    return ends, (opened - closed).cast("bigint")


def _split_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to the state "inside a string" and to the depth, for either state before it."""
    names = ("path", "split", "end_plain", "end_quoted", "depth_plain", "depth_quoted")
    at, states, depths = None, [False, True], [0, 0]

    def effect() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, (*at, *states, *depths), strict=True))])

    for batch in batches:
        for path, split, *after in zip(*(batch[c].to_pylist() for c in names), strict=True):
            if (path, split) != at:
                if at is not None:
                    yield effect()
                at, states, depths = (path, split), [False, True], [0, 0]
            for k, inside in enumerate(states):
                states[k] = after[inside]
                depths[k] += after[2 + inside]
    if at is not None:
        yield effect()


def _records_of_splits(level: int):
    """Records of each split, which end at commas outside strings at most ``level`` deep.

    A record that goes beyond its split is a ``part`` in each split it touches; the one in
    which it begins ``starts`` it.
    """
    taken = ("path", "split", "entered", "depth", "value", "end_plain", "end_quoted", "depth_plain", "depth_quoted")
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
    names = ("path", "split", "no", "from_depth", "to_depth", "part", "starts", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, depth, no, begun, texts, starts = None, False, 0, 0, 0, [], True
        out: list[tuple] = []

        def put(part: bool) -> None:
            out.append((*at, no, begun, depth, part or not starts, starts, ",".join(texts)))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))

        for batch in batches:
            for path, split, entered, before, value, *after in zip(*(batch[c].to_pylist() for c in taken), strict=True):
                if (path, split) != at:
                    if texts:
                        put(True)
                    at, inside, depth, no, begun, texts = (path, split), entered, before, 0, before, []
                    # A comma ended the split before; it ended a record too if it stood outside of all members.
                    starts = not entered and before <= level
                texts.append(value)
                depth += after[2 + inside]
                inside = after[inside]
                if not inside and depth <= level:
                    put(False)
                    no, begun, texts, starts = no + 1, depth, [], True
            yield flush()
        if texts:
            put(True)
        yield flush()

    return run


def json_records(spark: SparkSession, path: str, level: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(path, split, no, from_depth, to_depth, value)``: a JSON document cut at commas at most ``level`` brackets deep.

    Files are read as pieces between commas, so one document is split over tasks wherever it
    is large, be it one line or many. A first pass finds what each split makes of the state
    "inside a string" and of the depth, for either state it may be entered with; running
    totals over splits (one record each) give the true ones. The second pass puts records
    together split by split; only those that go beyond their split are shuffled. ``(split, no)``
    orders the records of a file. Files whose brackets or quotes do not close give none.
    """
    piece = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("piece_id"),
        "value",
        F.regexp_replace("value", r"\\.", "").alias("bare"),
    )
    (end_plain, depth_plain), (end_quoted, depth_quoted) = (_after(F.col("bare"), q) for q in (False, True))
    pieces = piece.select(
        "path", "split", "piece_id", "value",
        end_plain.alias("end_plain"), end_quoted.alias("end_quoted"),
        depth_plain.alias("depth_plain"), depth_quoted.alias("depth_quoted"),
    )
    effects = pieces.drop("piece_id", "value").mapInArrow(_split_effects, _EFFECTS)
    # Quotes outside strings always turn the state, so it is the parity of all quotes before.
    file, earlier = Window.partitionBy("path"), Window.partitionBy("path").orderBy("split")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("end_plain").cast("int")
    depth = F.when(F.col("entered"), F.col("depth_quoted")).otherwise(F.col("depth_plain"))
    splits = (
        effects.withColumn("entered", F.coalesce(F.sum(turns).over(earlier), F.lit(0)) % 2 == 1)
        .withColumn("closed", (F.sum(turns).over(file) % 2 == 0) & (F.sum(depth).over(file) == 0))
        .select("path", "split", "entered", "closed", F.coalesce(F.sum(depth).over(earlier), F.lit(0)).alias("depth"))
    )
    splits = stage_table(splits, "json-splits")
    size = splits.agg(F.coalesce(F.sum(F.octet_length("path") + 32), F.lit(0))).first()[0]
    small = size <= broadcast_bytes
    placed = pieces.join(F.broadcast(splits) if small else splits.hint("merge"), ["path", "split"]).filter("closed")
    if not small:
        placed = placed.sortWithinPartitions("path", "split", "piece_id")
    wanted = ("path", "split", "entered", "depth", "value", "end_plain", "end_quoted", "depth_plain", "depth_quoted")
    found = stage_table(placed.select(*wanted).mapInArrow(_records_of_splits(level), _RECORDS), "json-records")
    columns = ("path", "split", "no", "from_depth", "to_depth", "value")
    whole = found.filter(~F.col("part")).select(*columns)
    # Parts follow each other; each belongs to the last one that starts a record.
    part = found.filter("part")
    order = Window.partitionBy("path").orderBy("split", "no")
    begins = part.select("path", "split", "no", "starts").withColumn("record", F.sum(F.col("starts").cast("bigint")).over(order))
    joined = (
        part.join(begins.drop("starts"), ["path", "split", "no"])
        .groupBy("path", "record")
        .agg(F.sort_array(F.collect_list(F.struct("split", "no", "from_depth", "to_depth", "value"))).alias("parts"))
        .select(
            "path",
            F.col("parts")[0]["split"].alias("split"),
            F.col("parts")[0]["no"].alias("no"),
            F.col("parts")[0]["from_depth"].alias("from_depth"),
            F.element_at("parts", -1)["to_depth"].alias("to_depth"),
            F.array_join("parts.value", ",").alias("value"),
        )
    )
    return whole.unionByName(joined)


def json_members(spark: SparkSession, path: str, name: str | None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(path, split, no, value)``: the members of the list or object called ``name`` in a JSON object.

    ``value`` is the text of a member, with its key if it has one. Without ``name`` the document
    itself is the list. Of several containers of that name in a file the last one counts.
    """
    level = 1 if name is None else 2
    records = json_records(spark, path, level, broadcast_bytes)
    place = F.struct("split", "no")
    if name is None:
        opening = r"^\s*[\[{]"
        heads = records.filter("from_depth = 0")
    else:
        opening = r'^\s*\{?\s*"' + re.escape(name) + r'"\s*:\s*[\[{]'
        heads = records.filter((F.col("from_depth") < 2) & F.col("value").rlike(opening))
    # One row per file: where the container begins, and which record closes it.
    first = heads.groupBy("path").agg(F.max(place).alias("first"))
    last = (
        records.filter(F.col("to_depth") < level)
        .select("path", place.alias("place"))
        .join(first, "path")
        .filter(F.col("place") >= F.col("first"))
        .groupBy("path", "first")
        .agg(F.min("place").alias("last"))
    )
    bounds = stage_table(last, "json-bounds")
    size = bounds.agg(F.coalesce(F.sum(F.octet_length("path") + 48), F.lit(0))).first()[0]
    inside = records.join(F.broadcast(bounds) if size <= broadcast_bytes else bounds, "path").filter(
        (place >= F.col("first")) & (place <= F.col("last"))
    )
    body = F.when(place == F.col("first"), F.regexp_replace("value", opening, "")).otherwise(F.col("value"))
    closers = (F.lit(level) - F.col("to_depth")).cast("int")
    for k in range(1, level + 1):
        body = F.when((place == F.col("last")) & (closers >= k), F.regexp_replace(body, r"[}\]]\s*$", "")).otherwise(body)
    return inside.select("path", "split", "no", F.trim(F.regexp_replace(body, r"^\s+|\s+$", "")).alias("value")).filter("value <> ''")
