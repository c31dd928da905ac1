"""Exact dedup by distributed MSD radix partitioning."""

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.llm.common import BROADCAST_BYTES, ascii_lower, broadcast_if_small, lower_bytes, stage_table

# Bytes compared in the first round, growth per round, and the most bytes in one round.
FIRST_BYTES = 64
GROWTH = 8
MOST_BYTES = 1 << 18


def _piece(text: Column, depth: int, width: int) -> Column:
    return lower_bytes(F.substring(F.coalesce(text, F.lit("")).cast("binary"), depth + 1, width))


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    first_bytes: int = FIRST_BYTES,
    growth: int = GROWTH,
    most_bytes: int = MOST_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Groups of rows whose texts are equal byte by byte once A-Z are lower-cased.

    Returns ``row`` (a struct of all input columns), ``keep_id``, ``group_size`` and ``kept``;
    one row per input row. Groups are split by successive bytes until a group has one member
    or its texts have ended; each round takes a longer run of bytes, and only members of
    groups that are still open go on. Parts are counted by a hash aggregate with map-side
    partials, so a group with a third of all rows costs one partial row per task. No digest
    decides equality.

    The row with the largest id stays. Null texts count as empty; null ids rank below all
    others and still stay if a group has no other. Of rows that repeat id and text exactly
    one stays. An empty table gives an empty result. Extra columns of any name pass through
    inside ``row``.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text, doc_id = F.col("row").getField(text_column), F.col("row").getField(id_column)

    headed = rows.withColumn("piece", _piece(text, 0, first_bytes))
    shared = stage_table(
        headed.groupBy("piece").count().filter("count > 1").select(
            "piece", F.monotonically_increasing_id().alias("part")
        ),
        "radix-heads",
    )
    heads = broadcast_if_small(shared, F.length("piece") + 64, broadcast_bytes)
    alone = headed.join(heads, "piece", "left_anti").select(
        "row",
        doc_id.alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    open_rows = stage_table(
        headed.join(heads, "piece").select("row", "part", F.monotonically_increasing_id().alias("row_no")),
        "radix-open",
    )
    found, depth, width = [alone], first_bytes, first_bytes
    while not open_rows.isEmpty():
        width = min(width * growth, most_bytes)
        cut = open_rows.withColumn("piece", _piece(text, depth, width))
        parts = stage_table(
            cut.groupBy("part", "piece")
            .agg(
                F.count("*").alias("group_size"),
                F.max(doc_id).alias("keep_id"),
                F.coalesce(F.max_by("row_no", doc_id), F.max("row_no")).alias("keep_no"),
            )
            .filter("group_size > 1")
            .withColumn("next_part", F.monotonically_increasing_id()),
            "radix-parts",
        )
        parts = broadcast_if_small(parts, F.length("piece") + 96, broadcast_bytes)
        split = stage_table(
            cut.join(parts, ["part", "piece"], "left").select(
                "row",
                "row_no",
                F.col("next_part").alias("part"),
                F.when(F.col("group_size").isNull(), doc_id).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("group_size", F.lit(1)).alias("group_size"),
                F.coalesce(F.col("keep_no") == F.col("row_no"), F.lit(True)).alias("kept"),
                (F.col("group_size").isNull() | (F.length("piece") < width)).alias("done"),
            ),
            "radix-rows",
        )
        found.append(split.filter("done").select("row", "keep_id", "group_size", "kept"))
        open_rows = split.filter(~F.col("done")).select("row", "part", "row_no")
        depth += width
    out = found[0]
    for done in found[1:]:
        out = out.unionByName(done)
    return out


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, for the report only."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)
