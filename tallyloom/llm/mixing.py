"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.common import BROADCAST_BYTES, HOT_ROWS, WORD_PATTERN, join_facts, stage_table

# Documents per block, about; a block is the unit that quotas count.
BLOCK_DOCS = 4096
# A source is repeated at most this often.
MOST_REPEATS = 3
# A mix of more sources than this is refused, not cut; there is no limit unless one is set.
MOST_SOURCES: int | None = None
# Sources whose quotas one task splits over the shards.
GROUP_SOURCES = 10_000
SHARDS = 64
# Text that one task writes of a shard, about; larger shards are written in consecutive pieces.
PIECE_BYTES = 256 * 1024 * 1024
# The generator's own draws end here; larger sums are drawn by ``hypergeometric``.
GENERATOR_RANGE = 10**9
# Rows a source's last block may add, beyond those in hash order, to come near the target.
FILLS = 4
SEED = 20240229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def fair_targets(sizes: list[int], weights: list[float], most: int = MOST_REPEATS) -> list[float]:
    """Targets in proportion to the weights that sum to all sizes, none above ``most`` sizes."""
    targets = [0.0] * len(sizes)
    left, open_sources = float(sum(sizes)), [i for i, s in enumerate(sizes) if s > 0]
    while open_sources:
        level = left / sum(weights[i] for i in open_sources)
        full = [i for i in open_sources if level * weights[i] > most * sizes[i]]
        if not full:
            for i in open_sources:
                targets[i] = level * weights[i]
            break
        for i in full:
            targets[i] = float(most * sizes[i])
            left -= targets[i]
        open_sources = [i for i in open_sources if i not in set(full)]
    return targets


def fair_level(ranked: DataFrame, most: int = MOST_REPEATS) -> float:
    """Words per unit of weight, as ``fair_targets`` finds it, by repeated aggregates.

    One row per weight of the cycle reaches the driver in each round, so sums do not depend
    on the order of sources. A source is full if the level takes it beyond ``most`` sizes.
    """
    level, known = 0.0, -1
    while True:
        full = (F.lit(level) * F.col("weight") > most * F.col("source_size")).cast("bigint")
        rows = (
            ranked.filter("source_size > 0")
            .groupBy("weight")
            .agg(F.count("*").alias("n"), F.sum(full).alias("full"), F.sum("source_size").alias("size"), F.sum(full * F.col("source_size")).alias("spent"))
            .orderBy("weight")
            .collect()
        )
        n_full = sum(r.full for r in rows)
        if n_full <= known or n_full == sum(r.n for r in rows):
            return level
        left = sum(r["size"] for r in rows) - most * sum(r.spent for r in rows)
        level, known = max(level, left / sum(r.weight * (r.n - r.full) for r in rows)), n_full


def plan_sources(measured: DataFrame, block_docs: int, weight_cycle: tuple[float, ...]) -> DataFrame:
    """Targets and passes of each source, ranked in code point order, null last: one row per source.

    Ranks are numbered within ranges of names plus a small table of offsets.
    """
    spark = measured.sparkSession
    groups = measured.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    groups = stage_table(groups, "mix-sources")
    if MOST_SOURCES is not None and groups.count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: a mix needs a bounded list of them")
    order = F.col("source").asc_nulls_last()
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage_table(groups.repartitionByRange(ranges, order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    offsets, total = [], 0
    for r in ranged.groupBy("range").count().orderBy("range").collect():
        offsets.append((r["range"], total))
        total += r["count"]
    offsets = F.broadcast(spark.createDataFrame(offsets, "range int, offset bigint"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1 + F.col("offset")
    weights = F.array(*[F.lit(float(w)) for w in weight_cycle])
    ranked = (
        ranged.join(offsets, "range")
        .withColumn("rank", rank)
        .select("source", "source_size", "docs", "rank", F.get(weights, (F.col("rank") % len(weight_cycle)).cast("int")).alias("weight"))
    )
    ranked = stage_table(ranked, "mix-ranked")
    wanted = F.lit(fair_level(ranked)) * F.col("weight")
    most = (F.lit(MOST_REPEATS) * F.col("source_size")).cast("double")
    target = F.when(F.col("source_size") == 0, 0.0).otherwise(F.least(wanted, most))
    passes = F.floor(F.col("target") / F.col("source_size"))
    passes = passes - (passes * F.col("source_size") > F.col("target")).cast("int")  # a quotient may be rounded up
    passes = F.when(F.col("source_size") > 0, F.least(passes, F.lit(MOST_REPEATS))).otherwise(0).cast("int")
    return (
        ranked.withColumn("target", target)
        .withColumn("passes", passes)
        .withColumn("blocks", F.ceil(F.col("docs") / block_docs).cast("bigint"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .drop("weight")
    )


def shard_bounds(quotas: list[int], shards: int, seed: int, room: np.ndarray | None = None, group: tuple[int, ...] = ()) -> np.ndarray:
    """``(sources, shards + 1)`` bounds of each shard's run within the draws of each source.

    The root holds all quotas. Every node hands a random part of its blocks, drawn without
    replacement over all sources at once, to its left half and the rest to its right half,
    so quotas are met exactly and every shard gets its proportional number of blocks, or as
    many as ``room`` says where the quotas are those of one ``group`` of many.
    """
    counts = np.zeros((len(quotas), shards), dtype=np.int64)
    todo = [(0, shards, np.asarray(quotas, dtype=np.int64))]
    while todo:
        low, high, here = todo.pop()
        if high - low == 1:
            counts[:, low] = here
            continue
        middle = (low + high) // 2
        total = int(here.sum())
        draws = total * (middle - low) // (high - low) if room is None else int(room[low:middle].sum())
        rng = np.random.default_rng([seed, low, high, *group])
        if total < GENERATOR_RANGE:
            left = rng.multivariate_hypergeometric(here, draws, method="marginals")
        else:
            left = _marginal_draws(rng, here, draws)
        todo += [(low, middle, left), (middle, high, here - left)]
    return np.concatenate([np.zeros((len(quotas), 1), dtype=np.int64), np.cumsum(counts, axis=1)], axis=1)


def split_quotas(planned: DataFrame, shards: int, seed: int) -> DataFrame:
    """``(rank, bounds)`` of every source.

    The tree is drawn in two levels, which has the same distribution as one: sums of groups of
    GROUP_SOURCES ranks are split by the driver, the quotas within a group by one task.
    """
    quotas = planned.select("rank", "quota", F.floor(F.col("rank") / GROUP_SOURCES).cast("bigint").alias("group"))
    totals = [r.n for r in quotas.groupBy("group").agg(F.sum("quota").alias("n")).orderBy("group").collect()]
    rooms = np.diff(shard_bounds(totals, shards, seed), axis=1)

    def split(group: tuple, rows: pa.Table) -> pa.Table:
        number, rows = group[0].as_py(), rows.sort_by("rank")
        # A single group draws as if there were none.
        bounds = shard_bounds(rows["quota"].to_pylist(), shards, seed, rooms[number], (1 + number,) if len(rooms) > 1 else ())
        return pa.table({"rank": rows["rank"], "bounds": pa.array(bounds[:, 1:].tolist(), pa.list_(pa.int64()))})

    return quotas.groupBy("group").applyInArrow(split, "rank bigint, bounds array<bigint>")


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good, by inversion, for sums of any size.

    Probabilities follow from their ratios to the mode's. Those more than twelve standard
    deviations away are left out; together they are far below a double's last digit.
    """
    total = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    mode = (draws + 1) * (good + 1) // (total + 2)
    spread = (draws * (good / total) * (bad / total) * ((total - draws) / max(1, total - 1))) ** 0.5
    reach = int(12 * spread) + 64
    k = np.arange(max(low, mode - reach), min(high, mode + reach) + 1)
    at = k[:-1].astype(np.float64)
    ratios = np.log((good - at) / (at + 1)) + np.log((draws - at) / (bad - draws + at + 1))
    logs = np.concatenate([[0.0], np.cumsum(ratios)])
    sums = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(np.searchsorted(sums, rng.random() * sums[-1], side="right"), len(k) - 1)])


def _marginal_draws(rng: np.random.Generator, counts: np.ndarray, draws: int) -> np.ndarray:
    """Multivariate draw as one hypergeometric draw per source, each against all sources after it."""
    left = np.zeros_like(counts)
    rest = int(counts.sum())
    for i, count in enumerate(counts.tolist()):
        rest -= count
        if count and draws:
            left[i] = hypergeometric(rng, count, rest, draws) if count + rest >= GENERATOR_RANGE else rng.hypergeometric(count, rest, draws)
            draws -= int(left[i])
    return left


def mix_sources(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weight_cycle: tuple[float, ...] = (1.0, 2.0, 3.0),
    block_docs: int = BLOCK_DOCS,
    shards: int = SHARDS,
    seed: int = SEED,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """How often the mix takes each document, and into which output shards.

    Returns, beside ``row`` (a struct of all input columns): ``size`` in words,
    ``source_size``, ``target`` of the source, ``copies``, ``taken`` words, ``shards``,
    ``orders`` and ``pieces``: the output shard of each copy, its place in there, and into how
    many tasks a shard's rows are to be divided, by the bytes of all texts.

    A document belongs to a block of its source by a hash of its id and text, so block order
    is a random permutation. A source is passed over whole as often as its target allows; a
    further pass takes whole blocks up to the rest of the target and, of the block in which
    the rest ends, documents in hash order plus up to FILLS that fill the gap. Blocks drawn
    by a source are numbered through all passes, and the splitting tree gives every output
    shard a disjoint run of these numbers; within a shard rows are in hash order.

    What is known of a source is a row of a staged table, so there may be any number of sources:
    the driver sees single sums only. The table is broadcast if it measures small, else joined
    with large sources dealt out over tasks. Block sums are aggregated with map-side partials,
    so a source with a third of all rows stays spread. Null texts have size 0, the null source comes last, sources of
    size 0 get the target 0, repeated rows are documents of their own that fall into one
    block, and an empty table gives an empty result. Texts that tie in hash order go by size.
    A very long text is one row that is taken whole or not at all. Reruns agree for given rows.
    """
    key = F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), F.col(f"`{text_column}`"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{source_column}`").alias("source"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
        key.alias("key"),
    )
    text_bytes = F.coalesce(F.octet_length(F.col(f"row.`{text_column}`")), F.lit(0)).cast("bigint")
    measured = stage_table(rows.select("source", "size", "key", text_bytes.alias("bytes")), "mix-sizes")
    total_bytes = measured.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]  # a mix is as large as its input
    pieces = max(1, -(-total_bytes // (shards * piece_bytes)))
    plan = plan_sources(measured, block_docs, weight_cycle)
    name_bytes = F.coalesce(F.octet_length("source"), F.lit(0)) + 32

    def with_facts(df: DataFrame, *columns: str) -> DataFrame:
        facts = plan.select("source", "docs", *columns)
        return join_facts(df, facts, "source", name_bytes + 8 * len(columns), "docs", F.col("key"), broadcast_bytes, hot_rows)

    def of_source(df: DataFrame, more: DataFrame) -> DataFrame:
        """Tables of one row per source, side by side."""
        more = more.withColumnRenamed("source", "fact_source")
        return df.join(more, F.col("source").eqNullSafe(F.col("fact_source")), "left").drop("fact_source")

    block = F.pmod("key", "blocks").alias("block")
    blocks = (
        with_facts(measured, "blocks", "rest")
        .select("source", "size", "rest", block)
        .groupBy("source", "block")
        .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    )
    before = F.sum("words").over(Window.partitionBy("source").orderBy("block")) - F.col("words")
    # The first block whose end lies beyond the rest; earlier ones are taken whole.
    cuts = (
        blocks.withColumn("before", before)
        .filter(F.col("before") + F.col("words") > F.col("rest"))
        .groupBy("source")
        .agg(F.min(F.struct("block", (F.col("rest") - F.col("before")).alias("room"))).alias("cut"))
        .select("source", "cut.block", "cut.room")
    )
    quota = F.col("passes") * F.col("blocks") + F.col("cut") + (F.col("room") > 0).cast("int")
    plan = stage_table(
        of_source(plan, cuts)
        .withColumn("cut", F.coalesce("block", F.lit(0)))
        .withColumn("room", F.coalesce("room", F.lit(0.0)))
        .drop("block")
        .withColumn("quota", quota),
        "mix-cuts",
    )

    # Within the last block: hash order up to the rest, then rows that fill what is left.
    # Repeats of one row share a key and are taken together or not at all.
    in_order = Window.partitionBy("source").orderBy("key", "size")
    ends = (
        with_facts(measured, "blocks", "cut", "room")
        .filter((F.pmod("key", "blocks") == F.col("cut")) & (F.col("room") > 0))
        .groupBy("source", "room", "key", "size")
        .agg((F.count("*") * F.col("size")).alias("words"))
        .withColumn("end", F.sum("words").over(in_order))
    )
    ends = stage_table(ends, "mix-ends")
    prefix = ends.filter("end <= room").groupBy("source").agg(F.max(F.struct("end", "key", "size")).alias("last"))
    state = of_source(plan.filter("room > 0").select("source", "room"), prefix).select(
        "source",
        (F.col("room") - F.coalesce("last.end", F.lit(0))).alias("gap"),
        F.col("last.key").alias("last_key"),
        F.col("last.size").alias("last_size"),
        F.expr("cast(array() as array<struct<key:bigint,size:bigint>>)").alias("fills"),
    )
    state = stage_table(state, "mix-gaps")
    beyond = ends.filter("end > room").select("source", "key", "size", "words")
    for turn in range(FILLS):
        # The largest row that fits; in the last turn the one that comes nearest.
        off = F.abs(F.col("gap") - F.col("words"))
        fits = off < F.col("gap") if turn == FILLS - 1 else F.col("words") <= F.col("gap")
        best = (
            join_facts(beyond, state.select("source", "gap", F.col("fills.key").alias("filled")), "source", name_bytes + 8 * FILLS)
            .filter(fits & (F.col("words") > 0) & ~F.array_contains("filled", F.col("key")))
            .groupBy("source")
            .agg(F.min(F.struct(off.alias("off"), "key", "size", "words")).alias("best"))
        )
        more = F.when(F.col("best").isNotNull(), F.array(F.struct("best.key", "best.size")))
        state = of_source(state, best).select(
            "source", (F.col("gap") - F.coalesce("best.words", F.lit(0))).alias("gap"), "last_key", "last_size",
            F.concat("fills", F.coalesce(more, F.expr("cast(array() as array<struct<key:bigint,size:bigint>>)"))).alias("fills"),
        )
        state = stage_table(state, "mix-gaps")

    facts = of_source(plan, state.drop("gap")).join(split_quotas(plan, shards, seed), "rank")
    facts = facts.select(
        "source", "source_size", "docs", "target", "blocks", "passes", "cut", "bounds", "last_key", "last_size",
        F.coalesce("fills", F.expr("cast(array() as array<struct<key:bigint,size:bigint>>)")).alias("fills"),
    )
    facts = stage_table(facts, "mix-plan")
    width = name_bytes + 8 * shards + 16 * FILLS + 64
    placed = join_facts(rows, facts, "source", width, "docs", F.col("key"), broadcast_bytes, hot_rows)
    placed = placed.withColumn("block", F.pmod("key", "blocks"))
    chosen = (
        F.coalesce(F.col("key") < F.col("last_key"), F.lit(False))
        | F.coalesce((F.col("key") == F.col("last_key")) & (F.col("size") <= F.col("last_size")), F.lit(False))
        | F.array_contains("fills", F.struct("key", "size"))
    )
    part = (F.col("block") < F.col("cut")) | ((F.col("block") == F.col("cut")) & F.coalesce(chosen, F.lit(False)))
    copies = (F.col("passes") + part.cast("int")).alias("copies")
    draws = F.expr("if(copies = 0, array(), transform(sequence(0, copies - 1), p -> p * blocks + block))")
    shard_of = F.expr("transform(draws, d -> size(filter(bounds, b -> b <= d)))")
    return (
        placed.select("*", copies)
        .withColumn("draws", draws.cast("array<bigint>"))
        .select(
            "row",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
            shard_of.alias("shards"),
            F.transform("draws", lambda d: F.xxhash64(F.lit(seed), F.col("key"), d)).alias("orders"),
            F.lit(pieces).alias("pieces"),
        )
    )


def mixed_rows(mixed: DataFrame) -> DataFrame:
    """One row per copy: the input columns, ``mix_shard`` and ``mix_order``, shuffled within shards.

    The tasks that write a shard hold consecutive runs of its order, so their number grows with
    the texts while the shards stay those of the tree.
    """
    copies = F.explode(F.arrays_zip("shards", "orders")).alias("copy")
    place = F.col("mix_order").cast("double") / float(2**64) + 0.5  # 0 to 1, as orders are hashes
    piece = F.least(F.floor(place * F.col("pieces")), F.col("pieces") - 1)
    return (
        mixed.select("row", "pieces", copies)
        .select("row", "pieces", F.col("copy.shards").alias("mix_shard"), F.col("copy.orders").alias("mix_order"))
        .withColumn("piece", piece.cast("int"))
        .repartition("mix_shard", "piece")
        .sortWithinPartitions("mix_shard", "mix_order")
        .drop("pieces", "piece")
    )
