"""MinHash near-dedup with tensored banding."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.common import (
    BROADCAST_BYTES,
    HOT_ROWS,
    bounded_batches,
    broadcast_if_small,
    join_facts,
    stage_table,
    text_batches,
    tokens_of,
)
from tallyloom.llm.components import components
from tallyloom.llm.features import WordHashes

# Words per shingle; a link needs PERCENT of the union in common.
SHINGLE = 5
PERCENT = 75
# Collections of minhashes, and minhashes in each. A table key is a pair of collections.
COLLECTIONS = 28
HASHES = 3
SEED = 7
# Cells of a document's counts of shingles, from which an upper bound of a link follows.
CELLS = 256
# Pairs verified against one reading of a text, and rows of a collection key compared at once.
PAIRS_PER_HEAD = 512
TILE_ROWS = 2048

_words: WordHashes | None = None


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of all words if there are fewer than ``size``."""
    global _words
    if _words is None:
        _words = WordHashes()
    words = _words.array(tokens_of(text))
    if not len(words):
        return words
    width = min(size, len(words))
    n = len(words) - width + 1
    found = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        found = (found ^ words[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(32)
    return np.unique(found)


def minhash_factors(collections: int, hashes: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, size=(2, collections * hashes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def collection_keys(shingles: np.ndarray, factors: np.ndarray, hashes: int) -> np.ndarray:
    """One key per collection: its number and minhashes, mixed."""
    least = np.full(factors.shape[1], np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096, None]
        mixed = (part ^ factors[1]) * factors[0]
        np.minimum(least, mixed.min(axis=0), out=least)
    table = least.reshape(-1, hashes)
    keys = np.arange(len(table), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(hashes):
        keys = (keys ^ table[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
    return keys


def shingle_counts(shingles: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Shingles per cell. The sum of the smaller counts of two sets bounds what they share."""
    return np.bincount((shingles % np.uint64(cells)).astype(np.int64), minlength=cells).astype(np.int32)


def linked(left: np.ndarray, right: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the sets share at least ``percent`` of their union."""
    small, large = sorted((len(left), len(right)))
    if not small or 100 * small < percent * large:
        return False
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (small + large - common)


_DESCRIBED = (
    "doc_id bigint, key_a bigint, key_b bigint, n bigint, set_a bigint, set_b bigint, keys array<bigint>, cells binary"
)


def _describe(batches: Iterator[pa.RecordBatch], shingle: int, factors: np.ndarray, hashes: int) -> Iterator[pa.RecordBatch]:
    """Set size, a 128-bit digest of the set, collection keys and cell counts of each text."""
    for batch, texts in text_batches(batches):
        rows = []
        for text in texts:
            found = shingle_set(text, shingle)
            digest = xxhash.xxh3_128_intdigest(found.tobytes())
            keys = collection_keys(found, factors, hashes).view(np.int64).tolist() if len(found) else []
            rows.append((len(found), digest >> 65, digest & (2**63 - 1), keys, shingle_counts(found).tobytes()))
        columns = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        kept = ["doc_id", "key_a", "key_b"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), *arrays], [*kept, "n", "set_a", "set_b", "keys", "cells"]
        )


def _verify(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links among rows sorted so that each head's text comes before those to compare with it."""
    at, head = None, np.empty(0, dtype=np.uint64)
    for batch, texts in text_batches(batches):
        found = []
        for x, salt, y, text in zip(
            batch["x"].to_pylist(), batch["salt"].to_pylist(), batch["y"].to_pylist(), texts, strict=True
        ):
            if (x, salt) != at:
                at, head = (x, salt), shingle_set(text, shingle)  # the first row is the head itself
            elif x != y and linked(head, shingle_set(text, shingle), percent):
                found.append((x, y))
        columns = list(zip(*found, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["x", "y"])


def verified(
    pairs: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int, broadcast_bytes: int
) -> DataFrame:
    """The pairs ``(x, y)`` whose full shingle sets are linked.

    Each pair fetches the text of y; the text of x is fetched once per PAIRS_PER_HEAD pairs,
    so a node that is compared with very many others is spread over tasks.
    """
    salts = pairs.groupBy("x").agg(F.ceil(F.count("*") / PAIRS_PER_HEAD).cast("int").alias("salts"))
    salts = broadcast_if_small(stage_table(salts, "pair-salts"), F.lit(24), broadcast_bytes)
    members = pairs.join(salts, "x").select("x", F.pmod(F.xxhash64("y"), F.col("salts")).cast("int").alias("salt"), "y")
    members = stage_table(members, "pairs-salted")
    heads = members.select("x", "salt").distinct().select("x", "salt", F.col("x").alias("y"))
    places = nodes.select(F.col("node").alias("y"), "key_a", "key_b", F.col("rep").alias("rep_id"))
    wanted = stage_table(members.unionByName(heads).join(places, "y"), "pair-texts")
    wanted = broadcast_if_small(wanted, F.lit(64), broadcast_bytes)
    of_text = [texts[c] == wanted[c] for c in ("key_a", "key_b")] + [texts["doc_id"].eqNullSafe(wanted["rep_id"])]
    rows = texts.join(wanted, of_text).select("x", "salt", "y", "text")
    return (
        rows.repartition("x", "salt")
        .sortWithinPartitions("x", "salt", F.col("x") != F.col("y"))
        .mapInArrow(lambda b: _verify(b, shingle, percent), "x bigint, y bigint")
        .distinct()
    )


def _compare_tiles(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within a tile whose upper bound reaches a link.

    A tile holds nodes that share one collection key. Two nodes share a table key if they
    have another collection key in common, and are named under the smallest alone.
    """
    at, members = None, []

    def compared() -> pa.RecordBatch:
        found: list[tuple[int, int]] = []
        if members:
            node, component, n = (np.array([m[k] for m in members]) for k in ("node", "component", "n"))
            cells = np.array([np.frombuffer(m["cells"], dtype=np.int32) for m in members])
            side = np.array([m["side"] for m in members])
            keys = np.full((len(members), max(len(m["keys"]) for m in members)), np.iinfo(np.int64).max)
            for i, m in enumerate(members):
                keys[i, : len(m["keys"])] = m["keys"]
            rights = np.flatnonzero(side != 1)  # a tile of one part with itself has side 0 alone
            for i in np.flatnonzero(side != 2).tolist():
                js = rights[component[rights] != component[i]]
                if side[i] == 0:
                    js = js[js > i]
                js = js[100 * np.minimum(n[js], n[i]) >= percent * np.maximum(n[js], n[i])]
                common = np.isin(keys[js], members[i]["keys"])
                first = keys[js, common.argmax(axis=1)] if len(js) else js
                js = js[(common.sum(axis=1) > 1) & (first == at[0])]
                most = np.minimum(cells[js], cells[i]).sum(axis=1)
                js = js[100 * most >= percent * (n[js] + n[i] - most)]
                found += [(int(min(node[i], node[j])), int(max(node[i], node[j]))) for j in js.tolist()]
        columns = list(zip(*found, strict=True)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["x", "y"])

    for batch in batches:
        for r in batch.to_pylist():
            if (r["key"], r["low"], r["high"]) != at:
                yield compared()
                at, members = (r["key"], r["low"], r["high"]), []
            members.append(r)
    yield compared()


def _buckets(shared: DataFrame) -> DataFrame:
    """``(bucket, node)``: a table key for every pair of a node's collections, which are in order."""
    pairs = F.expr(
        "flatten(transform(sequence(0, size(keys) - 2), a ->"
        " transform(sequence(a + 1, size(keys) - 1), b -> xxhash64(keys[a], keys[b]))))"
    )
    return shared.select(F.explode(pairs).alias("bucket"), "node")


def _rest_pairs(
    shared: DataFrame, nodes: DataFrame, known: DataFrame, percent: int, tile_rows: int, broadcast_bytes: int, hot_rows: int
) -> DataFrame:
    """Pairs of nodes that share a table key, lie in different components, and may be linked.

    Nodes that share a table key share both of its collections, so they meet under single
    collection keys, of which a node has as many as there are collections, not a key for
    every pair. Under each key the largest component is set against the other nodes, which
    are few as a rule: its nodes are never compared with each other, and travel once for as
    many others as a tile holds.
    """
    labelled = shared.join(known, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "keys")
    labelled = stage_table(labelled, "labelled")
    entries = labelled.select(F.explode("keys").alias("key"), "node", "component")
    by_component = entries.groupBy("key", "component").agg(F.count("*").alias("members"))
    mixed = (
        by_component.groupBy("key")
        .agg(
            F.sum("members").alias("size"),
            F.count("*").alias("components"),
            F.max(F.struct("members", "component")).alias("main"),
        )
        .filter("components > 1")
        .select(
            "key",
            "size",
            F.col("main.component").alias("main"),
            F.ceil(F.col("main.members") / tile_rows).cast("int").alias("main_parts"),
            F.ceil((F.col("size") - F.col("main.members")) / tile_rows).cast("int").alias("other_parts"),
        )
    )
    mixed = stage_table(mixed, "mixed-keys")
    placed = join_facts(entries, mixed, "key", F.lit(48), "size", F.col("node"), broadcast_bytes, hot_rows)
    # Parts of the largest component come first; each meets each part of the others.
    tiles = F.expr(
        "if(component = main,"
        " transform(sequence(0, other_parts - 1), o -> named_struct('low', part, 'high', main_parts + o, 'side', 1)),"
        " concat("
        "  transform(sequence(0, main_parts - 1), m -> named_struct('low', m, 'high', main_parts + part, 'side', 2)),"
        "  transform(sequence(0, other_parts - 1), o -> named_struct("
        "   'low', main_parts + least(part, o), 'high', main_parts + greatest(part, o),"
        "   'side', if(part = o, 0, if(part < o, 1, 2))))))"
    )
    parts = F.when(F.col("component") == F.col("main"), F.col("main_parts")).otherwise(F.col("other_parts"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int")).select(
        "key", "node", "component", F.inline(tiles)
    )
    payload = labelled.select("node", "keys").join(nodes.select("node", "n", "cells"), "node")
    payload = stage_table(payload.join(placed.select("node").distinct(), "node", "left_semi"), "payload")
    width = F.length("cells") + 8 * F.size("keys") + 32
    rows = placed.join(broadcast_if_small(payload, width, broadcast_bytes), "node")
    return (
        rows.repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .select("key", "low", "high", "side", "node", "component", "n", "cells", "keys")
        .mapInArrow(lambda b: _compare_tiles(b, percent), "x bigint, y bigint")
    )


def near_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    collections: int = COLLECTIONS,
    hashes: int = HASHES,
    seed: int = SEED,
    tile_rows: int = TILE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Components of texts that share at least ``percent`` of their word shingles.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id reachable, itself
    included), ``kept`` (whether that is the row's own) and ``key_a``, ``key_b`` (two hashes
    of the text), one row per input row.

    Tensored banding: ``collections`` small collections of ``hashes`` minhashes are computed,
    and every pair of collections is one table, keyed by both. A link is found if two
    collections agree, so 28 collections of 3 serve 378 tables of 6 minhashes with 84
    minhashes instead of 2268; two sets at exactly 75 percent are missed with probability
    5e-6. Texts of equal sets are one class, which is represented by one node. Collections
    that no other node has cannot agree and make no table keys.

    In each table key the node with the smallest number is the pivot; all others are verified
    against it on full sets, which needs as many pairs as rows. Pivots come from an aggregate
    with map-side partials and are joined back, rows of hot table keys dealt out over tasks.
    What the links found so far do not connect is compared in a second round: nodes of
    different components that share a table key, and whose sizes and shingle counts per cell
    leave a link possible (see ``_rest_pairs``). Such pairs are formed inside tiles of bounded
    size, and only those that pass are handed on and verified. No table key is cut short.

    Null and empty texts, and texts without words, have 0 shingles and their own id. A null
    id is never the smallest: its component is that of the ids it is linked with, or null.
    Rows that repeat an id and a text share their fate. Very long texts count whole. Other
    columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    texts = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("key_a"),
        F.xxhash64(F.lit(1), text).alias("key_b"),
    )
    factors = minhash_factors(collections, hashes, seed)
    described = stage_table(texts.mapInArrow(lambda b: _describe(b, shingle, factors, hashes), _DESCRIBED), "shingle-sets")

    # One node per distinct set, placed at the text of its smallest id.
    classes = (
        described.filter("n > 0")
        .groupBy("set_a", "set_b")
        .agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"), F.min("n").alias("n"))
    )
    nodes = stage_table(
        classes.withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    # Keys, cells and place of a node are those of any row of its class with the smallest id.
    placed = described.select("set_a", "set_b", "doc_id", "key_a", "key_b", "keys", "cells").alias("d")
    same = [F.col("d.set_a") == F.col("c.set_a"), F.col("d.set_b") == F.col("c.set_b"), F.col("d.doc_id").eqNullSafe(F.col("c.rep"))]
    nodes = stage_table(
        placed.join(nodes.alias("c"), same)
        .select("c.node", "c.set_a", "c.set_b", "c.copies", "c.rep", "c.n", "d.key_a", "d.key_b", "d.keys", "d.cells")
        .dropDuplicates(["node"]),
        "nodes",
    )

    single = nodes.select("node", F.explode("keys").alias("key"))
    again = stage_table(single.groupBy("key").count().filter("count > 1").select("key"), "shared-collections")
    shared = stage_table(
        single.join(broadcast_if_small(again, F.lit(24), broadcast_bytes), "key")
        .groupBy("node")
        .agg(F.sort_array(F.collect_set("key")).alias("keys"))
        .filter(F.size("keys") > 1),
        "shared-nodes",
    )
    pivots = stage_table(
        _buckets(shared)
        .groupBy("bucket")
        .agg(F.min("node").alias("x"), F.count("*").alias("entries"))
        .filter("entries > 1"),
        "pivots",
    )
    stars = (
        join_facts(_buckets(shared), pivots, "bucket", F.lit(24), "entries", F.col("node"), broadcast_bytes, hot_rows)
        .filter("node > x")
        .select("x", F.col("node").alias("y"))
        .distinct()
    )
    stars = stage_table(stars, "star-pairs")
    links = stage_table(verified(stars, nodes, texts, shingle, percent, broadcast_bytes), "links")
    known = components(links, broadcast_bytes)

    rest = _rest_pairs(shared, nodes, known, percent, tile_rows, broadcast_bytes, hot_rows)
    rest = stage_table(rest.join(stars, ["x", "y"], "left_anti"), "rest-pairs")
    more = verified(rest, nodes, texts, shingle, percent, broadcast_bytes)
    links = stage_table(links.unionByName(more), "all-links")
    known = components(links, broadcast_bytes)

    # Only classes with copies or links change anything.
    member = nodes.select("node", "set_a", "set_b", "rep", "copies").join(known, "node", "left")
    smallest = member.filter("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    groups = stage_table(
        member.filter("copies > 1 or component is not null")
        .join(smallest, "component", "left")
        .select("set_a", "set_b", F.coalesce("least", "rep").alias("least")),
        "groups",
    )
    groups = broadcast_if_small(groups, F.lit(48), broadcast_bytes)
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("least", "doc_id"))
    return (
        described.select("doc_id", "key_a", "key_b", "n", "set_a", "set_b")
        .join(groups, ["set_a", "set_b"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "key_a", "key_b")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, with all their columns.

    Rows are told by id and text, the latter by its 128-bit hash, so a row whose id repeats
    with another text is judged on its own.
    """
    groups = near_groups(docs, id_column, text_column, **options)
    dropped = groups.filter(~F.col("kept")).select(
        F.col("doc_id").alias("drop_id"), F.col("key_a").alias("drop_a"), F.col("key_b").alias("drop_b")
    )
    dropped = stage_table(dropped, "near-dropped")
    limit = options.get("broadcast_bytes", BROADCAST_BYTES)
    text = F.coalesce(F.col(f"row.`{text_column}`"), F.lit(""))
    same = (
        F.col(f"row.`{id_column}`").cast("bigint").eqNullSafe(F.col("drop_id"))
        & (F.xxhash64(text) == F.col("drop_a"))
        & (F.xxhash64(F.lit(1), text) == F.col("drop_b"))
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(broadcast_if_small(dropped, F.lit(40), limit), same, "left_anti").select("row.*")
