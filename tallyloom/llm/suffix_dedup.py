"""Dedup of repeated strings by suffix arrays over content-chosen segments."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.llm.common import BROADCAST_BYTES, bounded_batches, broadcast_if_small, stage_table, text_batches

# A removed string has this many bytes; the hash of GRAM bytes chooses anchors.
LENGTH = 400
GRAM = 100
# Bytes of a text that are cut into segments at once; places in them fit PLACE_BITS.
CHUNK = 1 << 20
PLACE_BITS = np.uint64(21)
# Segment bytes per group of a task, and per suffix array in it.
BIN_BYTES = 2 << 20
ARRAY_BYTES = 256 << 10
# Anchors with more different segments than this are split further before they are sorted.
MOST_SEGMENTS = 1024

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < size:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(size, 1 << 20), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hashes of all runs of ``gram`` bytes; equal runs have equal hashes wherever they stand."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of each run of ``width`` keys."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    table = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    table[: len(keys)] = keys
    table = table.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts whose ``length``-byte strings share one anchor.

    Returns first start, number of starts, anchor place and anchor hash of each run. The
    anchor of a string is its ``gram``-byte run with the smallest hash, the leftmost of
    equals. It depends on the string alone, so equal strings have equal anchors at equal
    places, and lie in segments with the same anchor hash.
    """
    if len(data) < length:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, np.empty(0, dtype=np.uint64)
    hashes = gram_hashes(data, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    keys = ((hashes >> PLACE_BITS) << PLACE_BITS) | places
    low = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    anchor = (window_minima(keys, length - gram + 1) & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return first, np.diff(np.append(first, len(anchor))), anchor[first], hashes[anchor[first]]


def text_segments(text: bytes, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Segments of a text of any length, a chunk of starts at a time; the cuts only divide runs."""
    for at in range(0, max(0, len(text) - length + 1), CHUNK):
        part = np.frombuffer(text, dtype=np.uint8, count=min(CHUNK + length - 1, len(text) - at), offset=at)
        first, n, anchor, hashes = segments(part, length, gram)
        yield first + at, n, anchor - first, hashes


def suffix_order(data: bytes, depth: int) -> np.ndarray:
    """Start places of all suffixes, sorted by their first ``depth`` bytes: two-stage sorting.

    Only suffixes smaller than their successor are compared. The others follow by scanning
    the buckets of first bytes in rising order: a suffix placed at p puts the one at p - 1
    next in its bucket, if that is larger than its own successor.
    """
    text = np.frombuffer(data, dtype=np.uint8)
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    step = np.append(np.sign(text[1:].astype(np.int16) - text[:-1]), -1)
    deciding = np.where(step != 0, np.arange(n), n)[::-1]
    smaller = step[np.minimum.accumulate(deciding)[::-1]] > 0
    direct = np.array(sorted(np.flatnonzero(smaller).tolist(), key=lambda i: data[i : i + depth]), dtype=np.int64)
    direct_at = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[n - 1]].append(np.array([n - 1]))
    order = []

    def induce(placed: np.ndarray, byte: int) -> np.ndarray:
        """Hands predecessors to the buckets ahead; returns those that fall into this one."""
        before = placed[placed > 0] - 1
        before = before[~smaller[before]]
        heads = text[before]
        ranked = np.argsort(heads, kind="stable")
        before, heads = before[ranked], heads[ranked]
        cuts = np.flatnonzero(np.diff(heads)) + 1
        same = np.empty(0, dtype=np.int64)
        for group in np.split(before, cuts) if len(before) else []:
            if text[group[0]] == byte:
                same = group
            else:
                waiting[text[group[0]]].append(group)
        return same

    for byte in range(256):
        batch = np.concatenate(waiting[byte]) if waiting[byte] else np.empty(0, dtype=np.int64)
        while len(batch):
            order.append(batch)
            batch = induce(batch, byte)
        own = direct[direct_at[byte] : direct_at[byte + 1]]
        if len(own):
            order.append(own)
            induce(own, byte)
    return np.concatenate(order)


def common_prefixes(data: bytes, left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """Common prefix lengths of pairs of suffixes, counted up to ``most`` bytes."""
    text = np.frombuffer(data + bytes(most + 8), dtype=np.uint8)
    words = np.lib.stride_tricks.as_strided(text[:8].view(np.uint64), (len(text) - 7,), (1,))
    found = np.zeros(len(left), dtype=np.int64)
    alive = np.arange(len(left))
    for at in range(0, most, 8):
        differ = words[left[alive] + at] ^ words[right[alive] + at]
        ended = differ != 0
        first = differ[ended]
        # The lowest set bit of a little-endian word lies in the first byte that differs.
        lowest = (first & (~first + np.uint64(1))).astype(np.float64)
        found[alive[ended]] = at + (np.log2(lowest).astype(np.int64) >> 3)
        alive = alive[~ended]
        if not len(alive):
            break
    found[alive] = most
    return np.minimum(found, most)


def repeated_starts(contents: list[bytes], starts: list[int], length: int) -> list[np.ndarray]:
    """For each content, which of its first ``starts`` places begin a string found at another such place."""
    data = b"".join(contents)
    begin = np.concatenate([[0], np.cumsum([len(c) for c in contents])])
    order = suffix_order(data, length)
    valid = np.zeros(len(data) + 1, dtype=np.int64)
    for at, n in zip(begin, starts, strict=False):
        valid[at : at + n] = 1
    order = order[valid[order] > 0]
    shared = common_prefixes(data, order[:-1], order[1:], length) >= length
    again = np.zeros(len(data), dtype=bool)
    again[order[:-1][shared]] = True
    again[order[1:][shared]] = True
    return [again[at : at + n] for at, n in zip(begin, starts, strict=False)]


def runs(mask: np.ndarray) -> tuple[list[int], list[int]]:
    """First and past-the-last places of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edges[::2].tolist(), edges[1::2].tolist()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(values, dtype=np.uint64).view(np.int64), pa.int64())


_SEGMENTS = "key_a bigint, key_b bigint, start int, starts int, place int, anchor bigint, digest bigint"


def _segment_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        columns, counts, digests = [[], [], [], []], [], []
        for text in texts:
            data = text.encode() if text else b""
            total = 0
            for found in text_segments(data, length, gram):
                for column, values in zip(columns, found, strict=True):
                    column.append(values)
                ends = (found[0] + found[1] + length - 1).tolist()
                digests += [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(found[0].tolist(), ends, strict=True)]
                total += len(ends)
            counts.append(total)
        if not digests:
            continue
        start, n, place, anchor = (np.concatenate(c) for c in columns)
        keys = [np.repeat(np.asarray(batch[k]), counts) for k in ("key_a", "key_b")]
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(k, pa.int64()) for k in keys),
                *(pa.array(c.astype(np.int32)) for c in (start, n, place)),
                _signed(anchor),
                _signed(np.array(digests, dtype=np.uint64)),
            ],
            [c.split()[0] for c in _SEGMENTS.split(", ")],
        )


_FOUND = "anchor bigint, digest bigint, froms array<int>, tos array<int>"


def _sort_bin(table: pa.Table, length: int) -> pa.Table:
    """Suffix arrays over the segments of whole anchors, a bounded number of bytes at a time."""
    table = table.sort_by([("anchor", "ascending"), ("digest", "ascending")])
    anchors, digests = table["anchor"].to_pylist(), table["digest"].to_pylist()
    contents, starts = table["content"].to_pylist(), table["starts"].to_pylist()
    out, at = [], 0
    while at < len(anchors):
        end, size = at, 0
        while end < len(anchors) and (size < ARRAY_BYTES or anchors[end] == anchors[end - 1]):
            size += len(contents[end])
            end += 1
        for k, mask in enumerate(repeated_starts(contents[at:end], starts[at:end], length), start=at):
            if mask.any():
                out.append((anchors[k], digests[k], *runs(mask)))
        at = end
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["anchor", "digest", "froms", "tos"])


_BLOCKS = (
    "anchor bigint, digest bigint, content binary, starts int, place int, many boolean, offset int, width int,"
    " core_a bigint, core_b bigint, body bigint"
)


def _split_blocks(batches: Iterator[pa.RecordBatch], length: int, halve: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of strings by their distance from the anchor, with a digest of what all of a block share.

    A block holds the strings that start ``offset`` to ``offset + width - 1`` bytes before the
    anchor. All of them cover the same core, so equal strings lie in blocks of equal cores.
    """
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            width = r["width"] // 2 if halve else r["width"]
            for offset in (r["offset"], r["offset"] + width) if halve else (r["offset"],):
                low, high = max(offset, r["place"] - r["starts"] + 1), min(offset + width - 1, r["place"])
                if low > high:
                    continue
                content, place = r["content"], r["place"]
                core = xxhash.xxh3_128_intdigest(content[place - offset : max(0, place - offset - width + 1 + length)])
                body = content[place - high : place - low + length]
                out.append(
                    r | {"offset": offset, "width": width, "core_a": core >> 65, "core_b": core & (2**63 - 1)}
                    | {"body": xxhash.xxh3_64_intdigest(body, seed=high) >> 1}
                )
            if len(out) > 4096:
                yield pa.RecordBatch.from_pylist(out, schema=_BLOCKS_ARROW)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_BLOCKS_ARROW)


_ARROW_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
_BLOCKS_ARROW = pa.schema([(c.split()[0], _ARROW_KINDS[c.split()[1]]) for c in _BLOCKS.split(",")])


def split_hot(contents: DataFrame, length: int, gram: int, broadcast_bytes: int) -> DataFrame:
    """Repeated starts of segments whose anchor has very many different ones.

    Strings are grouped by their distance from the anchor in blocks that are halved until the
    segments of one core are alone, all equal, or a block is a single string. Every step is
    an aggregate and a join on numbers, so no task sees a whole anchor.
    """
    width = 1 << int(length - gram).bit_length()
    blocks = contents.select(
        "anchor", "digest", "content", "starts", "place", "many", F.lit(0).alias("offset"), F.lit(width).alias("width"),
        *(F.lit(0).cast("bigint").alias(c) for c in ("core_a", "core_b", "body")),
    ).mapInArrow(lambda b: _split_blocks(b, length, False), _BLOCKS)
    key = ["anchor", "offset", "core_a", "core_b"]
    found = None
    while True:
        blocks = stage_table(blocks, "hot-blocks")
        groups = stage_table(
            blocks.groupBy(*key)
            .agg(F.count("*").alias("n"), F.max("many").alias("some"), (F.min("body") == F.max("body")).alias("alike"))
            .filter("n > 1 or some")
            .select(*key, "alike"),
            "hot-groups",
        )
        known = blocks.join(broadcast_if_small(groups, F.lit(48), broadcast_bytes), key)
        done = F.col("alike") | (F.col("width") == 1)
        high = F.least(F.col("offset") + F.col("width") - 1, F.col("place"))
        low = F.greatest(F.col("offset"), F.col("place") - F.col("starts") + 1)
        part = known.filter(done).select(
            "anchor",
            "digest",
            F.array((F.col("place") - high).cast("int")).alias("froms"),
            F.array((F.col("place") - low + 1).cast("int")).alias("tos"),
        )
        found = part if found is None else found.unionByName(part)
        rest = known.filter(~done)
        if width == 1 or rest.isEmpty():
            return found
        width //= 2
        blocks = rest.select(*blocks.columns).mapInArrow(lambda b: _split_blocks(b, length, True), _BLOCKS)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segment contents of the texts that were chosen for them, once per task."""
    seen: set[tuple[int, int]] = set()
    names = ["anchor", "digest", "starts", "place", "many", "content"]
    for batch, texts in text_batches(batches):
        out = []
        for a, b, text, wanted in zip(
            batch["key_a"].to_pylist(), batch["key_b"].to_pylist(), texts, batch["wanted"].to_pylist(), strict=True
        ):
            if (a, b) in seen:
                continue
            seen.add((a, b))
            data = text.encode()
            for w in wanted:
                out.append([w[n] for n in names[:5]] + [data[w["start"] : w["start"] + w["bytes"]]])
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def merged_spans(spans: Column) -> Column:
    """Sorted spans of a text with those that touch or overlap made one."""


    def grown(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["from"].alias("from"), F.greatest(last["to"], span["to"]).alias("to"))
        apart = F.concat(done, F.array(span))
        together = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when(span["from"] <= last["to"], together).otherwise(apart)

    ordered = F.sort_array(spans)
    return F.aggregate(F.slice(ordered, 2, F.size(ordered)), F.slice(ordered, 1, 1), grown)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kept bytes of each text and its spans, none where it has none."""
    for batch, texts in text_batches(batches):
        kept, merged = [], []
        for text, spans in zip(texts, batch["spans"].to_pylist(), strict=True):
            data, at, parts = text.encode() if text else b"", 0, []
            for span in spans or []:
                parts.append(data[at : span["from"]])
                at = span["to"]
            kept.append(b"".join([*parts, data[at:]]))
            merged.append(spans or [])
        span_kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
        yield pa.RecordBatch.from_pydict(
            {
                "row": batch.column("row"),
                "n_bytes": pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                "spans": pa.array(merged, span_kind),
                "kept": pa.array(kept, pa.binary()),
            }
        )


def remove_repeats(
    docs: DataFrame,
    text_column: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    most_segments: int = MOST_SEGMENTS,
    bin_bytes: int = BIN_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Removes every byte covered by a ``length``-byte string that also starts anywhere else.

    Returns ``row`` (a struct of all input columns), ``n_bytes``, the removed ``spans`` (bytes
    from, to) and the ``kept`` bytes. Strings never cross texts, overlaps count, and all
    strings are judged on the input.

    A string meets its equals through its anchor (see ``segments``). Segments whose anchor
    occurs once hold no repeat. Equal segments are repeats whole, found by counting alone.
    Different segments of one anchor may share part of their strings: their contents go by
    anchor into bins of bounded size, where a suffix array over them is built by two-stage
    sorting and common prefixes of neighbours tell the repeats. Anchors with more than
    ``most_segments`` different segments are split by ``split_hot`` instead, with the same
    result. Texts themselves move only if the table of what to take from them is too large
    to broadcast. Equality of segments, and of cores in ``split_hot``, is that of 128 bits.

    Null and empty texts, and texts shorter than ``length``, keep all their bytes, of which
    a null has none. Repeated rows are repeats of each other. Texts of any length are cut
    into chunks of starts. Extra columns of any name pass through in ``row``; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        text.alias("text"),
        F.xxhash64(text).alias("key_a"),
        F.xxhash64(F.lit(1), text).alias("key_b"),
    )
    texts = rows.select("key_a", "key_b", "text").filter(F.octet_length("text") >= length)
    table = stage_table(texts.mapInArrow(lambda b: _segment_rows(b, length, gram), _SEGMENTS), "segments")

    one = ["key_a", "key_b", "start", "starts", "place"]  # of any one occurrence, all from the same row
    kinds = stage_table(
        table.groupBy("anchor", "digest").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in one)),
        "segment-kinds",
    )
    shared = stage_table(
        kinds.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).filter("total > 1").drop("total"),
        "shared-anchors",
    )
    known = kinds.join(broadcast_if_small(shared, F.lit(48), broadcast_bytes), "anchor")
    mixed = known.filter("kinds > 1").withColumn("many", F.col("n") > 1)

    wanted = stage_table(
        mixed.withColumn("bytes", F.col("starts") + (length - 1))
        .groupBy("key_a", "key_b")
        .agg(F.collect_list(F.struct("anchor", "digest", "start", "bytes", "starts", "place", "many")).alias("wanted")),
        "segment-places",
    )
    contents = (
        texts.join(broadcast_if_small(wanted, F.size("wanted") * 48 + 48, broadcast_bytes), ["key_a", "key_b"])
        .select("key_a", "key_b", "text", "wanted")
        .mapInArrow(_extract, "anchor bigint, digest bigint, starts int, place int, many boolean, content binary")
    )
    hot = stage_table(shared.filter(F.col("kinds") > most_segments).select("anchor"), "hot-anchors")
    hot_found = None
    if not hot.isEmpty():
        contents = stage_table(contents, "segment-contents")
        small = broadcast_if_small(hot, F.lit(48), broadcast_bytes)
        hot_found = split_hot(
            contents.join(small, "anchor").dropDuplicates(["anchor", "digest"]), length, gram, broadcast_bytes
        )
        contents = contents.join(small, "anchor", "left_anti")
    size = mixed.agg(F.sum(F.col("starts") + length)).first()[0] or 0
    bins = max(1, -(-size // bin_bytes))
    found = (
        contents.dropDuplicates(["anchor", "digest"])
        .withColumn("bin", F.pmod(F.xxhash64("anchor"), F.lit(bins)))
        .groupBy("bin")
        .applyInArrow(lambda t: _sort_bin(t.select(["anchor", "digest", "content", "starts"]), length), _FOUND)
    )
    if hot_found is not None:
        found = found.unionByName(hot_found)
    ranges = found.select("anchor", "digest", F.explode(F.arrays_zip("froms", "tos")).alias("r")).select(
        "anchor", "digest", F.col("r.froms").alias("low"), F.col("r.tos").alias("high")
    )
    whole = known.filter("n > 1").select("anchor", "digest", F.lit(0).alias("low"), F.col("starts").alias("high"))
    ranges = stage_table(whole.unionByName(ranges.join(whole.select("anchor", "digest"), ["anchor", "digest"], "left_anti")), "repeats")
    # Both sides are numbers and follow the input, so they are shuffled at any size.
    spans = stage_table(
        table.join(ranges, ["anchor", "digest"])
        .select(
            "key_a",
            "key_b",
            (F.col("start") + F.col("low")).cast("bigint").alias("from"),
            (F.col("start") + F.col("high") + (length - 1)).cast("bigint").alias("to"),
        )
        .distinct()
        .groupBy("key_a", "key_b")
        .agg(merged_spans(F.collect_list(F.struct("from", "to"))).alias("spans")),
        "spans",
    )
    joined = rows.join(broadcast_if_small(spans, F.size("spans") * 16 + 48, broadcast_bytes), ["key_a", "key_b"], "left")
    span = T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())])
    fields = [
        rows.schema["row"],
        T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(span)),
        T.StructField("kept", T.BinaryType()),
    ]
    return joined.select("row", "text", "spans").mapInArrow(_cut, T.StructType(fields))
