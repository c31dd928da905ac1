"""Language-model scoring: interpolated modified Kneser-Ney over words and word pairs.

Counts are made in Spark and stored as sorted hash arrays, which workers map into memory.
"""

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.llm.common import bounded_batches, shared_dir, text_batches, tokens_of
from tallyloom.llm.features import WordHashes

# Bytes of text per shard of the arrays, and pairs a task gathers before it hands them on.
SHARD_BYTES = 8 << 20
MOST_SHARD_BITS = 20
GATHERED = 1_500_000
GATHERED_WORDS = 200_000
# Pairs are keyed by two 32-bit word numbers.
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
# A word of its own that no text can hold: it has white space.
END = b"\n"


def local_folder(spark: SparkSession) -> str:
    """A new folder for arrays below the cluster's shared folder, as a path that can be mapped.

    Memory mapping needs a mounted folder that driver and executors see under one path.
    """
    shared = shared_dir(spark)
    path = shared.removeprefix("file://") if shared.startswith("file:///") else shared.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"language-model arrays are memory-mapped: {shared} has to be a mounted folder")
    folder = f"{path.rstrip('/')}/tables/{spark.sparkContext.applicationId}/lm-{uuid.uuid4().hex}"
    os.makedirs(folder)
    return folder


def mix(keys: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit keys that spreads them evenly."""
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    keys = (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return keys ^ (keys >> np.uint64(32))


_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def unmix(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(32))) * _INVERSE
    keys = (keys ^ (keys >> np.uint64(32))) * _INVERSE
    return keys ^ (keys >> np.uint64(32))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def packed(values: np.ndarray) -> bytes:
    """Integers as differences, bytes of one weight together, compressed."""
    if not len(values):
        return bytes(8)
    steps = np.diff(values, prepend=np.zeros(1, dtype=values.dtype))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), -1).T)
    return len(planes.tobytes()).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    if not size:
        return np.empty(0, dtype=kind)
    planes = np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True), dtype=np.uint8)
    steps = np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


def write_array(path: str, values: np.ndarray) -> None:
    """Whole or not at all, also if an attempt is lost or run twice."""
    context = TaskContext.get()
    own = f"{path}.{context.taskAttemptId() if context else 'driver'}"
    values.tofile(own)
    os.replace(own, path)


def read_array(path: str, kind: type) -> np.ndarray:
    return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.empty(0, dtype=kind)


@dataclass
class SortedArrays:
    """Sorted keys with counts, cut into shards by their top bits. Files are mapped when first used."""

    folder: str
    name: str
    bits: int
    starts: np.ndarray  # of each shard among all keys
    count_kind: type

    @cached_property
    def _open(self) -> dict:
        return {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_open"}

    def shard(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        if number not in self._open:
            at = f"{self.folder}/{self.name}-{number}"
            self._open[number] = (read_array(f"{at}.keys", np.uint64), read_array(f"{at}.counts", self.count_kind))
        return self._open[number]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (-1 where absent) and counts (0 where absent) of sorted keys."""
        places, counts = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys))
        cuts = np.searchsorted(keys, np.arange(1, 1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits))
        cuts = np.concatenate([[0], cuts, [len(keys)]])
        for number in np.flatnonzero(np.diff(cuts)).tolist():
            if self.starts[number] == self.starts[number + 1]:
                continue
            have, have_counts = self.shard(number)
            wanted = keys[cuts[number] : cuts[number + 1]]
            at = np.minimum(np.searchsorted(have, wanted), len(have) - 1)
            hit = np.flatnonzero(have[at] == wanted)
            places[cuts[number] + hit] = self.starts[number] + at[hit]
            counts[cuts[number] + hit] = have_counts[at[hit]]
        return places, counts


def _cut_rows(keys: np.ndarray, bits: int, *columns: np.ndarray) -> Iterator[tuple]:
    """``(shard, packed keys, packed columns)`` of sorted keys."""
    cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cuts = np.concatenate([[0], cuts, [len(keys)]])
    for shard in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[shard], cuts[shard + 1])
        yield (shard, packed(keys[part]), *(packed(c[part]) for c in columns))


_COUNTED = "shard int, keys binary, counts binary"
_STORED = "shard int, n bigint, total bigint, ones bigint, twos bigint, threes bigint, fours bigint"


def _counted(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
        ["shard", "keys", "counts"],
    )


def _in_slices(rows: list[tuple], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += sum(len(c) for c in row[1:])
        if size > most:
            yield _counted(part)
            part, size = [], 0
    if part:
        yield _counted(part)


def _store(folder: str, name: str, count_kind: type):
    """Merges the rows of each shard and writes its arrays; one row of totals per shard."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                entry = (unpacked(r["keys"], np.uint64), unpacked(r["counts"], np.int64))
                parts.setdefault(r["shard"], []).append(entry)
        for shard in sorted(parts):
            found = parts.pop(shard)
            keys, counts = summed(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))
            write_array(f"{folder}/{name}-{shard}.keys", keys)
            write_array(f"{folder}/{name}-{shard}.counts", counts.astype(count_kind))
            few = np.bincount(np.minimum(counts, 5), minlength=6)
            row = [shard, len(keys), int(counts.sum()), *few[1:5].tolist()]
            yield pa.RecordBatch.from_pydict(dict(zip(_NAMES, ([v] for v in row), strict=True)), schema=_STORED_ARROW)

    return store


_NAMES = [part.split()[0] for part in _STORED.split(", ")]
_STORED_ARROW = pa.schema([(n, pa.int32() if n == "shard" else pa.int64()) for n in _NAMES])


def _stored(counted: DataFrame, folder: str, name: str, bits: int, count_kind: type) -> tuple[SortedArrays, dict]:
    tasks = max(1, 1 << max(0, bits - 1))
    rows = counted.repartition(tasks, "shard").mapInArrow(_store(folder, name, count_kind), _STORED).collect()
    sizes = np.zeros(1 << bits, dtype=np.int64)
    for r in rows:
        sizes[r.shard] = r.n
    totals = {n: sum(r[n] for r in rows) for n in _NAMES[1:]}
    return SortedArrays(folder, name, bits, np.concatenate([[0], np.cumsum(sizes)]), count_kind), totals


def discounts(counts: dict) -> tuple[float, float, float]:
    """D1, D2 and D3+ of modified Kneser-Ney; one half where counts of counts are missing."""
    n1, n2, n3, n4 = (counts[k] for k in ("ones", "twos", "threes", "fours"))
    if not n1 or not n2 or not n3:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, start=1))


def discount_of(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.select([counts <= 0, counts < 2, counts < 3], [0.0, d[0], d[1]], d[2])


@dataclass
class Model:
    """What workers need to score: the arrays' places, and a few numbers."""

    words: SortedArrays
    pairs: SortedArrays
    n_words: int
    n_tokens: int
    n_pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    spare: float  # what discounting single words leaves for all words alike

    @cached_property
    def by_word(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word number (the last is the text's start): count as left, its spare share, left neighbours."""
        at = f"{self.words.folder}/word"
        size = self.n_words + 1
        kinds = (("total", np.float64), ("spare", np.float32), ("lefts", np.float64))
        return tuple(np.memmap(f"{at}.{n}", dtype=k, mode="r", shape=(size,)) for n, k in kinds)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "by_word"}

    def score(self, hashes: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Sums per text of word hashes laid end to end; ``starts`` has each text's first place."""
        distinct, back = np.unique(hashes, return_inverse=True)
        number, count = self.words.find(distinct)
        number, count = number[back], count[back]
        left = np.concatenate([[-1], number[:-1]])
        left[starts] = self.n_words
        total, spare, lefts = self.by_word
        known_word, known_left = number >= 0, left >= 0

        single = np.zeros(len(number))
        heard = lefts[number[known_word]]
        if self.n_pairs:
            single[known_word] = (heard - discount_of(heard, self.word_discounts)) / self.n_pairs
        single += self.spare / (self.n_words + 1)

        both = known_word & known_left
        keys, back = np.unique(pair_keys(left[both], number[both]), return_inverse=True)
        seen = self.pairs.find(keys)[1][back]
        p = single.copy()
        at_left = total[left[known_left]]
        p[known_left] = np.where(at_left > 0, single[known_left] * spare[left[known_left]], single[known_left])
        p[both] += np.where(seen > 0, (seen - discount_of(seen, self.pair_discounts)) / np.maximum(total[left[both]], 1.0), 0.0)

        base = np.log10((count + 1.0) / (self.n_tokens + self.n_words + 1.0))
        return {
            "n_known": np.add.reduceat((count > 0).astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts),
            "score": np.add.reduceat(np.log10(p), starts),
        }


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix((left.astype(np.uint64) << _HALF) | right.astype(np.uint64))


_hashes: WordHashes | None = None


def text_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts end to end, an end after each, and where each text starts."""
    global _hashes
    if _hashes is None:
        _hashes = WordHashes(xxhash.xxh3_64_intdigest)
    parts, starts, at = [], [], 0
    end = np.array([xxhash.xxh3_64_intdigest(END)], dtype=np.uint64)
    for text in texts:
        words = _hashes.array(tokens_of(text))
        parts += [words, end]
        starts.append(at)
        at += len(words) + 1
    return np.concatenate(parts), np.asarray(starts, dtype=np.int64)


def train_model(docs: DataFrame, text_column: str = "text") -> Model:
    """Counts words and pairs of all texts and stores them; see ``score_texts``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(f"`{text_column}`").alias("text"))
    folder = local_folder(spark)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_SHARD_BITS, max(1, int(size // SHARD_BYTES).bit_length()))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, seen), dtype=np.uint64, count=len(seen))
            counts = np.fromiter(seen.values(), dtype=np.int64, count=len(seen))
            seen.clear()
            keys, counts = summed(keys, counts)
            return _in_slices(list(_cut_rows(keys, bits, counts)))

        for _, slice_texts in text_batches(batches):
            for text in slice_texts:
                seen.update(tokens_of(text))
            seen[END] += len(slice_texts)
            if len(seen) > GATHERED_WORDS:
                yield from flush()
        yield from flush()

    words, word_totals = _stored(texts.mapInArrow(count_words, _COUNTED), folder, "words", bits, np.int64)
    n_words = word_totals["n"]
    if n_words >= 1 << 32:  # the end and the start of a text take numbers too
        raise ValueError(f"{n_words} distinct words; pairs are keyed by two 32-bit numbers")

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if not keys:
                return iter(())
            merged = summed(np.concatenate(keys), np.concatenate(counts))
            keys.clear(), counts.clear()
            held = 0
            return _in_slices(list(_cut_rows(merged[0], bits, merged[1])))

        for _, slice_texts in text_batches(batches):
            hashes, starts = text_hashes(slice_texts)
            distinct, back = np.unique(hashes, return_inverse=True)
            number = words.find(distinct)[0][back]
            left = np.concatenate([[0], number[:-1]])
            left[starts] = n_words
            here, n = np.unique(pair_keys(left, number), return_counts=True)
            keys.append(here)
            counts.append(n.astype(np.int64))
            held += len(here)
            if held > GATHERED:
                yield from flush()
        yield from flush()

    # No pair occurs more often than there are words, so its count fits this type exactly.
    kind = np.uint32 if word_totals["total"] < 1 << 32 else np.int64
    pairs, pair_totals = _stored(texts.mapInArrow(count_pairs, _COUNTED), folder, "pairs", bits, kind)
    d = discounts(pair_totals)
    lefts = _word_sides(spark, folder, pairs, n_words, d)
    d_word = discounts(lefts)
    kept = d_word[0] * lefts["ones"] + d_word[1] * lefts["twos"] + d_word[2] * lefts["more"]
    spare = kept / pair_totals["n"] if pair_totals["n"] else 1.0
    return Model(words, pairs, n_words, word_totals["total"], pair_totals["n"], d, d_word, spare)


def _word_sides(
    spark: SparkSession, folder: str, pairs: SortedArrays, n_words: int, d: tuple[float, float, float]
) -> dict:
    """Per word: total and spare share as left neighbour, and number of distinct left neighbours.

    Pair shards are summed by word where they are; the sums meet by ranges of word numbers.
    """
    shards = 1 << pairs.bits
    width = max(1, -(-(n_words + 1) // shards))
    sums = "part int, words binary, sums binary"

    def by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch["id"].to_pylist():
                if pairs.starts[shard] == pairs.starts[shard + 1]:
                    continue
                keys, counts = pairs.shard(shard)
                plain, counts = unmix(np.asarray(keys)), np.asarray(counts, dtype=np.int64)
                left, right = (plain >> _HALF).astype(np.int64), (plain & _LOW).astype(np.int64)
                rows = []
                sides = ((0, left, counts), (1, left, counts == 1), (2, left, counts == 2), (3, left, counts > 2))
                for kind, word, amount in (*sides, (4, right, np.ones(len(right)))):
                    chosen = amount > 0
                    ids, n = summed(word[chosen], amount[chosen].astype(np.int64))
                    cuts = np.searchsorted(ids, np.arange(shards + 1) * width)
                    for part in np.flatnonzero(np.diff(cuts)).tolist():
                        cut = slice(cuts[part], cuts[part + 1])
                        rows.append((part, bytes([kind]) + packed(ids[cut]), packed(n[cut])))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
                    ["part", "words", "sums"],
                )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                part = r["part"]
                table = parts.setdefault(part, np.zeros((5, min(width, n_words + 1 - part * width)), dtype=np.int64))
                ids = unpacked(r["words"][1:], np.int64) - part * width
                table[r["words"][0], ids] += unpacked(r["sums"], np.int64)
        for part, (total, ones, twos, more, lefts) in parts.items():
            spare = (d[0] * ones + d[1] * twos + d[2] * more) / np.maximum(total, 1)
            for name, values in (("total", total.astype(np.float64)), ("spare", spare.astype(np.float32)), ("lefts", lefts.astype(np.float64))):
                with open(f"{folder}/word.{name}", "r+b") as file:  # each part is its own range of the file
                    file.seek(part * width * values.itemsize)
                    file.write(values.tobytes())
            few = np.bincount(np.minimum(lefts, 5), minlength=6)
            row = dict(zip(_NAMES, [part, int((lefts > 0).sum()), int(lefts.sum()), *few[1:5].tolist()], strict=True))
            yield pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, schema=_STORED_ARROW)

    for name, item in (("total", 8), ("spare", 4), ("lefts", 8)):
        with open(f"{folder}/word.{name}", "wb") as file:
            file.truncate((n_words + 1) * item)
    found = (
        spark.range(shards)
        .repartition(shards, "id")
        .mapInArrow(by_word, sums)
        .repartition(shards, "part")
        .mapInArrow(write, _STORED)
        .collect()
    )
    totals = {n: sum(r[n] for r in found) for n in _NAMES[1:]}
    return totals | {"more": totals["n"] - totals["ones"] - totals["twos"]}


def score_texts(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``row`` (a struct of all input columns), ``n_tokens``, ``n_known``, ``base_score`` and ``score``.

    A text's tokens are its words, A-Z lower-cased, and one end. ``score`` is the log10
    probability under the interpolated modified Kneser-Ney model of words given the word
    before; ``base_score`` is that of single words with one added to each count. Words the
    model has not seen share what is left for one more word.

    The model lies in sorted arrays of 64-bit keys below the shared folder, cut into shards of
    bounded size. Workers map them and look up the sorted distinct pairs of a slice of texts
    at a time, so pages are read in order and memory does not grow with the model. Word keys
    are 64-bit hashes; pairs are keyed by word numbers without any loss.

    Null and empty texts have one token, the end. Repeated rows score alike and count as
    often as they occur when learnt. A model of no texts gives every token probability 1.
    Extra columns pass through in ``row``; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_column}`").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches):
            hashes, starts = text_hashes(texts)
            found = model.score(hashes, starts)
            n = np.diff(np.append(starts, len(hashes)))
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "n_tokens": n, **found})

    longs = [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")]
    doubles = [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    return rows.mapInArrow(score, T.StructType([rows.schema["row"], *longs, *doubles]))
