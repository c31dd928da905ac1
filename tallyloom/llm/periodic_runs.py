"""Periodic runs of words by block convolution at dyadic scales."""

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tallyloom.llm.common import bounded_batches, text_batches

# Words of the shortest run; a run also holds its period twice.
LEAST = 12
# Words of the longest block. Longer periods are looked for by blocks of this size in more windows.
MOST_BLOCK = 1 << 16
# Numbers transformed at once.
CHUNK = 1 << 18

# Primes below 2^31 with a primitive root; each minus one is a multiple of 2^25 or more.
PRIMES = ((2013265921, 31), (1811939329, 13), (2113929217, 5))

_tables: dict[tuple[int, int], tuple[list[np.ndarray], list[np.ndarray], int]] = {}


def _powers(prime: int, root: int, size: int) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Powers of the root of unity and of its inverse for every halving of ``size``; size's inverse."""
    if (prime, size) not in _tables:

        def levels(unit: int) -> list[np.ndarray]:
            out, length = [], size
            while length > 1:
                powers = np.ones(length // 2, dtype=np.uint64)
                step, done = unit, 1
                while done < len(powers):  # doubles the part that is known
                    powers[done : 2 * done] = powers[:done] * np.uint64(pow(step, done, prime)) % np.uint64(prime)
                    done *= 2
                out.append(powers)
                unit, length = unit * unit % prime, length // 2
            return out

        unit = pow(root, (prime - 1) // size, prime)
        _tables[prime, size] = levels(unit), levels(pow(unit, -1, prime)), pow(size, -1, prime)
    return _tables[prime, size]


def transform(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order."""
    p, out = np.uint64(prime), rows.copy()
    for powers in _powers(prime, root, rows.shape[1])[0]:
        view = out.reshape(len(rows), -1, 2, len(powers))
        left, right = view[:, :, 0, :].copy(), view[:, :, 1, :]
        total, gap = left + right, left + (p - right)
        view[:, :, 0, :] = np.minimum(total, total - p)  # below zero wraps to large
        view[:, :, 1, :] = gap * powers % p
    return out


def transform_back(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Inverse of ``transform``, from bit-reversed order."""
    p, out = np.uint64(prime), rows.copy()
    _, levels, scale = _powers(prime, root, rows.shape[1])
    for powers in reversed(levels):
        view = out.reshape(len(rows), -1, 2, len(powers))
        left, right = view[:, :, 0, :].copy(), view[:, :, 1, :] * powers % p
        total, gap = left + right, left + (p - right)
        view[:, :, 0, :] = np.minimum(total, total - p)
        view[:, :, 1, :] = np.minimum(gap, gap - p)
    return out * np.uint64(scale) % p


def zero_mismatches(blocks: np.ndarray, windows: np.ndarray, most: int) -> np.ndarray:
    """Where each block occurs in its window, as a boolean per offset.

    The sum of squared differences at every offset is computed modulo as many primes as its
    largest value, from codes up to ``most``, needs: it is 0 exactly if it is 0 modulo all.
    """
    width, span = blocks.shape[1], windows.shape[1]
    size = 1 << (span - 1).bit_length()
    offsets = span - width + 1
    found, product = None, 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        left = np.zeros((len(blocks), size), dtype=np.uint64)
        right = left.copy()
        left[:, :width] = blocks[:, ::-1]
        right[:, :span] = windows
        squares = np.cumsum(right[:, :span] * right[:, :span] % p, axis=1)  # below 2^31 each
        of_window = squares[:, width - 1 :].copy()
        of_window[:, 1:] -= squares[:, : offsets - 1]
        of_block = (left * left % p).sum(axis=1)[:, None]
        products = transform_back(transform(left, prime, root) * transform(right, prime, root) % p, prime, root)
        common = products[:, width - 1 : width - 1 + offsets]
        zero = (of_window + of_block) % p == 2 * common % p
        found = zero if found is None else found & zero
        product *= prime
        if width * most * most < product:
            return found
    raise ValueError("texts of over 2^36 words")


class Level(NamedTuple):
    """Blocks of ``size`` words find the periods of ``low`` to ``high`` that are ``wanted``."""

    size: int
    low: int
    high: int
    wanted: np.ndarray


def levels_for(words: int, least: int, most_block: int) -> list[Level]:
    """Block size for every period up to half of ``words``.

    A run of period p and length L has L - p >= max(p, least - p) places that equal the word p
    on. The largest block of which one, aligned, always fits in there is taken.
    """
    periods = np.arange(1, words // 2 + 1)
    room = np.maximum(periods, least - periods)
    sizes = np.minimum(1 << np.floor(np.log2((room + 1) // 2 + 0.25)).astype(np.int64), most_block)
    out = []
    for size in np.unique(sizes).tolist():
        of_size = periods[sizes == size]
        low, high = int(of_size[0]), int(of_size[-1])
        wanted = np.zeros(high - low + 1, dtype=bool)
        wanted[of_size - low] = True
        out.append(Level(size, low, high, wanted))
    return out


def _next_distance(keys: np.ndarray) -> np.ndarray:
    """Distance of each key to its next occurrence; very large if there is none."""
    out = np.full(len(keys), np.iinfo(np.int64).max, dtype=np.int64)
    order = np.argsort(keys, kind="stable")
    again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    out[order[again]] = order[again + 1] - order[again]
    return out


def _occurrences(
    codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, level: Level, most: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(start, distance)`` of every later occurrence of a block at a wanted distance in its text."""
    found_at, found_by = [], []
    size = level.size
    piece = max(4 * size, 32)
    for low in range(level.low, level.high + 1, piece):
        high = min(level.high, low + piece - 1)
        span = high - low + size
        rows = max(1, CHUNK // (1 << (span - 1).bit_length()))
        for at in range(0, len(starts), rows):
            first, last = starts[at : at + rows], ends[at : at + rows]
            here = first + low + size <= last
            first, last = first[here], last[here]
            if not len(first):
                continue
            places = first[:, None] + low + np.arange(span)
            inside = places < last[:, None]
            windows = np.where(inside, codes[np.minimum(places, len(codes) - 1)], most)  # no word has the code ``most``
            blocks = codes[first[:, None] + np.arange(size)]
            hits = zero_mismatches(blocks.astype(np.uint64), windows.astype(np.uint64), most)
            hits &= level.wanted[low - level.low : high - level.low + 1]
            row, offset = np.nonzero(hits)
            found_at.append(first[row])
            found_by.append(offset + low)
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_by)


def _extended(codes: np.ndarray, start: int, end: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The stretch in which every word equals the one ``period`` on, grown from ``start`` to ``end``."""
    step = 64
    while end + period < high:
        n = min(step, high - period - end)
        other = np.flatnonzero(codes[end : end + n] != codes[end + period : end + period + n])
        end += int(other[0]) if len(other) else n
        if len(other):
            break
        step *= 2
    step = 64
    while start > low:
        n = min(step, start - low)
        other = np.flatnonzero(codes[start - n : start] != codes[start - n + period : start + period])
        start -= n - 1 - int(other[-1]) if len(other) else n
        if len(other):
            break
        step *= 2
    return start, end


def _shorter_period(codes: np.ndarray, start: int, end: int, period: int) -> bool:
    """Whether a proper divisor of its period is a period of the stretch, which holds it twice."""
    rest, prime = period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            q = period // prime
            if np.array_equal(codes[start : end - q], codes[start + q : end]):
                return True
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return False


def runs_of(
    texts: list[np.ndarray], least: int = LEAST, most_block: int = MOST_BLOCK
) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of each text, a text being the codes of its words from 0 on.

    Blocks of all texts are convolved together. A block can only occur again if each of its
    words does within reach, and blocks deep inside a run that is known already have nothing
    to add; the others are transformed.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    found: list[set[tuple[int, int, int]]] = [set() for _ in texts]
    if lengths.sum() == 0 or lengths.max() < max(least, 2):
        return [[] for _ in texts]
    codes = np.concatenate(texts).astype(np.int64)
    most = int(codes.max()) + 1
    text_ends = np.cumsum(lengths)
    text_starts = text_ends - lengths
    owner = np.repeat(np.arange(len(texts)), lengths)
    ahead = _next_distance(owner * most + codes)
    known: list[dict[int, list[tuple[int, int]]]] = [{} for _ in texts]  # by text and period: starts and ends
    inside = np.zeros(len(codes), dtype=np.int64)  # end of the furthest known run of a short period at each place
    waiting: list[tuple[int, int, int]] = []

    size, starts, reach = 1, np.arange(len(codes)), ahead
    for level in levels_for(int(lengths.max()), least, most_block):
        while size < level.size:  # two blocks next to each other in a text make one of twice the size
            even = np.flatnonzero((starts - text_starts[owner[starts]]) // size % 2 == 0)
            even = even[even + 1 < len(starts)]
            even = even[(starts[even + 1] == starts[even] + size) & (owner[starts[even + 1]] == owner[starts[even]])]
            starts, reach = starts[even], np.maximum(reach[even], reach[even + 1])
            size *= 2
        later = []
        for run in waiting:
            if run[2] <= size:
                inside[run[0] : run[1]] = np.maximum(inside[run[0] : run[1]], run[1])
            else:
                later.append(run)
        waiting = later
        ends = text_ends[owner[starts]]
        useful = (reach <= level.high) & (starts + size + level.low <= ends)
        useful &= inside[starts] < np.minimum(starts + size + level.high, ends)
        at, by = _occurrences(codes, starts[useful], ends[useful], level, most)
        order = np.lexsort((at, by))
        at, by = at[order], by[order]
        first = np.flatnonzero(np.concatenate([[True], (by[1:] != by[:-1]) | (at[1:] != at[:-1] + size)])) if len(at) else []
        last = np.concatenate([first[1:] - 1, [len(at) - 1]]) if len(at) else []
        for i, j in zip(first, last, strict=True):
            start, end, period = int(at[i]), int(at[j]) + size, int(by[i])
            text = int(owner[start])
            if any(
                period % q == 0 and (k := bisect_right(spans, (start, len(codes)))) and spans[k - 1][1] >= end + period
                for q, spans in known[text].items()
            ):
                continue
            low, high = int(text_starts[text]), int(text_ends[text])
            start, end = _extended(codes, start, end, period, low, high)
            end += period
            if end - start < max(least, 2 * period) or (start - low, end - start, period) in found[text]:
                continue
            if _shorter_period(codes, start, end, period):
                continue
            found[text].add((start - low, end - start, period))
            spans = known[text].setdefault(period, [])
            spans.insert(bisect_right(spans, (start, end)), (start, end))
            waiting.append((start, end, period))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Numbers of the words that no run holds after its first period."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.flatnonzero(np.cumsum(edges[:n]) == 0)


_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def find_runs(
    docs: DataFrame, text_column: str = "text", least: int = LEAST, most_block: int = MOST_BLOCK
) -> DataFrame:
    """``row`` (a struct of all input columns), ``n_words``, ``runs`` and ``collapsed``.

    A run is a stretch of words (maximal pieces without ASCII white space) that repeats with
    its smallest period, holds that period at least twice and ``least`` words, and cannot be
    extended to either side. ``runs`` has start (word number), length and period of each, by
    start, then period. ``collapsed`` is the text without the repeats: words that no run
    holds after its first period, joined by one space.

    For each scale, a text is cut into aligned blocks of 2^k words. The sum of squared
    differences between a block and every place of the window after it is a convolution,
    which an exact integer transform computes; zeros are the block's occurrences. Their
    distances seed runs, which are extended word by word. Blocks are as large as allows one
    to lie inside every run of their periods, so no run is missed; see ``levels_for``.

    Null and empty texts, and texts of white space, have no runs and collapse to an empty
    text. Runs that tie in start are ordered by period. Repeated rows are treated alike, texts
    count whole; a very long one takes some hundred bytes per word in its task, whatever its
    periods, as blocks are transformed in bounded portions. An empty table gives an empty
    result, and input columns, being in ``row``, clash with none made here.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_column}`").alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, most_bytes=1 << 20):
            words = [t.encode().split() if t else [] for t in texts]
            coded = []
            for own in words:
                numbers: dict[bytes, int] = {}
                coded.append(np.array([numbers.setdefault(w, len(numbers)) for w in own], dtype=np.int64))
            found = runs_of(coded, least, most_block)
            collapsed = []
            for own, runs in zip(words, found, strict=True):
                kept = own if not runs else [own[i] for i in collapsed_words(len(own), runs).tolist()]
                collapsed.append(b" ".join(kept).decode())
            named = [[dict(zip(_RUN.names, r, strict=True)) for r in runs] for runs in found]
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in _RUN.names]))
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch.column("row"),
                    "n_words": pa.array([len(own) for own in words], pa.int64()),
                    "runs": pa.array(named, kind),
                    "collapsed": pa.array(collapsed, pa.string()),
                }
            )

    fields = [
        rows.schema["row"],
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(_RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
    return rows.mapInArrow(search, T.StructType(fields))
