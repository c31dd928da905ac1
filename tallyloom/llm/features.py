"""Hashed sparse text features, made per document inside Arrow batches."""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

# Width of the hashed feature space, and how many words a worker remembers.
FEATURE_BITS = 18
CACHE_WORDS = 60_000

_SHAPE = bytes(
    88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.DOTALL)
_EDGES = bytes(b for b in range(128) if not chr(b).isalnum())


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, digest: Callable[[bytes], int] = xxhash.xxh3_64_intdigest, most: int = CACHE_WORDS):
        self.digest, self.most = digest, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self.digest(word)
        self[word] = value
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def shape_digest(word: bytes) -> int:
    """Hash of a word's shape: letter case, digits and marks, with runs cut to one."""
    return xxhash.xxh3_64_intdigest(_RUN.sub(rb"\1", word.translate(_SHAPE)), seed=1)


def core_digest(word: bytes) -> int:
    """Hash of the lower-cased word without marks at its edges."""
    return xxhash.xxh3_64_intdigest(word.lower().strip(_EDGES))


def stem_digest(letters: int) -> Callable[[bytes], int]:
    """Hash of the first ``letters`` characters of the lower-cased word, for any word ending."""

    def digest(word: bytes) -> int:
        stem = word.lower().strip(_EDGES).decode(errors="replace")[:letters]
        return xxhash.xxh3_64_intdigest(stem.encode(errors="replace"), seed=letters)

    return digest


def pair(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of neighbouring items from their own hashes."""
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(salt))
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


def slots(hashes: np.ndarray, bits: int = FEATURE_BITS) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int32)


def sparse_rows(
    batches: Iterator[tuple[pa.RecordBatch, list[str | None]]],
    featurize: Callable[[str | None], tuple[np.ndarray, np.ndarray]],
    keep: list[str],
) -> Iterator[pa.RecordBatch]:
    """The ``keep`` columns of each batch with ``slots`` and ``weights`` of its texts."""
    for batch, texts in batches:
        found = [featurize(t) for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(i) for i, _ in found])]).astype(np.int32)
        flat = [np.concatenate(part) if found else np.empty(0) for part in zip(*found, strict=True)]
        columns = {c: batch.column(c) for c in keep}
        columns["slots"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[0].astype(np.int32)))
        columns["weights"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[1].astype(np.float32)))
        yield pa.RecordBatch.from_pydict(columns)
