"""BPE encoding and decoding through a table of distinct words."""

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tallyloom.llm.common import BROADCAST_BYTES, bounded_batches, stage_table, text_slices

# Words of the table that travel to every worker, most frequent first; the bytes they may take.
TABLE_WORDS = 250_000
# Bytes of words a task counts before it hands its counts on.
COUNT_BYTES = 12 << 20
# Longest word of the table; texts a task encodes at once; words that are encoded as one text.
MOST_BYTES = 256
SLICE_BYTES = 2 << 20
GROUP_WORDS = 256


def tokenizer_json(path: str) -> str:
    """The tokenizer file's text, without truncation and padding. Read on the driver, sent with the tasks."""
    with open(path, encoding="utf-8") as file:
        return json.dumps(json.load(file) | {"truncation": None, "padding": None})


def split_words(texts: pa.Array) -> pa.ListArray:
    """Runs between ASCII white space. No token spans it, and nothing before or after it changes a word.

    A text that begins or ends with white space has an empty word there, and so has one without words.
    """
    return pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))


def count_words(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``(word, n)``: distinct words of all texts, counted in tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            counted = pc.value_counts(pa.chunked_array(held, pa.string()))
            seen = pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["word", "n"])
            return seen.filter(pc.greater(pc.binary_length(seen["word"]), 0))

        for part in text_slices(batches):
            held.append(split_words(part.column("text")).flatten())
            size += held[-1].nbytes
            if size > COUNT_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    texts = docs.select(F.col(f"`{text_column}`").alias("text"))
    return texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class WordEncoder:
    """Ids of words, many at a time, and the piece of each id."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.bpe = Tokenizer.from_str(tokenizer)
        vocabulary = self.bpe.get_vocab(with_added_tokens=True)
        pieces: list[str] = [""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            pieces[i] = piece
        self.pieces = pa.array(pieces, pa.string())
        end = getattr(self.bpe.model, "end_of_word_suffix", None) or ""
        # A character of a piece is a byte of the text it stands for.
        self.widths = np.array([len(p.removesuffix(end)) for p in pieces], dtype=np.int64)

    def encode(self, words: list[str]) -> pa.ListArray:
        """``ids`` of each word.

        Words are encoded as texts of many, which takes half the time of one call each, and cut apart by
        the bytes of their pieces. A group in which these do not end where its words do, as the tokenizer's own
        normalizer leaves them, is encoded word by word.
        """
        groups = [words[at : at + GROUP_WORDS] for at in range(0, len(words), GROUP_WORDS)]
        found = [e.ids for e in self.bpe.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)]
        counts, flat = [], []
        for group, ids in zip(groups, found, strict=True):
            ids = np.array(ids, dtype=np.int32)
            ends = self._ends(group, ids)
            if ends is None:
                alone = [e.ids for e in self.bpe.encode_batch_fast(group, add_special_tokens=False)]
                ids = np.array([i for w in alone for i in w], dtype=np.int32)
                ends = np.cumsum([len(w) for w in alone])
            counts.append(np.diff(ends, prepend=0))
            flat.append(ids)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([[], *counts]))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, dtype=np.int32), *flat])))

    def _ends(self, group: list[str], ids: np.ndarray) -> np.ndarray | None:
        """Number of ids up to the end of each word, or nothing if pieces and words differ in bytes."""
        text = " ".join(group)
        # White space beyond ASCII inside a word would be taken for its end.
        if self.bpe.normalizer is None or text.split() != group:
            return None
        normal = self.bpe.normalizer.normalize_str(text).split(" ")
        if len(normal) != len(group) or "" in normal:
            return None
        ends = np.cumsum([len(w.encode()) for w in normal])
        covered = np.cumsum(self.widths[ids])
        at = np.searchsorted(covered, ends)
        if not len(covered) or covered[-1] != ends[-1] or (covered[at] != ends).any():
            return None
        return at + 1


@lru_cache(maxsize=1)
def word_encoder(tokenizer: str) -> WordEncoder:
    """One encoder per worker: reading the tokenizer takes most of a second."""
    return WordEncoder(tokenizer)


def encode_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """``ids`` of each distinct word, encoded once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            ids = encoder.encode(batch["word"].to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, "ids"])

    return words.mapInArrow(encode, T.StructType([*words.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def frequent_words(
    docs: DataFrame, tokenizer: str, text_column: str, table_words: int, table_bytes: int
) -> tuple[pa.Array, pa.Array]:
    """The most frequent words, within both bounds, and the ids of each; the empty word has none."""
    counted = stage_table(count_words(docs, text_column).filter(F.octet_length("word") <= MOST_BYTES), "bpe-counts")
    # Levels of frequency, 64 to a doubling, so that no task has to sort the words.
    level = F.floor(F.log2("n") * 64)
    # Per byte of a word one id and its own byte, with room to spare.
    width = F.octet_length("word") * 13 + 64
    levels = counted.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.sum(width).alias("bytes")).collect()
    words = size = 0
    lowest = None
    for r in sorted(levels, key=lambda r: -r.level):
        words, size = words + r.words, size + r.bytes
        if words > table_words or size > table_bytes:
            break
        lowest = r.level
    top = counted.filter(F.lit(False) if lowest is None else level >= lowest)
    table = encode_words(top.select("word"), tokenizer).toArrow()
    words = pa.concat_arrays([pa.array([""]), *(c.cast(pa.string()) for c in table["word"].chunks)])
    ids = pa.concat_arrays([pa.array([[]], pa.list_(pa.int32())), *(c.cast(pa.list_(pa.int32())) for c in table["ids"].chunks)])
    return words, ids


def encode_texts(
    docs: DataFrame,
    tokenizer_path: str,
    text_column: str = "text",
    table_words: int = TABLE_WORDS,
    table_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``row`` (a struct of all input columns), ``ids`` of the whole text, and ``decoded``.

    Words are counted over all texts in Spark. The table of distinct words is encoded once;
    then each text takes its words' ids by position, and the pieces of these ids from the
    vocabulary. The table at every worker has a bound (``table_words``, ``table_bytes``): it
    holds the most frequent words. A word beyond it is encoded where it stands, once per slice
    of texts, with the same result: shuffling each rare word to a table and its ids back to its
    text would move more than the texts themselves.

    Null and empty texts, and texts of white space, have no ids and decode to an empty text.
    Strings of special tokens inside a text become these tokens, as in the tokenizer itself.
    Repeated rows are encoded alike, long texts whole; extra columns pass through in ``row``;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    tokenizer = tokenizer_json(tokenizer_path)
    table = spark.sparkContext.broadcast(frequent_words(docs, tokenizer, text_column, table_words, table_bytes))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_column}`").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        words, word_ids = table.value
        for part in text_slices(batches, most_bytes=SLICE_BYTES):
            split = split_words(part.column("text"))
            coded = split.flatten().dictionary_encode()
            known = pc.index_in(coded.dictionary, words)
            rare = encoder.encode(coded.dictionary.filter(known.is_null()).to_pylist())
            # Of each distinct word of the slice: its place in the table, or after it among the rare ones.
            place = np.array(known.fill_null(-1), dtype=np.int64)
            place[place < 0] = len(words) + np.arange(len(rare))
            of_word = pa.concat_arrays([word_ids, rare]).take(pa.array(place))
            ids = of_word.take(coded.indices)
            # Ids up to the first word of each text, and past the last word of the last.
            offsets = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())])[split.offsets.to_numpy() - split.offsets[0].as_py()]
            offsets = pa.array(offsets.astype(np.int32))
            flat = ids.flatten()
            pieces = pa.ListArray.from_arrays(offsets, encoder.pieces.take(flat))
            yield pa.RecordBatch.from_pydict(
                {"row": part.column("row"), "ids": pa.ListArray.from_arrays(offsets, flat), "decoded": pc.binary_join(pieces, " ")}
            )

    fields = [rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return rows.mapInArrow(encode, T.StructType(fields))
