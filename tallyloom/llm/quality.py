"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.llm.common import bounded_batches, stage_table, text_batches
from tallyloom.llm.features import FEATURE_BITS, WordHashes, core_digest, pair, shape_digest, slots, sparse_rows

# Labelled rows the model is fitted on: those with the smallest hashes.
TRAIN_ROWS = 12_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.2, 0.1
THRESHOLD = 0.3

# A bigram of one word said twice, whatever the word.
_AGAIN = np.uint64(0x5851F42D4C957F2D)

_words: WordHashes | None = None
_shapes: WordHashes | None = None


def quality_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and weights of word and word-shape n-grams (one and two words), of length one.

    The last slot is the bias, so a text without words has that alone.
    """
    global _words, _shapes
    if _words is None:
        _words, _shapes = WordHashes(core_digest), WordHashes(shape_digest)
    tokens = text.encode().split() if text else []
    words, shapes = _words.array(tokens), _shapes.array(tokens)
    parts = [words, shapes]
    if len(tokens) > 1:
        again = words[1:][words[:-1] == words[1:]]
        parts += [pair(words[:-1], words[1:], 1), pair(shapes[:-1], shapes[1:], 2), np.full_like(again, _AGAIN)]
    index, counts = np.unique(slots(np.concatenate(parts)), return_counts=True)
    weights = np.log1p(counts).astype(np.float32)
    norm = np.sqrt((weights**2).sum())
    bias = 1 << FEATURE_BITS
    return np.append(index, bias).astype(np.int32), np.append(weights / norm if norm else weights, 1.0).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """Logistic regression under follow-the-regularised-leader (proximal) updates."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        self.follow(at, w, (float(sigmoid(w @ x)) - label) * x)

    def follow(self, at: np.ndarray, w: np.ndarray, gradient: np.ndarray) -> None:
        """Takes the gradient at the weights ``w`` of the slots ``at`` into account."""
        squared = gradient**2
        sigma = (np.sqrt(self.n[at] + squared) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] += squared


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, trainable: Column, rows: int, id_column: str, text_column: str
) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows`` labelled rows: a documented bound on fitting.

    Ids are drawn by the smallest hashes, so the draw is the same on every run; ids with
    several different labels are left out. The drawn ids are bounded, hence broadcast.
    """
    ids = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull())
        .withColumn("doc_id", F.col("id"))
        .filter(trainable)
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .orderBy(F.xxhash64("id"))
        .limit(rows)
        .select("id", "label")
    )
    ids = stage_table(ids, "drawn-labels")
    return (
        docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
        .join(F.broadcast(ids), F.col("doc_id") == F.col("id"))
        .select("doc_id", "text", "label")
    )


def sparse_sample(sample: DataFrame, featurize, rows: int) -> DataFrame:
    """Features of the sample, in hash order, at most ``rows`` of them even if ids repeat."""
    sparse = sample.mapInArrow(
        lambda batches: sparse_rows(text_batches(batches), featurize, ["doc_id", "label"]),
        "doc_id bigint, label int, slots array<int>, weights array<float>",
    )
    return sparse.orderBy(F.xxhash64("doc_id", "slots")).limit(rows)


def train_quality(sample: DataFrame, rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the model. Features are made in parallel; the bounded sample is learnt in one task."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for y, i, v in zip(batch["label"].to_pylist(), batch["slots"], batch["weights"], strict=True):
                examples.append((y, np.asarray(i.values, dtype=np.int32), np.asarray(v.values, dtype=np.float32)))
        model = Ftrl((1 << FEATURE_BITS) + 1)
        for _ in range(epochs):
            for y, at, x in examples:
                model.update(at, x, y)
        yield pa.RecordBatch.from_pydict({"weights": [model.weights().astype(np.float32).tobytes()]})

    learnt = sparse_sample(sample, quality_features, rows).coalesce(1).mapInArrow(learn, "weights binary").collect()
    empty = np.zeros((1 << FEATURE_BITS) + 1, dtype=np.float32)
    return np.frombuffer(learnt[0]["weights"], dtype=np.float32) if learnt else empty


def score_quality(docs: DataFrame, weights: np.ndarray, text_column: str = "text") -> DataFrame:
    """``row`` (a struct of all input columns) and ``score``, the probability of label 1."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(weights)  # fixed size: one float per feature slot
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_column}`").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch, texts in text_batches(batches):
            found = [quality_features(t) for t in texts]
            scores = sigmoid(np.array([w[i] @ x for i, x in found], dtype=np.float64))
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "score": pa.array(scores, pa.float64())})

    return rows.mapInArrow(score, T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())]))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    trainable: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Scores of all ``docs`` by a model fitted on a bounded sample of labelled ones.

    ``trainable`` is a condition on ``doc_id``. Only texts are inputs of a score. Null and
    empty texts have the bias alone and get the score it gives. Without any usable label all
    scores are 0.5. Repeated rows get equal scores; very long texts are featurized whole;
    extra columns pass through inside ``row``; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", trainable, rows, id_column, text_column)
    return score_quality(docs, train_quality(sample, rows), text_column)
