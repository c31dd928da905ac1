"""Toxicity: cumulative-link ordinal regression over sparse text features."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.llm.common import bounded_batches, text_batches
from tallyloom.llm.features import FEATURE_BITS, WordHashes, core_digest, slots, stem_digest
from tallyloom.llm.quality import Ftrl, labelled_sample, sigmoid, sparse_sample

# Labelled rows the model is fitted on: those with the smallest hashes.
TRAIN_ROWS = 12_000
EPOCHS = 6
ALPHA, L1, L2 = 0.5, 2.0, 0.1
CUT_STEP = 0.2
# Grades 0 (clean) to 3; a document counts as toxic from grade 1 on with this probability.
TOP_GRADE = 3
THRESHOLD = 0.4
# A marker occurs in this many toxic training texts at least, and this much more often there.
MARKER_TEXTS, MARKER_ODDS = 8, 8.0

# Stem lengths in characters: endings vary, what they are added to tells.
STEMS = (5, 7)

_hashes: list[WordHashes] = []


def toxic_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words of a text and of their stems, with log(1 + count) as weight."""
    if not _hashes:
        _hashes.extend([WordHashes(core_digest), *(WordHashes(stem_digest(n)) for n in STEMS)])
    tokens = text.encode().split() if text else []
    index, counts = np.unique(slots(np.concatenate([h.array(tokens) for h in _hashes])), return_counts=True)
    return index, np.log1p(counts).astype(np.float32)


def severity_grades(labels: np.ndarray, slots_of: list[np.ndarray], weights_of: list[np.ndarray]) -> np.ndarray:
    """Grades from yes-or-no labels: 0 for clean texts; toxic ones by how much of a marker they hold.

    Markers are features far more frequent among toxic training texts than among clean ones.
    The tertiles of their summed weights over the toxic training texts separate grades 1 to 3.
    """
    size = 1 << FEATURE_BITS
    seen = np.zeros((2, size))
    for y, at in zip(labels, slots_of, strict=True):
        seen[int(y > 0), at] += 1
    clean, toxic = max(1, int((labels == 0).sum())), max(1, int((labels > 0).sum()))
    odds = ((seen[1] + 0.5) / toxic) / ((seen[0] + 0.5) / clean)
    marker = (seen[1] >= MARKER_TEXTS) & (odds >= MARKER_ODDS)
    amounts = np.array([float(v[marker[at]].sum()) for at, v in zip(slots_of, weights_of, strict=True)])
    grades = np.zeros(len(labels), dtype=np.int32)
    bad = labels > 0
    if bad.any():
        edges = np.quantile(amounts[bad], np.arange(1, TOP_GRADE) / TOP_GRADE)
        grades[bad] = 1 + np.searchsorted(edges, amounts[bad], side="left")
    return grades


class CumulativeLink:
    """P(grade > k) = sigmoid(w.x - threshold_k): one weight vector, rising thresholds.

    Thresholds are a first one and positive gaps, kept positive as exponentials, so their
    order cannot break. Weights follow the regularised leader, so that rare words keep none.
    """

    def __init__(self, grades: int, size: int = 1 << FEATURE_BITS):
        self.shared = Ftrl(size, ALPHA, 1.0, L1, L2)
        self.cuts = np.concatenate([[2.0], np.zeros(grades - 1)])
        self.cuts_seen = np.full(grades, 1e-8)

    def thresholds(self) -> np.ndarray:
        return self.cuts[0] + np.concatenate([[0.0], np.cumsum(np.exp(self.cuts[1:]))])

    def above(self, margins: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... for each margin."""
        return sigmoid(np.asarray(margins)[:, None] - self.thresholds()[None, :])

    def update(self, at: np.ndarray, x: np.ndarray, grade: int) -> None:
        w = self.shared.weights(at)
        theta, margin = self.thresholds(), float(w @ x)
        over = sigmoid(margin - theta)  # over[k] = P(grade > k)
        high = 1.0 if grade == 0 else over[grade - 1]
        low = 0.0 if grade == len(theta) else over[grade]
        share = max(high - low, 1e-9)
        high_slope = 0.0 if grade == 0 else high * (1.0 - high)
        low_slope = 0.0 if grade == len(theta) else low * (1.0 - low)
        by_margin = -(high_slope - low_slope) / share
        by_theta = np.zeros(len(theta))
        if grade > 0:
            by_theta[grade - 1] += high_slope / share
        if grade < len(theta):
            by_theta[grade] -= low_slope / share
        self.shared.follow(at, w, by_margin * x)
        by_cut = np.cumsum(by_theta[::-1])[::-1]
        by_cut[1:] *= np.exp(self.cuts[1:])
        self.cuts_seen += by_cut**2
        self.cuts -= CUT_STEP * by_cut / np.sqrt(self.cuts_seen)


def learn_severity(
    labels: np.ndarray, slots_of: list[np.ndarray], weights_of: list[np.ndarray], epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from labels and sparse features."""
    grades = severity_grades(labels, slots_of, weights_of)
    model = CumulativeLink(TOP_GRADE)
    for _ in range(epochs):
        for y, at, x in zip(grades.tolist(), slots_of, weights_of, strict=True):
            model.update(at, x, y)
    return model.shared.weights().astype(np.float32), model.thresholds()


def train_severity(sample: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features are made in parallel; the bounded sample is learnt in one task."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, index, weights = [], [], []
        for batch in batches:
            labels += batch["label"].to_pylist()
            index += [np.asarray(i.values, dtype=np.int32) for i in batch["slots"]]
            weights += [np.asarray(v.values, dtype=np.float32) for v in batch["weights"]]
        w, theta = learn_severity(np.asarray(labels), index, weights)
        yield pa.RecordBatch.from_pydict({"weights": [w.tobytes()], "thresholds": [theta.tolist()]})

    sparse = sparse_sample(sample, toxic_features, rows).coalesce(1)
    learnt = sparse.mapInArrow(learn, "weights binary, thresholds array<double>").first()
    return np.frombuffer(learnt["weights"], dtype=np.float32), np.asarray(learnt["thresholds"])


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    trainable: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``row`` (a struct of all input columns), ``score`` = P(grade >= 1) and ``severity``, the expected grade.

    ``trainable`` is a condition on ``doc_id``; only texts are inputs of a score. Null and
    empty texts have no features and get the thresholds' own probabilities. Without any
    label the thresholds keep their start and all scores are alike. Repeated rows score
    alike, very long texts count whole, extra columns pass through inside ``row``, and an
    empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sample = labelled_sample(docs, labels, "toxic", trainable, rows, id_column, text_column)
    weights, thresholds = train_severity(sample, rows)
    model = spark.sparkContext.broadcast((weights, thresholds))  # fixed size: one float per feature slot
    table = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_column}`").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, theta = model.value
        for batch, texts in text_batches(batches):
            found = [toxic_features(t) for t in texts]
            margins = np.array([w[i] @ x for i, x in found], dtype=np.float64)
            above = sigmoid(margins[:, None] - theta[None, :])
            yield pa.RecordBatch.from_pydict(
                {"row": batch.column("row"), "score": pa.array(above[:, 0]), "severity": pa.array(above.sum(axis=1))}
            )

    return table.mapInArrow(
        score,
        T.StructType(
            [table.schema["row"], T.StructField("score", T.DoubleType()), T.StructField("severity", T.DoubleType())]
        ),
    )
