"""Quality and severity models: held-out accuracy, order of thresholds, defined edge cases."""

import random

import numpy as np
import pytest
from corpus import TEXTS
from pyspark.sql import functions as F

from tallyloom.llm.quality import Ftrl, quality_features, quality_scores, sigmoid
from tallyloom.llm.toxicity import TOP_GRADE, CumulativeLink, severity_grades, toxic_features, toxicity_scores


@pytest.fixture(scope="module")
def written(spark):
    """Prose, shouted junk, and prose with insults, by fixed seeds."""
    rng = random.Random(11)
    plain = [f"{a}{b}" for a in ("wal", "ber", "tan", "sor") for b in ("ing", "ed", "en", "s", "ly")]
    rude = ["grobnik", "stinkard", "lousel"]
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 60))]
        quality, toxic = 1, 0
        if i % 4 == 0:
            words, quality = [w.upper() + "!!" for w in words], 0
        elif i % 5 == 0:
            toxic = 1
            for _ in range(rng.randrange(1, 6)):
                words[rng.randrange(len(words))] = rng.choice(rude)
        docs.append((i, " ".join(words)))
        labels.append((i, quality, toxic))
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_quality_of_held_out_texts(written):
    docs, labels = written
    scored = quality_scores(docs, labels, F.col("doc_id") % 5 != 0).select("row.doc_id", "score")
    held = scored.filter("doc_id % 5 = 0").join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in held]) >= 0.97


def test_severity_of_held_out_texts(written):
    docs, labels = written
    scored = toxicity_scores(docs, labels, F.col("doc_id") % 3 != 0).select("row.doc_id", "score", "severity")
    held = scored.filter("doc_id % 3 = 0").join(labels, "doc_id").collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in held]) >= 0.9
    toxic = np.mean([r.severity for r in held if r.toxic])
    assert toxic > 0.8 > 4 * np.mean([r.severity for r in held if not r.toxic])


@pytest.mark.parametrize("scores", [quality_scores, toxicity_scores])
def test_edge_cases(edge_docs, no_docs, written, scores):
    _, labels = written
    out = scores(edge_docs, labels, F.lit(True)).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 for r in out)
    empty = {r.score for r in out if not (r.row.text or "").strip()}
    assert len(empty) == 1
    assert scores(no_docs, labels, F.lit(True)).collect() == []
    untaught = scores(edge_docs, labels.limit(0), F.lit(True)).collect()
    assert len({r.score for r in untaught}) == 1


def test_conflicting_and_null_labels_are_left_out(written, spark):
    docs, labels = written
    bad = spark.createDataFrame([(1, 0, 1), (None, 1, 1), (2, None, None)], labels.schema)
    assert quality_scores(docs, labels.union(bad), F.lit(True)).count() == 400


def test_bounded_sample(written):
    docs, labels = written
    scores = [r.score for r in quality_scores(docs, labels, F.lit(True), rows=5).collect()]
    assert len(scores) == 400


def test_features_are_of_the_whole_text():
    long = "word " * 50_000
    assert set(quality_features(long + "ZZTOP!")[0]) > set(quality_features(long)[0])
    assert len(toxic_features(None)[0]) == 0 and len(quality_features(None)[0]) == 1


def test_ftrl_zeroes_weights_without_signal():
    rng = np.random.default_rng(3)
    model = Ftrl(3, l1=2.0)
    for _ in range(500):
        y = float(rng.integers(0, 2))
        model.update(np.array([0, 1]), np.array([1.0, y]), y)
    assert model.weights()[2] == 0 and model.weights()[1] > 0.5


def test_cumulative_link_gradient_is_that_of_the_likelihood():
    """The step in the margin equals the difference quotient of the loss."""

    def loss(margin, theta, grade):
        over = np.concatenate([[1.0], sigmoid(margin - theta), [0.0]])
        return -np.log(over[grade] - over[grade + 1])

    for grade in range(TOP_GRADE + 1):
        model = CumulativeLink(TOP_GRADE, size=1)
        theta = model.thresholds()
        steps = []
        model.shared.follow = lambda at, w, g, steps=steps: steps.append(float(g[0]))
        model.update(np.array([0]), np.array([1.0]), grade)
        slope = (loss(1e-6, theta, grade) - loss(-1e-6, theta, grade)) / 2e-6
        assert steps[0] == pytest.approx(slope, abs=1e-5)
        assert (np.diff(model.thresholds()) > 0).all()


def test_grades_follow_the_amount_of_markers():
    labels = np.array([0] * 40 + [1] * 30)
    at = [np.array([1])] * 40 + [np.array([1, 2])] * 30
    weights = [np.array([1.0], dtype=np.float32)] * 40 + [np.array([1.0, 1 + k % 3], dtype=np.float32) for k in range(30)]
    grades = severity_grades(labels, at, weights)
    assert set(grades[:40].tolist()) == {0}
    assert [int(g) for g in grades[40:43]] == [1, 2, 3]
