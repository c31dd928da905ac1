"""Language-model scores against the formulas on plain dictionaries."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus import TEXTS

from tallyloom.llm import lm
from tallyloom.llm.lm import discounts, mix, packed, score_texts, train_model, unmix, unpacked


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def brute(train, texts):
    """Interpolated modified Kneser-Ney over pairs, and add-one single words."""
    words, pairs = Counter(), Counter()
    for t in train:
        words.update(tokens(t))
        pairs.update(zip([None, *tokens(t)], tokens(t)))
    n, v = sum(words.values()), len(words)

    def cuts(counts):
        c = Counter(counts)
        return discounts({"ones": c[1], "twos": c[2], "threes": c[3], "fours": c[4]})

    d, total, follow, lefts = cuts(pairs.values()), Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (a, b), c in pairs.items():
        total[a] += c
        follow[a][min(c, 3) - 1] += 1
        lefts[b] += 1
    e, kinds = cuts(lefts.values()), Counter(min(c, 3) for c in lefts.values())
    spare = sum(e[i] * kinds[i + 1] for i in range(3)) / len(pairs) if pairs else 1.0

    def single(w):
        c = lefts[w]
        return ((c - e[min(c, 3) - 1]) / len(pairs) if c else 0.0) + spare / (v + 1)

    def pair(a, w):
        if a not in total:
            return single(w)
        c = pairs[a, w]
        kept = (c - d[min(c, 3) - 1]) / total[a] if c else 0.0
        return kept + sum(d[i] * follow[a][i] for i in range(3)) / total[a] * single(w)

    out = []
    for t in texts:
        w = tokens(t)
        score = sum(math.log10(pair(a, x)) for a, x in zip([None, *w], w))
        base = sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w)
        out.append((len(w), sum(words[x] > 0 for x in w), base, score))
    return out, n


def check(docs, train, rows):
    model = train_model(train)
    out = score_texts(docs, model).collect()
    want, n = brute([t for _, t in rows(train)], [r.row.text for r in out])
    assert model.n_tokens == n
    for r, (count, known, base, score) in zip(out, want, strict=True):
        assert (r.n_tokens, r.n_known) == (count, known)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(score, rel=1e-6, abs=1e-6)


def pairs_of(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_edge_cases(edge_docs):
    check(edge_docs, edge_docs.filter("doc_id is null or doc_id % 3 <> 0"), pairs_of)


def test_table_in_many_shards(spark, sf, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(lm, "GATHERED", 5_000)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(80)
    check(docs, docs.filter("doc_id % 7 <> 2"), pairs_of)


def test_empty_and_untrained(edge_docs, no_docs):
    assert score_texts(no_docs, train_model(edge_docs)).collect() == []
    out = score_texts(edge_docs, train_model(no_docs)).collect()
    assert len(out) == len(TEXTS) and all(r.score == 0 and r.n_known == 0 for r in out)


def test_mixing_and_packing_are_lossless():
    rng = np.random.default_rng(2)
    keys = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (unmix(mix(keys)) == keys).all()
    assert (unpacked(packed(keys), np.uint64) == keys).all()
    assert len(unpacked(packed(keys[:0]), np.uint64)) == 0


def test_unmounted_folder_is_refused(spark, monkeypatch):
    monkeypatch.setattr(lm, "shared_dir", lambda spark: "hdfs://host/shared")
    with pytest.raises(ValueError, match="mounted"):
        lm.local_folder(spark)
