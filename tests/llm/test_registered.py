"""Registered corpus queries against SQL, brute force and labels; the pipeline stage by stage."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from compare import duck_rows, spark_rows
from corpus import TEXTS
from test_near_dedup import LOWER, expected as near_expected
from test_suffix_dedup import brute as repeats_expected

import corpus_pipeline
from tallyloom.llm.oracles import ORACLES
from tallyloom.llm.queries import QUERIES, tokenizer_path
from tallyloom.session import stage_table

TABLES = ("documents", "embeddings", "pages", "labels")


@pytest.fixture(scope="module")
def con():
    found = duckdb.connect()
    for table in TABLES:
        found.execute(f"create view {table} as select * from '/root/testdata/sf0.001/{table}.parquet'")
    return found


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_against_sql(spark, con, sf, name):
    columns, rows = spark_rows(QUERIES[name](spark, sf))
    wanted_columns, wanted = duck_rows(con, ORACLES[name])
    assert columns == wanted_columns
    assert rows == wanted


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_one_row_per_document(spark, sf, name):
    ids = Counter(r.doc_id for r in QUERIES[name](spark, sf).select("doc_id").collect())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()
    assert ids == Counter(r.doc_id for r in docs)


@pytest.fixture(scope="module")
def documents(spark):
    from compare import SF as sf

    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def digest(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rows_of(spark, sf, name):
    return sorted((tuple(r) for r in QUERIES[name](spark, sf).collect()), key=repr)


def encoded(texts):
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(tokenizer_path())
    bpe.no_truncation()
    bpe.no_padding()
    return [bpe.encode(t or "", add_special_tokens=False).ids for t in texts], bpe


def test_near_dedup_rows(spark, sf, documents):
    assert rows_of(spark, sf, "op2_near_dedup") == near_expected(documents)


def test_bpe_rows(spark, sf, documents):
    ids, bpe = encoded([t for _, t in documents])
    want = [
        (d, len(i), digest(" ".join(map(str, i))), digest(bpe.decode(i, skip_special_tokens=False)))
        for (d, _), i in zip(documents, ids, strict=True)
    ]
    assert rows_of(spark, sf, "op5_bpe") == sorted(want, key=repr)


def test_lm_base_rows(spark, sf, documents):
    words = {d: (t or "").translate(LOWER).encode().split() + [None] for d, t in documents}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in words}
    seen = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    total = sum(seen.values())
    for doc_id, held_out, n_tokens, n_known, train_tokens, base, score in rows_of(spark, sf, "op6_lm_scoring"):
        ws = words[doc_id]
        assert (held_out, n_tokens, n_known, train_tokens) == (held[doc_id], len(ws), sum(w in seen for w in ws), total)
        assert base == pytest.approx(sum(math.log10((seen[w] + 1) / (total + len(seen) + 1)) for w in ws))
        assert score < 0


@pytest.mark.parametrize(("name", "label", "limit"), [("op7_quality", "quality", 0.3), ("op9_toxicity", "toxic", None)])
def test_classifier_rows(spark, sf, name, label, limit):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r.asDict() for r in QUERIES[name](spark, sf).collect()]
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        if limit is not None:
            assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= limit)
    known = [(r["score"], labels[r["doc_id"]]) for r in found if r["held_out"] and labels.get(r["doc_id"]) is not None]
    good, bad = ([s for s, x in known if x == k] for k in (1, 0))
    ahead = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert ahead >= 0.9 * len(good) * len(bad)


def test_suffix_dedup_rows(spark, sf, documents):
    texts = [(t or "").encode() for _, t in documents]
    want = []
    for (d, _), t, (spans, kept) in zip(documents, texts, repeats_expected(texts, 400), strict=True):
        want.append((d, len(t), sum(b - a for a, b in spans), len(spans), digest(kept)))
    assert rows_of(spark, sf, "op8_suffix_dedup") == sorted(want, key=repr)


def test_mix_rows(spark, sf, documents):
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect()}
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in documents}
    of_source = Counter()
    for d, n in sizes.items():
        of_source[sources[d]] += n
    names = sorted(of_source, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, open_names = {}, float(sum(sizes.values())), set(names)
    while open_names:
        share = left / sum(weight[s] for s in open_names)
        full = {s for s in open_names if share * weight[s] > 3 * of_source[s]}
        if not full:
            target.update({s: share * weight[s] for s in open_names})
            break
        target.update({s: 3.0 * of_source[s] for s in full})
        left -= sum(target[s] for s in full)
        open_names -= full
    found = rows_of(spark, sf, "op3_mix_sources")
    assert found == rows_of(spark, sf, "op3_mix_sources")
    taken, per_shard = Counter(), Counter()
    for doc_id, size, source_size, wanted, words, shards in found:
        source, copies = sources[doc_id], [int(k) for k in shards.split(",") if k]
        assert words == size * len(copies) and all(0 <= k < 64 for k in copies)
        per_shard.update(copies)
        assert (size, source_size) == (sizes[doc_id], of_source[source])
        assert wanted == pytest.approx(target[source])
        assert 0 <= words <= 3 * size
        taken[source] += words
    largest = max(sizes.values())
    assert all(abs(taken[s] - target[s]) <= max(0.05 * target[s], largest) for s in names)
    assert sum(per_shard.values()) == sum(len(r[5].split(",")) for r in found if r[5])


def test_quality_stage_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.1"  # the smaller tables have too few labels to learn from
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["quality"](spark, docs, sf).select("doc_id").collect()}
    clean, junk = ([d for d, q in labels.items() if q == k] for k in (1, 0))
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)
    assert sum(d in kept for d in junk) <= 0.1 * len(junk)


def test_stages_against_brute_force(spark, sf):
    """Each stage on its own input: equal texts, near copies, the mix's bounds, the tokenizer."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    after = stage_table(stages["quality"](spark, docs, sf), "after-quality")

    before = [(r.doc_id, r.text) for r in after.collect()]
    after = stage_table(stages["exact_dedup"](spark, after, sf), "after-exact")
    largest = {}
    for d, t in before:
        key = (t or "").translate(LOWER)
        largest[key] = max(d, largest.get(key, d))
    assert sorted(r.doc_id for r in after.collect()) == sorted(largest.values())

    before = [(r.doc_id, r.text) for r in after.collect()]
    after = stage_table(stages["near_dedup"](spark, after, sf), "after-near")
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, _, stays in near_expected(before) if stays)

    before = Counter(r.doc_id for r in after.collect())
    mixed = stage_table(stages["mix"](spark, after, sf), "after-mix")
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(before) and max(times.values()) <= 3

    out = stages["encode"](spark, mixed, sf).collect()
    ids, bpe = encoded([r.text for r in out])
    assert [r.ids for r in out] == ids
    assert [r.decoded for r in out] == [bpe.decode(i, skip_special_tokens=False) for i in ids]


def test_stages_on_edge_cases(spark, edge_docs, no_docs, sf):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge_docs, sf)
        assert 0 < out.count() <= 3 * len(TEXTS), name
        if name != "encode":
            assert out.columns == edge_docs.columns, name
        assert stage(spark, no_docs, sf).count() == 0, name


def test_pipeline_keeps_what_its_stages_keep(spark, sf):
    out = corpus_pipeline.run(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    times = Counter(r.doc_id for r in out)
    assert max(times.values()) <= 3
    texts = {r.doc_id: r.text for r in out}
    assert all(docs[i].text == t for i, t in texts.items())
    lowered = Counter(t.lower() for t in texts.values())
    assert max(lowered.values()) == 1
    assert all(r.n_tokens == len(r.ids) for r in out)
