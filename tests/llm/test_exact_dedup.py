"""Exact groups against grouping by the whole text."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st
from corpus import TEXTS

from tallyloom.llm.exact_dedup import exact_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def check(rows, out):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    assert len(out) == len(rows)
    stay = defaultdict(int)
    for r in out:
        text = (r.row.text or "").translate(LOWER)
        ids = [i for i in groups[text] if i is not None]
        assert r.group_size == len(groups[text])
        assert r.keep_id == (max(ids) if ids else None)
        if r.kept:
            assert r.row.doc_id == r.keep_id
            stay[text] += 1
    assert all(stay[t] == 1 for t in groups)


def test_edge_cases(edge_docs):
    out = exact_groups(edge_docs, first_bytes=4, growth=2, most_bytes=16384)
    assert "row" in out.columns
    check(TEXTS, out.collect())


def test_without_broadcast(edge_docs):
    check(TEXTS, exact_groups(edge_docs, broadcast_bytes=-1).collect())


def test_empty(no_docs):
    assert exact_groups(no_docs).collect() == []


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("aAbé\n", max_size=9), min_size=1, max_size=12))
def test_any_texts(spark, texts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    check(rows, exact_groups(docs, first_bytes=2, growth=1, most_bytes=2).collect())
