"""Targets, exact quotas and repeats of a mix."""

import math
from collections import defaultdict

import numpy as np
import pytest
from corpus import TEXTS
from pyspark.sql import functions as F

from tallyloom.llm.mixing import (
    fair_targets,
    hypergeometric,
    mix_sources,
    mixed_rows,
    shard_bounds,
    split_quotas,
    word_count,
)
from tallyloom.session import stage_table


def test_targets_sum_and_stop_at_three_sizes():
    targets = fair_targets([10, 100, 1000, 0], [3.0, 1.0, 2.0, 5.0])
    assert sum(targets) == pytest.approx(1110)
    assert targets[0] == 30 and targets[1] == 300 and targets[2] == pytest.approx(780) and targets[3] == 0


def test_targets_without_limit_follow_weights():
    assert fair_targets([100, 100], [1.0, 2.0]) == pytest.approx([200 / 3, 400 / 3])


def test_shard_bounds_are_exact_and_disjoint():
    bounds = shard_bounds([10, 0, 333], 16, 5)
    assert bounds[:, 0].tolist() == [0, 0, 0] and bounds[:, -1].tolist() == [10, 0, 333]
    assert (np.diff(bounds, axis=1) >= 0).all()
    per_shard = np.diff(bounds, axis=1).sum(axis=0)
    assert per_shard.max() - per_shard.min() <= 4
    assert (shard_bounds([10, 0, 333], 16, 5) == bounds).all()


def test_large_counts_split_exactly():
    bounds = shard_bounds([4 * 10**9, 10**9 + 7], 8, 1)
    assert bounds[:, -1].tolist() == [4 * 10**9, 10**9 + 7]


def test_draws_beyond_the_generators_range_have_its_distribution():
    rng = np.random.default_rng(3)
    found = np.bincount([hypergeometric(rng, 5, 7, 4) for _ in range(20_000)], minlength=5) / 20_000
    wanted = [math.comb(5, k) * math.comb(7, 4 - k) / math.comb(12, 4) for k in range(5)]
    assert found == pytest.approx(wanted, abs=0.015)
    assert [hypergeometric(rng, 3, 0, 2), hypergeometric(rng, 0, 3, 2), hypergeometric(rng, 4, 4, 8)] == [2, 0, 4]
    large = np.array([hypergeometric(rng, 3 * 10**9, 10**9, 2 * 10**9) for _ in range(300)], dtype=float)
    deviation = (2e9 * 0.75 * 0.25 * 0.5) ** 0.5
    assert abs(large.mean() - 1.5e9) < 0.3 * deviation
    assert 0.8 * deviation < large.std() < 1.2 * deviation  # a proportional split has none


def test_shards_larger_than_a_task_are_written_in_pieces(spark):
    docs = spark.range(400).selectExpr("id as doc_id", "repeat('some words ', 20) as text", "'s' as source")
    mixed = stage_table(mix_sources(docs, shards=2, block_docs=8, piece_bytes=4000), "pieces")
    assert mixed.first().pieces == -(-400 * 220 // 8000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = mixed_rows(mixed).withColumn("task", F.spark_partition_id())
        spans = tasks.groupBy("mix_shard", "task").agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.task for r in spans}) > 2 and sum(r.n for r in spans) == 400


def test_edge_cases(edge_docs):
    out = mix_sources(edge_docs, block_docs=2, shards=4).collect()
    assert len(out) == len(TEXTS)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        words = len((r.row.text or "").encode().split())
        assert r.size == words and r.taken == r.copies * r.size and r.copies <= 3
        assert len(r.shards) == len(r.orders) == r.copies
        sizes[r.row.source] += words
        taken[r.row.source] += r.taken
        target[r.row.source] = r.target
    assert all(r.source_size == sizes[r.row.source] for r in out)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    again = mix_sources(edge_docs.repartition(5), block_docs=2, shards=4).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_empty(no_docs):
    assert mix_sources(no_docs).collect() == []


def test_taken_words_are_near_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mix_sources(docs, shards=8).cache()
    sums = defaultdict(lambda: [0, 0.0])
    for r in mixed.collect():
        assert r.taken <= 3 * r.size
        sums[r.row.source][0] += r.taken
        sums[r.row.source][1] = r.target
    for taken, target in sums.values():
        assert abs(taken - target) <= max(60, 0.02 * target)
    rows = mixed_rows(mixed).collect()
    assert sum(len(r.row.text.encode().split()) for r in rows) == sum(t for t, _ in sums.values())
    mixed.unpersist()


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr("tallyloom.llm.mixing.MOST_SOURCES", 2)
    docs = spark.createDataFrame([(i, "a b", f"s{i}") for i in range(3)], "doc_id bigint, text string, source string")
    with pytest.raises(ValueError, match="sources"):
        mix_sources(docs)


def test_any_number_of_sources(spark, monkeypatch):
    n = 10_050  # the mix used to refuse more than 10 000
    rows = [(i, "a " * (1 + i % 7), f"s{i:05}" if i < n else "s00000") for i in range(n + 300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    monkeypatch.setattr("tallyloom.llm.mixing.GROUP_SOURCES", 4000)
    out = mix_sources(docs, block_docs=4, shards=4, broadcast_bytes=-1, hot_rows=50).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    names = sorted(sizes)
    wanted = dict(zip(names, fair_targets([sizes[s] for s in names], [(1.0, 2.0, 3.0)[i % 3] for i in range(n)]), strict=True))
    assert sorted(r.row.doc_id for r in out) == list(range(n + 300))
    for r in out:
        assert r.target == pytest.approx(wanted[r.row.source]) and r.source_size == sizes[r.row.source]
        assert len(r.shards) == len(r.orders) == r.copies <= 3 and all(0 <= k < 4 for k in r.shards)


def test_quotas_of_many_groups_are_exact(spark, monkeypatch):
    monkeypatch.setattr("tallyloom.llm.mixing.GROUP_SOURCES", 10)
    quotas = [(7 * i) % 23 for i in range(95)]
    planned = spark.createDataFrame(list(enumerate(quotas)), "rank bigint, quota bigint")
    found = {r["rank"]: r["bounds"] for r in split_quotas(planned, 16, 5).collect()}
    assert [found[i][-1] for i in range(95)] == quotas
    counts = np.diff([[0, *found[i]] for i in range(95)], axis=1)
    assert (counts >= 0).all() and np.ptp(counts.sum(axis=0)) <= 4


def test_word_count_takes_ascii_white_space_only(spark):
    row = spark.createDataFrame([("a\u00a0b c\td\x0be",)], "text string").select(word_count("text").alias("n")).first()
    assert row.n == 4
