"""Members of JSON documents, whatever the splits, against the json module."""

import json
import random

import pytest

from tallyloom.sources.json_split import json_members
from tallyloom.sources.store import read_document

TEXTS = ["", "a", 'q"uote', "back\\", '\\"', "[,]", "{},", "ü,\n", "sources", '"sources": [']


def random_value(rng, depth=0):
    kind = rng.randint(0, 5 if depth < 3 else 3)
    if kind == 4:
        return [random_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    if kind == 5:
        return {rng.choice(TEXTS) + str(i): random_value(rng, depth + 1) for i in range(rng.randint(0, 3))}
    return [None, rng.random() < 0.5, rng.randint(-9, 9), rng.choice(TEXTS)][kind]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_members_are_those_of_the_parser(spark, small_splits, tmp_path, limit):
    rng, wanted = random.Random(7), {}
    for i in range(5):
        member = [{"id": k, "v": random_value(rng), "t": rng.choice(TEXTS)} for k in range(rng.randint(0, 8))]
        doc = {"a": random_value(rng), "b": [random_value(rng)], "sources": member, "c": random_value(rng)}
        names = list(doc)
        rng.shuffle(names)
        indent = rng.choice([None, 2])
        (tmp_path / f"d{i}.json").write_text(json.dumps({n: doc[n] for n in names}, indent=indent, ensure_ascii=False))
        wanted[f"d{i}.json"] = member
    found = {name: [] for name in wanted}
    for r in json_members(spark, str(tmp_path), "sources", limit).orderBy("path", "split", "no").collect():
        found[r.path.rsplit("/", 1)[1]].append(json.loads(r.value))
    assert found == wanted


def test_list_documents_objects_and_broken_ones(spark, small_splits, tmp_path):
    (tmp_path / "list.json").write_text(json.dumps([{"x": i, "y": ["a,b"] * i} for i in range(9)]))
    rows = json_members(spark, str(tmp_path / "list.json"), None).orderBy("split", "no").collect()
    assert [json.loads(r.value) for r in rows] == [{"x": i, "y": ["a,b"] * i} for i in range(9)]
    files = {f"k,{i}": {"n": i} for i in range(9)}
    (tmp_path / "map.json").write_text(json.dumps({"version": 1, "files": files}))
    rows = json_members(spark, str(tmp_path / "map.json"), "files").collect()
    assert json.loads("{" + ",".join(r.value for r in rows) + "}") == files
    (tmp_path / "cut.json").write_text('{"sources": [{"x": 1}, {"x": 2')
    assert json_members(spark, str(tmp_path / "cut.json"), "sources").count() == 0
    (tmp_path / "other.json").write_text('{"files": []}')
    assert read_document(spark, str(tmp_path / "other.json"), "x bigint").count() == 0


def test_a_large_document_is_read_in_many_tasks(spark, small_splits, tmp_path):
    (tmp_path / "doc.json").write_text(json.dumps({"sources": [{"x": i, "t": "z" * 40} for i in range(60)]}))
    rows = json_members(spark, str(tmp_path / "doc.json"), "sources").collect()
    assert len({r.split for r in rows}) > 10
    assert sorted(r.x for r in read_document(spark, str(tmp_path / "doc.json"), "x bigint").collect()) == list(range(60))
