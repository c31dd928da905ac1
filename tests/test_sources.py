"""Reading grids, files and documents, and writing state."""

import csv
import hashlib
import io
import json
import random

import pyarrow as pa
import pytest
from books import grid, registry as book_registry, sheet
from pyspark.sql import functions as F

from tallyloom import schemas
from tallyloom.sources import files, grid as grids, registry, store as stores


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_grid_round_trip(spark, tmp_path, fmt):
    g = grid(spark, sheet("s", [("a", None, 1), ("=B", 2.5)]))
    g.write.format(fmt).save(str(tmp_path / "g"))
    back = grids.read_grid(spark, str(tmp_path / "g"), fmt)
    assert sorted(back.collect(), key=lambda r: r.row_num) == sorted(g.collect(), key=lambda r: r.row_num)


def test_csv_grid_keeps_order_across_splits(spark, tmp_path):
    folder = tmp_path / "ledger"
    folder.mkdir()
    lines = [f'{i},"a,{i}",=A{i},x' if i % 5 else "" for i in range(1, 2001)]
    (folder / "6MM.csv").write_text("\n".join(lines) + "\n")
    (folder / "9MM.csv").write_text("Date,Items\n2024-01-01,9mm\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        g = grids.read_csv_grid(spark, str(folder))
        rows = {(r.sheet, r.row_num): r for r in g.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 2002
    for i in range(1, 2001):
        cells = [tuple(c) for c in rows["6MM", i].cells]
        want = [("int", str(i)), ("str", f"a,{i}"), ("formula", f"=A{i}"), ("str", "x")]
        assert cells == (want if i % 5 else [])
    assert [c.dtype for c in rows["9MM", 2].cells] == ["datetime", "str"]
    assert {r.source_id for r in rows.values()} == {"ledger"}


def csv_rows(text):
    """Rows of a CSV text, with Python's reader as the judge of quotes."""
    rows = []
    for row in csv.reader(io.StringIO(text, newline=""), doublequote=True):
        while row and row[-1].strip() == "":
            row.pop()
        rows.append([x if x.strip() else None for x in row])
    return rows


def read_rows(spark, folder, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = grids.read_csv_grid(spark, str(folder), typed=False).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    out = {}
    for r in rows:
        out.setdefault(r.sheet, {})[r.row_num] = [c.sval for c in r.cells]
    assert all(sorted(found) == list(range(1, len(found) + 1)) for found in out.values())
    return {name: [found[i] for i in sorted(found)] for name, found in out.items()}


@pytest.mark.parametrize(("split", "limit"), [(40, grids.BROADCAST_BYTES), (300, 0), (1 << 20, grids.BROADCAST_BYTES)])
def test_csv_grid_keeps_quoted_line_breaks_whole(spark, tmp_path, monkeypatch, split, limit):
    monkeypatch.setattr(grids.placed_rows, "__defaults__", (",", limit))
    folder = tmp_path / "ledger"
    folder.mkdir()
    rng = random.Random(split)
    cells = ["plain", "5in \"pipe\"", 'a "b', "x,y", "two\nlines", "three\n\nlines\n", 'q"\n"q', ",\n,", "", "7", "\r\nmixed", '"\n']
    texts = {"breaks": [[rng.choice(cells) for _ in range(rng.randrange(1, 5))] for _ in range(60)], "long": [["a\n" * 60, "b"], ["c"]] * 3}
    texts["none"] = [["a", "b"]] * 20
    for name, rows in texts.items():
        with open(folder / f"{name}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\r\n" if name == "breaks" else "\n").writerows(rows)
    # Quotes inside fields that no quote opens are text.
    (folder / "stray.csv").write_text('5" pipe,"a ""b"""\nx"y"z,"l\n1",w"\n"q"r,s\n')
    got = read_rows(spark, folder, split)
    for name in texts:
        assert got[name] == csv_rows((folder / f"{name}.csv").read_bytes().decode()), name
    assert got["stray"][:2] == [['5" pipe', 'a "b"'], ['x"y"z', "l\n1", 'w"']]
    assert len(got["stray"]) == 3


def test_csv_grid_equals_another_reader(spark, tmp_path):
    import duckdb

    folder = tmp_path / "ledger"
    folder.mkdir()
    rows = [[str(i), f'He said "{i}",\nthen left' if i % 3 else f"cell {i}", "x" * (i % 50 + 1)] for i in range(3000)]
    with open(folder / "pages.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)
    read = f"select * from read_csv('{folder}/pages.csv', header=false, all_varchar=true, quote='\"', escape='\"', delim=',')"
    assert read_rows(spark, folder, 3000)["pages"] == [list(r) for r in duckdb.sql(read).fetchall()]


def test_unclosed_quote_takes_the_rest(spark, tmp_path):
    folder = tmp_path / "ledger"
    folder.mkdir()
    (folder / "open.csv").write_text('a,b\nc,"d\ne,f\n')
    (folder / "empty.csv").write_text("")
    got = read_rows(spark, folder, 4)
    assert set(got) == {"open"}
    assert got["open"][0] == ["a", "b"] and len(got["open"]) == 2


def test_retag_applies_type_rules(spark):
    g = spark.createDataFrame(
        [("b", "s", 0, 1, [("str", " =A1"), ("int", "1"), (None, None), ("time", "10:00:00")])],
        schemas.struct_type(schemas.GRID),
    )
    assert [c.dtype for c in grids.retag(g).first().cells] == ["formula", "int", "null", "time"]


def test_typed_table_cells(spark):
    df = spark.sql("select 1 as i, 1.5D as f, true as b, timestamp '2024-01-01' as t, date '2024-01-01' as d, '=x' as s, cast(null as int) as n")
    g = grids.grid_from_table(df, "src", "sh", F.lit(1))
    assert [c.dtype for c in g.first().cells] == ["int", "float", "bool", "datetime", "date", "formula", "null"]


def test_listing_hashes_files_of_any_size_and_name(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    contents = {"a.bin": b"x" * 10, "Stock management.xlsx": b"y" * 3_000_000, "100% #1.bin": b"z"}
    for name, data in contents.items():
        (tmp_path / "raw" / name).write_bytes(data)
    listing = files.list_files(spark, str(tmp_path / "raw"), str(tmp_path))
    got = {r.file_key: (r.hash, r.size_bytes) for r in listing.collect()}
    assert got == {
        f"raw/{n}": (hashlib.sha256(d).hexdigest(), len(d)) for n, d in contents.items()
    }


def test_file_that_cannot_be_hashed_keeps_its_row(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for name, size in (("GLUE RECORD-1.xlsx", 50), ("Stock management.xlsx", 2000)):
        (tmp_path / "raw" / name).write_bytes(b"x" * size)
    listing = files.list_files(spark, str(tmp_path / "raw"), str(tmp_path), most_bytes=1000)
    rows = {r.file_key: r for r in listing.collect()}
    assert rows["raw/Stock management.xlsx"].hash is None and "2000" in rows["raw/Stock management.xlsx"].error
    got = {r.source_id: r.status for r in files.source_status(book_registry(spark), listing, "raw").collect()}
    assert got == {"stock_management": "error", "glue_record": "ok", "tree_log_suppliers": "missing"}


def test_files_beyond_one_value_are_hashed(spark, tmp_path):
    size = 2**31 + 5
    (tmp_path / "raw").mkdir()
    with open(tmp_path / "raw" / "Stock management.xlsx", "wb") as f:
        f.truncate(size)  # sparse: takes no room
    (tmp_path / "raw" / "GLUE RECORD-1.xlsx").write_bytes(b"x")
    want, zeros = hashlib.sha256(), bytes(1 << 20)
    for _ in range(size >> 20):
        want.update(zeros)
    want.update(bytes(size & 0xFFFFF))
    listing = files.list_files(spark, str(tmp_path / "raw"), str(tmp_path))
    got = {r.source_id: (r.status, r.hash, r.size_bytes) for r in files.source_status(book_registry(spark), listing, "raw").collect()}
    assert got["stock_management"] == ("ok", want.hexdigest(), size)
    assert got["glue_record"][:2] == ("ok", hashlib.sha256(b"x").hexdigest())


def test_unreadable_file_stops_no_other(tmp_path):
    (tmp_path / "b.bin").write_bytes(b"b")
    paths = [f"file:{tmp_path}/a.bin", f"file:{tmp_path}/b.bin"]
    batch = pa.RecordBatch.from_pydict({"path": paths, "length": [1, 1]})
    a, b = next(files._hashes(iter([batch]), files.local_opener, None)).to_pylist()
    assert a["hash"] is None and "a.bin" in a["error"]
    assert (b["hash"], b["error"]) == (hashlib.sha256(b"b").hexdigest(), None)


def viewfs(spark, folder):
    """A mount of its own that Python cannot open."""
    name = f"m{abs(hash(str(folder)))}"
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{name}.link./raw", f"file://{folder}")
    return f"viewfs://{name}"


def test_listing_of_a_store_that_only_spark_opens(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    rng = random.Random(6)
    contents = {
        "Stock management.xlsx": rng.randbytes(300_000), "100% #1 {a}[b].bin": b"z", "no end.txt": b"a\n\nb" * 5000,
        "end.txt": b"a\r\n\xff\xfe\n" * 4000, "sub/breaks": b"\n" * 9999, "one line": b"x" * 20_000, "x.gz": rng.randbytes(5000),
    }
    for name, data in contents.items():
        (folder / name).parent.mkdir(exist_ok=True)
        (folder / name).write_bytes(data)
    want = {f"raw/{n}": (hashlib.sha256(d).hexdigest(), len(d), None) for n, d in contents.items()}
    store = viewfs(spark, folder)
    for limit in (files.VALUE_BYTES, 1000):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        try:
            listing = files.list_files(spark, f"{store}/raw", store, value_bytes=limit)
            assert {r.file_key: (r.hash, r.size_bytes, r.error) for r in listing.collect()} == want
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    few = files.list_files(spark, f"{store}/raw", store, most_bytes=20_000, value_bytes=1000).collect()
    assert {r.file_key for r in few if r.error} == {k for k, v in want.items() if v[1] > 20_000}
    assert all("at most 20000" in r.error for r in few if r.error)
    assert {r.file_key: r.hash for r in few if r.hash} == {k: v[0] for k, v in want.items() if v[1] <= 20_000}


def test_store_is_opened_once_per_task(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for i in range(300):
        (tmp_path / "raw" / f"f{i}").write_bytes(b"%d" % i)

    def opener():
        import os
        import uuid

        from pyarrow import fs

        (tmp_path / f"opened-{os.getpid()}-{uuid.uuid4().hex}").touch()
        local = fs.LocalFileSystem()
        return lambda path: local.open_input_stream(path.removeprefix("file:"))

    listing = files.list_files(spark, str(tmp_path / "raw"), str(tmp_path), opener=opener)
    tasks = listing.rdd.getNumPartitions()
    got = {r.file_key: (r.hash, r.error) for r in listing.collect()}
    assert got == {f"raw/f{i}": (hashlib.sha256(b"%d" % i).hexdigest(), None) for i in range(300)}
    assert tasks < 60
    assert len(list(tmp_path.glob("opened-*"))) <= tasks


def test_lost_file_of_a_store_that_only_spark_opens(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name in ("a.bin", "b.bin"):
        (folder / name).write_bytes(name.encode())
    store = viewfs(spark, folder)
    listing = files.list_files(spark, f"{store}/raw", store)  # lists now, reads later
    (folder / "a.bin").unlink()
    got = {r.file_key: (r.hash, r.error) for r in listing.collect()}
    assert got == {"raw/a.bin": (None, "File cannot be read"), "raw/b.bin": (hashlib.sha256(b"b.bin").hexdigest(), None)}


def test_file_key_outside_root(spark):
    df = spark.createDataFrame([("file:/data/raw/a.xlsx",), ("/elsewhere/b.xlsx",)], "p string")
    keys = [r[0] for r in df.select(files.file_key(F.col("p"), "/data")).collect()]
    assert keys == ["raw/a.xlsx", "/elsewhere/b.xlsx"]


def test_source_status(spark):
    reg = book_registry(spark)
    listing = spark.createDataFrame(
        [("raw/Stock management.xlsx", "h1", 2048), ("raw/GLUE RECORD-1.xlsx", "h2", 10)],
        schemas.struct_type(schemas.LISTING),
    )
    errors = spark.createDataFrame([("glue_record", "bad zip")], "source_id string, error string")
    got = {r.source_id: (r.status, r.error) for r in files.source_status(reg, listing, "raw", errors).collect()}
    assert got == {
        "stock_management": ("ok", None),
        "glue_record": ("error", "bad zip"),
        "tree_log_suppliers": ("missing", "File not found: raw/Tree log suppliers Book.xlsx"),
    }


def test_registry_document_keeps_order(spark, tmp_path):
    records = [
        {"filename": "b.grid", "source_id": "b", "seed_type": "glue_ledger", "base_uom": "bags"},
        {"filename": "a.grid", "source_id": "a", "seed_type": "glue_ledger"},
        {"filename": "c.grid", "source_id": "c", "seed_type": "mdf_ledger"},
    ]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=1))
    reg = registry.read_registry(spark, str(tmp_path / "r.json"))
    assert [(r.source_id, r.source_no) for r in reg.orderBy("source_no").collect()] == [("b", 0), ("a", 1), ("c", 2)]
    glue = registry.sources_of(reg, "glue_ledger").orderBy("source_no").collect()
    assert [(r.source_id, r.base_uom) for r in glue] == [("b", "bags"), ("a", "units")]


def test_snapshots_ignore_incomplete_versions(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path))
    ddl = "k string, v bigint"
    assert store.read("t", ddl).count() == 0
    store.ensure("t", ddl)
    store.write("t", spark.createDataFrame([("a", 1)], ddl))
    store.ensure("t", ddl)
    # The next version may be computed from the current one, and is then the current one.
    store.write("t", store.read("t", ddl).withColumn("v", F.col("v") + 1))
    (tmp_path / "t" / "v00000099").mkdir()
    assert [tuple(r) for r in store.read("t", ddl).collect()] == [("a", 2)]


def test_append_log_drops_bad_lines(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path))
    ddl = "script string, n bigint"
    assert store.read_log("log", ddl).count() == 0
    store.append("log", spark.createDataFrame([("a", 1)], ddl))
    store.append("log", spark.createDataFrame([("b", 2)], ddl))
    (tmp_path / "log" / "extra.json").write_text('{"script": "c", "n": 3}\nnot json\n{"script": \n')
    assert sorted(tuple(r) for r in store.read_log("log", ddl).collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_combined_document(spark, tmp_path):
    ddl = "source_id:string,status:string"
    assert stores.read_document(spark, str(tmp_path / "none.json"), ddl.replace(":", " ")).count() == 0
    doc = {"generated_at": "now", "sources": [{"source_id": "a", "status": "ok"}, {"source_id": "b"}]}
    (tmp_path / "catalog.json").write_text(json.dumps(doc, indent=2))
    got = stores.read_document(spark, str(tmp_path / "catalog.json"), "source_id string, status string")
    assert [tuple(r) for r in got.orderBy("source_id").collect()] == [("a", "ok"), ("b", None)]


def test_per_source_output_replaces_only_its_sources(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path))
    ddl = "source_id string, n bigint"
    store.write_per_source("out", spark.createDataFrame([("a", 1), ("b", 2)], ddl))
    store.write_per_source("out", spark.createDataFrame([("b", 3)], ddl))
    got = spark.read.json(str(tmp_path / "out"))
    assert sorted((r.source_id, r.n) for r in got.collect()) == [("a", 1), ("b", 3)]


def test_sheet_selection(spark):
    g = grid(spark, sheet("x", [(1,)], "a", 0), sheet("y", [(1,)], "a", 1), sheet("x", [(1,)], "b", 0))
    assert grids.first_sheet(g).count() == 2
    assert grids.named_sheet(g, "y").count() == 1
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    missing = grids.missing_sheets(sources, g, "y").orderBy("source_id").collect()
    assert [(r.source_id, r.available_sheets) for r in missing] == [("b", 1), ("c", 0)]


DDL = "k string, n bigint, v string"


def changed(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def test_changes_are_written_beside_the_version(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path))
    store.write("t", spark.range(200_000).selectExpr("cast(id as string) k", "id n", "sha2(cast(id as string), 512) v"))
    store.change("t", DDL, ["k"], changed(spark, ("7", 1, "x"), ("new", 2, None), (None, 3, "null key")))
    store.change("t", DDL, ["k"], changed(spark, ("7", 4, "y")), spark.createDataFrame([("8",), ("7",), ("none",)], "k string"))
    folders = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert [f[0] for f in folders] == ["d", "d", "v"]
    assert [spark.read.parquet(str(tmp_path / "t" / f)).count() for f in folders] == [3, 3, 200_000]
    rows = {r.k: (r.n, r.v) for r in store.read("t", DDL).collect()}
    assert len(rows) == 200_000 + 2 - 1
    assert rows["7"] == (4, "y") and "8" not in rows and rows["new"] == (2, None) and rows[None] == (3, "null key")
    store.change("t", DDL, ["n"], changed(spark, ("by n", 4, "")))  # other keys: what was there is folded first
    assert {r.k for r in store.read("t", DDL).filter("n = 4").collect()} == {"by n"}
    store.change("t", DDL, ["k"], changed(spark), spark.createDataFrame([], "k string"))
    assert len(list((tmp_path / "t").iterdir())) == 6


def test_all_rows_of_a_key_are_replaced(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path))
    store.change("t", DDL, ["k"], changed(spark, ("a", 1, ""), ("a", 2, ""), ("b", 3, "")))
    store.change("t", DDL, ["k"], changed(spark, ("a", 9, ""), ("a", 9, "")))
    assert sorted((r.k, r.n) for r in store.read("t", DDL).collect()) == [("a", 9), ("a", 9), ("b", 3)]


def test_many_changes_are_folded(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path), keep_versions=1)
    store.ensure("t", DDL)
    for i in range(2 * stores.MOST_CHANGES + 3):
        store.change("t", DDL, ["k"], changed(spark, (f"k{i % 5}", i, "")))
    assert len(store._folders("t")) <= stores.MOST_CHANGES + 1
    assert sorted((r.k, r.n) for r in store.read("t", DDL).collect()) == [(f"k{i % 5}", i) for i in range(15, 19)] + [("k4", 14)]


def test_killed_transaction_changes_nothing(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path))
    store.write("t", changed(spark, ("a", 1, "")))
    store.append("log", changed(spark, ("first", 1, "")), key="r1")
    for last in range(4):

        class Killed(Exception):
            pass

        with pytest.raises(Killed), store.transaction():
            steps = [
                lambda: store.change("t", DDL, ["k"], changed(spark, ("b", 2, ""))),
                lambda: store.write("u", changed(spark, ("c", 3, ""))),
                lambda: store.append("log", changed(spark, ("second", 1, "")), key="r2"),
            ]
            for step in steps[:last]:
                step()
            if last:
                assert {r.k for r in store.read("t", DDL).collect()} == {"a", "b"}
            raise Killed
        again = stores.Store(spark, str(tmp_path))
        assert [r.k for r in again.read("t", DDL).collect()] == ["a"]
        assert again.read("u", DDL).count() == 0
        assert [r.k for r in again.read_log("log", DDL).collect()] == ["first"]
    with store.transaction():
        for step in steps:
            step()
    again = stores.Store(spark, str(tmp_path))
    assert {r.k for r in again.read("t", DDL).collect()} == {"a", "b"}
    assert {r.k for r in again.read_log("log", DDL).collect()} == {"first", "second"}
    store.append("log", changed(spark, ("second", 1, "")), key="r2")
    assert again.read_log("log", DDL).count() == 2


def test_log_is_published_by_the_next_reader(spark, tmp_path, monkeypatch):
    store = stores.Store(spark, str(tmp_path))
    monkeypatch.setattr(stores.Store, "_publish", lambda self, state: None)  # killed right after the pointer
    store.append("log", changed(spark, ("a", 1, "")), key="r1")
    monkeypatch.undo()
    assert [r.k for r in stores.Store(spark, str(tmp_path)).read_log("log", DDL).collect()] == ["a"]


def test_folders_of_odd_sources_go(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path))
    names = ["a b", "x/y", "100%", "q=1:2", "plain", "ä?"]
    store.write_per_source("out", spark.createDataFrame([(n, 1) for n in names], "source_id string, n bigint"))
    assert len(list((tmp_path / "out").glob("source_id=*"))) == len(names)
    done = spark.createDataFrame([(n,) for n in names], "source_id string")
    store.write_per_source("out", spark.createDataFrame([("plain", 2)], "source_id string, n bigint"), done)
    assert [p.name for p in (tmp_path / "out").glob("source_id=*")] == ["source_id=plain"]
