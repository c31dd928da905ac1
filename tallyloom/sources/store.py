"""State between runs: versioned tables with change files, append-only logs, and JSON documents.

Layout below a store's root: ``<table>/v<n>`` is a whole version of a table, ``<table>/d<n>``
what changed after it, ``_state/s<n>.json`` names the versions that make up the tables. Only
the newest such pointer counts, so writes become visible together, when it is written.
"""

import functools
import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.schemas import column_names, empty, struct_type
from tallyloom.sources.json_split import json_members

STATE = "_state"
# Change files of a table beyond which, or beyond which share of its bytes, they are folded into a version.
MOST_CHANGES = 8
FOLD_SHARE = 0.25


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _path(spark, path)
    return system.exists(hadoop)


def _names(spark: SparkSession, folder: str) -> list[str]:
    hadoop, system = _path(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(hadoop)] if system.exists(hadoop) else []


def _versions(spark: SparkSession, folder: str) -> dict[str, int]:
    """Complete versions and change files below a folder, by name."""
    named = {n: int(n[1:]) for n in _names(spark, folder) if n[:1] in ("v", "d") and n[1:].isdigit()}
    return {n: k for n, k in named.items() if path_exists(spark, f"{folder}/{n}/_SUCCESS")}


def transactional(method: Callable) -> Callable:
    """A method of an object with a ``store``: what it writes becomes visible when it returns, or not at all."""

    @functools.wraps(method)
    def run(self, *args, **kwargs):
        with self.store.transaction():
            return method(self, *args, **kwargs)

    return run


class Store:
    """Tables below one root folder on a shared file system; one writer at a time.

    A table is its last whole version with the changes written since, of which the last one
    counts for each key. Nothing that is being read is ever overwritten. Whatever is written
    inside ``transaction`` becomes visible at its end through one pointer file; if it is
    killed before, all tables and logs stay at what they were.
    """

    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 3):
        self.spark = spark
        self.keep_versions = max(1, keep_versions)
        self.root = root.rstrip("/")
        self._open: dict | None = None  # the state a running transaction is building

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- pointer -----------------------------------------------------------------------

    def _pointers(self) -> list[int]:
        names = _names(self.spark, self.path(STATE))
        return sorted(int(n[1:-5]) for n in names if n[:1] == "s" and n.endswith(".json") and n[1:-5].isdigit())

    def _state(self) -> dict:
        """``tables``: folders (a version and its changes in order) and keys by table; ``logs``: staged folder, log and key to publish."""
        if self._open is not None:
            return self._open
        pointers = self._pointers()
        if not pointers:
            return {"tables": {}, "logs": []}
        hadoop, system = _path(self.spark, f"{self.path(STATE)}/s{pointers[-1]:08d}.json")
        stream = system.open(hadoop)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)))
        finally:
            stream.close()

    def _commit(self, state: dict) -> None:
        """Write the next pointer under another name, and rename it: it is there as a whole, or not at all."""
        pointers = self._pointers()
        target = f"{self.path(STATE)}/s{(pointers[-1] if pointers else 0) + 1:08d}.json"
        hadoop, system = _path(self.spark, f"{self.path(STATE)}/{uuid.uuid4().hex}.tmp")
        stream = system.create(hadoop, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        if not system.rename(hadoop, _path(self.spark, target)[0]):
            raise RuntimeError(f"{target} is there already: another run writes to this store")
        for number in pointers[: -self.keep_versions]:
            self._delete(f"{self.path(STATE)}/s{number:08d}.json")
        self._publish(state)
        self._clean(state)

    def _publish(self, state: dict) -> None:
        """Move the log files of a pointer to their place; finished by the next reader if this is cut short."""
        for source, target, key in state["logs"]:
            folder, system = _path(self.spark, source)
            if system.exists(folder):
                system.mkdirs(_path(self.spark, target)[0])
                for name in _names(self.spark, source):
                    if name.startswith("part-"):
                        system.rename(_path(self.spark, f"{source}/{name}")[0], _path(self.spark, f"{target}/{name}")[0])
                if key:
                    system.create(_path(self.spark, f"{target}/{self._marker(key)}")[0], True).close()
                system.delete(folder, True)

    @staticmethod
    def _marker(key: str) -> str:
        return f"_key-{quote(key, safe='')}"

    def _clean(self, state: dict) -> None:
        """Old versions go; of those before the current one, ``keep_versions`` stay for readers of this run."""
        for name, table in state["tables"].items():
            folders = table["folders"]
            there = _versions(self.spark, self.path(name))
            earlier = sorted(k for n, k in there.items() if n[0] == "v" and k < int(folders[0][1:]))
            if len(earlier) > self.keep_versions:
                for folder, number in there.items():
                    if number < earlier[-self.keep_versions]:
                        self._delete(f"{self.path(name)}/{folder}")

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """Writes inside become visible together at the end. One inside another is part of it."""
        if self._open is not None:
            yield
            return
        state = self._state()
        self._publish(state)
        self._open = {"tables": dict(state["tables"]), "logs": []}
        try:
            yield
            if self._open != {"tables": state["tables"], "logs": []}:
                done, self._open = self._open, None
                self._commit(done)
        finally:
            self._open = None

    # --- tables ------------------------------------------------------------------------

    def _folders(self, name: str) -> list[str]:
        """The current version of a table and its changes; of a store without pointers, the last version."""
        known = self._state()["tables"].get(name)
        if known is not None:
            return known["folders"]
        if self._pointers():
            return []
        whole = sorted(n for n in _versions(self.spark, self.path(name)) if n[0] == "v")
        return whole[-1:]

    def _next(self, name: str, kind: str) -> str:
        numbers = [int(n[1:]) for n in _names(self.spark, self.path(name)) if n[1:].isdigit()]
        return f"{kind}{max(numbers, default=0) + 1:08d}"

    def ensure(self, name: str, ddl: str) -> None:
        """Create an empty first version unless the table exists."""
        if not self._folders(name):
            self.write(name, empty(self.spark, ddl))

    def read(self, name: str, ddl: str) -> DataFrame:
        """The table as it is now; an absent one reads as empty.

        All rows of a key come from the last change that names it, else from the version.
        """
        folders = self._folders(name)
        if not folders:
            return empty(self.spark, ddl)
        schema = struct_type(ddl)
        whole = self.spark.read.schema(schema).parquet(f"{self.path(name)}/{folders[0]}")
        if len(folders) == 1:
            return whole
        keys = self._state()["tables"][name]["keys"]
        changes = [
            self.spark.read.schema(struct_type(f"{ddl}, removed_key boolean"))
            .parquet(f"{self.path(name)}/{folder}")
            .withColumn("change_no", F.lit(i))
            for i, folder in enumerate(folders[1:])
        ]
        changed = functools.reduce(DataFrame.unionByName, changes)
        last = changed.groupBy(*[F.col(k).alias(f"last_{k}") for k in keys]).agg(F.max("change_no").alias("last_no"))

        def same(rows: DataFrame) -> Column:
            return functools.reduce(Column.__and__, [rows[k].eqNullSafe(last[f"last_{k}"]) for k in keys])

        columns = column_names(ddl)
        current = changed.join(last, same(changed) & (changed["change_no"] == last["last_no"]), "left_semi")
        kept = whole.join(last, same(whole), "left_anti").select(*columns)
        return kept.unionByName(current.filter(~F.col("removed_key")).select(*columns))

    def write(self, name: str, df: DataFrame) -> None:
        """A new version of the whole table."""
        with self.transaction():
            folder = self._next(name, "v")
            df.write.mode("overwrite").parquet(f"{self.path(name)}/{folder}")
            self._open["tables"][name] = {"folders": [folder], "keys": []}

    def change(self, name: str, ddl: str, keys: list[str], rows: DataFrame, removed: DataFrame | None = None) -> None:
        """Replace all rows of the keys in ``rows`` by these, and drop the keys in ``removed``.

        Only ``rows`` and the removed keys are written. Once the changes of a table are many,
        or large next to its version, they are folded into the next one.
        """
        with self.transaction():
            folders = self._folders(name)
            if not folders:
                self.write(name, rows.select(*column_names(ddl)))
                return
            if len(folders) > 1 and self._open["tables"][name]["keys"] != keys:
                self.write(name, self.read(name, ddl))  # changes by other keys end here
                folders = self._folders(name)
            fields = struct_type(ddl)
            written = rows.select(*[F.col(f.name).cast(f.dataType) for f in fields], F.lit(False).alias("removed_key"))
            if removed is not None:
                gone = [F.col(f.name) if f.name in keys else F.lit(None) for f in fields]
                named = [c.cast(f.dataType).alias(f.name) for c, f in zip(gone, fields, strict=True)]
                dropped = removed.select(*keys).distinct().join(rows.select(*keys).distinct(), keys, "left_anti")
                written = written.unionByName(dropped.select(*named, F.lit(True).alias("removed_key")))
            folder = self._next(name, "d")
            written.write.mode("overwrite").parquet(f"{self.path(name)}/{folder}")
            if self.spark.read.parquet(f"{self.path(name)}/{folder}").isEmpty():
                self._delete(f"{self.path(name)}/{folder}")
                return
            folders = [*folders, folder]
            self._open["tables"][name] = {"folders": folders, "keys": keys}
            sizes = [self._bytes(f"{self.path(name)}/{f}") for f in folders]
            if len(folders) - 1 > MOST_CHANGES or sum(sizes[1:]) > FOLD_SHARE * sizes[0] + (1 << 20):
                self.write(name, self.read(name, ddl))

    def _bytes(self, path: str) -> int:
        hadoop, system = _path(self.spark, path)
        return system.getContentSummary(hadoop).getLength()

    def _delete(self, path: str) -> None:
        hadoop, system = _path(self.spark, path)
        system.delete(hadoop, True)

    # --- logs and outputs --------------------------------------------------------------

    def append(self, name: str, df: DataFrame, fmt: str = "json", key: str | None = None) -> None:
        """Append-only log, JSON lines by default; it can be read once the transaction is over.

        ``key`` names what is appended, such as a run: the same key appends nothing again.
        """
        with self.transaction():
            target = self.path(name)
            if key and path_exists(self.spark, f"{target}/{self._marker(key)}"):
                return
            if key and [target, key] in [x[1:] for x in self._open["logs"]]:
                return
            source = f"{self.path(STATE)}/log-{uuid.uuid4().hex}"
            df.write.format(fmt).save(source)
            self._open["logs"] = [*self._open["logs"], [source, target, key]]

    def read_log(self, name: str, ddl: str) -> DataFrame:
        if self._open is None:
            self._publish(self._state())
        return read_json_lines(self.spark, self.path(name), ddl)

    def write_per_source(self, name: str, df: DataFrame, done: DataFrame | None = None) -> None:
        """One folder per source; only the sources in ``df`` are replaced.

        A source of ``done(source_id)`` that has no row in ``df`` loses the folder it had. The
        folders that are there are listed once, and the stale ones found in Spark. These are
        copies for others to read: they are written as they come, outside any transaction.

        The rebalance hint gathers each source into few files and still splits a source
        that holds much of the data.
        """
        (
            df.hint("rebalance", "source_id")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_id")
            .json(self.path(name))
        )
        if done is not None:
            gone = done.select("source_id").join(df.select("source_id").distinct(), "source_id", "left_anti").distinct()
            # The writer escapes characters of an id that a folder name cannot have, as %XX.
            there = [(f, unquote(f.partition("=")[2])) for f in _names(self.spark, self.path(name)) if f.startswith("source_id=")]
            folders = self.spark.createDataFrame(there, "folder string, source_id string")
            for row in folders.join(gone, "source_id", "left_semi").select("folder").toLocalIterator():
                self._delete(f"{self.path(name)}/{row.folder}")


def read_json_lines(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines; malformed lines are dropped, an absent path reads as empty."""
    if not path_exists(spark, path):
        return empty(spark, ddl)
    rows = spark.read.schema(struct_type(ddl)).option("mode", "DROPMALFORMED").json(path)
    return rows.select(*column_names(ddl))


def read_document(spark: SparkSession, path: str, source_ddl: str) -> DataFrame:
    """Records of the ``sources`` list of a combined JSON document, or empty if absent; read by many tasks."""
    if not path_exists(spark, path):
        return empty(spark, source_ddl)
    record = F.from_json("value", struct_type(source_ddl)).alias("record")
    return json_members(spark, path, "sources").select(record).select("record.*")
