"""Files as inputs: listing, content hashes, and status of registered sources."""

import hashlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.session import stage_table

# Called once per task; gives a function that opens a file by its listed path for reading bytes.
Opener = Callable[[], Callable[[str], BinaryIO]]

# Bytes read at once, and the largest file that Spark hands over as one value.
CHUNK_BYTES = 1 << 20
VALUE_BYTES = 64 << 20
# Largest array of the JVM, with room for its header.
MOST_VALUE_BYTES = (1 << 31) - 64
# Spark's line reader unpacks files of these names.
_PACKED = r"\.(gz|bz2|deflate|lz4|snappy|zst|Z)$"


def file_key(path: Column, root: str) -> Column:
    """Path relative to ``root``, or the path as given where it lies elsewhere."""
    prefix = root.rstrip("/") + "/"
    plain = F.regexp_replace(path, r"^file:/+", "/")
    return F.when(plain.startswith(prefix), F.substring(plain, len(prefix) + 1, 1 << 30)).otherwise(plain)


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def local_opener() -> Callable[[str], BinaryIO]:
    """Opens plain paths and ``file:`` paths as they are; nothing in a name is parsed or unescaped."""

    def open_file(path: str) -> BinaryIO:
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")

    return open_file


def _hashes(batches: Iterator[pa.RecordBatch], opener: Opener, most_bytes: int | None) -> Iterator[pa.RecordBatch]:
    open_file, buffer = opener(), bytearray(CHUNK_BYTES)
    view = memoryview(buffer)

    def stream_hash(path: str) -> str:
        digest = hashlib.sha256()
        with open_file(path) as stream:
            while n := stream.readinto(view):
                digest.update(view[:n])
        return digest.hexdigest()

    for batch in batches:
        hashes, errors = [], []
        for path, length in zip(batch["path"].to_pylist(), batch["length"].to_pylist(), strict=True):
            digest = error = None
            if most_bytes is not None and length > most_bytes:
                error = _too_long(length, most_bytes)
            else:
                try:
                    digest = stream_hash(path)
                except OSError as e:
                    error = f"File cannot be read: {e}"
            hashes.append(digest)
            errors.append(error)
        columns = [batch["path"], batch["length"], pa.array(hashes, pa.string()), pa.array(errors, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["path", "length", "hash", "error"])


def _too_long(length: int, most_bytes: int) -> str:
    return f"File has {length} bytes, at most {most_bytes} are wanted"


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of files from their lines in order; null where the bytes do not add up to the file's size."""
    at, size, done, digest = None, 0, 0, None

    def finished() -> pa.RecordBatch:
        if done == size - 1:  # a break ends the file, which is the only one that has no line after it
            digest.update(b"\n")
        whole = done in (size, size - 1)
        return pa.RecordBatch.from_pydict(
            {"uri": pa.array([at], pa.string()), "hash": pa.array([digest.hexdigest() if whole else None], pa.string())}
        )

    for batch in batches:
        for uri, length, line in zip(batch["uri"].to_pylist(), batch["size"].to_pylist(), batch["line"], strict=True):
            if uri != at:
                if at is not None:
                    yield finished()
                at, size, done, digest = uri, length, 0, hashlib.sha256()
            else:
                digest.update(b"\n")
                done += 1
            piece = line.as_buffer()
            digest.update(piece)
            done += piece.size
    if at is not None:
        yield finished()


def _hashes_through_spark(spark: SparkSession, folder: str, most_bytes: int | None, value_bytes: int) -> DataFrame:
    """As ``_hashes`` for stores that only Spark's readers open.

    Files of up to ``value_bytes`` are hashed as values where they are read. Longer ones are
    read in splits, as lines without decoding, which are brought into the file's order in one
    task per file and fed to the hash one after the other.
    """
    options = {"recursiveFileLookup": "true", "ignoreMissingFiles": "true", "ignoreCorruptFiles": "true"}
    values = spark.read.format("binaryFile").options(**options).load(folder)
    listed = stage_table(values.select("path", "length", F.col("_metadata.file_path").alias("uri")), "listing")
    wanted = listed if most_bytes is None else listed.filter(F.col("length") <= most_bytes)
    packed = F.col("uri").rlike(_PACKED)
    long = wanted.filter((F.col("length") > value_bytes) & ~packed)
    most_value = F.least(F.when(F.col("_metadata.file_path").rlike(_PACKED), MOST_VALUE_BYTES).otherwise(value_bytes), F.lit(most_bytes))
    short = values.filter((F.col("length") <= MOST_VALUE_BYTES) & (F.col("length") <= most_value))
    hashed = short.select(F.col("_metadata.file_path").alias("uri"), F.sha2("content", 256).alias("hash"))
    if not long.isEmpty():
        lines = (
            spark.read.options(**options, lineSep="\n")
            .text(folder)
            .filter(F.col("_metadata.file_size") > value_bytes)
            .select(
                F.col("_metadata.file_path").alias("uri"),
                F.col("_metadata.file_block_start").alias("block"),
                F.col("_metadata.file_size").alias("size"),
                F.monotonically_increasing_id().alias("line_id"),
                F.col("value").cast("binary").alias("line"),
            )
            .filter(~packed & (F.lit(True) if most_bytes is None else F.col("size") <= most_bytes))
        )
        in_order = lines.repartition("uri").sortWithinPartitions("uri", "block", "line_id").select("uri", "size", "line")
        hashed = hashed.unionByName(in_order.mapInArrow(_hash_lines, "uri string, hash string"))
    error = F.when(F.col("hash").isNull(), F.lit("File cannot be read"))
    if most_bytes is not None:
        told = F.concat(F.lit("File has "), F.col("length"), F.lit(f" bytes, at most {most_bytes} are wanted"))
        error = F.when(F.col("length") > most_bytes, told).otherwise(error)
    return listed.join(hashed, "uri", "left").select("path", "length", "hash", error.alias("error"))


def list_files(
    spark: SparkSession,
    folder: str,
    root: str,
    most_bytes: int | None = None,
    opener: Opener | None = None,
    value_bytes: int = VALUE_BYTES,
) -> DataFrame:
    """``(file_key, hash, size_bytes, error)`` of all files below ``folder``.

    Names and sizes come from Spark's listing, whose scan cuts tasks by bytes: many small
    files share a task, a large one has its own. A file is read once, in chunks, by a task that
    opens its store once: plain paths as such, other stores through ``opener``, which may
    return the ``open_input_stream`` of an Arrow file system. Without an opener, stores that
    are not local are read through Spark itself (``_hashes_through_spark``): no credentials
    leave Spark's configuration, and no process is started.

    A file that cannot be read keeps its row, without hash and with an error, and no file
    stops another. There is no limit of size unless the caller sets ``most_bytes``; only packed
    files (.gz and the like) above 2 GB in a store without opener become error rows. Spark's
    scan passes over empty files and those that are gone by then: they count as missing.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if opener is None and place.getUri().getScheme() == "file":
        opener = local_opener
    if opener is None:
        hashed = _hashes_through_spark(spark, folder, most_bytes, min(value_bytes, MOST_VALUE_BYTES))
    else:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
        hashed = found.load(folder).select("path", "length").mapInArrow(
            lambda b: _hashes(b, opener, most_bytes), "path string, length bigint, hash string, error string"
        )
    return hashed.select(
        file_key(F.col("path"), root).alias("file_key"), "hash", F.col("length").alias("size_bytes"), "error"
    )


def source_status(registry: DataFrame, listing: DataFrame, folder_key: str, errors: DataFrame | None = None) -> DataFrame:
    """Registry with ``ok``, ``missing`` or ``error`` per source; no source stops another.

    ``errors(source_id, error)`` holds what decoding reported for unreadable files; a listing
    may bring an ``error`` of its own for files that could not be hashed.
    """
    if "error" in listing.columns:
        listing = listing.withColumnRenamed("error", "list_error")
    else:
        listing = listing.withColumn("list_error", F.lit(None).cast("string"))
    prefix = folder_key.rstrip("/") + "/" if folder_key else ""
    keyed = registry.withColumn("file_key", F.concat(F.lit(prefix), F.col("filename")))
    joined = keyed.join(listing, "file_key", "left")
    if errors is None:
        joined = joined.withColumn("read_error", F.lit(None).cast("string"))
    else:
        joined = joined.join(
            errors.select("source_id", F.col("error").alias("read_error")), "source_id", "left"
        )
    missing = F.col("size_bytes").isNull()
    read_error = F.coalesce("list_error", "read_error")
    return joined.select(
        *registry.columns,
        "file_key",
        "hash",
        "size_bytes",
        F.when(missing, "missing")
        .when(read_error.isNotNull(), "error")
        .otherwise("ok")
        .alias("status"),
        F.when(missing, F.concat(F.lit("File not found: "), F.col("file_key")))
        .otherwise(read_error)
        .alias("error"),
    )
