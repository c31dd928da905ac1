"""Joins and numbering that stay balanced when one key holds much of the data."""

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyloom.schemas import struct_type
from tallyloom.session import stage_table

# A lookup is broadcast only when its measured content is below this size.
BROADCAST_BYTES = 64 * 1024 * 1024
# A shuffled sheet is cut into blocks of 2 ** BLOCK_BITS row numbers.
BLOCK_BITS = 20
# A key with more rows than this is spread over several tasks, and how widely.
HOT_ROWS = 1_000_000
ID_BUCKETS = 4096
# Rows of a small table that are unfolded inside one row, and rows that share a copy of them in a join.
CHUNK_ROWS = 1000
SHARE_ROWS = 100_000
# Rows of the larger side that one task of a shuffled join of whole tables gets.
JOIN_ROWS = 500_000


# Measured once per table object: several operators share one staged table.
_measured: WeakKeyDictionary = WeakKeyDictionary()


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's content: text lengths plus 16 bytes per column and row."""
    if df not in _measured:
        texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in df.dtypes if t == "string"]
        width = sum(texts, F.lit(16 * len(df.columns))).cast("bigint")
        _measured[df] = df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("b")).first().b
    return _measured[df]


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def attach_sheet_facts(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    limit: int | None = None,
    position: str = "row_num",
    part_of: DataFrame | None = None,
) -> DataFrame:
    """Inner join of sheet rows with per-sheet facts (``first_row`` and ``last_row`` among them).

    Facts that measure small are broadcast, so the rows are not shuffled at all. Otherwise
    both sides are cut into blocks of row numbers and joined on (sheet, block): no task
    then receives more than one block of a sheet, whatever share of all rows it holds. The
    facts are one record per block there, so they are hashed and the rows need no sort.
    ``part_of`` names the staged table the facts are taken from, whose size bounds theirs.
    """
    if fits_broadcast(facts if part_of is None else part_of, limit):
        return rows.join(F.broadcast(facts.drop("first_row", "last_row")), keys)

    def block(column):
        return F.shiftright(column, BLOCK_BITS)

    spread = facts.withColumn("block", F.explode(F.sequence(block("first_row"), block("last_row"))))
    return (
        rows.withColumn("block", block(position))
        .join(spread.drop("first_row", "last_row").hint("shuffle_hash"), [*keys, "block"])
        .drop("block")
    )


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    spread_by: list[str],
    limit: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Left join with a table that is unique on ``keys``, while ``rows`` may repeat keys heavily.

    A table that measures small is broadcast. Otherwise keys with more than ``hot_rows``
    rows are found by a pre-aggregated count; there are at most ``count(rows)/hot_rows``
    of them, and only those are salted, so the table is copied for hot keys alone.
    """
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), keys, "left")
    per_salt = HOT_ROWS if hot_rows is None else hot_rows
    hot = stage_table(
        rows.dropna(subset=keys)
        .groupBy(*keys)
        .count()
        .filter(F.col("count") > per_salt)
        .select(*keys, F.ceil(F.col("count") / per_salt).cast("int").alias("salts")),
        "hot-keys",
    )
    if hot.isEmpty():
        return rows.join(table, keys, "left")
    # Bounded by rows / hot_rows, and still measured before it is broadcast.
    small = F.broadcast(hot) if fits_broadcast(hot) else hot
    salts = F.coalesce("salts", F.lit(1))
    salted_rows = rows.join(small, keys, "left").withColumn(
        "salt", F.pmod(F.xxhash64(*spread_by), salts).cast("int")
    )
    salted_table = table.join(small, keys, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    return (
        salted_rows.drop("salts")
        .join(salted_table.drop("salts"), [*keys, "salt"], "left")
        .drop("salt")
    )


def keep_keys(
    rows: DataFrame, wanted: DataFrame, keys: list[str], spread_by: list[str], limit: int | None = None
) -> DataFrame:
    """Rows whose key is in ``wanted`` (unique on the keys); hot keys are spread as in ``lookup``."""
    marked = wanted.select(*keys, F.lit(True).alias("wanted"))
    return lookup(rows, marked, keys, spread_by, limit).filter("wanted").select(*rows.columns)


def drop_keys(
    rows: DataFrame, unwanted: DataFrame, keys: list[str], spread_by: list[str], limit: int | None = None
) -> DataFrame:
    """Rows whose key is not in ``unwanted`` (unique on the keys); the complement of ``keep_keys``."""
    marked = unwanted.select(*keys, F.lit(True).alias("unwanted"))
    return (
        lookup(rows, marked, keys, spread_by, limit)
        .filter(F.col("unwanted").isNull())
        .select(*rows.columns)
    )


def with_each(
    rows: DataFrame, table: DataFrame, spread_by: list[str], chunk: int = CHUNK_ROWS, limit: int | None = None
) -> DataFrame:
    """Every row of ``rows`` with every row of ``table``, which is by far the smaller one.

    A table of up to ``chunk`` rows becomes an array in the plan that is unfolded inside each
    row. A larger one is packed into arrays of about that many rows; each row of ``rows`` meets
    them one by one, broadcast if the table measures small, else by a join for which the
    arrays are copied to shares of the rows. Neither side is collected or shuffled as pairs.
    """
    n = table.count()
    fields = struct_type(", ".join(f"`{c}` {t}" for c, t in table.dtypes))
    if n <= chunk:
        found = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, r, strict=True)]) for r in table.collect()]
        return rows.select("*", F.inline(F.array(*found).cast(T.ArrayType(fields))))
    parts = -(-n // chunk)
    part = F.pmod(F.xxhash64(*table.columns), F.lit(parts)).cast("int").alias("each_part")
    packed = stage_table(table.groupBy(part).agg(F.collect_list(F.struct(*table.columns)).alias("each")), "packed")
    met = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("each_part"))
    if fits_broadcast(table, limit):
        joined = met.join(F.broadcast(packed), "each_part")
    else:
        shares = max(1, -(-rows.count() // SHARE_ROWS))
        salt = F.pmod(F.xxhash64(*spread_by), F.lit(shares)).cast("int")
        copies = packed.withColumn("each_salt", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
        joined = met.withColumn("each_salt", salt).join(copies, ["each_part", "each_salt"])
    return joined.select(*rows.columns, F.inline("each"))


def tasks_for(n: int) -> int:
    """Tasks that get ``JOIN_ROWS`` rows each of ``n``."""
    return max(1, -(-n // JOIN_ROWS))


def dealt_join(rows: DataFrame, table: DataFrame, keys: list[str], n: int, limit: int | None = None) -> DataFrame:
    """Left join of ``n`` rows that hold each key a few times with a table that does so too.

    A table that measures small is broadcast. Otherwise both sides are dealt by key over as many
    tasks as their rows need, so that what a task sorts does not grow with the input, even if it is
    read from a single file split. A size the planner guesses decides nothing: it takes a table
    whose rows are unfolded from a smaller one for as small as that.
    """
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), keys, "left")
    tasks = tasks_for(max(n, table.count()))
    return rows.repartition(tasks, *keys).join(table.repartition(tasks, *keys).hint("merge"), keys, "left")


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``(key, order)`` of the first row per key.

    The order is a single number, so this is a hash aggregate with map-side partials; a
    ranking window would bring all rows of a hot key into one task.
    """
    return rows.groupBy(key).agg(F.min(order).alias(order))


def dense_ids(rows: DataFrame, key: str, start: Column, buckets: int = ID_BUCKETS) -> DataFrame:
    """Add ``item_id`` = ``start`` + 1, 2, ... over rows that are unique on ``key``.

    A row number over all rows would run in one task. Rows are numbered inside hash
    buckets instead, and a table of at most ``buckets`` counts shifts each bucket. The
    numbers depend on the keys alone, so a recomputed task hands out the same ones.
    """
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    shifts = (
        bucketed.groupBy("bucket")
        .count()
        .withColumn("total", F.sum("count").over(Window.orderBy("bucket")))
        .select("bucket", (F.col("total") - F.col("count")).alias("shift"))
    )
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(key))
    return (
        bucketed.withColumn("place", place)
        .join(F.broadcast(shifts), "bucket")
        .withColumn("item_id", (start + F.col("shift") + F.col("place")).cast("bigint"))
        .drop("bucket", "shift", "place")
    )
