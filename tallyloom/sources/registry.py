"""Registry of sources: which file, which seed type, which unit."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.fixed_values import DEFAULT_UOM
from tallyloom.schemas import REGISTRY


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Registry document: a JSON list in which order matters; a new source is one more record."""
    entry = REGISTRY.replace(" string", ":string").replace(" bigint", ":bigint")
    records = F.from_json("value", F.lit(f"array<struct<{entry}>>"))
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(records).alias("pos", "r"))
        .select("r.*", "pos")
        .withColumn("source_no", F.col("pos").cast("bigint"))
        .drop("pos")
    )


def read_registry_table(spark: SparkSession, path: str) -> DataFrame:
    """Large registry kept as a table under its contract, with ``source_no`` given."""
    return spark.read.schema(REGISTRY).parquet(path)


def sources_of(registry: DataFrame, seed_type: str) -> DataFrame:
    """Sources of one seed type, with the default unit where none is given."""
    return registry.filter(F.col("seed_type") == seed_type).withColumn(
        "base_uom", F.coalesce("base_uom", F.lit(DEFAULT_UOM))
    )
