"""Connected components of a link table by label passing in Spark."""

from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.common import BROADCAST_BYTES, HOT_ROWS, join_facts, stage_table


def components(links: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(node, component)`` for every node of ``links(x, y)``; the component is its smallest node.

    Every round takes the smallest label among the neighbours, by an aggregate with map-side
    partials, and then follows labels one step, so that long chains shorten by half. Each
    round is stored, which cuts lineage; only a count of changes reaches the driver.
    """
    both = stage_table(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))), "links")
    labels = stage_table(
        both.groupBy(F.col("x").alias("node")).agg(F.least("node", F.min("y")).alias("component"), F.count("*").alias("degree")),
        "labels",
    )
    while True:
        # A node has as many rows here as neighbours; those of a hot one are dealt out.
        said = labels.select(F.col("node").alias("y"), "component", "degree")
        heard = (
            join_facts(both, said, "y", F.lit(32), "degree", F.col("x"), broadcast_bytes, hot_rows)
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        near = labels.join(heard, "node").select(
            "node", "degree", F.col("component").alias("old"), F.least("component", "heard").alias("via")
        )
        near = stage_table(near, "heard")
        members = near.groupBy("via").agg(F.count("*").alias("members"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("next")).join(members, "via")
        jump = stage_table(jump, "jump")
        moved = join_facts(near, jump, "via", F.lit(32), "members", F.col("node"), broadcast_bytes, hot_rows)
        labels = stage_table(moved.select("node", "degree", "old", F.least("via", "next").alias("component")), "labels")
        if labels.filter("old <> component").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component", "degree")
