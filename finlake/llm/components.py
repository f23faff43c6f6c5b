"""Connected components of a link table, by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm.hot import join_by_key
from finlake.llm.store import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, label`` for every node that has a link; label: the smallest node it reaches.

    Rounds of two steps until nothing changes: each node takes the smallest
    label among its neighbours' (a partially aggregated minimum, so hubs cost
    no more than other nodes), then the label of its label, which halves the
    length of chains.  Each round is written to the shared folder.
    """
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x != y")
    both = stored(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    label = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select(
        "node", F.least("node", "m").alias("label"))
    label = stored(label, "labels")
    while True:
        near = both.join(label.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(
            F.min("label").alias("m"))
        low = stored(label.join(near, "node").select("node", "label", F.least("label", "m").alias("low")), "low")
        # one label may be that of most nodes: its rows stay where they are
        jump = low.groupBy("low").agg(F.count(F.lit(1)).alias("n")).join(
            label.select(F.col("node").alias("low"), F.col("label").alias("up")), "low", "left")
        nxt = stored(join_by_key(low, jump, "low", "n").select(
            "node", F.least("low", F.coalesce("up", "low")).alias("label"),
            (F.least("low", F.coalesce("up", "low")) != F.col("label")).alias("moved")), "labels")
        changed = nxt.filter("moved").limit(1).count()
        label = nxt.drop("moved")
        if not changed:
            return label
