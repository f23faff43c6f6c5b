"""Positions of values in their global order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finlake.session import stored


def global_positions(values: DataFrame, col: str, out: str) -> DataFrame:
    """``values`` (one row per value) with each row's 0-based place in the order of ``col``, NULL last.

    The values are dealt to ranges of the order and stored; each range numbers
    its own and adds the sizes of the ranges before it, which are as many
    numbers as there are ranges.
    """
    ranged = values.repartitionByRange(F.col(col).asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    ranged = stored(ranged)  # every later step sees the same ranges
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    listed = sizes.agg(F.sort_array(F.collect_list(F.struct("_part", "n"))).alias("all"))  # a number per range
    before = listed.select(F.transform("all", lambda x, i: F.struct(x["_part"].alias("_part"), F.aggregate(
        F.slice("all", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, y: a + y["n"]).alias("_before"))).alias("all"))
    before = before.select(F.inline("all"))
    within = Window.partitionBy("_part").orderBy(F.col(col).asc_nulls_last())
    return ranged.withColumn("_in", F.row_number().over(within)).join(F.broadcast(before), "_part").withColumn(
        out, F.col("_before") + F.col("_in") - 1).drop("_part", "_in", "_before")
