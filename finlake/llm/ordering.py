"""Positions of rows within ordered groups, however large a group is."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.llm.store import ship, stored


def _count_in_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``_k``: the row's number within its group in this sorted partition."""
    last, had = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column("_g")
        fresh = np.ones(b.num_rows, bool)
        fresh[1:] = pc.not_equal(g.slice(1), g.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
        fresh[0] = g[0].as_py() != last
        row = np.arange(b.num_rows)
        start = np.maximum.accumulate(np.where(fresh, row, -1))
        k = np.where(start < 0, row + had, row - start)
        last, had = g[b.num_rows - 1].as_py(), int(k[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(k, pa.int64())], names=[*b.schema.names, "_k"])


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``_pos``: the row's 0-based place among the rows of its ``_g`` (not null), ordered by ``order``.

    Nulls come first; rows equal in all of ``order`` are numbered as they come.
    The rows are dealt to ranges of (group, order, row), so a group of any size,
    equal rows included, spreads over as many tasks as it needs.  Each sorted
    range counts on its own; only a range's first group can have begun before
    it, so at most one offset per range is broadcast.  The result is stored in
    its ranges.
    """
    spark = df.sparkSession
    ship(spark)
    by = ["_g", *order, "_at"]
    ranged = df.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    ranged = ranged.drop("_at").withColumn("_part", F.spark_partition_id())
    out = stored(ranged.mapInArrow(_count_in_partition, T.StructType([*ranged.schema, T.StructField("_k", T.LongType())])),
                 name)
    ends = out.groupBy("_part").agg(F.min("_g").alias("a"), F.max("_g").alias("b"))
    # two groups a range at most: bounded by the number of ranges
    edge = F.broadcast(ends.select(F.explode(F.array("a", "b")).alias("_g")).distinct())
    sizes = out.join(edge, "_g", "left_semi").groupBy("_g", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.sum("n").over(before)).filter("_off > 0").drop("n")
    return out.join(F.broadcast(offsets), ["_g", "_part"], "left").withColumn(
        "_pos", F.col("_k") + F.coalesce("_off", F.lit(0))).drop("_part", "_k", "_off")
