"""Membership filters and joins whose small side has a checked size."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def keep_members(df: DataFrame, column: str, members: Iterable | DataFrame) -> DataFrame:
    """Rows whose ``column`` is one of ``members`` (a driver list or a table): a left-semi join.

    Spark broadcasts the member side only when its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks with runtime sizes)
    and falls back to a sort-merge semi join otherwise, so no unbounded side is
    ever broadcast.
    """
    if not isinstance(members, DataFrame):
        schema = T.StructType([T.StructField(column, df.schema[column].dataType)])
        members = df.sparkSession.createDataFrame([(v,) for v in dict.fromkeys(members)], schema)
    right = members.select(F.col(members.columns[0]).alias(column)).distinct()
    return df.join(right, column, "left_semi")
