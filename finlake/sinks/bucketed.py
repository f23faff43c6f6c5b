"""Parquet tables bucketed by a join key, so joins and groupings on it need no shuffle.

A bucketed table is written with one shuffle (each task holds exactly one
bucket) and from then on every query that joins or groups by the key reads it
in place.  Rows are sorted inside a bucket by the columns that queries filter
on, so Parquet statistics still skip row groups.

Spark keeps bucketing in its catalog, which may not outlive the session; the
layout is passed again (:class:`Layout`) when a table is opened, and the table
is registered under a name made from its path.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layout:
    """Bucket key, number of buckets, order inside a bucket, partition column (one folder per load unit)."""

    key: str
    buckets: int
    sort: tuple[str, ...]
    partition: str | None = None


def write_bucketed(df: DataFrame, path: str, layout: Layout) -> None:
    """``df`` as bucketed Parquet files under ``path``, which is replaced."""
    spark = df.sparkSession
    # a catalog entry is the only way to a bucketed write; the files stay when it goes
    name = f"finlake_load_{uuid.uuid4().hex}"
    w = (df.repartition(layout.buckets, layout.key).write.mode("overwrite").format("parquet")
         .bucketBy(layout.buckets, layout.key).sortBy(*layout.sort).option("path", path))
    if layout.partition:
        w = w.partitionBy(layout.partition)
    try:
        w.saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _ddl(schema, names: list[str]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for n in names for f in schema if f.name == n)


def open_bucketed(spark: SparkSession, path: str, layout: Layout, schema=None,
                  partitions: dict[str, str] | None = None) -> DataFrame:
    """The table at ``path``; with ``partitions`` (value -> folder) the table made of those folders."""
    if schema is None:
        schema = spark.read.parquet(path).schema
    names = [f.name for f in schema if f.name != layout.partition]
    if layout.partition:
        names.append(layout.partition)
    key = hashlib.sha1(f"{path}|{layout}|{schema.simpleString()}|{sorted((partitions or {}).items())}".encode()).hexdigest()
    name = f"finlake_{key[:20]}"
    if not spark.catalog.tableExists(name):
        by = f"PARTITIONED BY ({layout.partition}) " if layout.partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema, names)}) USING parquet {by}"
                  f"CLUSTERED BY ({layout.key}) SORTED BY ({', '.join(layout.sort)}) INTO {layout.buckets} BUCKETS "
                  f"LOCATION '{path}'")
        if partitions:
            each = " ".join(f"PARTITION ({layout.partition} = '{v}') LOCATION '{p}'" for v, p in sorted(partitions.items()))
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {each}")
    return spark.table(name)
