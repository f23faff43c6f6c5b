"""Load monitoring: loaded folders, per-folder row counts, stored table sizes.

Sizes come from the files themselves, not from a database catalog: the
``binaryFile`` source lists a table's files, and without its content column it
opens none of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.scalar import pretty_size
from finlake.sinks import warehouse


def loaded_folders(ledger: DataFrame) -> DataFrame:
    return ledger.select("folder_name").orderBy(F.col("folder_name").desc())


def folder_fact_counts(fs_num: DataFrame, fs_sub: DataFrame) -> DataFrame:
    """Facts per loaded folder, newest folder first."""
    return (fs_num.select("adsh").join(fs_sub.select("adsh", "folder"), "adsh")
            .groupBy("folder").agg(F.count(F.lit(1)).alias("facts"))
            .orderBy(F.col("folder").desc()))


def warehouse_folders(spark: SparkSession, root: str) -> DataFrame:
    """Per quarter of the newest manifest its filings, their facts and their companies (0 where a quarter has none)."""
    now = warehouse.latest(spark, root)
    sub, num = (warehouse.read(spark, root, t, now) for t in ("fs_sub", "fs_num"))
    # facts join their filing inside its bucket
    facts = num.groupBy("folder", "adsh").agg(F.count(F.lit(1)).alias("facts"))
    per_filing = sub.select("folder", "adsh", "cik").join(facts, ["folder", "adsh"], "left")
    counts = per_filing.groupBy("folder").agg(
        F.count(F.lit(1)).alias("filings"), F.sum("facts").alias("facts"), F.count_distinct("cik").alias("companies"))
    folders = spark.createDataFrame([(f,) for f in now.recorded], "folder string")
    return folders.join(counts, "folder", "left").select(
        "folder", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("filings", "facts", "companies")])


def table_sizes(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table, files, bytes, size) for Parquet tables given as name -> path: one row per file is read."""
    files = None
    for name, path in tables.items():
        part = spark.read.format("binaryFile").load(path).select(
            F.lit(name).alias("table"), F.col("length").alias("bytes"))
        files = part if files is None else files.unionByName(part)
    per_table = files.groupBy("table").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return per_table.select("table", "files", "bytes", pretty_size("bytes").alias("size"))


def table_counts(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table, rows) for Parquet tables given as name -> path; the counts come from file footers."""
    out = None
    for name, path in tables.items():
        part = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows")
        out = part if out is None else out.unionByName(part)
    return out
