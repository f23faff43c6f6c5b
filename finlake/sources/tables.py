"""Stored tables: Parquet folders, temp views and database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """A Parquet table (partition columns discovered); optionally exposed to SQL as ``view``."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """A database table, read in parallel ranges of ``partition_column`` when given.

    Filters and column selections on the result are pushed into the SQL sent
    to the database.
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()


WAREHOUSE_TABLES = ("fs_sub", "fs_num", "stock", "ticker_cik_mapping", "recorded")


def register_warehouse(spark: SparkSession, root: str,
                       names: tuple[str, ...] = WAREHOUSE_TABLES) -> list[str]:
    """Expose the stored tables under ``root`` as temp views with their usual names.

    Afterwards ad-hoc SQL runs as before, with named parameters instead of
    text substitution, e.g.
    ``spark.sql("SELECT * FROM fs_sub WHERE cik = :cik", args={"cik": 320193})``.
    Missing tables are skipped; the registered names are returned.
    """
    from pyspark.errors import AnalysisException

    done = []
    for name in names:
        try:
            read_parquet(spark, f"{root.rstrip('/')}/{name}", view=name)
        except AnalysisException:
            continue
        done.append(name)
    return done
