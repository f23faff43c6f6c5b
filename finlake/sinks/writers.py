"""Sinks: partitioned Parquet, JDBC tables, CSV/JSON exports and the load ledger.

Writes are idempotent per partition (dynamic partition overwrite), so a job
that is retried after losing executors, or re-run for the same folder, leaves
one copy of the data.  The ledger row is appended only after the data commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER_SCHEMA = T.StructType([T.StructField("folder_name", T.StringType(), False)])


def write_partitioned(df: DataFrame, path: str, partition_by: str | list[str] = "folder",
                      spread_by: str | None = None, spread: int = 16,
                      cluster_by: list[str] | None = None,
                      max_records_per_file: int = 5_000_000) -> None:
    """Parquet partitioned by load unit; only the partitions present are replaced.

    A load unit can be very large (one quarter may hold a big share of all
    facts), so rows are never shuffled by the partition column alone: by
    default each task writes its own files for the units it holds; with
    ``spread_by`` rows are hashed over (unit, ``spread`` buckets) to bound the
    file count.  Rows are sorted by ``cluster_by`` inside each file so Parquet
    row-group statistics let pushed filters (``tag IN (...)``) skip row groups.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    out = df
    if spread_by:
        salt = F.pmod(F.xxhash64(F.col(spread_by)), F.lit(spread))
        out = out.repartition(*[F.col(c) for c in cols], salt)
    if cluster_by:
        out = out.sortWithinPartitions(*cols, *cluster_by)
    (out.write
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .mode("overwrite").partitionBy(*cols).parquet(path))


def write_replace(df: DataFrame, path: str) -> None:
    """Replace a whole table (prices are reloaded in full)."""
    df.write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict[str, str] | None = None) -> None:
    """Append to / replace a database table.  ``truncate`` keeps the table's DDL."""
    w = df.write.mode(mode).option("truncate", "true" if mode == "overwrite" else "false")
    w.jdbc(url, table, properties=properties or {})


def jdbc_delete_folders(spark: SparkSession, url: str, table: str, folders: list[str],
                        properties: dict[str, str] | None = None) -> None:
    """Remove the folders' rows of an earlier, perhaps broken-off load, so that an append can be repeated."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    con = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        if con.getMetaData().getTables(None, None, table, None).next():
            st = con.prepareStatement(f"DELETE FROM {table} WHERE folder = ?")
            for f in folders:
                st.setString(1, f)
                st.executeUpdate()
    finally:
        con.close()


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; quotes doubled so titles with commas/quotes round-trip."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True)
        .option("quote", '"').option("escape", '"').csv(path))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


# ---------------------------------------------------------------- load ledger

def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Folders already loaded; empty when the ledger does not exist yet."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except Exception as exc:  # path not found -> nothing recorded yet
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        raise


def pending_folders(requested: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requested folders not yet recorded (anti join; repeats collapse)."""
    req = requested.select(F.col(requested.columns[0]).alias("folder_name")).distinct()
    return req.join(ledger, "folder_name", "left_anti")


def record_folders(spark: SparkSession, path: str, folders: list[str]) -> None:
    """Append ledger rows; call only after the folder's data is committed."""
    if folders:
        spark.createDataFrame([(f,) for f in folders], LEDGER_SCHEMA) \
            .write.mode("append").parquet(path)
