"""Filing ingest: ledger check -> read -> company/form filter -> period facts -> write -> ledger.

One Spark job handles every pending folder.  The fact table is reduced with a
left-semi join to its filings on (adsh, year(ddate) = year(period)), which keeps
only facts dated in the filing's own year (prior-year comparatives are
dropped on purpose).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions import tags
from finlake.operators.joins import keep_members
from finlake.sinks import warehouse, writers
from finlake.sources import filings as src
from finlake.sources.prices import wide_to_long


def select_filings(sub: DataFrame, companies: Iterable[int] | DataFrame | None,
                   forms: Iterable[str] = tags.FORMS) -> DataFrame:
    """Quarterly and annual filings of the given companies, ``folder`` first."""
    out = sub.filter(F.col("form").isin(list(forms)))
    if companies is not None:
        out = keep_members(out, "cik", companies)
    return out.select("folder", *[c for c in out.columns if c != "folder"])


def keep_period_facts(num: DataFrame, sub: DataFrame) -> DataFrame:
    """Facts whose date falls in the same year as their filing's period."""
    n = num.alias("n")
    s = sub.select("adsh", "period").alias("s")
    cond = (F.col("n.adsh") == F.col("s.adsh")) & (F.year("n.ddate") == F.year("s.period"))
    kept = n.join(s, cond, "left_semi")
    return kept.drop(*[c for c in ("version", "coreg", "footnote") if c in num.columns])


def ingest_filings(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    folders: list[str],
    companies: Iterable[int] | DataFrame | None,
    ledger_path: str | None,
    sink: str = "parquet",
    jdbc_url: str | None = None,
    jdbc_props: dict[str, str] | None = None,
) -> list[str]:
    """Load the requested quarter folders that are not yet in the ledger.

    Returns the folders loaded by this call.  Re-running after a failure
    re-writes the same folder partitions (dynamic overwrite) before the
    ledger is appended, so a folder is never stored twice.

    The ``warehouse`` sink keeps bucketed tables and the ledger under one
    manifest in ``out_root`` (:mod:`finlake.sinks.warehouse`): a load becomes
    visible as a whole; it takes no ``ledger_path``.
    """
    if sink == "warehouse":
        return load_warehouse(spark, raw_root, out_root, folders, companies)
    if not ledger_path:
        raise ValueError(f"sink {sink!r} needs ledger_path")
    requested = spark.createDataFrame([(f,) for f in folders], "folder_name string")
    ledger = writers.read_ledger(spark, ledger_path)
    # The pending list is a handful of folder names (bounded by the request).
    pending = [r.folder_name for r in writers.pending_folders(requested, ledger).collect()]
    if not pending:
        return []

    sub = select_filings(src.read_sub(spark, raw_root, pending), companies)
    num = keep_period_facts(src.read_num(spark, raw_root, pending), sub)

    if sink == "parquet":
        # no shuffle before the write: the scan splits / join output are already
        # balanced, each task writes its own files per folder
        writers.write_partitioned(sub, f"{out_root}/fs_sub", cluster_by=["cik"])
        writers.write_partitioned(num, f"{out_root}/fs_num", cluster_by=["tag", "adsh"])
    elif sink == "jdbc":
        # Database tables are appended to (as the original loader did).  The
        # folders' rows go first, so a load that failed half-way is repeated
        # safely; the ledger row follows both appends.
        if not jdbc_url:
            raise ValueError("jdbc sink needs jdbc_url")
        for df, table in ((sub, "fs_sub"), (num, "fs_num")):
            writers.jdbc_delete_folders(spark, jdbc_url, table, pending, jdbc_props)
            writers.write_jdbc(df, jdbc_url, table, "append", jdbc_props)
        ledger_rows = spark.createDataFrame([(f,) for f in pending], writers.LEDGER_SCHEMA)
        writers.write_jdbc(ledger_rows, jdbc_url, "recorded", "append", jdbc_props)
    else:
        raise ValueError(f"unknown sink {sink!r}")

    writers.record_folders(spark, ledger_path, pending)
    return sorted(pending)


def load_warehouse(spark: SparkSession, raw_root: str, out_root: str, folders: list[str],
                   companies: Iterable[int] | DataFrame | None, replace: bool = False,
                   pattern: str = src.PATTERN, buckets: int = warehouse.BUCKETS) -> list[str]:
    """Load the folders that the manifest hasn't recorded (all of them with ``replace``); those made visible.

    ``buckets`` is chosen with the first load and stays: about the facts of a
    quarter over 256 MB, or the cores of the cluster for many quarters at once.
    """
    done = set() if replace else set(warehouse.latest(spark, out_root).recorded)
    pending = sorted({f for f in folders if f not in done})
    if not pending:
        return []
    sub = select_filings(src.read_sub(spark, raw_root, pending, pattern), companies)
    num = keep_period_facts(src.read_num(spark, raw_root, pending, pattern), sub)
    written = warehouse.write_load(spark, out_root, warehouse.layouts(sub, num, buckets))
    return warehouse.commit(spark, out_root, written, pending, replace)


def read_loaded(spark: SparkSession, out_root: str) -> tuple[DataFrame, DataFrame]:
    """The loaded filing and fact tables (folder is a partition column)."""
    return spark.read.parquet(f"{out_root}/fs_sub"), spark.read.parquet(f"{out_root}/fs_num")


def ingest_prices(wide: DataFrame, out_path: str, sink: str = "parquet",
                  jdbc_url: str | None = None, jdbc_props: dict[str, str] | None = None) -> None:
    """Daily bars: staged wide download -> long (Date, Ticker) rows -> full replace."""
    bars = wide_to_long(wide)
    if sink == "parquet":
        writers.write_replace(bars, out_path)
    elif sink == "jdbc":
        writers.write_jdbc(bars, jdbc_url, "stock", "overwrite", jdbc_props)
    else:
        raise ValueError(f"unknown sink {sink!r}")
