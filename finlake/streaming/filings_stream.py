"""Incremental filing ingest with Structured Streaming.

The original pipeline is triggered by hand per quarter folder and keeps a
ledger of loaded folders.  Here a file stream over the landing area is the
trigger: every new ``sub.txt`` or ``num.txt`` of ``<landing>/<yyyyqN>/`` is
picked up by the next micro-batch, and a folder is loaded by the batch ingest
job (:func:`finlake.plans.ingest.ingest_filings`) once it has both; a folder
whose second file is still to come waits for that file's own trigger.  Files
have to appear whole: copy them under a name that begins with ``_`` or ``.``
and rename, as usual for landing areas.

Exactly-once: the stream's checkpoint records which files were handed to a
committed batch; a batch that is retried (lost executor, restarted driver)
re-runs the ingest for the same folders, which overwrites the same folder
partitions and skips folders already in the ledger.  Run it with
``available_now=True`` for scheduled catch-up runs, or with a processing-time
trigger as a long-running job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from finlake.plans.ingest import ingest_filings
from finlake.session import checkpoint_dir, file_listing
from finlake.sources.filings import FOLDER_RE


def arrived_folders(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of the quarter folder of each line of newly arrived files."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    lines = r.load(f"{landing.rstrip('/')}/*/{{sub,num}}.txt")
    return lines.select(F.regexp_extract(F.col("_metadata.file_path"), FOLDER_RE, 1)
                        .alias("folder"))


def start_filing_stream(
    spark: SparkSession,
    landing: str,
    out_root: str,
    ledger_path: str | None = None,
    companies: Iterable[int] | DataFrame | None = None,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    max_files: int | None = None,
    sink: str = "parquet",
) -> StreamingQuery:
    """Start the incremental ingest; returns the running query.

    With the ``warehouse`` sink a folder's filings, facts and ledger entry
    become visible together (no ``ledger_path`` then).
    """
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/filings"

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        # distinct folder names of this batch: a handful per trigger
        folders = sorted(r.folder for r in batch.select("folder").distinct().collect()
                         if r.folder)
        folders = [f for f in folders if {"sub.txt", "num.txt"} <= {
            name for name, *_ in file_listing(batch.sparkSession, f"{landing.rstrip('/')}/{f}")}]
        if folders:
            ingest_filings(batch.sparkSession, landing, out_root, folders, companies, ledger_path, sink)

    w = arrived_folders(spark, landing, max_files).writeStream.foreachBatch(load_batch) \
        .option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
