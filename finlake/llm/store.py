"""Helpers shared by the operators: stored intermediates, ids, column names."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.session import checkpoint_dir

#: ``_d`` of a row without an id: such rows sort behind all others
NULL_ID = 2**63 - 1

#: Spark's setting that drops a query's shuffle files at its end
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: whole texts travel in Arrow batches; these bound a batch where the session doesn't
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
           "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20)}


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: what follows reads files every executor can reach, so a
    lost executor costs only the tasks it ran.  The folder is a new one for
    each call.  The write's own shuffle files go as soon as it has ended: nothing
    reads them again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/finlake-llm/{uuid.uuid4().hex}/{name}"
    _written(spark).append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _written(spark: SparkSession) -> list[str]:
    """Folders that this context's operators have written, in order."""
    sc = spark.sparkContext
    if not hasattr(sc, "_finlake_written"):
        sc._finlake_written = []
    return sc._finlake_written


def mark(spark: SparkSession) -> int:
    """A place in the order of what is written, for :func:`release`."""
    return len(_written(spark))


def release(spark: SparkSession, since: int, keep: DataFrame) -> None:
    """Remove the intermediates written since the mark, but for the stored table that ``keep`` reads.

    For a job that has stored its result and holds no other table made since.
    """
    mine = _written(spark)
    files = keep.inputFiles()
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for k in range(since, len(mine)):
        folder = mine[k] and mine[k].rsplit("/", 1)[0]
        if folder and files and not any(folder.rsplit("/", 1)[1] in f for f in files):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
            mine[k] = ""


def is_held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of the id's text leaves remainder 0; false for a null id."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(rest == 0, F.lit(False))


def ordered_id(doc_id: Column) -> Column:
    """The id as a number that sorts null ids last."""
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_ID))


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """``_d``, ``_t``: rows that repeat an id are told apart by their text."""
    return [ordered_id(doc_id).alias("_d"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_t")]


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once per context; bound the Arrow batches."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    sc = spark.sparkContext
    if getattr(sc, "_finlake_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="finlake-"), "finlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._finlake_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_text(df: DataFrame, fn, fields: str, rows: int = 512) -> DataFrame:
    """``df`` with its ``text`` replaced by what ``fn`` makes of it.

    ``fn`` takes a list of texts (None for null) and returns a list of columns,
    in the order of ``fields`` (DDL).  The other columns pass through as Arrow
    arrays, nulls and all; ``rows`` texts are held at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(df.sparkSession)
    carry = [c for c in df.columns if c != "text"]
    made = T._parse_datatype_string(fields)
    schema = T.StructType([df.schema[c] for c in carry] + made.fields)
    arrow = to_arrow_schema(made)

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, rows):
                b = whole.slice(low, rows)
                out = fn(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in carry), *(pa.array(v, f.type) for v, f in zip(out, arrow))],
                    names=[*carry, *arrow.names])

    return df.select(*carry, "text").mapInArrow(run, schema)
