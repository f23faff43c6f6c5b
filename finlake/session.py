"""Spark session settings shared by jobs, tests and the bench.

On a cluster the session comes from the launcher; ``configure`` only fills in
settings that were not given, so cluster-wide choices always win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for the workload: many mid-sized shuffles (per-company
# aggregates, date-keyed joins) where AQE coalescing and skew splitting matter
# more than a fixed partition count.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # the size check behind every broadcast: planner estimate, then AQE's
    # runtime measurement; bigger sides are sort-merge joined (skew split by AQE)
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # remove checkpoint files once their DataFrame is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "finlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts, as the cluster names it.

    Reads ``spark.checkpoint.dir`` (or the context's directory).  When nothing
    is configured a cluster session raises; only a session in one local process
    (``local[n]``) gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if re.fullmatch(r"local(\[.*\])?", sc.master):  # one process: its own folder is shared by all it runs
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="finlake-checkpoints-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; configure a shared folder for the cluster"
    )


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the configured folder; set ``fallback`` only where none is set (tests)."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        os.makedirs(fallback, exist_ok=True)
        spark.sparkContext.setCheckpointDir(fallback)
        return spark.sparkContext.getCheckpointDir() or fallback


def object_store_conf(access_key: str | None = None, secret_key: str | None = None,
                      endpoint: str | None = None) -> dict[str, str]:
    """Settings for reading ``s3a://`` paths; keys are passed in, never stored in code.

    Without keys the default credential chain of the cluster is used.
    """
    conf = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if access_key and secret_key:
        conf.update({
            "spark.hadoop.fs.s3a.aws.credentials.provider":
                "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
            "spark.hadoop.fs.s3a.access.key": access_key,
            "spark.hadoop.fs.s3a.secret.key": secret_key,
        })
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    return conf


def cut_lineage(df):
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    Columnar files are smaller than checkpointed rows and let later passes read
    only the columns they need.  Each call has a folder of its own; they are
    the cluster's scratch data.  Without a configured folder the DataFrame is
    returned as is (recomputed where reused); a machine-local folder is never
    substituted.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        return df
    path = f"{root.rstrip('/')}/finlake-cut/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df):
    """``df`` written as Parquet to the shared checkpoint folder and read back, for steps that must see the same rows
    in the same partitions; on a cluster without such a folder this raises."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/finlake-cut/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modified) of the file, or of the files right under the folder, by Spark's file system.

    Works for every path that Spark reads; empty when there is nothing.
    """
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(jpath):
        return []
    found = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(jpath)]
    return sorted(found)
