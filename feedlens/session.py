"""SparkSession helpers.

Cluster settings (shuffle partitions, checkpoint folder, memory) belong to
whoever launches the job; these helpers only fill in values that are unset,
which is what local tests and the bench need.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "feedlens",
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder from ``spark.checkpoint.dir``; a scratch one only if unset.

    On a cluster the launcher names a shared folder in ``spark.checkpoint.dir``
    and that is used as is.  A local scratch folder is created only when the
    setting is missing, which happens in tests and local runs.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="feedlens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the parquet tables of a test-data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shuffle_partitions(df) -> int:
    """The session's ``spark.sql.shuffle.partitions`` (cluster-sized on a cluster).

    Used as an explicit count for CPU-heavy repartitions, which AQE would
    otherwise coalesce down to a few tasks when the bytes are small.
    """
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df, *cols):
    """Spread an input that arrives in fewer splits than the cluster has cores.

    A large table on a cluster already has many splits and is returned as
    is; a small file (one row group) is hash-partitioned by ``cols`` so the
    CPU-heavy text work that follows runs on every core.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # no RDD view (e.g. a Connect session): leave the input as is
        return df
    return df.repartition(max(target, shuffle_partitions(df)), *cols)


def materialize(df):
    """``df`` computed once and kept in the cluster's checkpoint folder.

    Used at stage boundaries that several later steps read (valid sentences,
    scores, assignments): the returned frame reads the files, so later plans
    stay small and a lost executor never replays earlier stages.  Parquet files,
    as :func:`stored` writes them, take a fraction of a checkpoint with its cache.
    """
    return stored(df)


def stored(df):
    """``df`` written once as Parquet in the checkpoint folder, and read from there.

    One job, and a cut of the lineage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
