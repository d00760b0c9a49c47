"""Session defaults and the shared checkpoint directory."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in the library relies on.
#  * ANSI on (Spark 4 default): bad casts raise, so coercions use try_* explicitly.
#  * UTC session zone: the warehouse is zone-less (timestamp_ntz); UTC keeps
#    unix_micros-based day arithmetic identical to wall-clock differences.
#  * AQE with skew-join splitting and partition coalescing: dimension joins are
#    converted to broadcast joins at runtime from *measured* stage sizes, and a
#    hot join key is split across tasks.
SESSION_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


# Sizing for a large cluster (100 TB-class inputs, ~1000 executors). Shuffle
# stages start wide and AQE coalesces them to ~256 MB partitions, so one
# setting serves the fact-sized shuffles (fact x customer join) and the
# small aggregates alike; skewed partitions over 5x the median and 512 MB are
# split; scan splits stay at 256 MB; a side is broadcast only below 64 MB.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply the library's SQL defaults to an existing session (and the
    cluster sizing with ``cluster=True``)."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    if cluster:
        for k, v in CLUSTER_DEFAULTS.items():
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "starmart") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server ports)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STARMART_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only when it is unset (local tests) do we create a scratch folder.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="starmart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


# Spark removes the shuffle files of a query when the query ends, not when the driver's garbage collector finds them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_jobs = {"open": 0, "before": "false"}
_kept: ContextVar[list[str] | None] = ContextVar("kept", default=None)


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """A job that leaves its tables alone on disk: the shuffle files of each of its queries go when that query ends, the frames
    it stored (``stored``) when the job does. Jobs may lie within each other or run side by side."""
    with _lock:
        if _jobs["open"] == 0:
            _jobs["before"] = spark.conf.get(FREE_SHUFFLES)
            spark.conf.set(FREE_SHUFFLES, "true")
        _jobs["open"] += 1
    own = _kept.set([])
    try:
        yield
    finally:
        paths = _kept.get()
        _kept.reset(own)
        with _lock:
            _jobs["open"] -= 1
            if _jobs["open"] == 0:
                spark.conf.set(FREE_SHUFFLES, _jobs["before"])
        jvm = spark.sparkContext._jvm
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """The frame written once as parquet under the shared checkpoint folder, and read back: what a checkpoint does, in compressed
    columns (a checkpoint of lines holds several times their bytes), of which a reader takes those it needs. Within a job
    (``tidied``) it is there until the job ends."""
    path = scratch_path(df.sparkSession, f"stored-{uuid.uuid4().hex}")
    kept = _kept.get()
    if kept is not None:
        kept.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
