"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import ensure_checkpoint_dir

BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first longer form of it that no column of ``df`` has (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def keep(spark: SparkSession, df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back: later steps
    start from files that every executor can read, also after one is lost. ``options``: of the writer."""
    path = shared(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_starmart_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="starmart-code-")) / "starmart_code.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._starmart_shipped = True


def mapped(df: DataFrame, task, schema) -> DataFrame:
    """``mapInArrow`` with a task whose code lives in this package. Whole texts travel in batches of
    ``BATCH_ROWS`` rows at most, which bounds what a task and its JVM hold at a time."""
    spark = df.sparkSession
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))

    def bounded(batches):
        try:
            yield from task(batches)
        finally:
            trim()

    return df.mapInArrow(bounded, schema)


def trim() -> None:
    """Give back what a finished task has freed; its worker lives on for the next one."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if give_back is not None:
        give_back(0)
