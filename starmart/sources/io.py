"""Readers and sinks: raw CSV extracts, reject log, exception sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

CORRUPT = "_corrupt_record"


def read_csv_extract(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """S1: scan a raw CSV extract (header row) with an explicit schema.

    No schema inference (a full extra pass, and zip prefixes would lose
    leading zeros). Rows that do not fit the schema are kept with their raw
    text in ``_corrupt_record`` (PERMISSIVE mode) for the reject route.
    """
    return (
        spark.read.schema(f"{schema}, {CORRUPT} string")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def with_arrival(files: DataFrame) -> DataFrame:
    """``arrived_at``: when the file that holds a row was written (for frames that read files)."""
    return files.withColumn("arrived_at", F.col("_metadata.file_modification_time").cast("timestamp_ntz"))


def read_if_exists(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The parquet table at ``path``, or None where the path does not exist.

    Any other failure (storage, unreadable footers) is raised: it must never
    look like a table that was not created yet. With ``schema``, a folder
    that holds no files yet (partitioned, no rows) is an empty table.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def nan_to_null(df: DataFrame) -> DataFrame:
    """S10: float NaN becomes a real NULL (never carry NaN into the warehouse)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.when(~F.isnan(c), c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_rejects(rejects: DataFrame, base: str, run_id: str, name: str = "reject_log") -> str:
    """S4: append the run's rejects under ``run_id=<id>`` (one folder per run)."""
    path = f"{base.rstrip('/')}/{name}"
    rejects.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)
    return path


def write_exceptions(rows: DataFrame, path: str) -> str:
    """S6: exception sink. Always written (an empty result is one empty
    folder) instead of counting first, which would run the plan twice."""
    rows.write.mode("overwrite").parquet(path)
    return path
