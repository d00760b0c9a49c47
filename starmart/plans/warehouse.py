"""Warehouse tables under one commit log.

A table is a set of immutable folders ``<base>/<table>/load=<id>[/partition=value]``. A commit names
the folders of every table; it is written as one file, so it is there whole or
not at all. Readers resolve the latest commit (or an earlier one): what a run wrote
before it died belongs to no commit and is never read. Several tables change
together or not at all: the fact, its failure queue and the control log are one
commit. Folders are named, not files, so a manifest grows with the number of loads
and rewritten partitions, never with the data.

One run writes a warehouse at a time (as the load jobs of a schedule do); a second commit on the
same parent is found out and raised by the run that made it, and the first one stays.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.io import read_if_exists

MANIFEST = "seq long, commit_id string, parent string, committed_at timestamp_ntz, table_name string, columns string, folder string, partition string"
ROWS_PER_FILE = 10_000_000
# tables that are stored in parts
PARTS = {"dim_customer": ("dim_customer_current", "dim_customer_history")}
LOG = "etl_control_log"


class CommitConflict(RuntimeError):
    """Another run committed on the same parent first."""


@dataclass(frozen=True)
class Snapshot:
    seq: int
    commit_id: str
    folders: dict[str, dict[str, str]]  # table -> {folder: partition value, '' for a whole load}
    columns: dict[str, str]  # table -> its columns, as DDL


EMPTY = Snapshot(0, "", {}, {})


class Warehouse:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    # -------------------------------------------------------------- reading
    def log(self) -> DataFrame | None:
        """All manifests, or None before the first commit."""
        schema = self.spark.createDataFrame([], MANIFEST).schema
        return read_if_exists(self.spark, f"{self.base}/_commits", schema)

    def snapshot(self, seq: int | None = None) -> Snapshot:
        """The latest snapshot, or the one of commit number ``seq``. Of two commits with one number the earlier counts."""
        log = self.log()
        if log is None:
            return EMPTY
        wanted = log.agg(F.max("seq")).first()[0] if seq is None else seq  # one scalar
        rows = log.where(F.col("seq") == wanted).collect()  # a row for each live folder
        if not rows:
            return EMPTY
        first = min((r["committed_at"], r["commit_id"]) for r in rows)[1]
        folders: dict[str, dict[str, str]] = {}
        columns: dict[str, str] = {}
        for r in rows:
            if r["commit_id"] == first:
                columns[r["table_name"]] = r["columns"]
                own = folders.setdefault(r["table_name"], {})
                if r["folder"]:
                    own[r["folder"]] = r["partition"]
        return Snapshot(wanted, first, folders, columns)

    def read(self, table: str, at: Snapshot | None = None) -> DataFrame | None:
        """A table as of a snapshot (default: the latest); None if no commit has it."""
        snap = self.snapshot() if at is None else at
        if table in PARTS:
            parts = [p for p in (self.read(n, snap) for n in PARTS[table]) if p is not None]
            return parts[0].unionByName(parts[1]) if len(parts) > 1 else (parts or [None])[0]
        if table not in snap.folders:
            return None
        schema = StructType.fromDDL(snap.columns[table])
        names = sorted(snap.folders[table])
        if not names:
            return self.spark.createDataFrame([], schema)
        top = f"{self.base}/{table}"
        found = self.spark.read.schema(schema).option("basePath", top).parquet(*[f"{top}/{n}" for n in names])
        return found.select(*schema.names)

    def last_load(self, table: str) -> DataFrame:
        """The rows that the latest commit added to a table; none if it left the table as it was."""
        snap = self.snapshot()
        before = self.snapshot(snap.seq - 1) if snap.seq > 1 else EMPTY
        own = snap.folders.get(table, {})
        new = {f: p for f, p in own.items() if f not in before.folders.get(table, {})}
        return self.read(table, Snapshot(snap.seq, snap.commit_id, {table: new}, snap.columns))

    # -------------------------------------------------------------- writing
    def begin(self, log_id: int, target: str, run_by: str = "starmart") -> Transaction:
        return Transaction(self, log_id, target, run_by)

    def write(self, df: DataFrame, path: str, partition_by: Sequence[str] = (), rows_per_file: int = ROWS_PER_FILE) -> None:
        w = df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)

    def commit(self, parent: Snapshot, folders: dict[str, dict[str, str]], columns: dict[str, str]) -> Snapshot:
        """One new snapshot with these folders and columns, as one file."""
        me, now = uuid.uuid4().hex, _dt.datetime.now()
        rows = [(parent.seq + 1, me, parent.commit_id, now, t, columns[t], f, p) for t, own in folders.items() for f, p in (own.items() or [("", "")])]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.base}/_commits")
        done = self.snapshot(parent.seq + 1)
        if done.commit_id != me:
            raise CommitConflict(f"commit {parent.seq + 1} of {self.base} was made by another run")
        return done


class Transaction:
    """Writes that become visible together, with the run's control-log row (L2).

        with warehouse.begin(7, "fact_sales") as tx:
            tx.append("fact_sales", rows, ["fact_year"])
            tx.loaded = rows                  # counted for the log

    On an exception nothing of it becomes visible; a FAILED log row is committed alone, with the message,
    and the exception propagates.
    """

    def __init__(self, warehouse: Warehouse, log_id: int, target: str, run_by: str):
        self.w, self.log_id, self.target, self.run_by = warehouse, log_id, target, run_by
        self.loaded: DataFrame | int = 0
        self.rejected: DataFrame | int = 0
        self.last_loaded_ts = None
        self.load = f"load=r{log_id}-{uuid.uuid4().hex[:12]}"

    def __enter__(self) -> Transaction:
        self.started = _now()
        self.parent = self.w.snapshot()
        self._as_parent()
        return self

    def _as_parent(self) -> None:
        self.folders = {t: dict(own) for t, own in self.parent.folders.items()}
        self.columns = dict(self.parent.columns)

    def read(self, table: str) -> DataFrame | None:
        """A table as of the transaction's start."""
        return self.w.read(table, self.parent)

    def append(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), **options) -> None:
        self.w.write(self._ordered(table, df), f"{self.w.base}/{table}/{self.load}", partition_by, **options)
        self.folders.setdefault(table, {})[self.load] = ""

    def written(self, table: str) -> DataFrame:
        """What this transaction has written to a table."""
        return self.w.spark.read.schema(StructType.fromDDL(self.columns[table])).parquet(f"{self.w.base}/{table}/{self.load}")

    def replace(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), **options) -> None:
        """Truncate and reload: the new snapshot holds this frame alone; earlier ones keep what they had."""
        self.append(table, df, partition_by, **options)
        self.folders[table] = {self.load: ""}

    def replace_partitions(self, table: str, df: DataFrame, column: str, touched: Iterable) -> None:
        """Copy on write: ``df`` has the new rows of the touched values of ``column`` (all others keep their folders)."""
        touched = {str(v) for v in touched}
        old = {f: p for f, p in self.folders.get(table, {}).items() if p not in touched}
        df = self._ordered(table, df)
        # dealt by value; a value with many rows is split over several tasks
        self.w.write(df.hint("rebalance", F.col(column)), f"{self.w.base}/{table}/{self.load}", [column])
        held = [str(r[0]) for r in self.written(table).select(column).distinct().collect()]  # at most the touched values
        if not set(held) <= touched:
            raise ValueError(f"{table}: rows outside the touched partitions")
        self.folders[table] = old | {f"{self.load}/{column}={v}": v for v in held}

    def _ordered(self, table: str, df: DataFrame) -> DataFrame:
        """The frame in the table's order of columns; a new table or new columns are noted for readers."""
        known = StructType.fromDDL(self.columns[table]).names if table in self.columns else []
        if set(known) == set(df.columns):
            df = df.select(*known)
        self.columns[table] = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return df

    def __exit__(self, et, ev, tb) -> bool:
        from .etl import log_row

        spark = self.w.spark
        if et is None:
            row = log_row(spark, self.log_id, self.target, self.started, _now(), self.loaded, self.rejected, self.last_loaded_ts, "SUCCESS", None, self.run_by)
            self.append(LOG, row.coalesce(1))
            self.snapshot = self.w.commit(self.parent, self.folders, self.columns)
        else:
            self.load = f"load=f{self.log_id}-{uuid.uuid4().hex[:12]}"
            self._as_parent()
            self.append(LOG, log_row(spark, self.log_id, self.target, self.started, _now(), 0, 0, None, "FAILED", str(ev), self.run_by).coalesce(1))
            self.w.commit(self.parent, self.folders, self.columns)
        return False


def _now() -> str:
    return _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
