"""Load orchestration: incremental fact loads, SCD2 runs, run log, snapshots.

Tables are plain parquet directories. A table that is replaced (a dimension
snapshot, a full fact reload) is written to a new version directory and a
one-row pointer is switched only after the write succeeded, so a failed run
never leaves a half-written table behind (no in-place UPDATE/TRUNCATE).
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dims as D
from ..operators import facts as FA
from ..operators import reconcile as R
from ..operators import staging as S
from ..session import stored, tidied
from ..sources import fixtures as FX
from ..sources.io import nan_to_null
from .star import Params, build_dims, fact_of_extract, stage_all
from .warehouse import LOG, ROWS_PER_FILE, Snapshot, Transaction, Warehouse

CONTROL_LOG_SCHEMA = (
    "log_id long, target_table string, run_start_ts timestamp_ntz, run_end_ts timestamp_ntz, "
    "records_loaded long, records_rejected long, last_loaded_ts timestamp_ntz, status string, "
    "error_message string, run_by string"
)


# ------------------------------------------------------------------ watermark
def watermark_of(stg_orders: DataFrame, fact: DataFrame) -> DataFrame:
    """One-row frame: the latest purchase time among orders present in the
    fact (the *data* clock; the load wall-clock never selects anything
    after the data ends)."""
    loaded = stg_orders.join(fact.select("order_id").distinct(), "order_id", "left_semi")
    return loaded.agg(F.max("order_purchase_timestamp").alias("watermark"))


def after_watermark(stg_orders: DataFrame, watermark) -> DataFrame:
    """``purchase > watermark`` for a literal (pushed to the scan) or a
    one-row frame (broadcast; NULL watermark selects everything)."""
    if watermark is None or isinstance(watermark, (str, _dt.datetime)):
        return FA.incremental_orders(stg_orders, watermark)
    wm = F.broadcast(watermark.select(F.col("watermark").alias("_wm")))
    ts = F.col("order_purchase_timestamp")
    return stg_orders.crossJoin(wm).where(F.col("_wm").isNull() | (ts > F.col("_wm"))).drop("_wm")


def incremental_fact(
    spark: SparkSession, src: dict[str, DataFrame], p: Params, first_extract_before: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Two loads: first the extract of orders placed before
    ``first_extract_before``, then the full extract after the watermark of
    the first load. Returns (batch1, batch2, union). The union equals a full
    load; batch2 is guarded against re-appending loaded orders."""
    full_stg = stage_all(src, p)
    dims = build_dims(spark, src, full_stg, p)  # stable keys across both runs

    cut = F.lit(first_extract_before).cast("timestamp_ntz")
    src1 = dict(src, orders=src["orders"].where(F.col("order_purchase_timestamp") < cut))
    so1 = S.stage_orders(src1["orders"]).kept

    def fact_of(cleaned, orders):
        return fact_of_extract(src, {**full_stg, "stg_orders": cleaned}, dims, p, orders).fact

    batch1 = stored(fact_of(so1, so1))  # read three times: watermark, guard, union
    wm = watermark_of(so1, batch1)
    batch2 = fact_of(full_stg["stg_orders"], after_watermark(full_stg["stg_orders"], wm))
    batch2 = FA.dedupe_against(batch2, batch1)
    return batch1, batch2, batch1.unionByName(batch2)


# ------------------------------------------------------------------ SCD2 runs
def scd2_runs(spark: SparkSession, sf_dir: str, runs: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """Apply a sequence of customer feeds ``(feed_as_of, run_date)`` to an
    empty dimension. Returns the final snapshot and per-run action counts."""
    dim, closed = D.empty_dim_customer(spark), None
    counts = []
    for i, (as_of, run_date) in enumerate(runs, start=1):
        feed = S.stage_customers(FX.customer_feed(spark, sf_dir, as_of), run_date)
        r = D.scd2_merge(dim, feed, run_date)
        # Each snapshot is materialised before the next run reads it (as the
        # ETL job writes it); this also keeps the lineage short.
        # Closed versions are done with; the next run reads current rows only.
        versions = r.dim.checkpoint(eager=True)
        dim, ended = versions.where("is_current"), versions.where("not is_current")
        closed = ended if closed is None else closed.unionByName(ended)
        counts.append(D.scd2_action_counts(r.actions).withColumn("run", F.lit(i)))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return dim.unionByName(closed), out


# ------------------------------------------------------------------ run log
def log_row(
    spark: SparkSession,
    log_id: int,
    target: str,
    started: str,
    ended: str,
    loaded: DataFrame | int,
    rejected: DataFrame | int = 0,
    last_loaded_ts=None,
    status: str = "SUCCESS",
    error: str | None = None,
    run_by: str = "starmart",
) -> DataFrame:
    """One control-log row. ``loaded``/``rejected`` may be counts or frames
    (counted lazily by a one-row aggregate, never collected)."""
    def cnt(x, name):
        if isinstance(x, DataFrame):
            return x.agg(F.count(F.lit(1)).alias(name))
        return spark.range(1).select(F.lit(int(x)).cast("long").alias(name))

    row = cnt(loaded, "records_loaded").crossJoin(cnt(rejected, "records_rejected"))
    return row.select(
        F.lit(log_id).cast("long").alias("log_id"),
        F.lit(target).alias("target_table"),
        F.lit(started).cast("timestamp_ntz").alias("run_start_ts"),
        F.lit(ended).cast("timestamp_ntz").alias("run_end_ts"),
        F.col("records_loaded").cast("long"),
        F.col("records_rejected").cast("long"),
        F.lit(last_loaded_ts).cast("timestamp_ntz").alias("last_loaded_ts"),
        F.lit(status).alias("status"),
        F.lit(error).cast("string").alias("error_message"),
        F.lit(run_by).alias("run_by"),
    )


class run_logged:  # noqa: N801  (used as a context manager)
    """L2: time a load and produce its control-log row (SUCCESS or FAILED).

        with run_logged(spark, 5, "fact_sales") as log:
            write(...)
            log.loaded = fact_df          # counted lazily
        log.row  ->  one-row DataFrame, appended to the control log at ``sink`` if given

    On an exception the row records FAILED with the whole message, is stored
    like any other and the exception propagates.
    """

    def __init__(self, spark: SparkSession, log_id: int, target: str, run_by: str = "starmart", sink: str | None = None):
        self.spark, self.log_id, self.target, self.run_by, self.sink = spark, log_id, target, run_by, sink
        self.loaded, self.rejected, self.last_loaded_ts, self.row = 0, 0, None, None

    def __enter__(self):
        self.started = _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
        return self

    def __exit__(self, et, ev, tb):
        ended = _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
        if et is None:
            self.row = log_row(self.spark, self.log_id, self.target, self.started, ended, self.loaded, self.rejected,
                               self.last_loaded_ts, "SUCCESS", None, self.run_by)
        else:
            self.row = log_row(self.spark, self.log_id, self.target, self.started, ended, 0, 0, None, "FAILED",
                               str(ev), self.run_by)
        if self.sink is not None:
            self.row.write.mode("append").parquet(self.sink)
        return False


def load_dim_date_if_empty(spark: SparkSession, existing: DataFrame, start: str, end: str) -> DataFrame | None:
    """D1: build the calendar only when the table is empty (idempotent)."""
    if existing.limit(1).count() > 0:
        return None
    return D.build_dim_date(spark, start, end)


def last_watermark(control_log: DataFrame, target: str = "fact_sales") -> DataFrame:
    """``max(last_loaded_ts)`` over successful loads of ``target`` (one row)."""
    return control_log.where((F.col("target_table") == target) & (F.col("status") == "SUCCESS")).agg(
        F.max("last_loaded_ts").alias("watermark")
    )


def load_mode(fact: DataFrame) -> str:
    """FULL when the fact is empty, else INCREMENTAL (a ``limit(1)`` probe)."""
    return "FULL" if fact.limit(1).count() == 0 else "INCREMENTAL"


# ------------------------------------------------------------------ snapshots
def write_snapshot(
    df: DataFrame, base: str, name: str, version: str, partition_by: Sequence[str] = (), pointer: bool = True
) -> str:
    """Write ``df`` as ``base/name/v=<version>``; then (``pointer``) switch the
    table's current-version pointer, so readers never see a partial table."""
    path = f"{base.rstrip('/')}/{name}/v={version}"
    w = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if not pointer:
        return path
    spark = df.sparkSession
    # the pointer only grows: the last row is current, and there is no moment without one
    spark.createDataFrame([(version, time.time_ns())], "version string, seq long").coalesce(1).write.mode("append").parquet(
        f"{base.rstrip('/')}/{name}/_current"
    )
    return path


def read_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame:
    return _at_pointer(spark, spark.read.parquet(f"{base.rstrip('/')}/{name}/_current"), base, name)


def _at_pointer(spark: SparkSession, pointer: DataFrame, base: str, name: str) -> DataFrame:
    v = pointer.agg(F.max_by("version", "seq").alias("version")).first()["version"]  # one row
    return spark.read.parquet(f"{base.rstrip('/')}/{name}/v={v}")


def write_all(frames: dict[str, DataFrame], base: str, version: str, pointer: bool, workers: int = 4) -> dict[str, str]:
    """Write independent tables as concurrent Spark jobs (one thread each)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=workers) as ex:
        futs = {k: ex.submit(write_snapshot, df, base, k, version, (), pointer) for k, df in frames.items()}
        return {k: f.result() for k, f in futs.items()}


def land_raw(src: dict[str, DataFrame], base: str, version: str) -> dict[str, DataFrame]:
    """S1: land the raw extract once as typed parquet; staging reads it from
    there, so whatever produced the extract is never recomputed."""
    paths = write_all({f"raw_{k}": v for k, v in src.items()}, base, version, pointer=False)
    spark = next(iter(src.values())).sparkSession
    return {k: spark.read.parquet(paths[f"raw_{k}"]) for k in src}


def run_etl(
    spark: SparkSession, src: dict[str, DataFrame], p: Params, base: str, version: str, land: bool = True
) -> dict[str, str]:
    """Full ETL: land the extract (unless already landed), staging tables,
    dimensions, fact (partitioned by year), each written once. Returns the
    written paths."""
    if land:
        src = land_raw(src, base, version)
    stg = stage_all(src, p, materialize=True)
    names = ("stg_orders", "stg_items", "stg_customers", "stg_products", "stg_payments", "stg_rejects")
    paths = write_all({k: stg[k] for k in names}, base, version, pointer=False)
    stg_r = {k: spark.read.parquet(v) for k, v in paths.items()}
    dims = build_dims(spark, src, stg_r, p)
    paths.update(write_all(dims, base, version, pointer=True))
    dims_r = {k: spark.read.parquet(paths[k]) for k in dims}
    fb = FA.build_fact(
        stg_r["stg_items"], stg_r["stg_orders"], stg_r["stg_payments"], dims_r["dim_customer"], dims_r["dim_product"],
        dims_r["dim_seller"], p.run_date, materialize=True,
    )
    # Year partitions, rows sorted by date within each file: parquet min/max
    # statistics then skip row groups for month/day slices as well.
    fact = fb.fact.withColumn("fact_year", (F.col("date_key") / 10000).cast("int")).sortWithinPartitions(
        "fact_year", "date_key"
    )
    paths["fact_sales"] = write_snapshot(fact, base, "fact_sales", version, partition_by=["fact_year"])
    fails = fb.failures.withColumn("failed_dims", F.array_join("failed_dims", ","))
    paths["fact_failures"] = write_snapshot(fails, base, "fact_lookup_failures", version, pointer=False)
    return paths


def write_star_bucketed(
    spark: SparkSession, star: dict[str, DataFrame], base: str, prefix: str, buckets: int,
    key: str = "customer_key",
) -> dict[str, DataFrame]:
    """Write ``fact_sales`` and ``dim_customer`` as catalog tables bucketed
    and sorted by ``key`` (files under ``base``). Customer-level analytics
    (RFM, Pareto, cohorts) then join and aggregate the fact without a
    shuffle: both sides already share the hash partitioning on ``key``.
    Returns the star with the two tables read back from the catalog."""
    out = dict(star)
    for name in ("fact_sales", "dim_customer"):
        table = f"{prefix}_{name}"
        (
            star[name].write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
            .option("path", f"{base.rstrip('/')}/{table}").saveAsTable(table)
        )
        out[name] = spark.table(table)
    return out


def batch_days(fact: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of the written fact on the days of ``batch``: years as literals, so other year folders
    are never listed or read, and days by a broadcast of at most the calendar's days."""
    days = batch.select((F.col("date_key") / 10000).cast("int").alias("fact_year"), "date_key").distinct().checkpoint(eager=True)
    years = [r["fact_year"] for r in days.select("fact_year").distinct().collect()]  # at most the calendar's years
    return fact.where(F.col("fact_year").isin(years)).join(F.broadcast(days.select("date_key")), "date_key", "left_semi")


QUEUE = "fact_failure_queue"
QUEUE_KEY = ("order_id", "order_item_id", "product_id", "seller_id")


def merge_failures(tx: Transaction, assembled: DataFrame, run: int) -> None:
    """F5/S6: the failure queue holds each line that ever failed a lookup once, with its state (pending or loaded),
    the number of attempts, and the first and last run that tried it. The outcomes of a run are merged by
    line into the months that hold them; other months keep their files. Lines with equal business keys
    are one row with their number. ``assembled``: all lines of the run with ``failed_dims``, stored."""
    old = tx.read(QUEUE)
    bad = F.size("failed_dims") > 0
    month = F.coalesce(F.year("order_purchase_timestamp") * 100 + F.month("order_purchase_timestamp"), F.lit(0)).alias("fail_month")
    tried = assembled.select(*QUEUE_KEY, month, bad.alias("bad"), F.array_join("failed_dims", ",").alias("failed_dims"))
    out = tried.where("bad")
    if old is not None:
        # a line that loads matters only if it failed before
        waiting = old.where("state = 'pending'").select(*[F.col(c).alias(f"_{c}") for c in QUEUE_KEY])
        out = out.unionByName(tried.where(~F.col("bad")).join(waiting, _same(QUEUE_KEY, "_"), "left_semi"))
    out = out.groupBy(*QUEUE_KEY).agg(
        F.max("fail_month").alias("fail_month"), F.max(F.col("bad").cast("int")).alias("bad"), F.count(F.lit(1)).alias("lines"), F.max("failed_dims").alias("failed_dims")
    )
    out = stored(out)
    touched = [r[0] for r in out.select("fail_month").distinct().collect()]  # at most the calendar's months
    if not touched:
        return
    runs = F.lit(run).cast("long")
    new = out.select(*[F.col(c).alias(f"_{c}") for c in QUEUE_KEY], F.col("fail_month").alias("_month"), F.col("bad").alias("_bad"), F.col("lines").alias("_lines"), F.col("failed_dims").alias("_failed"))
    if old is None:
        old = tx.w.spark.createDataFrame([], queue_schema(out))
    both = old.where(F.col("fail_month").isin(touched)).withColumn("_old", F.lit(True)).join(new, _same(QUEUE_KEY, "_"), "full")
    hit = F.col("_bad").isNotNull()
    key = [F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in QUEUE_KEY]
    merged = both.select(
        *key,
        F.when(hit, F.when(F.col("_bad") > 0, F.lit("pending")).otherwise(F.lit("loaded"))).otherwise(F.col("state")).alias("state"),
        F.when(F.col("_bad") > 0, F.col("_failed")).otherwise(F.col("failed_dims")).alias("failed_dims"),
        F.when(hit, F.col("_lines")).otherwise(F.col("lines")).alias("lines"),
        (F.coalesce("attempts", F.lit(0)) + hit.cast("int")).cast("int").alias("attempts"),
        F.coalesce("first_run", runs).alias("first_run"),
        F.when(hit, runs).otherwise(F.col("last_run")).alias("last_run"),
        F.coalesce("fail_month", "_month").alias("fail_month"),
    )
    tx.replace_partitions(QUEUE, merged, "fail_month", touched)


def queue_schema(lines: DataFrame) -> str:
    """Columns of the failure queue for lines with these key types."""
    kinds = dict(lines.dtypes)
    return ", ".join(f"{c} {kinds[c]}" for c in QUEUE_KEY) + ", state string, failed_dims string, lines long, attempts int, first_run long, last_run long, fail_month int"


def _same(keys: Sequence[str], prefix: str):
    """Null-safe equality of each key with its prefixed twin."""
    cond = F.lit(True)
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return cond


def lines_since(items: DataFrame, orders: DataFrame, staged: DataFrame, watermark: _dt.datetime) -> DataFrame:
    """The staged lines that the selected ``orders`` can meet: before any lookup, so that an incremental load does not shuffle
    the lines of all orders. A line has the day of its staged order: those from the watermark's day on are taken by
    it, earlier ones by id if an earlier order is selected too (it waits, or has the id of a new one)."""
    day = int(watermark.strftime("%Y%m%d"))
    early = F.coalesce(F.col("date_key") < day, F.lit(False))
    older = staged.where(early).select("order_id")
    again = stored(older.join(orders.select("order_id"), "order_id", "left_semi").distinct())
    n = again.count()
    if 4 * n > older.count():  # most of them: the join with their orders finds them as cheaply
        return items
    recent = items.where(~early)
    return recent if n == 0 else recent.unionByName(items.where(early).join(again, "order_id", "left_semi"))


def load_fact(
    spark: SparkSession,
    stg: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    base: str,
    run_date: str,
    log_id: int,
    purchase_time_fixed: bool = True,
    full_reload: bool = False,
    watermark_basis: str = "data",
    rows_per_file: int = ROWS_PER_FILE,
) -> dict:
    """Phase-4 job: F1 load mode, F2 watermark from the control log, F3
    selection, F4-F6 assembly, F7 load, L2 control-log row.

    FULL (no fact yet, an empty one, or ``full_reload``) replaces the table; INCREMENTAL selects
    orders after the last successful watermark and those with lines pending in the
    failure queue, drops lines already loaded (N7) and appends. Fact, failure queue, the audit of required columns (P26) and
    control log change in one commit (N8): a run that dies at any point leaves the tables as they were. The guard reads only the
    fact's years and days that the batch holds, as an order keeps its purchase
    time; ``purchase_time_fixed=False`` compares with the whole fact. The
    watermark is the latest purchase time loaded; with ``watermark_basis='load_time'`` it is the latest arrival
    (column ``arrived_at`` of the staged orders, see ``sources.io.with_arrival``), so orders placed earlier that arrive late are found (N6).
    A failure ends the run, with a FAILED row in the control log. Returns
    mode, rows loaded, lookup failures, watermark.
    """
    clock = {"data": "order_purchase_timestamp", "load_time": "arrived_at"}[watermark_basis]
    with tidied(spark), Warehouse(spark, base).begin(log_id, "fact_sales") as tx:
        existing = tx.read("fact_sales")
        mode = "FULL" if full_reload or existing is None else load_mode(existing)
        wm = None
        if mode == "INCREMENTAL":
            past = tx.read(LOG)
            wm = last_watermark(past).first()["watermark"] if past is not None else None  # one scalar
        orders = FA.incremental_orders(stg["stg_orders"], wm, clock)
        queue = tx.read(QUEUE) if wm is not None else None
        if queue is not None:  # orders up to the watermark with lines that wait
            old = stg["stg_orders"].where(F.col(clock) <= F.lit(wm).cast("timestamp_ntz"))
            waiting = queue.where("state = 'pending'").select("order_id").distinct()
            orders = orders.unionByName(old.join(waiting, "order_id", "left_semi"))
        lines = FA.fact_inputs(stg["stg_items"])
        if wm is not None and watermark_basis == "data" and purchase_time_fixed and "date_key" in lines.columns:
            lines = lines_since(lines, orders, stg["stg_orders"], wm)
        fb = FA.build_fact(
            lines, orders, stg["stg_payments"], dims["dim_customer"], dims["dim_product"], dims["dim_seller"],
            run_date, materialize=True,
        )
        rows = nan_to_null(fb.fact)
        if mode == "INCREMENTAL":
            rows = FA.dedupe_against(rows, batch_days(existing, rows) if purchase_time_fixed else existing)
        # Year partitions, rows sorted by date within each file: parquet min/max
        # statistics then skip row groups for month/day slices as well.
        rows = rows.withColumn("fact_year", (F.col("date_key") / 10000).cast("int"))
        put = tx.replace if mode == "FULL" else tx.append
        put("fact_sales", rows.sortWithinPartitions("fact_year", "date_key"), ["fact_year"], rows_per_file=rows_per_file)
        merge_failures(tx, fb.assembled, log_id)
        tx.append("fact_required_audit", FA.required_column_audit(fb.assembled).withColumn("run", F.lit(log_id).cast("long")).coalesce(1))
        written = tx.written("fact_sales")
        tx.loaded, tx.rejected = written, fb.failures
        seen = watermark_of(orders, written).first()["watermark"] if watermark_basis == "data" else orders.agg(F.max(clock)).first()[0]  # one scalar
        tx.last_loaded_ts = max((t for t in (seen, wm) if t is not None), default=None)
        out = {"mode": mode, "rows": written.count(), "failures": fb.failures.count(), "watermark": tx.last_loaded_ts}
    return out


def verify_load(spark: SparkSession, base: str, stg: dict[str, DataFrame], run: int) -> DataFrame:
    """F8: the days that a load wrote, staged lines against lines of the fact and lines that wait in the failure
    queue (``operators.reconcile``). Of the fact, only the years and days of that load are read."""
    wh = Warehouse(spark, base)
    snap = wh.snapshot()
    fact, queue = wh.read("fact_sales", snap), wh.read(QUEUE, snap)
    own = {t: {f: p for f, p in folders.items() if f.startswith(f"load=r{run}-")} for t, folders in snap.folders.items()}
    batch = wh.read("fact_sales", Snapshot(snap.seq, snap.commit_id, own, snap.columns))
    days = batch_days(fact, batch)
    staged = stg["stg_items"].join(F.broadcast(batch.select("date_key").distinct()), "date_key", "left_semi")  # at most the calendar's days
    if queue is not None:
        staged = R.without(staged, queue.where("state = 'pending'"), QUEUE_KEY)
    return R.compare(R.digest(staged, "order_item_id", "price"), R.digest(days, "order_item_seq", "unit_price"))


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The current snapshot of a table that the load jobs wrote."""
    found = Warehouse(spark, base).read(name)
    if found is None:
        raise ValueError(f"{base} has no table {name}")
    return found


def load_dimensions(
    spark: SparkSession, src: dict[str, DataFrame], stg: dict[str, DataFrame], p: Params, base: str, version: str,
    first_log_id: int = 1,
) -> dict:
    """Phase-3 job. The calendar is built once (D1); sellers and products are
    reloaded with the keys of the key map kept and new members
    numbered after them (D2/D3, no re-numbering on reload); the customer
    feed is merged as SCD2 into the previous snapshot (D4). The key map of a dimension (``keys_<name>``: one row for
    each business id ever seen, of the feed's own type) only grows, in the commit that adds the members. A feed that
    holds an id twice gives one row (``dims.one_per_id``) and the others to ``dim_duplicates``. Each table is one commit with its control-log row (L2)."""
    with tidied(spark):
        wh = Warehouse(spark, base)
        out = {}
        log_id = first_log_id
        dd = wh.read("dim_date")
        new_dd = D.build_dim_date(spark, p.date_start, p.date_end) if dd is None else load_dim_date_if_empty(spark, dd, p.date_start, p.date_end)
        if new_dd is not None:
            with wh.begin(log_id, "dim_date") as tx:
                tx.replace("dim_date", new_dd)
                tx.loaded = new_dd
            log_id += 1
        sellers = stored(src["sellers"])  # read for the members, their numbers and the repeated ids
        builders = {
            "dim_seller": lambda keys: D.build_dim_seller(sellers, p.run_date, keys),
            "dim_product": lambda keys: D.build_dim_product(stg["stg_products"], p.run_date, keys),
        }
        feeds = {"dim_seller": sellers, "dim_product": stg["stg_products"]}
        for name, fn in builders.items():
            with wh.begin(log_id, name) as tx:
                short = name.removeprefix("dim_")
                prev, keys = tx.read(name), tx.read(f"keys_{name}")
                if keys is None and prev is not None:
                    keys = FA.key_map(prev, f"{short}_id", f"{short}_key", f"{short}_id")
                df = stored(D.keep_absent(fn(keys), prev, f"{short}_key"))
                tx.replace(name, df)
                members = FA.key_map(df, f"{short}_id", f"{short}_key", f"{short}_id")
                tx.append(f"keys_{name}", members if keys is None else members.join(keys, f"{short}_id", "left_anti"))
                twice = D.repeated_ids(feeds[name], f"{short}_id").select(F.lit(name).alias("dimension"), F.col("member"), "rows", F.lit(version).alias("version"))
                tx.append("dim_duplicates", twice)
                tx.loaded = df
            log_id += 1
        with wh.begin(log_id, "dim_customer") as tx:
            feed = stg["stg_customers"]
            # closed versions never change: they are appended once, and a merge reads and rewrites current rows only
            # (the largest key is always a current row's, since a version is closed by one with a larger key)
            prev = tx.read("dim_customer_current")
            r = D.scd2_merge(D.empty_dim_customer(spark, dict(feed.dtypes)["customer_id"]) if prev is None else prev, feed, p.run_date)
            dim = stored(r.dim)
            tx.replace("dim_customer_current", dim.where("is_current"))
            tx.append("dim_customer_history", dim.where("not is_current"))
            tx.loaded = r.actions.where(F.col("action") != "unchanged")
            out["scd2_actions"] = D.scd2_action_counts(r.actions)
        out.update({k: read_table(spark, base, k) for k in ("dim_date", "dim_seller", "dim_product", "dim_customer")})
        return out
