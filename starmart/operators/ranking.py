"""Global (or hot-partition-safe) row numbers, running sums, ranks and tiles.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task,
and ``Window.partitionBy(k)`` puts a hot ``k`` into one task. These operators
compute the same numbers with balanced tasks:

1. ``repartitionByRange(*partition_by, *order_by)`` cuts the total order into
   contiguous chunks (Spark samples the keys to pick the cut points, so a hot
   partition value is split over several chunks; AQE merges adjacent small
   chunks, keeping their order).
2. Inside each (chunk, partition value) a windowed row number / running sum.
3. A per-(chunk, partition value) summary (count, sums) -- at most
   ``#chunks + #partition values`` rows -- gives each chunk its offset through a
   running sum over chunk ids, which is added back.

The result equals the plain window exactly, provided ``(partition_by,
order_by)`` is a total order (append a unique key as the last sort column).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[tuple[str, bool]]  # (column, ascending); NULLs first asc / last desc


def _sort_cols(order_by: Order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last() for c, asc in order_by]


def global_scan(
    df: DataFrame,
    order_by: Order,
    partition_by: Sequence[str] = (),
    row_number: str | None = "_rn",
    running_sums: Mapping[str, Column] | None = None,
    partition_count: str | None = None,
    partition_sums: Mapping[str, Column] | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    rank_cols: int | None = None,
    num_chunks: int | None = None,
) -> DataFrame:
    """Add ``row_number`` (1-based within ``partition_by``), running sums
    (ROWS UNBOUNDED PRECEDING .. CURRENT ROW), the partition row count,
    partition totals and ``rank`` / ``dense_rank`` over the first
    ``rank_cols`` columns of ``order_by`` (ties share a rank), all in one pass.

    Ranks: inside a chunk, windowed ``rank``/``dense_rank`` are exact except
    for the chunk's first tie group, which may have started in earlier
    chunks; the summary carries each chunk's first/last value and the size
    of its last tie group, and running sums along runs of chunks that end
    with one value give the correction (linear in the number of chunks).
    """
    running_sums = dict(running_sums or {})
    partition_sums = dict(partition_sums or {})
    P = list(partition_by)
    want_rank = bool(rank or dense_rank)
    V = [c for c, _ in order_by[: (rank_cols or len(order_by))]]
    vals = {f"_v_{k}": v for k, v in running_sums.items()}
    pvals = {f"_pv_{k}": v for k, v in partition_sums.items()}
    base = df.withColumns({**vals, **pvals}) if (vals or pvals) else df
    sort = [F.col(p).asc_nulls_first() for p in P] + _sort_cols(order_by)
    if num_chunks:
        ranged = base.repartitionByRange(int(num_chunks), *sort)
    else:
        # Width from the session; AQE merges adjacent small ranges to the
        # advisory partition size, so chunk ids stay in range order while
        # the chunk count follows the data size.
        ranged = base.repartitionByRange(*sort)
    ranged = ranged.withColumn("_chunk", F.spark_partition_id())

    # (2) local numbering inside each chunk (and partition value). The chunks
    # are balanced by construction, so this window has no hot task.
    if not (P or running_sums or want_rank):
        # Row numbers only: sort inside the range chunk and take each row's
        # position in the partition (the low 33 bits of the monotonically
        # increasing id); no window, so no second exchange.
        local = ranged.sortWithinPartitions(*sort).withColumn(
            "_lrn", (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")
        )
    else:
        w = Window.partitionBy("_chunk", *P).orderBy(*_sort_cols(order_by))
        wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = ranged.withColumn("_lrn", F.row_number().over(w))
        local = local.withColumns({f"_ls_{k}": F.sum(f"_v_{k}").over(wr) for k in running_sums})
    if want_rank:
        wv = Window.partitionBy("_chunk", *P).orderBy(*_sort_cols(order_by[: len(V)]))
        local = local.withColumns({"_lrank": F.rank().over(wv), "_ldense": F.dense_rank().over(wv)})
    # Materialise once in the shared checkpoint folder: the summary below and
    # the final join both read it, so the input and its two shuffles are not
    # recomputed, and the lineage is cut (a lost executor re-reads files).
    local = local.checkpoint(eager=True)

    # (3) per-chunk summary and offsets: at most #chunks + #partition values rows.
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    aggs += [F.sum(f"_v_{k}").alias(f"_sum_{k}") for k in running_sums]
    aggs += [F.sum(f"_pv_{k}").alias(f"_psum_{k}") for k in partition_sums]
    if want_rank:
        vs = F.struct(*[F.col(c) for c in V])
        aggs += [
            F.min_by(vs, "_lrn").alias("_fv"),
            F.max_by(vs, "_lrn").alias("_lv"),
            F.max("_lrank").alias("_lastg"),
            F.max("_ldense").alias("_nd"),
        ]
    summ = local.groupBy("_chunk", *P).agg(*aggs)
    ws = Window.partitionBy(*P).orderBy("_chunk")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    whole = ws.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offs = {"_off": F.coalesce(F.sum("_cnt").over(before), F.lit(0))}
    offs.update({f"_soff_{k}": F.sum(f"_sum_{k}").over(before) for k in running_sums})
    if partition_count:
        offs["_pcnt"] = F.sum("_cnt").over(whole)
    offs.update({f"_ptot_{k}": F.sum(f"_psum_{k}").over(whole) for k in partition_sums})
    if want_rank:
        # a boundary whose two sides hold the same value splits one tie group
        split = F.coalesce(F.lag("_lv").over(ws).eqNullSafe(F.col("_fv")), F.lit(False)).cast("long")
        summ = summ.withColumn("_split", split)
        offs["_split"] = F.col("_split")
        # distinct values wholly before this chunk's first value
        offs["_dbefore"] = (
            F.coalesce(F.sum("_nd").over(before), F.lit(0))
            - F.coalesce(F.sum("_split").over(ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
        )
    summ = summ.withColumns(offs)
    if want_rank:
        # Chunks that end with one value are neighbours: number these runs and add up, along each, the sizes
        # of the last tie groups. A chunk that starts with the value before its border takes the sum so far.
        ends = F.coalesce(F.lag("_lv").over(ws).eqNullSafe(F.col("_lv")), F.lit(False))
        summ = summ.withColumn("_run", F.sum((~ends).cast("long")).over(ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        along = Window.partitionBy(*P, "_run").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        summ = summ.withColumn("_tails", F.sum(F.col("_cnt") - F.col("_lastg") + 1).over(along))
        offs["_eqb"] = F.when(F.col("_split") == 1, F.lag("_tails").over(ws)).otherwise(0)
        summ = summ.withColumn("_eqb", offs["_eqb"])
    summ = summ.select("_chunk", *P, *offs.keys())
    if not P:
        # One row per chunk (at most spark.sql.shuffle.partitions): a proven bound, so broadcast.
        summ = F.broadcast(summ)
    if P:  # NULL is a partition value of its own: join null-safely
        summ = summ.select("_chunk", *[F.col(p).alias(f"_s_{p}") for p in P], *offs.keys())
        cond = local["_chunk"] == summ["_chunk"]
        for p in P:
            cond = cond & local[p].eqNullSafe(summ[f"_s_{p}"])
        joined = local.join(summ, cond, "inner").drop(summ["_chunk"])
    else:
        joined = local.join(summ, "_chunk", "inner")

    out = {}
    if row_number:
        out[row_number] = (F.col("_off") + F.col("_lrn")).cast("long")
    for k in running_sums:
        out[k] = F.col(f"_ls_{k}") + F.coalesce(F.col(f"_soff_{k}"), F.lit(0))
    if partition_count:
        out[partition_count] = F.col("_pcnt").cast("long")
    for k in partition_sums:
        out[k] = F.col(f"_ptot_{k}")
    first_group = F.col("_lrank") == 1
    if rank:
        out[rank] = (F.col("_off") + F.col("_lrank") - F.when(first_group, F.col("_eqb")).otherwise(0)).cast("int")
    if dense_rank:
        out[dense_rank] = (F.col("_dbefore") + F.col("_ldense")).cast("int")
    keep = [c for c in df.columns]
    return joined.select(*keep, *[v.alias(k) for k, v in out.items()])


def ntile_from_rn(rn: Column, total: Column, k: int) -> Column:
    """``NTILE(k)`` from a 1-based row number and the partition row count.

    With q = N div k and r = N mod k the first r tiles hold q+1 rows.
    """
    q = F.floor(total / F.lit(k)).cast("long")
    r = (total - q * k).cast("long")
    big = (q + 1) * r
    return (
        F.when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
        .otherwise(r + F.floor((rn - 1 - big) / q) + 1)
        .cast("int")
    )


def with_ntile(df: DataFrame, k: int, order_by: Order, name: str, partition_by: Sequence[str] = (), num_chunks: int | None = None) -> DataFrame:
    s = global_scan(df, order_by, partition_by, row_number="_nt_rn", partition_count="_nt_n", num_chunks=num_chunks)
    return s.withColumn(name, ntile_from_rn(F.col("_nt_rn"), F.col("_nt_n"), k)).drop("_nt_rn", "_nt_n")


def with_row_number(df: DataFrame, order_by: Order, name: str, partition_by: Sequence[str] = (), num_chunks: int | None = None) -> DataFrame:
    return global_scan(df, order_by, partition_by, row_number=name, num_chunks=num_chunks)


def with_rank(
    df: DataFrame,
    order_by: Order,
    name: str,
    partition_by: Sequence[str] = (),
    dense: bool = False,
    num_chunks: int | None = None,
) -> DataFrame:
    """``RANK()`` (or ``DENSE_RANK()``) over ``order_by`` values; ties share a
    rank. A hash of the whole row is appended as sort tie-break only so that
    the range cut can split a value held by a huge number of rows over
    several chunks; the ranks do not depend on it."""
    tb = "_rank_tb"
    d = df.withColumn(tb, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    kw = {"dense_rank": name} if dense else {"rank": name}
    out = global_scan(d, list(order_by) + [(tb, True)], partition_by, row_number=None, rank_cols=len(order_by), num_chunks=num_chunks, **kw)
    return out.drop(tb)
