"""Order statistics by distributed selection: exact ranks without sorting the rows.

The value at a rank is found by counting. Values become order-preserving integers; one pass
counts them in ``BUCKETS`` equal buckets of the range, the bucket that holds the wanted rank
becomes the next range, and so on until a range is one value or has so few rows
that they are looked at (``FEW`` at most). Ties are told apart by a unique key, selected in the same way
among the rows of one value. All wanted ranks of all columns share each pass, so there are
about as many passes as log(range) / log(``BUCKETS``), three or four in practice, each a scan with a
partial aggregate of at most ``BUCKETS`` rows for each open range. Nothing is sorted, ranged or windowed,
and what comes to the driver is bounded by the numbers above.

``with_tiles`` is ``NTILE``: with the last row of each tile known as (value, key), a row's tile is an
expression of literals, set where the row is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096
FEW = 2000


def code(df: DataFrame, column: str) -> Column:
    """The column as an integer of the same order (NULL stays NULL)."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    if isinstance(kind, T.DecimalType):
        return (c * F.lit(10**kind.scale)).cast("decimal(38,0)").cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("long")
    raise TypeError(f"{column}: {kind.simpleString()} has no integer of the same order; use ranking.global_scan")


@dataclass
class _Range:
    """Where a wanted rank still lies: codes lo..hi, and its place (1-based) among the rows there."""

    place: int
    lo: int
    hi: int
    value: int | None = None  # the value, once found: lo..hi are keys then
    done: tuple[int, int | None] | None = None

    @property
    def width(self) -> int:
        return -(-(self.hi - self.lo + 1) // BUCKETS)

    @property
    def at(self) -> tuple:
        return self.value, self.lo, self.hi


def select_ranks(df: DataFrame, columns: Mapping[str, Column], key: Column | None, ranks: Mapping[str, Sequence[int]], spans: Mapping[str, tuple[int, int]], key_span: tuple[int, int] | None) -> dict[str, list[tuple[int, int | None]]]:
    """(code, key) at each wanted rank of each column (1-based, ascending; the key None if there is none).

    ``columns``: non-NULL integer codes by name; ``spans``: smallest and largest code; ``key``: a unique integer."""
    open_ = {n: [_Range(r, *spans[n]) for r in rs] for n, rs in ranks.items()}
    data = df.select(*[c.alias(f"c_{n}") for n, c in columns.items()], *([key.alias("k")] if key is not None else []))

    def settle(x: _Range) -> None:
        """A range of one value is that value; with a key, the search goes on among its keys."""
        if x.done is None and x.lo == x.hi:
            if x.value is not None:
                x.done = (x.value, x.lo)
            elif key is None:
                x.done = (x.lo, None)
            else:
                x.value, (x.lo, x.hi) = x.lo, key_span
                settle(x)

    while True:
        for xs in open_.values():
            for x in xs:
                settle(x)
        todo = {n: sorted({x.at for x in xs if x.done is None}, key=str) for n, xs in open_.items()}
        if not any(todo.values()):
            return {n: [x.done for x in xs] for n, xs in open_.items()}
        # one array of (range, bucket) marks a row; a row is in few ranges, most in none
        marks = []
        names = [(n, at) for n, ats in todo.items() for at in ats]
        for i, (n, (value, lo, hi)) in enumerate(names):
            c = F.col("k") if value is not None else F.col(f"c_{n}")
            inside = (c >= lo) & (c <= hi)
            if value is not None:
                inside = inside & (F.col(f"c_{n}") == value)
            width = _Range(0, lo, hi, value).width
            marks.append(F.when(inside, F.lit(i * BUCKETS).cast("long") + F.call_function("div", c - F.lit(lo).cast("long"), F.lit(width).cast("long"))))
        counted = data.select(F.explode(F.array_compact(F.array(*marks))).alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n"))
        found: dict[int, list[tuple[int, int]]] = {}
        for r in sorted((r["b"], r["n"]) for r in counted.collect()):  # at most BUCKETS rows for each range
            found.setdefault(r[0] // BUCKETS, []).append((r[0] % BUCKETS, r[1]))
        number = {x: i for i, x in enumerate(names)}
        small: dict[tuple, list[_Range]] = {}
        for n, xs in open_.items():
            for x in xs:
                if x.done is None:
                    width, before = x.width, 0
                    for bucket, count in found[number[n, x.at]]:
                        if before + count >= x.place:
                            break
                        before += count
                    lo = x.lo + bucket * width
                    x.place, x.lo, x.hi = x.place - before, lo, min(x.hi, lo + width - 1)
                    if count <= FEW and x.lo < x.hi:
                        small.setdefault((n, x.at), []).append(x)
        if small:
            _look(data, small, key is not None)


def _look(data: DataFrame, small: dict[tuple, list[_Range]], keyed: bool) -> None:
    """Settles ranges of at most FEW rows by their rows."""
    marks = []
    for i, (n, (value, lo, hi)) in enumerate(small):
        c = F.col("k") if value is not None else F.col(f"c_{n}")
        inside = (c >= lo) & (c <= hi) & (F.col(f"c_{n}") == value if value is not None else F.lit(True))
        marks.append(F.when(inside, F.struct(F.lit(i).alias("i"), F.col(f"c_{n}").alias("c"), (F.col("k") if keyed else F.lit(None).cast("long")).alias("k"))))
    rows: dict[int, list[tuple]] = {}
    for r in data.select(F.explode(F.array_compact(F.array(*marks))).alias("x")).select("x.*").collect():  # at most FEW rows for each range
        rows.setdefault(r["i"], []).append((r["c"], r["k"]))
    for i, xs in enumerate(small.values()):
        ordered = sorted(rows[i], key=lambda t: (t[0], t[1] or 0))
        for x in xs:
            x.done = ordered[x.place - 1]


def with_tiles(df: DataFrame, k: int, tiles: Mapping[str, tuple[str, bool]], key: str) -> DataFrame:
    """Adds ``NTILE(k) OVER (ORDER BY column [DESC], key)`` for each ``name: (column, ascending)``; ``key`` is a unique integer
    column. NULLs come first ascending, last descending. The rows are read by each pass; give a written or checkpointed frame."""
    raw = {n: code(df, c) if asc else -code(df, c) for n, (c, asc) in tiles.items()}
    aggs = [F.count(F.lit(1)).alias("n"), F.min(key).alias("kl"), F.max(key).alias("kh")]
    aggs += [f(c).alias(f"{p}_{n}") for n, c in raw.items() for f, p in ((F.min, "lo"), (F.max, "hi"))]
    facts = df.agg(*aggs).first()  # one row
    total = facts["n"]
    if total == 0:
        return df.withColumns({n: F.lit(1).cast("int") for n in tiles})
    codes, spans = {}, {}
    for n, (_, asc) in tiles.items():
        lo, hi = (facts[f"lo_{n}"] or 0) - asc, (facts[f"hi_{n}"] or 0) + (not asc)
        codes[n] = F.coalesce(raw[n], F.lit(lo if asc else hi).cast("long"))
        spans[n] = (lo, hi)
    last = [j * (total // k) + min(j, total % k) for j in range(1, k)]  # rank of the last row of each tile but one
    last = [r for r in last if 0 < r < total]
    found = select_ranks(df, codes, F.col(key).cast("long"), {n: last for n in tiles}, spans, (facts["kl"], facts["kh"]))
    out = {}
    for n, bounds in found.items():
        tile = F.lit(1)
        for v, at in bounds:
            tile = tile + ((codes[n] > v) | ((codes[n] == v) & (F.col(key).cast("long") > at))).cast("int")
        out[n] = tile.cast("int")
    return df.withColumns(out)
