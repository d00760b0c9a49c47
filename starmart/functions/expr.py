"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from built-in Spark functions, so it
stays inside whole-stage codegen; there is no Python UDF in the library.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

MICROS_PER_DAY = 86_400_000_000

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's (do not reorder or rename).
# Order status -> reporting category; an unmapped status gives NULL.
STATUS_CATEGORY = {
    "delivered": "Completed",
    "shipped": "In Transit",
    "approved": "Processing",
    "processing": "Processing",
    "invoiced": "Processing",
    "canceled": "Canceled",
    "unavailable": "Canceled",
    "created": "Processing",
}
# Price bands over the mean item price, right-closed: (0,50] (50,200] (200,500] (500,inf)
PRICE_BAND_EDGES = (0.0, 50.0, 200.0, 500.0, float("inf"))
PRICE_BAND_LABELS = ("Budget", "Mid-Range", "Premium", "Luxury")
# Weight bands over product_weight_g, right-closed: (0,500] (500,2000] (2000,10000] (10000,inf)
WEIGHT_BAND_EDGES = (0.0, 500.0, 2000.0, 10000.0, float("inf"))
WEIGHT_BAND_LABELS = ("Light", "Medium", "Heavy", "Bulky")
UNKNOWN_BAND = "Unknown"
# Default label when a product has no category translation.
UNCATEGORIZED = "uncategorized"
# ---------------------------------------------------------------------------


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: str | Column) -> Column:
    """Python ``str.title`` semantics: a letter is upper-cased when the
    character before it is not a letter, every other letter is lower-cased.

    ``initcap`` only restarts after whitespace (``D'oeste``), this restarts
    after any non-letter (``D'Oeste``, ``Mogi-Guacu``, ``Sp2X``).
    """
    pieces = F.split(col(c), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(
        F.transform(pieces, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, F.lit(2), F.length(x))))),
        "",
    )


def strip(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (Python ``str.strip``)."""
    return F.regexp_replace(F.regexp_replace(col(c), r"^\s+", ""), r"\s+$", "")


def micros_between(start: str | Column, end: str | Column) -> Column:
    """Exact elapsed microseconds ``end - start`` (NULL if either is NULL)."""
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def floor_days(start: str | Column, end: str | Column) -> Column:
    """Whole days elapsed, floored: 25h -> 1, -2h -> -1 (pandas ``.dt.days``).

    Not ``datediff`` (counts midnights) and not ``timestampdiff(DAY)``
    (truncates toward zero).
    """
    us = micros_between(start, end)
    return ((us - F.pmod(us, F.lit(MICROS_PER_DAY))).cast("long") / F.lit(MICROS_PER_DAY)).cast("int")


def date_key(ts: str | Column) -> Column:
    """Integer YYYYMMDD key."""
    t = col(ts)
    return (F.year(t) * 10000 + F.month(t) * 100 + F.dayofmonth(t)).cast("int")


def week_of_year_monday(d: str | Column) -> Column:
    """``%W``: week number with Monday as first day, days before the first
    Monday are week 0 (range 0..53). ``weekofyear`` is ISO and differs."""
    x = col(d)
    return ((F.dayofyear(x) + 6 - F.weekday(x)) / 7).cast("int")


def band(c: str | Column, edges: Sequence[float], labels: Sequence[str], default: str = UNKNOWN_BAND) -> Column:
    """Right-closed interval labelling ``(e[i], e[i+1]] -> labels[i]``.

    Values at or below the first edge, above the last edge and NULL get
    ``default`` (the lower edge itself is excluded, as in ``pd.cut``).
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    x = col(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = x > F.lit(lo)
        if hi != float("inf"):
            cond = cond & (x <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out.otherwise(F.lit(default))


def status_category(c: str | Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in STATUS_CATEGORY.items() for x in kv]), col(c))


def coerce_timestamp(c: str | Column, dtype: DataType | None = None, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse to timestamp_ntz; unparseable text becomes NULL (never raises)."""
    x = col(c)
    if dtype is None or isinstance(dtype, StringType):
        return F.try_to_timestamp(x, F.lit(fmt)).cast("timestamp_ntz")
    return x.cast("timestamp_ntz")


def coerce_number(c: str | Column, to: str = "decimal(10,2)") -> Column:
    """``pd.to_numeric(errors='coerce')``: bad values become NULL."""
    return F.expr(f"try_cast({c} as {to})") if isinstance(c, str) else c.try_cast(to)


def exact_div(n: Column, d: Column) -> Column:
    """Integral quotient of non-negative ``n`` by positive ``d`` (exact, decimal(38,0))."""
    return ((n - F.pmod(n, d)) / d).cast("decimal(38,0)")


def round_half_away(num: Column, den: Column, digits: int) -> Column:
    """Exact ``round(num / den, digits)`` (half away from zero) as DOUBLE.

    ``num`` and ``den`` must be integer valued (scale money to cents first).
    Decimal or double division followed by ``round`` rounds twice (or rounds
    a binary fraction); this uses integer arithmetic only, so every engine
    gives the same digits. ``den = 0`` yields NULL (MySQL ``x/0``), never an
    ANSI error.
    """
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    ad = F.abs(d)
    q = exact_div(F.abs(n) * F.lit(2 * 10**digits) + ad, ad * 2)
    sign = F.signum(n) * F.signum(d)
    return F.when(d != 0, sign * q.cast("double") / F.lit(float(10**digits)))


def cents(c: str | Column) -> Column:
    """Money (scale <= 2) as an exact integer number of cents."""
    return (col(c) * 100).cast("decimal(38,0)")
