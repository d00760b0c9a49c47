"""Compare a registered Spark query with its DuckDB oracle (dev tool + tests)."""

from __future__ import annotations

import math
import sys

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else v)
    df = df.astype(object).where(pd.notnull(df), None)
    key = df.apply(lambda r: tuple(("" if v is None else str(v)) for v in r), axis=1)
    return df.iloc[key.argsort(kind="stable")].reset_index(drop=True)


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as E

    s = E.queries()[name](spark, sf_dir).toPandas()
    sql = E.oracle_sql()[name]
    con = con or duck(sf_dir)
    o = con.sql(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"rows differ: spark={len(s)} oracle={len(o)}"
    a, b = _canon(s), _canon(o)
    bad = []
    for c in a.columns:
        for i, (x, y) in enumerate(zip(a[c], b[c])):
            if x is None and y is None:
                continue
            if x is None or y is None or (x != y and str(x) != str(y)):
                bad.append((c, i, x, y))
                break
    if bad:
        return False, f"values differ: {bad[:5]}"
    return True, f"ok ({len(s)} rows)"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from starmart.session import local_session

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = local_session(shuffle_partitions=8)
    import __spark_entry__ as E

    con = duck(sf)
    names = names or [n for n in E.queries() if n in E.oracle_sql()]
    fails = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf, con)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        fails += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - fails}/{len(names)} passed")
