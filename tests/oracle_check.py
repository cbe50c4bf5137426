"""Run queries() against oracle_sql() in DuckDB and compare results.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE"}


def type_mismatches(spark_dtypes, duck_columns, duck_types):
    """Columns whose Spark type does not correspond to the DuckDB type."""
    s = dict(spark_dtypes)
    d = {n: str(t) for n, t in zip(duck_columns, duck_types)}
    out = []
    for n in sorted(set(s) | set(d)):
        st = s.get(n)
        want = SPARK_TO_DUCK.get(st, st.upper() if st else None)
        if want != d.get(n):
            out.append((n, st, d.get(n)))
    return out


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return names, out


def compare(spark, con, sf_dir, key, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    s_names, s_rows = canon(df.columns, srows)
    if sql is None:
        return dict(key=key, ok=None, rows=len(s_rows), spark_s=round(t_spark, 2))
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    types_bad = type_mismatches(df.dtypes, d_cols, rel.types)
    d_rows = rel.fetchall()
    d_names, d_rows = canon(d_cols, d_rows)
    ok = s_names == d_names and s_rows == d_rows and not types_bad
    info = dict(key=key, ok=ok, rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t_spark, 2))
    if types_bad:
        info["type_mismatches"] = types_bad
    if not ok:
        info["spark_cols"], info["oracle_cols"] = s_names, d_names
        diff_s = [r for r in s_rows if r not in set(d_rows)][:3]
        diff_d = [r for r in d_rows if r not in set(s_rows)][:3]
        info["only_spark"], info["only_oracle"] = diff_s, diff_d
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from quarry.session import build_session
    import __spark_entry__ as E
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        # a session as a caller might bring it: default partitions, another zone
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[8]")
                 .config("spark.sql.session.timeZone", "America/New_York")
                 .config("spark.ui.enabled", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in (keys or sorted(qs)):
        try:
            info = compare(spark, con, sf_dir, k, qs[k], sqls.get(k))
        except Exception as e:  # noqa: BLE001
            info = dict(key=k, ok=False, error=repr(e)[:600])
        if info.get("ok") is False:
            bad += 1
        print(info, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")


if __name__ == "__main__":
    main(sys.argv)
