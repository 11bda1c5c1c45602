"""Compare registered Spark queries with their DuckDB oracle (like the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
                 "boolean": "BOOLEAN", "array<string>": "VARCHAR[]", "smallint": "SMALLINT",
                 "float": "FLOAT"}


def type_mismatches(df, res):
    duck_types = {d[0]: str(d[1]).upper() for d in res.description}
    out = []
    for c, t in df.dtypes:
        want = SPARK_TO_DUCK.get(t, t.upper())
        got = duck_types.get(c)
        if got is not None and got != want:
            out.append((c, t, got))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t = time.time()
    df = fn(spark, sf_dir)
    srows = df.collect()
    scols = df.columns
    ts = time.time() - t
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(ts, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    ok_cols = sorted(scols) == sorted(dcols)
    a, b = canon(scols, srows), canon(dcols, drows)
    types = type_mismatches(df, res)
    ok = ok_cols and a == b and not types
    info = dict(name=name, ok=ok, rows=(len(srows), len(drows)), spark_s=round(ts, 2))
    if types:
        info["types"] = types
    if not ok_cols:
        info["cols"] = (sorted(scols), sorted(dcols))
    elif not ok:
        sa, sb = set(a), set(b)
        info["only_spark"] = list(sa - sb)[:3]
        info["only_duck"] = list(sb - sa)[:3]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from ratingsmith.session import get_session
    import __spark_entry__ as entry
    spark = get_session("oracle-check", master=f"local[{os.environ.get('ORACLE_CPUS', '8')}]",
                        conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            info = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            info = dict(name=name, ok=False, error=repr(e)[:600])
        bad += info.get("ok") is False
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
