"""Run registered queries in Spark and their oracle SQL in DuckDB on the
same parquet tables; compare row count, column names and the multiset of
rows (exact values). Usage: python tests/oracle_check.py SF_DIR [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


SPARK_TO_DUCK = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "IntegerType()": "INTEGER",
                 "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN", "DateType()": "DATE",
                 "TimestampNTZType()": "TIMESTAMP", "TimestampType()": "TIMESTAMP WITH TIME ZONE"}


def type_diff(schema, con, sql):
    """Columns whose Spark type differs from the oracle's DuckDB type."""
    st = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in schema.fields}
    dt = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = f"rows-only {len(srows)}"
            print(f"{name:28s} {results[name]} ({ts:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCKDB ERROR {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        ok_cols = sorted(cols) == sorted(dcols)
        types = type_diff(df.schema, con, sqls[name])
        a, b = rows_of(cols, srows), rows_of(dcols, drows)
        ok = ok_cols and not types and len(srows) == len(drows) and a == b
        results[name] = "OK" if ok else "MISMATCH"
        print(f"{name:28s} {results[name]} spark={len(srows)} duck={len(drows)} ({ts:.1f}s)", flush=True)
        if not ok and verbose:
            if types:
                print("   types (spark, duck):", types)
            if not ok_cols:
                print("   cols spark", sorted(cols), "\n   cols duck ", sorted(dcols))
            else:
                print("   only spark:", list((a - b).items())[:3])
                print("   only duck: ", list((b - a).items())[:3])
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sys.argv[1], sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v != "OK" and not v.startswith("rows-only")]
    print("FAILED:", bad)
