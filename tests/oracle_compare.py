"""Run every registered query on Spark and its SQL oracle on DuckDB; compare rows, schema and values.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()

SPARK_TO_DUCK = {
    "IntegerType()": "INTEGER",
    "LongType()": "BIGINT",
    "DoubleType()": "DOUBLE",
    "StringType()": "VARCHAR",
    "BooleanType()": "BOOLEAN",
    "TimestampType()": "TIMESTAMP",
    "TimestampNTZType()": "TIMESTAMP",
    "FloatType()": "FLOAT",
    "DateType()": "DATE",
    "ShortType()": "SMALLINT",
}


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        return round(f, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def duck_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E

    con = duck_connection(sf_dir)
    qs = E.queries()
    sqls = E.oracle_sql()
    results = {}
    for name in names or qs:
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        spark_rows = [tuple(r) for r in df.collect()]
        spark_cols = df.columns
        spark_types = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
        t1 = time.time()
        if name not in sqls:
            results[name] = {"rows": len(spark_rows), "oracle": None, "ok": True}
            if verbose:
                print(f"{name:32s} rows={len(spark_rows):7d} (no oracle) {t1 - t0:.2f}s")
            continue
        rel = con.execute(sqls[name])
        duck_cols = [d[0] for d in rel.description]
        duck_rows = rel.fetchall()
        duck_types = dict(zip(duck_cols, [str(d[1]) for d in rel.description]))
        same_cols = sorted(spark_cols) == sorted(duck_cols)
        type_diff = {c: (spark_types.get(c), duck_types.get(c)) for c in spark_cols
                     if c in duck_types and spark_types.get(c) != duck_types.get(c)
                     and not spark_types.get(c, "").startswith("DecimalType")}
        same_vals = same_cols and canon(spark_rows, spark_cols) == canon(duck_rows, duck_cols)
        ok = same_cols and same_vals and len(spark_rows) == len(duck_rows) and not type_diff
        results[name] = {"rows": len(spark_rows), "oracle_rows": len(duck_rows), "ok": ok, "types": type_diff}
        if verbose:
            flag = "OK " if ok else "BAD"
            print(f"{flag} {name:32s} rows={len(spark_rows):7d}/{len(duck_rows):7d} cols={same_cols} "
                  f"vals={same_vals} types={type_diff or 'ok'} {t1 - t0:.2f}s")
            if same_cols and not same_vals:
                a = canon(spark_rows, spark_cols)
                b = canon(duck_rows, duck_cols)
                print("   spark-only:", [r for r in a if r not in b][:3])
                print("   oracle-only:", [r for r in b if r not in a][:3])
            if not same_cols:
                print("   spark cols:", spark_cols)
                print("   duck cols: ", duck_cols)
    return results


if __name__ == "__main__":
    from strata.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [n for n, r in res.items() if not r["ok"]]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
