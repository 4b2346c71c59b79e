"""Compare registered Spark queries with their DuckDB SQL on the same parquet files.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.  Prints one line
per query: rows on each side, column names and types, and whether the
sorted values agree (exactly, or to 1e-9 relative for doubles).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "date": "DATE"}


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, float(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return (1, float(v))
    except Exception:
        pass
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (1, float(v))
    return (4, str(v))


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def _close(a, b):
    if a == b:
        return True
    if a[0] == 1 and b[0] == 1 and isinstance(a[1], float) and isinstance(b[1], float):
        return math.isclose(a[1], b[1], rel_tol=1e-9, abs_tol=1e-9)
    return False


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = dict(zip(d_cols, (str(t) for t in rel.types)))
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "sec": round(t_spark, 2)}
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    type_diff = [(f.name, f.dataType.simpleString(), d_types.get(f.name)) for f in sdf.schema.fields
                 if SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                 != d_types.get(f.name)]
    res["types_match"] = not type_diff
    if type_diff:
        res["type_diff"] = type_diff
    if not res["cols_match"]:
        res["cols"] = (sorted(s_cols), sorted(d_cols))
        res["ok"] = False
        return res
    a, b = _rows(s_rows, s_cols), _rows(d_rows, d_cols)
    exact = a == b
    close = exact or (len(a) == len(b) and all(len(x) == len(y) and all(_close(p, q) for p, q in zip(x, y))
                                               for x, y in zip(a, b)))
    res["exact"] = exact
    res["ok"] = close and res["types_match"]
    if not close:
        for x, y in zip(a, b):
            if x != y:
                res["first_diff"] = (x, y)
                break
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/") and not a.startswith("--")]
    import __spark_entry__ as entry
    from tallyframe.session import get_session

    if "--plain" in argv:   # a session as a caller might build it, none of our settings
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
                 .config("spark.ui.enabled", "false").getOrCreate())
    else:
        spark = get_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            print(f"{name}: no oracle")
            continue
        try:
            r = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "ok": False, "error": repr(e)[:400]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
