"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: status, rows, and the first difference.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v if STRICT else round(v, 9))
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, (int,)):
        return (1, float(v))
    return (2, str(v))


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [r.asDict() for r in sdf.collect()]
    t_spark = time.time() - t0
    if sql is None:
        return "ROWS", len(s_rows), t_spark, ""
    rel = con.sql(sql)
    d_cols_raw = list(rel.columns)
    d_rows = [dict(zip(d_cols_raw, r)) for r in rel.fetchall()]
    d_cols = sorted(d_cols_raw)
    if s_cols != d_cols:
        return "COLS", len(s_rows), t_spark, f"spark={s_cols} duck={d_cols}"
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {c: str(t) for c, t in zip(d_cols_raw, rel.types)} if hasattr(rel, "types") else {}
    bad_types = {c: (s_types[c], d_types[c]) for c in d_types if s_types.get(c) != d_types[c]}
    if bad_types:
        return "TYPE", len(s_rows), t_spark, str(bad_types)
    if len(s_rows) != len(d_rows):
        return "COUNT", len(s_rows), t_spark, f"spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, u, v) for c, u, v in zip(s_cols, x, y) if u != v]
            return "VALUE", len(s_rows), t_spark, str(diff)[:400]
    return "OK", len(s_rows), t_spark, ""


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from tonestream.session import build_session

    spark = build_session(master="local[8]", shuffle_partitions=8, app="oracle-compare")
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            status, n, t, msg = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            status, n, t, msg = "ERROR", -1, 0.0, f"{type(e).__name__}: {str(e)[:400]}"
        bad += status not in ("OK", "ROWS")
        print(f"{status:6s} {name:32s} rows={n:<7d} {t:6.1f}s {msg}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
