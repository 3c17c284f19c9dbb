"""Run registered queries on Spark and their SQL on DuckDB and compare."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v + 0.0)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(x) for x in df.collect()]
    took = time.time() - start
    if sql is None:
        return None, len(got), took, ""
    start = time.time()
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want = res.fetchall()
    sql_took = time.time() - start
    if sorted(df.columns) != sorted(names):
        return False, len(got), took, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    note = f"sql {sql_took:.1f}s"
    bad = [f"{c}:{t}" for c, t in types.items() if "HUGE" in t or "DECIMAL" in t or "INT128" in t]
    if bad:
        note += f" TYPES {bad}"
    if a != b:
        only = [x for x in a if x not in set(b)][:2]
        other = [x for x in b if x not in set(a)][:2]
        return False, len(got), took, f"rows {len(a)} vs {len(b)}; spark {str(only)[:500]} sql {str(other)[:500]}"
    return True, len(got), took, note


def main(argv):
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from veinworks.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("compare", "local[8]", **{"spark__sql__shuffle__partitions": "8", "spark__ui__enabled": "false", "spark__driver__memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = e.queries(), e.oracle_sql()
    wanted = [n for n in queries if not argv or any(a in n for a in argv)]
    failed = []
    for n in wanted:
        try:
            ok, rows, took, note = compare(spark, con, n, queries[n], sql.get(n), sf_dir)
        except Exception as err:  # report and go on
            ok, rows, took, note = False, 0, 0.0, f"{type(err).__name__}: {str(err)[:700]}"
        state = {True: "ok  ", False: "FAIL", None: "rows"}[ok]
        print(f"{state} {n} rows={rows} {took:.1f}s {note}", flush=True)
        if ok is False:
            failed.append(n)
    print(f"{len(wanted)} queries, {len(failed)} failed: {failed}")


if __name__ == "__main__":
    main(sys.argv[1:])
