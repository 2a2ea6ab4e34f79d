"""Run registered queries against their SQL: `python tests/oracle_check.py [sf] [name ...]`."""

from __future__ import annotations

import os
import sys
import threading
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df, con, sql):
    """None when equal, else what differs."""
    got_names = spark_df.columns
    got = rows_of(got_names, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    want = rows_of(names, rel.fetchall())
    if sorted(names) != sorted(got_names):
        return f"columns {sorted(got_names)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(names)}: {g} != {w}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    off = [(n, t, types[n]) for n, t in spark_df.dtypes if kinds.get(t, t) != types[n]]
    if off:
        return f"types {off}"
    return None if got else "no rows"


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    sqls, bad = entry.oracle_sql(), 0
    limit = 60
    for name, fn in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        timer = threading.Timer(limit, lambda: os._exit(print(f"HUNG {name}", flush=True) or 3))
        timer.start()
        try:
            if name in sqls:
                problem = compare(fn(spark, sf_dir), con, sqls[name])
            else:
                problem = None if fn(spark, sf_dir).count() else "no rows"
        except Exception as e:  # a broken query must not hide the others
            problem = f"{type(e).__name__}: {str(e)[:600]}"
            if argv[1:]:
                traceback.print_exc()
        timer.cancel()
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:28s} {time.time() - start:6.2f}s {'' if name in sqls else '(rows only) '}{problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
