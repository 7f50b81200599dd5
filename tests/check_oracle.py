"""Compare every registered query with its SQL twin: ``check_oracle.py DIR [name ...]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, query, sql):
    """(spark rows, oracle rows, first difference or None)."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(mine), None, None
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    theirs = rows_of(columns, found.fetchall())
    if sorted(columns) != sorted(df.columns):
        return len(mine), len(theirs), (sorted(df.columns), sorted(columns))
    if mine == theirs:
        return len(mine), len(theirs), None
    extra, missing = set(mine) - set(theirs), set(theirs) - set(mine)
    return len(mine), len(theirs), (sorted(extra)[:2], sorted(missing)[:2])


if __name__ == "__main__":
    from clickmart import session

    spark = session.build(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    directory, names = sys.argv[1], sys.argv[2:]
    con = oracle_connection(directory)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            mine, theirs, diff = compare(spark, con, directory, name, query, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            mine, theirs, diff = None, None, f"{type(e).__name__}: {str(e)[:600]}"
        bad += diff is not None
        print(f"{'FAIL' if diff else 'ok  '} {name} {mine} {theirs} {time.time() - start:.1f}s", flush=True)
        if diff:
            print("     ", diff, flush=True)
    print("failures:", bad)
