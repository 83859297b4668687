"""Run queries next to their SQL on one scale; ``python -m tests.oracle sf_dir [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb

import __spark_entry__ as entry


def normal(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for table in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return con


def compare(spark, con, sf_dir, name):
    """None where both agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    mine = sorted_rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if mine else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {df.columns} / {columns}"
    theirs = sorted_rows(columns, cur.fetchall())
    if mine == theirs:
        return None
    odd = [p for p in zip(mine, theirs) if p[0] != p[1]][:2]
    return f"{len(mine)} / {len(theirs)} rows, such as {odd}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sf = sys.argv[1]
    con = duck(sf)
    for key in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            wrong = compare(session, con, sf, key)
        except Exception as e:  # show every query's state
            wrong = f"{type(e).__name__}: {str(e)[:500]}"
        print(f"{'ok' if wrong is None else 'WRONG':6} {key} {time.time() - start:.1f}s {wrong or ''}", flush=True)
