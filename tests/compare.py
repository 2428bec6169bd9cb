"""Run queries and their SQL side by side.

    python tests/compare.py [sf] [query ...]

With CLUSTER_LIKE set, nothing is broadcast by size, as on tables too large for it.
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v))
    return str(v)


def rows_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, run, sql, sf_dir) -> tuple[bool, str]:
    start = time.time()
    df = run(spark, sf_dir)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return True, f"{len(left[1])} rows, no SQL, {seconds:.2f}s"
    cur = con.execute(sql)
    right = rows_of([d[0] for d in cur.description], cur.fetchall())
    note = f"{len(left[1])} rows, {seconds:.2f}s"
    if left == right:
        return True, note
    if left[0] != right[0]:
        return False, f"columns {left[0]} != {right[0]}"
    a, b = set(left[1]), set(right[1])
    return False, f"{len(left[1])} != {len(right[1])} rows; only Spark {list(a - b)[:2]}; only SQL {list(b - a)[:2]}"


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:] or list(queries())
    spark, con = session(), engine(sf_dir)
    if os.environ.get("CLUSTER_LIKE"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    bad = 0
    for name in wanted:
        try:
            ok, note = compare(spark, con, queries()[name], oracle_sql().get(name), sf_dir)
        except Exception as e:  # report and go on to the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print("ok " if ok else "BAD", name, note, flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} match")
