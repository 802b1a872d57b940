"""Run every query against its SQL twin: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(repr(r[i]) for i in order) for r in rows])


def compare(spark, con, sf, name) -> str:
    df = entry.queries()[name](spark, sf)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows only ({len(got)})"
    rel = con.execute(sql)
    columns = [c[0] for c in rel.description]
    want = normal(rel.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return f"ok ({len(got)})"
    seen, wanted = set(got), set(want)
    extra, missing = [r for r in got if r not in wanted], [r for r in want if r not in seen]
    return f"DIFF rows {len(got)}/{len(want)} extra {extra[:3]} missing {missing[:3]}"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, con, sf, name)
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            verdict = "ERROR " + str(error)[:600]
        print(f"{name:28s} {time.time() - start:6.1f}s {verdict}", flush=True)


if __name__ == "__main__":
    main()
