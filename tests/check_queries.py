"""Compare every query with its SQL twin: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _text(value):
    if isinstance(value, float):
        return f"{value:.12g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, query, text: str) -> str:
    """Empty if both agree, else what differs."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    result = con.execute(text)
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if mine != theirs:
        a, b = set(mine), set(theirs)
        return f"{len(mine)} against {len(theirs)} rows; {sorted(a - b)[:2]} against {sorted(b - a)[:2]}"
    return ""


def main(argv) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = connect(sf_dir), entry.oracle_sql(), 0
    names = argv[1:] or list(entry.queries())
    for name in names:
        start = time.time()
        try:
            found = compare(spark, con, sf_dir, entry.queries()[name], twins[name])
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(found)
        print(f"{'BAD' if found else 'ok '} {name} {time.time() - start:.1f}s {found}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
