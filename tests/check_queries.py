"""Compare every registered query with its SQL twin: ``check_queries.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_module  # noqa: E402


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns sorted by name, sorted by value."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if v is None or (isinstance(v, float) and v != v):
            return ("", "null")
        if isinstance(v, (bool,)):
            return ("b", str(v))
        if isinstance(v, pd.Timestamp):
            v = v.to_pydatetime()
        if isinstance(v, float):
            v = v + 0.0 if v else 0.0
        return (type(v).__name__, repr(v))

    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, int, float]:
    """``(verdict, rows, seconds)`` of one query."""
    started = time.time()
    df = entry_module.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        return ("rows-only" if got else "EMPTY"), len(got), seconds
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(columns)} vs {sorted(df.columns)}", len(got), seconds
    left, right = canonical(df.columns, got), canonical(columns, want)
    if left == right:
        return ("ok" if got else "ok but EMPTY"), len(got), seconds
    extra = sorted(set(left) - set(right))[:3]
    lost = sorted(set(right) - set(left))[:3]
    return f"DIFF rows {len(left)}/{len(right)} extra={extra} lost={lost}", len(got), seconds


def main() -> int:
    sf_dir = sys.argv[1]
    spark, con = session(), database(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry_module.queries():
        try:
            verdict, rows, seconds = compare(spark, con, sf_dir, name)
        except Exception as e:  # noqa: BLE001
            verdict, rows, seconds = f"ERROR {type(e).__name__}: {str(e)[:600]}", 0, 0.0
        bad += verdict not in ("ok", "rows-only")
        print(f"{name:26s} {rows:8d} {seconds:7.2f}s  {verdict}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
