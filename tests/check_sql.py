"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


timings: dict[str, tuple[float, float]] = {}


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return str(value)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, query, sql: str, folder: str) -> str | None:
    """None when both agree, else a short description of the difference."""
    begun = time.time()
    frame = query(spark, folder)
    mine = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    spent = time.time() - begun
    relation = connection.sql(sql)
    theirs = canonical(relation.columns, relation.fetchall())
    timings[name] = (spent, time.time() - begun - spent)
    if mine == theirs:
        return None
    if mine[0] != theirs[0]:
        return f"{name}: columns {mine[0]} / {theirs[0]}"
    only_mine = sorted(set(mine[1]) - set(theirs[1]))[:3]
    only_theirs = sorted(set(theirs[1]) - set(mine[1]))[:3]
    return f"{name}: {len(mine[1])} / {len(theirs[1])} rows\n  spark {only_mine}\n  sql   {only_theirs}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    database = connect(where)
    for name in chosen:
        try:
            problem = compare(spark, database, name, entry.queries()[name], entry.oracle_sql()[name], where)
        except Exception as error:
            problem = f"{name}: {type(error).__name__} {str(error)[:600]}"
        spent = " / ".join(f"{t:.1f}s" for t in timings.get(name, ()))
        print("ok  " if problem is None else "DIFF", name, spent, problem or "", flush=True)
