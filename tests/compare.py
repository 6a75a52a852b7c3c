"""Run registered queries and their SQL on the same tables and compare the rows.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


def differences(frame, connection, sql: str) -> list[str]:
    """Empty when the Spark rows and the SQL rows are the same."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    expected = rows(names, relation.fetchall())
    actual = rows(frame.columns, [tuple(r) for r in frame.collect()])
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(names)}")
    if actual != expected:
        only_spark = list((actual - expected).items())[:3]
        only_sql = list((expected - actual).items())[:3]
        problems.append(
            f"{sum(actual.values())} rows, {sum(expected.values())} expected\n"
            f"   only here:  {only_spark}\n   only in SQL: {only_sql}"
        )
    return problems


def main() -> int:
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, build in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = build(spark, folder)
            problems = differences(frame, connection, oracle_sql()[name]) if name in oracle_sql() else []
            frame.count()
        except Exception as problem:
            problems = [f"{type(problem).__name__}: {str(problem)[:1500]}"]
        bad += bool(problems)
        print(f"{'DIFF' if problems else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for shown in problems:
            print("  ", shown[:2500], flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
