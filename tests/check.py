"""Run queries beside their SQL: ``python tests/check.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return "null" if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for a, e in zip(actual, expected):
        if a != e:
            return f"{sorted(names)}: {a} against {e}"
    return None


def main(sf_dir: str, *names: str) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            n = df.count()
            spent = time.time() - start
            problem = difference(df, con, sql[name]) if name in sql else "(no SQL)"
        except Exception as error:
            n, spent, problem = -1, time.time() - start, str(error)[:600]
        failed += problem is not None and problem != "(no SQL)"
        print(f"{name:40} {n:>9} {spent:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
