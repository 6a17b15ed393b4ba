"""Run queries and their SQL side by side. `python -m tests.compare [folder] [name ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    return repr(value)


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def difference(spark: SparkSession, con, folder: str, fn, sql: str | None) -> str:
    """Empty when the query equals its SQL in columns, types and rows."""
    df = fn(spark, folder)
    got = df.collect()
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = [(c, t, types[c]) for c, t in df.dtypes if _TYPES.get(t, t) != types[c]]
    if wrong:
        return f"types {wrong}"
    if not want:
        return "the SQL gives no rows"
    a, b = _rows(df.columns, got), _rows(names, want)
    if len(a) != len(b):
        return f"{len(a)} rows, SQL {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            bad = [(sorted(names)[i], p[:300], q[:300]) for i, (p, q) in enumerate(zip(x, y)) if p != q]
            return f"values differ: {bad[:3]}"
    return ""


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from newsflow.session import build_session

    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        start = time.time()
        try:
            problem = difference(spark, con, folder, queries[name], oracles.get(name))
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql " if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem}",
              flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]), 1))
