"""Compare registered queries with their oracle SQL: ``python tests/oracle_check.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


# Spark type and the type DuckDB must report for it.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    cursor = con.execute(sql)
    columns = [column[0] for column in cursor.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    wrong = {n: (kind, kinds[n]) for n, kind in df.dtypes if TYPES.get(kind) != kinds[n]}
    if wrong:
        return f"types {wrong}"
    want = rows_of(columns, cursor.fetchall())
    if got == want:
        return None
    extra = [row for row in got[:20000] if row not in set(want)][:2]
    missing = [row for row in want[:20000] if row not in set(got)][:2]
    return f"rows {len(got)} vs {len(want)}; only here {extra}; only oracle {missing}"


if __name__ == "__main__":
    from ripplelog.session import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = session(
        "oracle-check",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__sql__session__timeZone=os.environ.get("CHECK_ZONE", "UTC"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    failed = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, name, folder)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{time.time() - start:7.2f}s {name} {problem or ''}", flush=True)
    print("failed:", failed)
