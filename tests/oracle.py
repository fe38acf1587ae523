"""Compare registered queries with their SQL twins, as a script or from tests.

    python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DEFAULT_DIR = "/root/testdata/sf0.01"

KINDS = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint",
    "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (int, str, datetime, date, Decimal)):
        return f"{type(value).__name__}:{value}"
    return repr(float(value))


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def compare(frame, con, sql: str) -> str | None:
    """What differs between a query's result and its SQL twin's, or None."""
    got = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cursor.description}
    wanted = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if kinds != dict(frame.dtypes):
        return f"types {dict(frame.dtypes)} != {kinds}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    for a, b in zip(got, wanted):
        if a != b:
            return f"{a} != {b} (sorted columns {sorted(names)})"
    return None if got else "no rows"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else DEFAULT_DIR
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if args and name not in args:
            continue
        started = time.time()
        try:
            if name in sql:
                fault = compare(query(spark, sf_dir), con, sql[name])
                verdict = "ok" if fault is None else f"DIFFERS: {fault}"
            else:
                verdict = f"rows only: {len(query(spark, sf_dir).collect())}"
        except Exception as error:  # report and go on with the next query
            verdict = f"FAILED: {str(error)[:1500]}"
        failed += not verdict.startswith(("ok", "rows only"))
        print(f"{name}: {verdict} [{time.time() - started:.1f}s]", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
