"""Run registered queries on Spark and their SQL on DuckDB and report every difference.

    python tools/compare.py [/path/to/sf] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tapelake.plans import all_queries, all_sql  # noqa: E402
from tapelake.session import local_session  # noqa: E402

TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and value != value:
        return "NaN"
    return value


def connect(path: str):
    con = duckdb.connect()
    for file in sorted(Path(path).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(spark, con, path: str, name: str) -> str:
    start = time.time()
    df = all_queries()[name](spark, path)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    took = time.time() - start
    sql = all_sql().get(name)
    if sql is None:
        return f"rows {sum(got.values())} ({took:.1f}s)"
    cursor = con.execute(f"SELECT * FROM ({sql.strip().rstrip(';')}) LIMIT 0")
    types = {c[0]: str(c[1]) for c in cursor.description}
    if sorted(types) != columns:
        return f"COLUMNS spark {columns} sql {sorted(types)}"
    wrong = [(f.name, f.dataType.simpleString(), types[f.name]) for f in df.schema
             if TYPES.get(f.dataType.simpleString()) != types[f.name]]
    if wrong:
        return f"TYPES {wrong}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = Counter(tuple(plain(v) for v in row) for row in con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"DIFFER spark {sum(got.values())} sql {sum(want.values())}\n  {columns}\n  +{extra}\n  -{missing}"
    return f"ok rows {sum(got.values())} ({took:.1f}s)"


def main() -> int:
    args = sys.argv[1:]
    path = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(path)
    bad = 0
    for name in args or all_queries():
        try:
            result = compare(spark, con, path, name)
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        bad += not result.startswith(("ok", "rows"))
        if args or not result.startswith("ok") or result.startswith("ok rows 0"):
            print(f"{name}: {result}", flush=True)
    print(f"{len(args or all_queries())} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
