"""Compare queries with their SQL: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float):
        return repr(value + 0.0)
    return repr(value)


def kinds(row) -> list[str]:
    return [type(v).__name__ for v in row]


def differences(spark, sf: str, con, name: str, query, sql: str) -> list[str]:
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = [tuple(row) for row in df.select(*columns).collect()]
    rel = con.sql(sql)
    if sorted(rel.columns) != columns:
        return [f"columns {columns} against {sorted(rel.columns)}"]
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = rel.project(quoted).fetchall()
    if len(got) != len(want):
        return [f"{len(got)} rows against {len(want)}"]
    left = sorted([tuple(map(plain, row)) for row in got])
    right = sorted([tuple(map(plain, row)) for row in want])
    found = [f"{a} against {b}" for a, b in zip(left, right) if a != b]
    # Integer widths and the like: compare what each side calls the types.
    simple = {"bigint": "long", "integer": "int", "varchar": "string", "hugeint": "HUGEINT"}
    types = dict(zip(rel.columns, [str(t).lower() for t in rel.types]))
    spark_types = dict(df.dtypes)
    for c in columns:
        a = {"bigint": "long", "int": "int"}.get(spark_types[c], spark_types[c])
        b = simple.get(types[c], types[c])
        if a != b:
            found.append(f"type of {c}: {a} against {b}")
    return found


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from tallyrisk.session import configure

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = connect(sf), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args or queries:
        start = time.time()
        if name not in oracle:
            rows = queries[name](spark, sf).count()
            print(f"rows {name} {rows} {time.time() - start:.1f}s", flush=True)
            continue
        try:
            found = differences(spark, sf, con, name, queries[name], oracle[name])
        except Exception as e:  # noqa: BLE001
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        for line in found[:4]:
            print("     ", line[:700], flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
