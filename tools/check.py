"""Run registered queries and their SQL checks side by side and compare values.

usage: python tools/check.py [--sf 0.01] [prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quern.plans import ORACLES, QUERIES  # noqa: E402
from quern.tables import NAMES  # noqa: E402


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quern-check")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return (type(value).__name__, value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", repr(value + 0.0))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("date", value.isoformat())
    return (type(value).__name__, repr(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def spark_rows(frame):
    """Column names and rows as Spark holds them (no pandas coercion)."""
    return frame.columns, [tuple(r) for r in frame.collect()]


def compare(frame, con, sql) -> str:
    names, got = spark_rows(frame)
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(names, got), rows_of(want_names, want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"values differ in {len(bad)} rows, first {sorted(names)}\n     spark {bad[0][0]}\n     sql   {bad[0][1]}"
    return f"ok {len(got)}" if got else "EMPTY"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--set", action="append", default=[])
    parser.add_argument("--quiet", action="store_true")
    parser.add_argument("--no-sql", action="store_true", help="only time the queries")
    parser.add_argument("--skip", action="append", default=[])
    parser.add_argument("prefix", nargs="*")
    args = parser.parse_args()
    directory = f"/root/testdata/sf{args.sf}"
    spark, con = session(), duck(directory)
    for pair in args.set:
        spark.conf.set(*pair.split("="))
    bad = 0
    for name, fn in QUERIES.items():
        if args.prefix and not any(name.startswith(p) for p in args.prefix):
            continue
        if any(name.startswith(p) for p in args.skip):
            continue
        start = time.time()
        try:
            frame = fn(spark, directory)
            if args.no_sql:
                frame.write.format("noop").mode("overwrite").save()
                result = "ok timed"
            elif name in ORACLES:
                result = compare(frame, con, ORACLES[name])
            else:
                result = f"rows-only {len(frame.collect())}"
        except Exception as error:  # noqa: BLE001
            result = "ERROR " + " | ".join(str(error).strip().splitlines()[:4])[:600]
        good = result.startswith(("ok", "rows-only"))
        bad += not good
        if not (good and args.quiet):
            print(f"{name:42s} {time.time() - start:6.2f}s {result}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
