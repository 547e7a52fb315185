"""Runs registered queries on Spark and their SQL twins on DuckDB and compares the results.

    python tools/check.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

from suite import CASES, ORACLES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BLOB",
}


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def compare(spark_df, relation) -> str:
    rows = spark_df.collect()
    names = spark_df.columns
    other_names = [d[0] for d in relation.description]
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} != {sorted(other_names)}"
    types = {d[0]: str(d[1]) for d in relation.description}
    odd = [
        f"{n}:{k}/{types[n]}" for n, k in spark_df.dtypes if KINDS.get(k) and types[n] not in (KINDS[k], "NUMBER", "STRING", "DATETIME", "bool")
    ]
    other = relation.fetchall()
    order = sorted(names)
    mine = sorted((tuple(plain(r[n]) for n in order) for r in rows), key=repr)
    at = [other_names.index(n) for n in order]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in other), key=repr)
    if len(mine) != len(theirs):
        extra = sorted(set(mine) - set(theirs), key=repr)[:2]
        lost = sorted(set(theirs) - set(mine), key=repr)[:2]
        return f"rows {len(mine)} != {len(theirs)}  only spark {extra}  only sql {lost}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"values differ {order}: {a} != {b}"
    return f"ok {len(mine)} rows" + (f" TYPES {odd}" if odd else "") + (" EMPTY" if not mine else "")


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    bad = 0
    for name, query in CASES.items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = query(spark, folder)
            if name in ORACLES:
                text = compare(df, duck.execute(ORACLES[name]))
            else:
                text = f"ok {len(df.collect())} rows (no SQL)"
        except Exception as error:  # noqa: BLE001  (every failure is reported)
            text = f"{type(error).__name__}: {str(error)[:600]}"
        failed = not text.startswith("ok")
        bad += failed
        print(f"{'FAIL' if failed else 'pass'} {name:34s} {time.time() - start:5.2f}s {text}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
