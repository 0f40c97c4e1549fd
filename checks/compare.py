"""Runs queries next to their SQL and compares names, types and rows.

    python -m checks.compare [sf_dir] [query ...]
"""

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from .oracle import ORACLE
from .queries import QUERIES

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def local_session(cpus="8", partitions=8):
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("nightledger")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def _kind(text):
    names = {
        "bigint": "long", "int": "int", "string": "text", "date": "date", "double": "double",
        "timestamp_ntz": "moment", "BIGINT": "long", "INTEGER": "int", "VARCHAR": "text",
        "DATE": "date", "DOUBLE": "double", "TIMESTAMP": "moment",
    }
    return names.get(text, text.lower())


def compare(spark, con, name, sf_dir):
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    if name not in ORACLE:
        return None
    want = con.sql(ORACLE[name])
    if sorted(df.columns) != sorted(want.columns):
        return f"columns {sorted(df.columns)} / {sorted(want.columns)}"
    have_types = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    want_types = {n: _kind(str(t)) for n, t in zip(want.columns, want.types)}
    if have_types != want_types:
        return f"types {sorted(set(have_types.items()) ^ set(want_types.items()))}"
    rows = _rows(want.columns, want.fetchall())
    if got != rows:
        return f"{len(got - rows)} rows only here, {len(rows - got)} only in SQL: {list((got - rows))[:2]} {list((rows - got))[:2]}"
    return None


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con = local_session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        begun = time.time()
        try:
            differs = compare(spark, con, name, sf_dir)
        except Exception as error:
            differs = f"{type(error).__name__}: {str(error)[:600]}"
        bad += differs is not None
        print(f"{name:28s} {time.time() - begun:6.1f}s  {differs or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
