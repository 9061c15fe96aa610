"""Run registered queries beside their SQL and compare whole results.

    python -m checks.compare [--set key=value ...] [sf_dir] [name ...]

``--set`` changes a Spark setting, for instance ``spark.sql.autoBroadcastJoinThreshold=-1`` to see the
plans that large tables get.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.spark_queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def local_session(cores: int | str = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("merchmill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_cell(row[i])) for i in order) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> dict:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    mine = rows_of(df.columns, (tuple(r) for r in df.collect()))
    seconds = time.time() - start
    result = con.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    theirs = rows_of(columns, result.fetchall())
    return {
        "name": name, "seconds": round(seconds, 2), "rows": sum(mine.values()),
        "same": sorted(columns) == sorted(df.columns) and mine == theirs,
        "only_spark": list((mine - theirs).elements())[:2], "only_sql": list((theirs - mine).elements())[:2],
        "sql_rows": sum(theirs.values()),
    }


def main(argv: list[str]) -> int:
    spark = local_session()
    while argv[:1] == ["--set"]:
        spark.conf.set(*argv[1].split("=", 1))
        argv = argv[2:]
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    con = duck(sf_dir)
    bad = 0
    for name in argv[1:] or QUERIES:
        try:
            r = compare(spark, con, sf_dir, name)
        except Exception as problem:  # shown, counted, and the next query goes on
            bad += 1
            print(f"ERROR {name}: {str(problem)[:1500]}", flush=True)
            continue
        print(f"{'ok   ' if r['same'] else 'DIFF '}{name:28s}{r['rows']:8d} rows {r['seconds']:6.2f} s", flush=True)
        if not r["same"]:
            bad += 1
            print("   ", r["sql_rows"], "\n    spark", r["only_spark"], "\n    sql  ", r["only_sql"], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
