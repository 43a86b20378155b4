"""Compare every registered query with its SQL on DuckDB.

usage: python tools/check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

from larkspur.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark, con, folder, name):
    """(spark rows, matches or None without SQL, detail)."""
    frame = catalog.QUERIES[name](spark, folder)
    got = bag(frame.columns, frame.collect())
    if name not in catalog.SQL:
        return sum(got.values()), None, ""
    result = con.execute(catalog.SQL[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(frame.columns):
        return sum(got.values()), False, f"columns {sorted(frame.columns)} / {sorted(columns)}"
    want = bag(columns, result.fetchall())
    if got == want:
        types = {d[0]: str(d[1]) for d in result.description}
        return sum(got.values()), True, " ".join(f"{f.name}:{f.dataType.simpleString()}/{types[f.name]}" for f in frame.schema)
    missing, extra = want - got, got - want
    return sum(got.values()), False, (f"{sum(missing.values())} missing {list(missing)[:2]}, "
                                      f"{sum(extra.values())} extra {list(extra)[:2]}")


def main(folder="/root/testdata/sf0.01", *names):
    spark = (SparkSession.builder.master("local[8]").appName("check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="larkspur-"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(folder), []
    for name in names or catalog.QUERIES:
        began = time.time()
        try:
            rows, same, detail = compare(spark, con, folder, name)
        except Exception as error:  # report and go on to the next query
            rows, same, detail = -1, False, f"{type(error).__name__}: {str(error)[:600]}"
        verdict = {True: "ok", False: "DIFFERS", None: "rows"}[same]
        if same is False or (same is None and rows <= 0):
            bad.append(name)
        print(f"{verdict:8}{name:28}{rows:>9} {time.time() - began:6.1f}s  {detail}", flush=True)
    print("differing:", bad or "none")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
