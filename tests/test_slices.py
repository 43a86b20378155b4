"""Slices of training tables follow from the data alone."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import classify, slices

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys, tempfile
from pyspark.sql import SparkSession
slots, files = sys.argv[1:3]
spark = (SparkSession.builder.master(f"local[{slots}]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", slots)
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="larkspur-")).getOrCreate())
spark.sparkContext.setLogLevel("OFF")
from larkspur.operators import classify
rows = spark.range(3000).selectExpr(
    "cast(pmod(xxhash64(id), 3) = 0 AS FLOAT) AS label", "cast(pmod(xxhash64(id, 1), 1000) AS FLOAT) AS a",
    "cast(pmod(xxhash64(id, 2), 1000) AS FLOAT) AS b")
trees = classify.fit_forest(rows.repartition(int(files)), num_trees=3, seed=5, parts=5).stages[-1].toDebugString
print("TREES", hash(trees.split(chr(10), 1)[1]))
"""


def test_slices_grow_with_the_table():
    planned = [slices.planned_slices(n, 100) for n in (0, 1, 10 ** 4, 10 ** 5, 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 9, 10 ** 12)]
    assert planned == sorted(planned)
    assert planned[:2] == [1, 1] and planned[4] == slices.FEW and planned[-1] == -(-10 ** 14 // slices.LARGE)
    assert slices.planned_slices(500_000, 8008) == slices.FEW


def test_one_forest_on_any_number_of_slots_and_files():
    found = set()
    for slots, files in ((2, 1), (8, 13)):
        done = subprocess.run([sys.executable, "-c", SCRIPT, str(slots), str(files)], cwd=ROOT, capture_output=True, text=True,
                              env=os.environ | {"PYTHONHASHSEED": "0"}, timeout=200)
        found.add(next(line for line in done.stdout.splitlines() if line.startswith("TREES")))
    assert len(found) == 1


@pytest.mark.parametrize("share", [0.0, 0.4])
def test_rows_are_dealt_whole_and_hot_rows_are_split(spark, monkeypatch, share):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    monkeypatch.setattr(slices, "TOGETHER", 50)
    rows = spark.range(3000).select(
        F.when(F.col("id") < 3000 * share, 1.0).otherwise(F.col("id") % 2).cast("double").alias("label"),
        array_to_vector(F.when(F.col("id") < 3000 * share, F.array(F.lit(7.0), F.lit(7.0))).otherwise(
            F.array(F.col("id").cast("double"), F.lit(0.5)))).alias("x"))
    both = []
    for files in (1, 7):
        dealt = slices.deal_rows(rows.repartition(files), 12, "label", "x").select("label", vector_to_array("x").alias("x"))
        both.append([[(r["label"], tuple(r["x"])) for r in part] for part in dealt.rdd.glom().collect()])
    assert both[0] == both[1] and len(both[0]) == 12
    want = [(r["label"], tuple(r["x"])) for r in rows.select("label", vector_to_array("x").alias("x")).collect()]
    assert sorted(sum(both[0], [])) == sorted(want)
    sizes = [len(part) for part in both[0]]
    assert max(sizes) < 3 * np.mean(sizes)


def test_slices_of_a_fit_follow_its_rows(spark, monkeypatch):
    asked = []
    deal = classify.deal_rows
    monkeypatch.setattr(classify, "deal_rows", lambda rows, n, *names: asked.append(n) or deal(rows, n, *names))
    monkeypatch.setattr(slices, "SMALL", 1000)
    for n in (50, 500, 5000):
        rows = spark.range(n).selectExpr("cast(id % 2 AS FLOAT) AS label", "cast(id AS FLOAT) AS a")
        classify.fit_logistic(rows, max_iter=1)
    assert asked == [1, 6, 60]
    classify.select_features(rows, max_iter=1, parts=3)
    assert asked[-1] == 3
