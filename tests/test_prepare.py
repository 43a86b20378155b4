import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.functions.cleaning import to_binary_label
from larkspur.operators import prepare as prep
from larkspur.sources import tables


def test_features_stand_in_string_order():
    assert prep.feature_columns(["id", "f2", "label", "f10", "f1"]) == ["f1", "f10", "f2"]


def test_typing_of_ids_and_values(spark):
    raw = spark.createDataFrame(
        [("1", "1.5"), (" 2 ", " 2 "), ("3.7", "abc"), ("-4.0", ""), ("x", "NaN"), ("99999999999", None)],
        "id STRING, v STRING")
    got = [tuple(r) for r in prep.type_columns(raw).collect()]
    assert [g[0] for g in got] == [1, 2, 3, -4, None, 99999999999]
    assert [g[1] for g in got[:4]] == [1.5, 2.0, None, None]
    assert math.isnan(got[4][1]) and got[5][1] is None


def test_missing_values_of_every_kind(spark):
    raw = spark.createDataFrame([(1, 1.0, "a"), (2, float("nan"), "b"), (3, None, "c"), (4, 4.0, "  "),
                                 (5, 5.0, None), (6, 6.0, " NaN ")], "id INT, v DOUBLE, s STRING")
    blanked = {r["id"]: (r["v"], r["s"]) for r in prep.blank_missing(raw).collect()}
    assert blanked == {1: (1.0, "a"), 2: (None, "b"), 3: (None, "c"), 4: (4.0, None), 5: (5.0, None), 6: (6.0, None)}
    assert [r["id"] for r in prep.drop_missing(raw).collect()] == [1]


def test_clean_and_rejects_share_all_rows(spark):
    raw = spark.createDataFrame([(str(i), "" if i % 3 == 0 else "1", "x" if i % 5 == 0 else "2") for i in range(60)],
                                "id STRING, a STRING, b STRING")
    clean, rejects = prep.split_rejects(raw)
    kept, lost = {str(r["id"]) for r in clean.collect()}, {r["id"] for r in rejects.collect()}
    assert kept | lost == {str(i) for i in range(60)} and not kept & lost
    assert rejects.columns == raw.columns
    only_b = prep.split_rejects(raw, columns=["b"])[1]
    assert {r["id"] for r in only_b.collect()} == {str(i) for i in range(0, 60, 5)}


def test_scan_time_parsing_equals_casting(spark, tmp_path):
    values = ["1", "2.5", "", "  ", "abc", "NaN", "1e3", "-0.1", " 7 ", None, "Infinity", "1,5"]
    raw = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id STRING, v STRING")
    path = str(tmp_path / "t.csv")
    raw.write.option("header", True).csv(path)
    by_cast = {tuple(r) for r in prep.prepare(tables.read_csv(spark, path)).collect()}
    by_scan = {tuple(r) for r in prep.prepare(tables.read_feature_csv(spark, path)).collect()}
    assert by_cast == by_scan and len(by_cast) == 6


def test_scaling_is_learned_once_and_reused(spark):
    train = spark.createDataFrame([(1, 0.0, 5.0), (2, 2.0, 5.0), (3, 4.0, 5.0)], "id INT, a DOUBLE, b DOUBLE")
    other = spark.createDataFrame([(9, 8.0, 5.0)], "id INT, a DOUBLE, b DOUBLE")
    scaled = prep.scale(other, prep.fit_scaling(train))
    assert scaled.columns == ["id", "a", "b", "features"]
    assert scaled.select(vector_to_array("features")).first()[0] == [4.0, 0.0]


def test_signed_labels(spark):
    got = spark.createDataFrame([(-1,), (1,), (0,)], "y INT").select(to_binary_label(F.col("y"))).collect()
    assert [r[0] for r in got] == [0.0, 1.0, 0.0]


def test_prepare_prunes_unused_columns(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(10).selectExpr("id", "id * 1.0f AS a", "id AS b", "id AS c").write.parquet(path)
    plan = prep.prepare(spark.read.parquet(path), columns=["a"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,a:" in plan and "Exchange" not in plan


@pytest.mark.parametrize("width", [300])
def test_wide_tables(spark, tmp_path, width):
    names = [f"f{i}" for i in range(width)]
    path = str(tmp_path / "wide.csv")
    spark.range(50).selectExpr("cast(id AS STRING) id", *(f"cast(id + {i} AS STRING) {n}" for i, n in enumerate(names))) \
        .write.option("header", True).csv(path)
    rows = prep.prepare(tables.read_feature_csv(spark, path))
    assert rows.count() == 50 and len(rows.columns) == width + 1
