"""Wide vectors are made as they are read; the fit is Spark's."""

import glob
import os

import numpy as np
import pytest
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from larkspur.operators import classify, evaluate, linear, wide
from larkspur.plans import catalog
from larkspur.sources import shared


def make(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = np.hstack([rng.normal(2.0, (0.5, 1.0, 30.0), size=(n, 3)), np.full((n, 1), 7.0)])
    y = (x[:, 0] + 0.05 * x[:, 2] + rng.normal(size=n) > 3).astype(float)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "v ARRAY<DOUBLE>, label DOUBLE")


def reader(width):
    to_matrix = linear.matrix_reader(width)
    return lambda batch: to_matrix(batch.column("v"))


def test_fit_is_that_of_spark(spark, monkeypatch):
    monkeypatch.setattr(wide, "HELD_BYTES", 1000)
    x, y = make()
    rows = frame(spark, x, y).repartition(5)
    estimator = classify.logistic(max_iter=200, penalty="ridge", reg_param=0.02, tol=1e-10)
    model = wide.fit(rows, reader(4), 4, estimator)
    vectors = rows.select("label", array_to_vector("v").alias("raw"))
    scaled = StandardScaler(inputCol="raw", outputCol="features").fit(vectors).transform(vectors)
    spark_model = estimator.fit(scaled)
    assert np.allclose(model.coefficients[:3] * x[:, :3].std(axis=0, ddof=1), spark_model.coefficients.toArray()[:3], atol=1e-6)
    assert model.coefficients[3] == 0 and model.intercept == pytest.approx(spark_model.intercept, abs=1e-5)
    assert model.objective[0] == pytest.approx(spark_model.summary.objectiveHistory[0], abs=1e-12)
    assert model.objective[-1] == pytest.approx(spark_model.summary.objectiveHistory[-1], abs=1e-9)
    assert all(b <= a for a, b in zip(model.objective, model.objective[1:]))
    got = evaluate.accuracy(wide.evaluate_rows(model, rows, reader(4))).first()
    want = ((x @ model.coefficients + model.intercept > 0) == (y == 1)).mean()
    assert got["rows"] == 600 and got["accuracy"] == pytest.approx(want)


def test_odd_tables_of_a_wide_fit(spark):
    x, y = make(40)
    estimator = classify.logistic(max_iter=5)
    one = wide.fit(frame(spark, x, np.ones(40)), reader(4), 4, estimator)
    assert one.intercept == float("inf") and not one.coefficients.any()
    for rows, said in ((frame(spark, x, y).limit(0), "empty"), (frame(spark, x, y + 1), "labels"),
                       (frame(spark, np.where(x == 7, np.nan, x), y), "finite")):
        with pytest.raises(Exception, match=said):
            wide.fit(rows, reader(4), 4, estimator)
    with pytest.raises(ValueError, match="L1"):
        wide.fit(frame(spark, x, y), reader(4), 4, classify.logistic(penalty="lasso", reg_param=0.1))


def test_nothing_wide_is_staged_or_kept(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(120, 64)).tolist())]
    spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").write.parquet(f"{tmp_path}/embeddings.parquet")
    before = set(glob.glob(f"{shared.shared_folder(spark)}/*/wide-*"))
    result = catalog.wide_run(spark, str(tmp_path)).first()
    assert result["train_rows"] + result["test_rows"] == 120 * 25 and result["features"] == 2144 and result["rises"] == 0
    (staged,) = set(glob.glob(f"{shared.shared_folder(spark)}/*/wide-*")) - before
    size = sum(os.path.getsize(f) for f in glob.glob(f"{staged}/*.parquet"))
    assert size < 120 * 25 * 2144 * 4 / 20
    found = spark.read.parquet(staged)
    assert found.count() == 3000 and found.agg(F.max(F.size("embedding"))).first()[0] == 64
