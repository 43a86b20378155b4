import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.operators import classify, evaluate, prepare as prep
from larkspur.plans import jobs
from larkspur.sources import models, tables


@pytest.fixture(scope="module")
def planted(spark):
    """Two real features, three of noise."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 5))
    y = (2 * x[:, 0] - 3 * x[:, 1] + rng.normal(size=4000) > 0).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i] * [1, 10, 1, 1, 1])) for i in range(4000)]
    return prep.prepare(spark.createDataFrame(
        rows, "id INT, label INT, a DOUBLE, b DOUBLE, n1 DOUBLE, n2 DOUBLE, n3 DOUBLE"))


def test_known_signal_is_learned(spark, planted):
    model = classify.fit_logistic(planted)
    table = {r["feature"]: r for r in classify.coefficients(spark, model).collect()}
    assert table["a"]["coefficient"] > 1 and table["b"]["coefficient"] < -1
    assert all(abs(table[n]["coefficient"]) < 0.2 for n in ("n1", "n2", "n3"))
    # b was stretched tenfold, so per raw unit it weighs a tenth of its scaled weight.
    assert table["b"]["raw_coefficient"] == pytest.approx(table["b"]["coefficient"] / 10, rel=0.05)
    assert evaluate.accuracy(classify.evaluate_rows(model, planted)).first()["accuracy"] > 0.85


def test_penalties_differ_and_need_a_strength(spark, planted):
    def zeros(penalty):
        model = classify.fit_logistic(planted, penalty=penalty, reg_param=0.05)
        return classify.coefficients(spark, model).filter("coefficient = 0").count()
    assert zeros("lasso") > zeros("ridge") == 0
    with pytest.raises(ValueError):
        classify.fit_logistic(planted, penalty="lasso")
    with pytest.raises(ValueError):
        classify.penalty_mix("other", 1.0)
    assert jobs.penalty_from_flags(True, True) == "ridge"


def test_selection_finds_the_real_features(planted):
    chosen = classify.select_features(planted)
    assert {r["feature"] for r in chosen.collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        classify.select_features(planted, max_iter=10.5)


def test_objective_never_rises(spark, planted):
    history = classify.training_history(spark, classify.fit_logistic(planted, max_iter=11, penalty="ridge", reg_param=2.5e-6))
    values = [r["objective"] for r in history.orderBy("iteration").collect()]
    assert len(values) > 3 and all(b <= a + 1e-12 for a, b in zip(values, values[1:]))


def test_staging_does_not_change_the_fit(planted):
    fits = [classify.fit_logistic(planted, staged=s).stages[-1].coefficients.toArray() for s in (True, False)]
    assert np.allclose(*fits, rtol=1e-6)


def test_saved_models_score_alike(spark, planted, tmp_path):
    for fit in (classify.fit_logistic, classify.fit_forest):
        model, path = fit(planted), str(tmp_path / fit.__name__)
        models.save_model(model, path)
        models.save_model(model, path)  # replaces the first
        loaded = models.load_model(f"file://{path}")
        a, b = (classify.score(m, planted, with_probability=True).collect() for m in (model, loaded))
        assert a == b


def test_forest_repeats_with_its_seed(planted):
    trees = [classify.fit_forest(planted, seed=3).stages[-1].toDebugString.split("\n", 1)[1] for _ in range(2)]
    assert trees[0] == trees[1]


def test_accuracy_equals_library_evaluator(spark, planted):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = classify.evaluate_rows(classify.fit_forest(planted), planted)
    theirs = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(rows)
    assert evaluate.accuracy(rows).first()["accuracy"] == pytest.approx(theirs, abs=1e-12)


def test_scoring_ignores_label_and_unused_columns(spark, planted):
    model = classify.fit_logistic(planted, features=["a", "b"])
    raw = spark.createDataFrame([("1", None, "1", "-1", "junk"), ("2", "", "oops", "1", "")],
                                "id STRING, label STRING, a STRING, b STRING, extra STRING")
    assert [tuple(r) for r in classify.score(model, raw).collect()] == [(1, 1)]


@pytest.mark.parametrize("algorithm", ["logistic", "forest"])
def test_train_and_predict_from_files(spark, planted, tmp_path, algorithm):
    text, model, out, bad = (str(tmp_path / n) for n in ("in.csv", "model", "out.csv", "bad.csv"))
    spoiled = planted.withColumn("a", F.when(F.col("id") == 7, F.lit("?")).otherwise(F.col("a").cast("string")))
    spoiled.write.option("header", True).csv(text)
    jobs.run(spark, f"file://{text}", text, model, out, algorithm=algorithm)
    jobs.predict(spark, text, model, out, rejects_path=bad)
    got = tables.read_csv(spark, out)
    assert got.columns == ["id", "prediction"] and got.count() == 3999
    assert [r["id"] for r in tables.read_csv(spark, bad).collect()] == ["7"]
    truth = planted.select(F.col("id").cast("string"), "label")
    hits = got.join(truth, "id").filter("cast(prediction AS INT) = cast(label AS INT)").count()
    assert hits > 3400


def test_forest_takes_no_penalty(spark):
    with pytest.raises(ValueError):
        jobs.train(spark, "unused", algorithm="forest", ridge=True)


@pytest.mark.parametrize("coding", [0, -1])
def test_libsvm_jobs(spark, planted, tmp_path, coding):
    text, model = str(tmp_path / "in.libsvm"), str(tmp_path / "model")
    coded = F.when(F.col("label") == 1, 1.0).otherwise(float(coding)).alias("label")
    prep.assemble(planted).select(coded, "features").write.format("libsvm").save(text)
    fitted = jobs.train_libsvm(spark, text, model, 5)
    result = jobs.evaluate_libsvm(spark, text, model, 5).first()
    assert result["rows"] == 4000 and result["accuracy"] > 0.85
    assert fitted.stages[-1].summary.accuracy == pytest.approx(result["accuracy"])
    jobs.train_libsvm(spark, text, model, 5, classify.forest(num_trees=8))
    assert jobs.evaluate_libsvm(spark, text, model, 5).first()["accuracy"] > 0.8


def test_benchmark_reports_each_configuration(spark, planted):
    report = jobs.benchmark(spark, planted, planted, [{"max_iter": 1}, {"max_iter": 5}]).collect()
    assert [r["config"] for r in report] == ["max_iter=1", "max_iter=5"]
    assert all(r["test_rows"] == 4000 and r["train_seconds"] > 0 and r["accuracy"] > 0.5 for r in report)


def test_feature_selection_job(spark, planted, tmp_path):
    text = str(tmp_path / "in.csv")
    planted.write.option("header", True).csv(text)
    assert {r["feature"] for r in jobs.select_features(spark, text).collect()} == {"a", "b"}


def test_one_seed_gives_one_forest(spark):
    """However many slices the rows come in, in whatever order."""
    rows = spark.range(3000).selectExpr(
        "id", "cast(pmod(xxhash64(id), 3) = 0 AS FLOAT) AS label", "cast(pmod(xxhash64(id, 1), 1000) AS FLOAT) AS a",
        "cast(pmod(xxhash64(id, 2), 1000) AS FLOAT) AS b")
    trees = {classify.fit_forest(rows.repartition(n), num_trees=3, seed=5).stages[-1].toDebugString.split("\n", 1)[1] for n in (1, 7)}
    assert len(trees) == 1


def test_fits_leave_no_work_tables(spark):
    from larkspur.sources.shared import _work_root

    rows = spark.range(200).selectExpr("id", "cast(id % 2 AS FLOAT) AS label", "cast(id AS FLOAT) AS a")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def tables():
        root = jvm.org.apache.hadoop.fs.Path(_work_root(spark))
        return len(root.getFileSystem(conf).globStatus(jvm.org.apache.hadoop.fs.Path(root, "assembled-*")) or [])

    before = tables()
    classify.fit_logistic(rows)
    classify.fit_forest(rows, num_trees=2)
    assert tables() == before
