"""Runs of small steps in one task give what a job for each step gives."""

import numpy as np
import pytest

from larkspur.operators import linear, sgd


def frame(spark, n=700, width=5):
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(n, width)), rng.integers(0, 3, n)
    return spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(n)],
                                 "id BIGINT, features ARRAY<DOUBLE>, label INT").repartition(6)


def test_small_steps_share_jobs(spark):
    rows, context = frame(spark), spark.sparkContext
    settings = sgd.Settings(n_classes=3, epochs=2, batch_size=5, world=1, lr=0.1, target_accuracy=2.0)
    context.setJobGroup("many-steps", "many-steps")
    trained = sgd.train(rows, rows, "id", settings)
    context.setJobGroup("rest", "rest")
    assert [(e, s, n) for e, s, n, *_ in trained.steps] == [(e, s, 5) for e in (1, 2) for s in range(140)]
    assert len(context.statusTracker().getJobIdsForGroup("many-steps")) < 60


@pytest.mark.parametrize("run_bytes", [0, 1000, 5000])
def test_runs_of_any_length_give_the_same_weights(spark, monkeypatch, run_bytes):
    rows = frame(spark, 300)
    settings = sgd.Settings(n_classes=3, epochs=2, batch_size=7, world=3, lr=0.2, target_accuracy=2.0)
    whole = sgd.train(rows, rows, "id", settings)
    monkeypatch.setattr(sgd, "RUN_BYTES", run_bytes)
    asked = []
    monkeypatch.setattr(sgd, "batch_sums", lambda *given, one=sgd.batch_sums: asked.append(1) or one(*given))
    cut = sgd.train(rows, rows, "id", settings)
    assert len(asked) == (len(cut.steps) if run_bytes < 2 * 21 * 4 * 6 else 0)
    assert np.allclose(whole.weights, cut.weights, atol=1e-12)
    assert np.allclose(whole.steps, cut.steps, atol=1e-12) and np.allclose(whole.epochs, cut.epochs, atol=1e-12)


def test_a_step_may_span_batches(spark):
    rows = frame(spark, 200).selectExpr("cast(id div 100 AS INT) AS step", "features", "label")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    found = []
    for size in ("10000", "33"):
        kept = spark.conf.get(setting)
        spark.conf.set(setting, size)
        try:
            optimizer = sgd.Momentum(0.9, 1e-4)
            found.append((*sgd.run_steps(rows, linear.zero_weights(3, 5), optimizer, 0.1), optimizer.velocity))
        finally:
            spark.conf.set(setting, kept)
    assert np.allclose(found[0][0], found[1][0]) and np.allclose(found[0][2], found[1][2])
    assert [r[:2] for r in found[0][1]] == [r[:2] for r in found[1][1]] == [(0, 100), (1, 100)]
    assert sgd.run_steps(rows.limit(0), linear.zero_weights(3, 5), sgd.Momentum(0.9, 0.0), 0.1)[1] == []


@pytest.mark.parametrize("label", [-1, 3, None])
def test_runs_refuse_labels_outside_the_classes(spark, label):
    rows = spark.createDataFrame([(0, [1.0], 0), (1, [1.0], label)], "step INT, features ARRAY<DOUBLE>, label INT")
    with pytest.raises(Exception, match="labels must be"):
        sgd.run_steps(rows, linear.zero_weights(3, 1), sgd.Momentum(0.9, 0.0), 0.1)
