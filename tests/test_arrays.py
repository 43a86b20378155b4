import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.functions import vectors
from larkspur.operators import evaluate, linear, schedule, sgd
from larkspur.plans import jobs
from larkspur.sources import arrays


def make(n=900, k=3, d=4, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, k, n)
    x = (rng.normal(size=(n, d)) + np.eye(k, d)[y] * 3).astype(np.float32)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(len(y))],
                                 "id BIGINT, features ARRAY<FLOAT>, label INT")


def numpy_gradient(w, x, y):
    logits = x.astype(float) @ w[:, :-1].T + w[:, -1]
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    loss = -np.log(p[np.arange(len(y)), y]).mean()
    p[np.arange(len(y)), y] -= 1
    return np.hstack([p.T @ x, p.sum(0)[:, None]]) / len(y), loss


def test_gradient_matches_numpy(spark):
    x, y = make()
    w = np.random.default_rng(1).normal(size=(3, 5))
    grad, loss, count = sgd.batch_sums(frame(spark, x, y), w)
    expected, mean_loss = numpy_gradient(w, x, y)
    assert count == 900 and np.allclose(grad / count, expected, atol=1e-10)
    assert loss / count == pytest.approx(mean_loss, abs=1e-10)


@pytest.mark.parametrize("world,batch_size,steps_per_block", [(1, 128, 64), (4, 50, 2), (7, 31, 3)])
def test_training_matches_a_numpy_loop(spark, world, batch_size, steps_per_block):
    import hashlib
    x, y = make()
    rows = frame(spark, x, y)
    settings = sgd.Settings(n_classes=3, epochs=2, batch_size=batch_size, world=world, lr=0.1, seed=4,
                            target_accuracy=2.0, steps_per_block=steps_per_block)
    trained = sgd.train(rows, rows, "id", settings)
    w, velocity, losses = np.zeros((3, 5)), None, []
    for epoch in (1, 2):
        order = sorted(range(900), key=lambda i: hashlib.md5(f"4:{epoch}:{i}".encode()).hexdigest())
        order += order[:-900 % world]
        ranks = [order[r::world] for r in range(world)]
        for first in range(0, len(ranks[0]), batch_size):
            parts = [numpy_gradient(w, x[r[first:first + batch_size]], y[r[first:first + batch_size]]) for r in ranks]
            pull = np.mean([g for g, _ in parts], axis=0) + 1e-4 * w
            velocity = pull if velocity is None else 0.9 * velocity + pull
            w = w - 0.1 * (pull + 0.9 * velocity)
            losses.append(np.mean([l for _, l in parts]))
    assert np.allclose(trained.weights, w, atol=1e-9)
    assert np.allclose([s[-1] for s in trained.steps], losses, atol=1e-9)
    assert trained.epochs[-1][3] > 0.9
    log = schedule.training_log(trained.history(spark), 2)
    assert log.filter("batch % 2 <> 0").count() == 0 and log.count() > 0


def test_training_stops_at_the_target(spark):
    x, y = make()
    rows = frame(spark, x, y)
    trained = sgd.train(rows, rows, "id", sgd.Settings(n_classes=3, epochs=50, lr=0.5))
    assert len(trained.epochs) < 5 and trained.epochs[-1][3] >= 0.8


def test_few_and_many_tasks_add_up_alike(spark):
    x, y = make()
    rows, w = frame(spark, x, y), np.random.default_rng(2).normal(size=(3, 5))
    few, many = sgd.batch_sums(rows.coalesce(1), w), sgd.batch_sums(rows.repartition(9), w)
    assert np.allclose(few[0], many[0]) and few[1:] == pytest.approx(many[1:])


@pytest.mark.parametrize("label", [-1, 3, None])
def test_labels_outside_the_classes_are_refused(spark, label):
    rows = spark.createDataFrame([([1.0], 0), ([1.0], label)], "features ARRAY<DOUBLE>, label INT")
    with pytest.raises(Exception, match="labels must be"):
        sgd.batch_sums(rows, linear.zero_weights(3, 1))


def test_array_jobs_round_trip(spark, tmp_path):
    x, y = make()
    data, model, out = (str(tmp_path / n) for n in ("data", "model", "out"))
    arrays.write_arrays(frame(spark, x, y), data)
    trained = jobs.train_arrays(spark, data, model, settings=sgd.Settings(n_classes=3, epochs=3, lr=0.5))
    assert np.array_equal(linear.load_weights(spark, model), trained.weights)
    jobs.predict_arrays(spark, data, model, out)
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(out).collect()}
    scores = x.astype(float) @ trained.weights[:, :-1].T + trained.weights[:, -1]
    assert [got[i] for i in range(900)] == scores.argmax(1).tolist()


def test_work_tables_can_be_cleared(spark):
    from larkspur.sources.shared import clear_work, work_path
    path = work_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    clear_work(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_parts_are_fixed_and_disjoint(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10000).write.parquet(path)
    train, test = (arrays.read_arrays(spark, path, p) for p in ("train", "test"))
    assert train.count() + test.count() == 10000 and not train.join(test, "id").count()
    assert 0.78 < train.count() / 10000 < 0.82
    with pytest.raises(ValueError):
        arrays.read_arrays(spark, path, "other")


def test_uneven_arrays_are_refused(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id INT, features ARRAY<DOUBLE>")
    with pytest.raises(Exception, match="every row needs"):
        linear.score_arrays(rows, linear.zero_weights(2, 2)).collect()


def test_dtypes(spark):
    rows = spark.createDataFrame([([0.1],)], "a ARRAY<DOUBLE>")
    single = rows.select(vectors.to_dtype(F.col("a"), "fp32").alias("a"))
    assert single.schema["a"].dataType.simpleString() == "array<float>"
    assert single.select(vectors.to_dtype(F.col("a"), "fp64")).first()[0] == [float(np.float32(0.1))]
    with pytest.raises(NotImplementedError):
        vectors.to_dtype(F.col("a"), "fp16")


def test_losses_survive_large_scores(spark):
    rows = spark.createDataFrame([([1000.0, 0.0], 0), ([-1000.0, 0.0], 0), ([2.0, 2.0], 1)], "scores ARRAY<DOUBLE>, label INT")
    losses = [r[0] for r in rows.select(vectors.cross_entropy(F.col("scores"), F.col("label"))).collect()]
    assert losses == pytest.approx([0.0, 1000.0, math.log(2)])
    assert evaluate.mean_cross_entropy(rows).first()["accuracy"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("slots, shuffles", [(8, 1), (1000, 2)])
def test_gradients_are_summed_as_vectors(spark, slots, shuffles):
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(3)
    parts = rng.normal(size=(300, 17))
    tasks = spark.createDataFrame([(p.tolist(),) for p in parts], "part ARRAY<DOUBLE>").select(array_to_vector("part").alias("part"))
    total = sgd.summed(tasks, slots)
    assert np.allclose(total.first()["total"].toArray(), parts.sum(axis=0), atol=1e-12)
    plan = total._jdf.queryExecution().sparkPlan().toString()
    # Two aggregates a level; a vector is one value of the plan, not a row for every weight.
    assert plan.count("aggregate_metrics") and plan.count("ObjectHashAggregate") == 2 * shuffles and "explode" not in plan


def test_steps_have_row_groups_of_their_own(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    rng = np.random.default_rng(5)
    rows = frame(spark, rng.normal(size=(4000, 64)), rng.integers(0, 3, 4000))
    settings = sgd.Settings(n_classes=3, batch_size=500)
    sgd.write_epoch(rows, "id", 1, settings, str(tmp_path / "epoch"), 65)
    groups = []
    for path in glob.glob(f"{tmp_path}/epoch/block=0/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        place = meta.schema.names.index("step")
        groups += [meta.row_group(i).column(place).statistics for i in range(meta.num_row_groups)]
    spans = [g.max - g.min for g in groups]
    assert len(groups) >= 8 and max(spans) <= 2
    assert sgd.block_steps(settings, 65) > 1000 and sgd.block_steps(sgd.Settings(steps_per_block=3), 65) == 3
    plan = spark.read.parquet(f"{tmp_path}/epoch/block=0").filter("step = 3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(step,3)" in plan
