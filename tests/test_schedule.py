import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from larkspur.operators import schedule


def by_hand(losses, lr=0.02, patience=2):
    best, bad, out = float("inf"), 0, []
    for loss in losses:
        if loss < best * (1 - 1e-4):
            best, bad = loss, 0
        else:
            bad += 1
        if bad > patience:
            lower = lr * 0.1
            if lr - lower > 1e-8:
                lr = lower
            bad = 0
        out.append((lr, best, bad))
    return out


def rates(spark, runs, **options):
    rows = [(r, e, float(l)) for r, losses in runs.items() for e, l in enumerate(losses)]
    got = schedule.plateau_rates(spark.createDataFrame(rows, "run_id BIGINT, epoch BIGINT, loss DOUBLE"), **options)
    out = {}
    for r in got.orderBy("run_id", "epoch").collect():
        out.setdefault(r["run_id"], []).append((r["lr"], r["best_loss"], r["bad_epochs"]))
    return out


def check(spark, runs, **options):
    got = rates(spark, runs, **options)
    for run, losses in runs.items():
        want = by_hand(losses)
        assert [g[2] for g in got[run]] == [w[2] for w in want]
        assert np.allclose([g[:2] for g in got[run]], [w[:2] for w in want], rtol=1e-12, atol=0, equal_nan=True)


def test_rate_falls_after_patience_runs_out(spark):
    got = rates(spark, {1: [1.0, 1.0, 1.0, 1.0, 0.5]})[1]
    assert [round(g[0], 6) for g in got] == [0.02, 0.02, 0.02, 0.002, 0.002]


@pytest.mark.parametrize("part_epochs", [1, 7, 500, 1_000_000])
def test_many_runs_of_many_shapes(spark, part_epochs):
    rng = np.random.default_rng(2)
    runs = {r: rng.exponential(size=rng.integers(1, 400)) for r in range(30)}
    runs[100] = np.linspace(1, 0.1, 3000)           # improves at each epoch
    runs[101] = np.full(3000, 1.0)                  # never improves
    runs[102] = 1 - np.arange(3000) * 3e-5          # improves by less than the threshold per epoch
    runs[103] = np.concatenate([np.full(50, 1.0), np.full(50, 0.5), np.full(50, 0.6)])
    check(spark, runs, part_epochs=part_epochs)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(losses=st.lists(st.sampled_from([1.0, 0.99995, 0.9999, 0.9998, 0.5, 0.2, 2.0]), min_size=1, max_size=60))
def test_any_history(spark, losses):
    check(spark, {7: losses}, part_epochs=3)


def test_odd_losses(spark):
    inf, nan = float("inf"), float("nan")
    runs = {1: [nan, inf, nan, 3.0, nan, 2.0, nan, nan, nan, 0.0, 0.0, 0.0, 0.0], 2: [nan, nan, nan, nan], 3: [inf] * 9,
            4: [1.0, -inf, -inf, -5.0, 2.0], 5: [-0.0, 0.0, -1e-300, 1.0]}
    for part_epochs in (2, 1_000_000):
        check(spark, runs, part_epochs=part_epochs)
    none = spark.createDataFrame([(1, 0, None), (1, 1, 2.0), (1, 2, None)], "run_id BIGINT, epoch BIGINT, loss DOUBLE")
    assert [(r["best_loss"], r["bad_epochs"]) for r in schedule.plateau_rates(none).orderBy("epoch").collect()] == [
        (inf, 1), (2.0, 0), (2.0, 1)]
    assert schedule.plateau_rates(none.limit(0)).collect() == []


@pytest.mark.parametrize("part_epochs, fold_events", [(3, 10 ** 6), (100, 150), (10 ** 6, 10 ** 6)])
def test_losses_of_any_sign(spark, part_epochs, fold_events):
    """A negative best loss is beaten by losses that are a little worse, so it may drift."""
    rng = np.random.default_rng(4)
    runs = {r: rng.normal(size=rng.integers(1, 200)) for r in range(12)}
    runs[50] = -1 + 1e-5 * rng.normal(size=600)
    runs[51] = np.linspace(1, -1, 500)
    runs[52] = -1 + np.arange(400) * 5e-5
    runs[53] = np.concatenate([np.linspace(2, 1.999, 300), [-3.0], np.full(50, -3.0), np.full(50, -2.9999), np.full(20, 5.0)])
    check(spark, runs, part_epochs=part_epochs, fold_events=fold_events)


def test_plan_holds_no_python(spark):
    rows = spark.createDataFrame([(1, 0, 2.0), (1, 5, 1.0)], "run_id BIGINT, epoch BIGINT, loss DOUBLE")
    for part_epochs in (2, 1_000_000):
        plan = schedule.plateau_rates(rows, part_epochs=part_epochs)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_stop_epoch(spark):
    rows = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.8), (1, 3, 0.9), (2, 1, 0.1)], "run_id INT, epoch INT, accuracy DOUBLE")
    assert [tuple(r) for r in schedule.stop_epochs(rows).collect()] == [(1, 2)]
