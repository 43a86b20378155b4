import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from larkspur.operators import sampling
from larkspur.sources import tables


def order(n, seed, epoch):
    return sorted(range(n), key=lambda k: hashlib.md5(f"{seed}:{epoch}:{k}".encode()).hexdigest())


@pytest.mark.parametrize("digits", [1, 2, 4, 5])
def test_positions_follow_the_digest(spark, digits):
    rows = sampling.shuffled_positions(spark.range(3000), "id", 11, 2, digits).collect()
    assert [r["id"] for r in sorted(rows, key=lambda r: r["pos"])] == order(3000, 11, 2)
    assert {r["n_rows"] for r in rows} == {3000}


def test_epochs_differ_and_repeat(spark):
    def keys(epoch):
        return sampling.shuffled_positions(spark.range(500), "id", 1, epoch).orderBy("pos").collect()
    assert keys(1) == keys(1) != keys(2)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 60), world=st.integers(1, 9), batch=st.integers(1, 7))
def test_shards_cover_rows_evenly(spark, n, world, batch):
    rows = sampling.epoch_batches(spark.range(n), "id", 3, 1, world, batch).collect()
    total = -(-n // world) * world
    assert sorted(r["pos"] for r in rows) == list(range(total))
    expected = order(n, 3, 1)
    for r in rows:
        assert r["id"] == expected[r["pos"] % n]
        assert (r["rank"], r["slot"], r["batch"]) == (r["pos"] % world, r["pos"] // world, r["pos"] // world // batch)
    assert len({r["id"] for r in rows if r["pos"] < n}) == n


@pytest.mark.parametrize("n", [1, 2, 5000])
def test_key_order_is_exact_for_uneven_keys(spark, n):
    frame = spark.range(n).selectExpr("cast(pow(1.004, id) * 1000 AS BIGINT) * 10000 + id AS k")
    rows = sorted(sampling.ordered_positions(frame, "k", 64).collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in rows] == list(range(n))
    assert all(a["k"] < b["k"] for a, b in zip(rows, rows[1:]))


def test_key_order_of_neighbouring_large_keys(spark):
    """Keys that share one double still get exact, distinct positions."""
    frame = spark.range(2000).selectExpr("9007199254740992 + id AS k")
    rows = sorted(sampling.ordered_positions(frame, "k", 32).collect(), key=lambda r: r["pos"])
    assert [r["k"] - 9007199254740992 for r in rows] == list(range(2000))


def test_no_window_over_the_whole_table(spark):
    plan = sampling.shuffled_positions(spark.range(100), "id", 1, 1)._jdf.queryExecution().executedPlan().toString()
    # Both unpartitioned windows sit above the per-bucket counts, inside the broadcast.
    assert "BroadcastHashJoin" in plan and plan.count("SinglePartition") <= 2


def test_file_place_keys_drive_the_sampler(spark, folder):
    rows = tables.read_keyed_parquet(spark, f"{folder}/lineitem.parquet")
    assert tables.find_repeated_keys(rows, "row_key").count() == 0
    placed = sampling.shuffled_positions(rows.select("row_key"), "row_key", 1, 1)
    assert placed.select("pos").distinct().count() == rows.count()


@pytest.mark.parametrize("place", [sampling.ordered_positions, lambda df, key: sampling.shuffled_positions(df, key, 1, 1)])
def test_repeated_keys_are_refused(spark, place):
    rows = spark.range(100).selectExpr("id % 99 AS k")
    assert [tuple(r) for r in tables.find_repeated_keys(rows, "k").collect()] == [(0, 2)]
    with pytest.raises(Exception, match="unique key"):
        place(rows, "k").collect()
    with pytest.raises(Exception, match="unique key"):
        place(spark.range(9).selectExpr("nullif(id, 4) AS k"), "k").collect()


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        sampling.shuffled_positions(spark.range(1), "id", 1, 1, digits=9)
    placed = sampling.shuffled_positions(spark.range(4), "id", 1, 1)
    with pytest.raises(ValueError):
        sampling.shard(placed, 0)
    with pytest.raises(ValueError):
        sampling.batches(sampling.shard(placed, 2), 0)


@pytest.mark.parametrize("buckets", [None, 1, 9])
def test_text_keys_have_an_order(spark, buckets):
    frame = spark.range(700).selectExpr("md5(cast(id AS STRING)) AS k")
    rows = sorted(sampling.ordered_positions(frame, "k", buckets).collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in rows] == list(range(700))
    assert all(a["k"] < b["k"] for a, b in zip(rows, rows[1:]))
