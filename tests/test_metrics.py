import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from larkspur.operators import rollup
from larkspur.sources import objects, points
from larkspur.streaming import rollups

START = dt.datetime(2024, 1, 1)


def sample(spark, seconds, value=None):
    rows = [(i, START + dt.timedelta(seconds=s), "cpu" if i % 3 else "mem", i % 2, i % 4, float(i if value is None else value))
            for i, s in enumerate(seconds)]
    return spark.createDataFrame(
        rows, "point_id BIGINT, ts TIMESTAMP, measurement STRING, namespace INT, pod BIGINT, value DOUBLE")


def test_default_window_is_the_report_period(spark):
    got = rollup.usage_over_time(sample(spark, [0, 9, 10, 19, 20])).agg(F.sum("points"), F.count("*")).first()
    assert tuple(got) == (5, 5)
    assert rollup.usage_over_time(sample(spark, [0, 9, 10, 19, 20]).withColumn("measurement", F.lit("x"))).count() == 3


def test_range_is_half_open(spark):
    rows = rollup.in_range(sample(spark, [0, 10, 20]), START, START + dt.timedelta(seconds=20))
    assert sorted(r["point_id"] for r in rows.collect()) == [0, 1]


def test_pickers_choose_namespace_and_pod(spark, folder):
    rows = sample(spark, range(40))
    picked = rollup.pod_usage(rows, "1 hour", namespace=1, pod=3, start=START, end=START + dt.timedelta(seconds=36))
    assert {(r["namespace"], r["pod"]) for r in picked.collect()} == {(1, 3)}
    assert picked.agg(F.sum("points")).first()[0] == len([i for i in range(36) if i % 4 == 3])
    plan = rollup.in_range(spark.read.parquet(f"{folder}/events.parquet"), "2024-01-02", "2024-01-03") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_latest_settles_ties_by_id(spark):
    got = rollup.latest_usage(sample(spark, [5, 5, 5, 5, 5, 5, 5, 5]), "pod")
    assert {r["pod"]: r["value"] for r in got.collect()} == {0: 4.0, 1: 5.0, 2: 6.0, 3: 7.0}
    top = rollup.top_usage(sample(spark, [1] * 8, value=1.0), 2, "pod").collect()
    assert sorted((r["measurement"], r["place"], r["pod"]) for r in top) == [
        ("cpu", 1, 0), ("cpu", 2, 1), ("mem", 1, 0), ("mem", 2, 2)]


def test_latest_is_the_same_for_every_kind_of_time_and_id(spark):
    rows = [(i % 5 - 2, f"2024-0{1 + i % 3}-10 0{i % 4}:1{i % 2}:0{i % 7}.00000{i % 3}", i % 6, float(i)) for i in range(400)]
    base = spark.createDataFrame(rows, "point_id BIGINT, ts STRING, pod INT, value DOUBLE")
    # A unique id per row, below zero for half of them.
    base = base.withColumn("point_id", (F.col("value") * 46116860184273879 - 9223372036854775807).cast("bigint"))
    want = {}
    for r in base.collect():
        key = (r["ts"], r["point_id"])
        want[r["pod"]] = max(want.get(r["pod"], (("", 0), 0.0)), (key, r["value"]))
    for kind in ("timestamp", "timestamp_ntz"):
        for id_type in ("bigint", "struct"):
            typed = base.withColumn("ts", F.col("ts").cast(kind))
            if id_type == "struct":
                typed = typed.withColumn("point_id", F.struct("point_id"))
            latest = rollup.latest_usage(typed, "pod")
            assert {r["pod"]: r["value"] for r in latest.collect()} == {p: v for p, (_, v) in want.items()}
            plan = latest._jdf.queryExecution().executedPlan().toString()
            assert ("SortAggregate" in plan) == (id_type == "struct")


def test_hot_keys_are_combined_before_the_shuffle(spark):
    plan = rollup.usage_over_time(sample(spark, [0]))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_avg") > plan.index("Exchange")  # printed from the top down


def files(spark, tmp_path, parts, name="in"):
    path = str(tmp_path / name)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def test_stream_equals_batch_when_nothing_is_late(spark, tmp_path):
    parts = [sample(spark, range(i * 100, i * 100 + 100)) for i in range(4)]
    path = files(spark, tmp_path, parts)
    stream = points.read_points_stream(spark, path, parts[0].schema, files_per_trigger=1)
    out = str(tmp_path / "out")
    rollups.write_updates(rollups.rollup_stream(stream, "10 seconds", "1 hour", "pod"), out, str(tmp_path / "p"))
    got = rollups.read_updates(spark, out, "pod").orderBy("window_start", "measurement", "pod").collect()
    want = rollup.usage_over_time(spark.read.parquet(path), "10 seconds", "pod").orderBy("window_start", "measurement", "pod").collect()
    assert got == want and spark.read.parquet(out).select("batch_id").distinct().count() >= 4


def test_late_points_are_left_out_after_the_delay(spark, tmp_path):
    parts = [sample(spark, [0, 1, 2]), sample(spark, [1000]), sample(spark, [3]), sample(spark, [2000])]
    path = str(tmp_path / "in")
    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    for part in parts:  # one run per file, so that arrival order is fixed
        part.coalesce(1).write.mode("append").parquet(path)
        stream = points.read_points_stream(spark, path, parts[0].schema)
        rollups.write_closed(rollups.rollup_stream(stream, "10 seconds", "1 minute"), out, progress)
    got = spark.read.parquet(out).groupBy("window_start").agg(F.sum("points")).orderBy("window_start").collect()
    assert [(r[0] - START).seconds for r in got] == [0, 1000]
    assert [r[1] for r in got] == [3, 1]


def test_late_points_are_counted(spark, tmp_path):
    parts = [sample(spark, [0, 1, 2]), sample(spark, [1000]), sample(spark, [3, 4]), sample(spark, [2000])]
    path, out, progress, read = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p"), 0
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        stream = points.read_points_stream(spark, path, parts[0].schema)
        read += rollups.write_updates(rollups.rollup_stream(stream, "10 seconds", "1 minute"), out, progress)
    counted = rollups.read_updates(spark, out).agg(F.sum("points")).first()[0]
    assert read == 7 and rollups.late_points(spark, out, read) == 7 - counted == 2


def test_alerts_are_withdrawn_by_the_stream(spark, tmp_path):
    parts = [sample(spark, [1, 2], value=9.0), sample(spark, [3, 4], value=0.0)]
    path = files(spark, tmp_path, parts)
    out, progress = str(tmp_path / "out"), str(tmp_path / "p")
    stream = points.read_points_stream(spark, path, parts[0].schema, files_per_trigger=1)
    windows = rollups.rollup_stream(stream.withColumn("measurement", F.lit("cpu")), "10 seconds", "1 hour")
    rollups.write_updates(rollups.with_alerts(windows, 5.0), out, progress)
    raised = [r["over"] for r in spark.read.parquet(out).orderBy("batch_id").collect()]
    assert sorted(raised) in ([False, True], [False, False]) and rollups.read_alerts(spark, out).count() == 0


def test_copy_is_exactly_once_over_restarts(spark, tmp_path):
    parts = [sample(spark, range(10)), sample(spark, range(10, 20))]
    path = str(tmp_path / "in")
    for part in parts:
        part.write.mode("append").parquet(path)
        rollups.copy_stream(points.read_points_stream(spark, path, parts[0].schema),
                            str(tmp_path / "out"), str(tmp_path / "p"))
    rollups.copy_stream(points.read_points_stream(spark, path, parts[0].schema), str(tmp_path / "out"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_binary_objects_round_trip(spark, tmp_path):
    contents = {"a.bin": bytes(range(256)) * 10, "b.bin": b"\x00", "c.bin": b"\r\n\x00"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    scanned = objects.read_files(spark, f"file://{tmp_path}", "*.bin")
    assert {r["path"].rsplit("/", 1)[1]: r["length"] for r in scanned.collect()} == {n: len(c) for n, c in contents.items()}
    table = str(tmp_path / "table")
    objects.write_objects(scanned, table)
    objects.write_objects(scanned, table)
    back = objects.read_objects(spark, table).select("path", F.md5("content").alias("digest")).collect()
    assert {r["path"].rsplit("/", 1)[1]: r["digest"] for r in back} == {n: hashlib.md5(c).hexdigest() for n, c in contents.items()}


def test_file_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"x")
    plan = objects.read_files(spark, str(tmp_path)).select("path", "length")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_late_points_have_a_table_of_their_own(spark, tmp_path):
    parts = [sample(spark, [0, 1, 2]), sample(spark, [1000]), sample(spark, [3, 4, 995]), sample(spark, [2000])]
    path, out, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
        stream = points.read_points_stream(spark, path, parts[0].schema)
        rollups.write_usage_and_late(stream, out, progress, "10 seconds", "1 minute", "pod")
    late = rollups.read_late(spark, out)
    assert sorted((r["ts"] - START).seconds for r in late.collect()) == [3, 4] and late.columns == parts[0].columns
    windows = rollups.read_usage(spark, out, "pod")
    assert windows.agg(F.sum("points")).first()[0] == 6
    whole = rollup.usage_over_time(spark.read.parquet(path).filter("second(ts) not in (3, 4)"), "10 seconds", "pod")
    assert sorted(map(tuple, windows.collect())) == sorted(map(tuple, whole.select(windows.columns).collect()))


def test_live_latest_follows_late_and_equal_times(spark, tmp_path):
    parts = [sample(spark, [50, 5, 5, 5]), sample(spark, [10, 60, 5, 5]), sample(spark, [50, 1, 5, 70])]
    path, out, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p")
    for i, part in enumerate(parts):
        part.withColumn("point_id", F.col("point_id") + 10 * i).coalesce(1).write.mode("append").parquet(path)
        rollups.write_latest(rollups.latest_stream(points.read_points_stream(spark, path, part.schema), "measurement", "pod"), out, progress)
    want = rollup.latest_usage(spark.read.parquet(path), "measurement", "pod")
    got = rollups.read_latest(spark, out, "measurement", "pod")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))
    top = rollup.top_usage(spark.read.parquet(path), 1, "pod")
    assert sorted(map(tuple, rollups.top_latest(spark, out, 1, "pod").select(top.columns).collect())) == sorted(map(tuple, top.collect()))


def test_chains_of_chunks(spark, tmp_path):
    contents = {"a": bytes(range(256)) * 3, "b": b"", "c": b"x" * 100, "d": b"y" * 101, "none": None}
    frame = spark.createDataFrame([(k, v) for k, v in contents.items()], "path STRING, content BINARY")
    path = str(tmp_path / "chunks")
    objects.write_chunks(objects.cut_objects(frame, 100), path)
    chunks = objects.read_chunks(spark, path)
    assert {r["path"]: r["n_parts"] for r in objects.checked_chains(chunks).filter("whole").collect()} == {"a": 8, "b": 1, "c": 1, "d": 2, "none": 1}
    assert {r["path"]: bytes(r["content"]) for r in objects.join_chunks(chunks).collect()} == {k: v or b"" for k, v in contents.items()}
    for broken in (chunks.filter("path <> 'a' OR part <> 3"), chunks.union(chunks.filter("path = 'd'")),
                   chunks.withColumn("part", F.when(F.col("path") == "d", 1 - F.col("part")).otherwise(F.col("part")))):
        assert objects.checked_chains(broken).filter("NOT whole").count() == 1
        with pytest.raises(Exception, match="broken chain"):
            objects.join_chunks(broken).collect()
    other = str(tmp_path / "changed")
    objects.write_chunks(chunks.withColumn("bytes", F.when(F.col("path") == "c", F.lit(b"z")).otherwise(F.col("bytes"))), other)
    with pytest.raises(Exception, match="does not match"):
        objects.read_chunks(spark, other).collect()


def test_mounts_need_places(spark, tmp_path):
    from larkspur.sources import mounts

    root = mounts.mount(spark, "unit", {"/here": str(tmp_path)})
    spark.range(3).write.parquet(f"{root}/here/rows")
    assert spark.read.parquet(f"file:{tmp_path}/rows").count() == 3
    with pytest.raises(ValueError):
        mounts.mount(spark, "unit", {"here": str(tmp_path)})
