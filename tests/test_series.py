from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hostvane.operators import series

T0 = datetime(2026, 4, 16, 19, 42, 59)


def samples(spark, values, step=3.0, machine="m"):
    rows = [(machine, T0 + timedelta(seconds=step * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "machine string, ts timestamp, v bigint")


def column(frame, name):
    return [r[name] for r in frame.orderBy("ts").collect()]


def test_rates_with_elapsed_and_nominal_time(spark):
    frame = samples(spark, [100, 130, 160], step=1.5)
    assert column(series.counter_rates(frame, {"r": "v"}), "r") == [None, 20.0, 20.0]
    assert column(series.counter_rates(frame, {"r": "v"}, interval=3), "r") == [None, 10.0, 10.0]


def test_counter_reset(spark):
    frame = samples(spark, [100, 160, 10])
    assert column(series.counter_rates(frame, {"r": "v"}), "r") == [None, 20.0, -50.0]
    assert column(series.counter_rates(frame, {"r": "v"}, null_resets=True), "r") == [None, 20.0, None]


def test_no_time_elapsed_gives_no_rate(spark):
    frame = spark.createDataFrame([("m", T0, 1, 5), ("m", T0, 2, 9)], "machine string, ts timestamp, id int, v int")
    rates = series.counter_rates(frame, {"r": "v"}, order=["ts", "id"]).orderBy("id")
    assert [r["r"] for r in rates.collect()] == [None, None]


def test_sample_and_hold(spark):
    frame = samples(spark, list(range(1, 15)))
    assert column(series.sample_and_hold(frame, "v"), "held") == [1] * 5 + [6] * 6 + [12] * 3
    assert column(series.sample_and_hold(frame, "v", every=1), "held") == list(range(1, 15))


@pytest.mark.parametrize("width", [None, 5_000_000])
def test_failed_measurements_are_passed_over(spark, width):
    frame = samples(spark, [*range(1, 6), None, *range(7, 15)])
    width = None if width is None else F.lit(width)
    assert column(series.sample_and_hold(frame, "v", width=width), "held") == [1] * 11 + [12] * 3
    none = samples(spark, [None] * 9)
    assert column(series.sample_and_hold(none, "v", width=width), "held") == [None] * 9


def test_batches(spark):
    frame = samples(spark, range(130))
    numbers = column(series.batch_numbers(frame), "batch")
    assert numbers == [0] * 60 + [1] * 60 + [2] * 10
    assert column(series.batch_numbers(frame, rows=3), "batch")[:7] == [0, 0, 0, 1, 1, 1, 2]


def test_gaps(spark):
    rows = [("m", T0 + timedelta(seconds=s)) for s in (0, 3, 6, 13, 16)]
    gaps = series.sample_gaps(spark.createDataFrame(rows, "machine string, ts timestamp"), 3.0)
    assert column(gaps, "elapsed_s") == [None, 3.0, 3.0, 7.0, 3.0]
    assert column(gaps, "is_gap") == [None, False, False, True, False]


def test_latest_snapshot(spark):
    frame = samples(spark, [1, 2, 3]).unionByName(samples(spark, [9, 8], machine="other"))
    assert {r["machine"]: r["v"] for r in series.latest_snapshot(frame).collect()} == {"m": 3, "other": 8}


def test_minute_series(spark):
    frame = samples(spark, range(40))  # 1 s before a full minute, then 20 per minute
    rows = series.minute_series(frame, ["v"]).orderBy("minute").collect()
    assert [(r["samples"], r["avg_v"], r["max_v"]) for r in rows] == [(1, 0.0, 0), (20, 10.5, 20), (19, 30.0, 39)]


def test_two_weeks_of_minutes(spark):
    span = spark.createDataFrame([(datetime(2026, 4, 1), datetime(2026, 4, 15))], "a timestamp, b timestamp")
    grid = series.time_grid(span, "a", "b")
    stats = grid.agg(F.count("ts"), F.count_distinct("ts"), F.min("ts"), F.max("ts")).first()
    assert tuple(stats) == (20_160, 20_160, datetime(2026, 4, 1), datetime(2026, 4, 14, 23, 59))


def test_missing_minutes(spark):
    span = spark.createDataFrame([("m", T0, T0 + timedelta(minutes=5))], "machine string, a timestamp, b timestamp")
    grid = series.time_grid(span, "a", "b").select("machine", "ts")
    seen = grid.where(F.minute("ts") != 45)
    assert [r["ts"].minute for r in series.missing_points(grid, seen, ["machine", "ts"]).collect()] == [45]


def test_wide_to_long_doubles_the_rows(spark):
    frame = samples(spark, range(7)).withColumn("w", F.col("v") * 2)
    long = series.wide_to_long(frame, ["ts"], ["v", "w"])
    assert long.columns == ["ts", "metric", "value"] and long.count() == 14


def test_keep_flagged_drops_unknown(spark):
    frame = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, flag boolean")
    assert [r["id"] for r in series.keep_flagged(frame, "flag").collect()] == [1]


@pytest.mark.parametrize("partitions", [1, 6])
def test_repeats_keep_the_fuller_copy(spark, partitions):
    older = spark.createDataFrame([("m", T0, 1.0), ("n", T0, 2.0)], "machine string, ts timestamp, cpu double")
    newer = older.where("machine = 'm'").withColumn("n_processes", F.lit(4))
    merged = series.append_versions(older, older, newer).repartition(partitions)
    got = {r["machine"]: r["n_processes"] for r in series.drop_repeats(merged).collect()}
    assert got == {"m": 4, "n": None}


def test_series_is_sorted(spark):
    frame = samples(spark, range(100)).repartition(9)
    times = [r["ts"] for r in series.series(frame, {"ts": F.col("ts"), "v": F.col("v")}).collect()]
    assert times == sorted(times)


def test_repeats_are_sorted_once(spark):
    frame = samples(spark, [1, 2, 3])
    plan = series.drop_repeats(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
