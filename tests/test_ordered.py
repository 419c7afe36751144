"""Sliced computations against brute force, with a hot machine, ties, missing times and missing machines."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hostvane.operators import ordered, series

START = datetime(2026, 4, 1, 23, 59, 30)


def make_rows(seed=7, n=3000):
    """A third of the rows belong to one machine; some rows lack a machine or a time; times repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        machine = "hot" if rng.random() < 0.34 else rng.choice([f"m{j}" for j in range(40)])
        machine = None if rng.random() < 0.02 else machine
        ts = START + timedelta(seconds=rng.choice([rng.randrange(200), rng.randrange(400_000)]))
        ts = None if rng.random() < 0.02 else ts
        rows.append((machine, ts, i, rng.randrange(1000), rng.random() < 0.5))
    return rows


SCHEMA = "machine string, ts timestamp, id int, counter bigint, flag boolean"


def brute(rows):
    """Per id: previous counter, seconds since, row number, running count of flags."""
    expected = {}
    per_machine = {}
    for row in rows:
        if row[0] is not None and row[1] is not None:
            per_machine.setdefault(row[0], []).append(row)
        else:
            expected[row[2]] = (None, None, None, None)
    for group in per_machine.values():
        group.sort(key=lambda r: (r[1], r[2]))
        flags = 0
        for i, row in enumerate(group):
            flags += row[4]
            previous = group[i - 1] if i else None
            expected[row[2]] = (
                previous[3] if previous else None,
                (row[1] - previous[1]).total_seconds() if previous else None,
                i + 1,
                flags,
            )
    return expected


WIDTHS = [None, 1e6, 60e6, 3600e6, 1e12]


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("naive", [False, True])
def test_against_brute_force(spark, width, naive):
    rows = make_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    if naive:
        frame = frame.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    fixed = None if width is None else F.lit(width)
    order = ["ts", "id"]
    previous = ordered.with_previous(frame, ["machine"], order, {"before": "counter"}, fixed, elapsed="dt")
    both = ordered.with_running_counts(
        previous, ["machine"], order, {"n": F.lit(True), "flags": F.col("flag")}, fixed
    )
    got = {r["id"]: (r["before"], r["dt"], r["n"], r["flags"]) for r in both.collect()}
    assert got == brute(rows)


def test_width_follows_the_busiest_day(spark):
    midnight = datetime(2026, 4, 2)
    rows = [("hot", midnight + timedelta(seconds=17 * i), i, 0, False) for i in range(5000)]
    frame = spark.createDataFrame([*rows, ("cold", START, -1, 0, False)], SCHEMA)

    def width(target):
        return spark.range(1).select(ordered.slice_width(frame, ["machine"], "ts", target).alias("w")).first()["w"]

    assert width(50_000) == 10 * 86400e6
    sliced = ordered._summary_slices(frame, ["machine"], ["ts"], F.lit(width(100)))
    assert 95 <= sliced.groupBy("machine", "__slice").count().agg(F.max("count")).first()[0] <= 105


def test_width_of_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert series.running_counter(empty).count() == 0


def test_no_task_needs_a_whole_machine(spark):
    """Every window over rows is partitioned by the slice too."""
    frame = spark.createDataFrame(make_rows(n=50), SCHEMA)
    for result in (
        series.counter_rates(frame, {"rate": "counter"}, order=["ts", "id"]),
        series.sample_and_hold(frame, "counter", order=["ts", "id"]),
        series.batch_numbers(frame, order=["ts", "id"]),
    ):
        plan = result._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line and "ts#" in line.split("windowspecdefinition(")[1].split("specifiedwindow")[0]:
                assert "__slice" in line


def test_last_row(spark):
    rows = make_rows()
    got = {
        r["machine"]: r["id"]
        for r in ordered.last_row(spark.createDataFrame(rows, SCHEMA).dropna(), ["machine"], ["ts", "id"]).collect()
    }
    want = {}
    for machine, ts, i, *_ in rows:
        if machine and ts:
            want[machine] = max(want.get(machine, (ts, i)), (ts, i))
    assert got == {machine: key[1] for machine, key in want.items()}


def test_last_row_sorts_only_the_latest_rows(spark):
    rows = [("a", 1, 5, "x"), ("a", 2, 1, "y"), ("a", 2, 3, "z"), (None, 7, 1, "n"), ("t", None, 1, "p"), ("t", None, 2, "q")]
    frame = spark.createDataFrame(rows, "k string, t int, n int, v string")
    assert {r["k"]: r["v"] for r in ordered.last_row(frame, ["k"], ["t", "n"]).collect()} == {"a": "z", None: "n", "t": "q"}
    plan = ordered.last_row(frame, ["k"], ["t", "n"])._jdf.queryExecution().executedPlan().toString()
    below_join = plan[plan.index("Join") :]
    assert "HashAggregate" in below_join and "SortAggregate" not in below_join
