import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hostvane import schemas
from hostvane.functions import process_text
from hostvane.operators import processes

T0 = datetime(2026, 4, 6, 7)


def test_explode_and_flatten(spark):
    texts = [
        (1, "[{'pid': 7, 'name': 'a', 'username': 'u', 'cpu_percent': 1.5, 'memory_info': {'rss': 10, 'vms': 20}}]"),
        (2, "[]"),
        (3, "broken"),
        (4, None),
    ]
    frame = spark.createDataFrame(texts, "id int, text string").select(
        "id", process_text.parse_list(F.col("text")).alias("p")
    )
    rows = processes.flatten_struct(processes.explode_list(frame, "p", ["id"]), "memory_info")
    assert rows.columns == ["id", "pid", "name", "username", "cpu_percent", "memory_info_rss", "memory_info_vms"]
    assert [tuple(r) for r in rows.collect()] == [(1, 7, "a", "u", 1.5, 10, 20)]
    assert rows.count() == frame.agg(F.sum(F.when(F.size("p") > 0, F.size("p")))).first()[0]


@pytest.mark.parametrize("cutoff, kept", [(2.5, [2.5, 5.0]), (5.0, [5.0])])
def test_heavy_in_list(spark, cutoff, kept):
    frame = spark.createDataFrame([([(2.49,), (2.5,), (5.0,), (None,)],)], "p array<struct<memory_percent:double>>")
    heavy = frame.select(processes.heavy_in_list(F.col("p"), cutoff).alias("h")).first()["h"]
    assert [p.memory_percent for p in heavy] == kept


def test_heavy_by_rss_is_strict(spark):
    rows = spark.createDataFrame([(1, "a", 50), (2, "b", 51)], "pid int, name string, rss bigint")
    [heavy] = processes.heavy_by_rss(rows, F.lit(1000)).collect()
    assert (heavy["pid"], heavy["memoria_mb"]) == (2, 0.0)
    assert heavy["porcentagem_ram"] == pytest.approx(5.1)


def rows_of(spark, entries):
    return spark.createDataFrame(
        entries, "sample int, pid bigint, name string, cpu_percent double, rss bigint, read_bps bigint, write_bps bigint"
    )


def test_totals_from_rows_and_from_lists_agree(spark):
    rng = random.Random(3)
    entries = [(rng.randrange(20), i, f"p{i % 5}", rng.randrange(100) / 10, rng.randrange(10**9), 1, 2) for i in range(500)]
    rows = rows_of(spark, entries)
    totals = {r["sample"]: (r["n_processes"], r["sum_cpu"], r["sum_rss"]) for r in processes.host_totals(rows, ["sample"]).collect()}
    record = F.struct("pid", "name", "cpu_percent", F.struct("rss").alias("memory_info"))
    nested = rows.groupBy("sample").agg(F.collect_list(record).alias("p"))
    lists = {r["sample"]: (r["n_processes"], r["sum_cpu"], r["sum_rss"]) for r in processes.list_totals(nested, "p").collect()}
    assert totals == lists
    sizes = {r["sample"]: r["n_names"] for r in processes.active_name_counts(rows, ["sample"]).collect()}
    names = {r["sample"]: len(r["active_names"]) for r in processes.list_totals(nested, "p").collect()}
    assert sizes == names


def test_every_sample_has_one_list_of_any_length(spark):
    entries = [(1, i, "hot", 0.0, 0, 0, 0) for i in range(12_000)] + [(2, i, "cold", 0.0, 0, 0, 0) for i in range(10)]
    entries += [(3, 7, "same", 0.0, 0, 0, 0)] * 25
    lists = processes.build_lists(rows_of(spark, entries), ["sample"], ["pid", "name"], ["pid"])
    collected = {r["sample"]: [p.pid for p in r["processes"]] for r in lists.collect()}
    assert collected == {1: list(range(12_000)), 2: list(range(10)), 3: [7] * 25}
    totals = processes.list_totals(lists.selectExpr("sample", "transform(processes, p -> struct(p.name, 1.5D AS cpu_percent, struct(2L AS rss) AS memory_info)) AS p"), "p")
    assert {r["sample"]: (r["n_processes"], r["sum_cpu"]) for r in totals.collect()} == {1: (12_000, 18_000.0), 2: (10, 15.0), 3: (25, 37.5)}


def test_cpu_and_memory_accounting(spark):
    hosts = spark.createDataFrame([(1, 60.0), (2, 10.0), (3, 5.0)], "sample int, cpu_pct double")
    totals = spark.createDataFrame(
        [(1, 1600.0, 10**9), (2, 80.0, 10**12)], "sample int, sum_cpu double, sum_rss bigint"
    )
    explained = {r["sample"]: (r["cpu_explained"], r["cpu_unexplained"]) for r in processes.explain_cpu(hosts, totals, ["sample"]).collect()}
    assert explained == {1: (100.0, -40.0), 2: (5.0, 5.0), 3: (0.0, 5.0)}
    total = 64 * 1024**3
    memory = {
        r["sample"]: (r["mem_used_expected"], r["mem_available_expected"])
        for r in processes.reconcile_memory(hosts, totals, ["sample"], F.lit(total)).collect()
    }
    base = 12 * 1024**3
    assert memory[1] == (base + 10**9, total - base - 10**9)
    assert memory[2] == (62 * 1024**3, 2 * 1024**3)
    assert memory[3] == (base, total - base)


def fleet(spark):
    """Three samples at a weekday peak (target 26), one of them without processes."""
    catalogue = spark.createDataFrame([(f"s{i:02d}", 30 - i) for i in range(26)], "name string, position int")
    entries = [(1, i, f"s{i:02d}", 0.0, 0, 0, 0) for i in range(24)] + [(1, 99, "alien", 0.0, 0, 0, 0)]
    entries += [(2, 1, "s05", 0.0, 0, 0, 0), (2, 2, "s05", 0.0, 0, 0, 0)]
    hosts = spark.createDataFrame([(1, T0), (2, T0), (3, T0)], "sample int, ts timestamp")
    return hosts, rows_of(spark, entries), catalogue


def test_service_gap(spark):
    hosts, rows, _ = fleet(spark)
    got = {r["sample"]: (r["active"], r["target"], r["gap"]) for r in processes.service_gap(hosts, rows, ["sample"]).collect()}
    assert got == {1: (25, 26, 1), 2: (2, 26, 24), 3: (0, 26, 26)}


def test_missing_services(spark):
    hosts, rows, catalogue = fleet(spark)
    got = processes.missing_services(hosts, rows, catalogue, ["sample"]).collect()
    assert {r["name"] for r in got if r["sample"] == 1} == {"s24", "s25"}
    assert {r["name"] for r in got if r["sample"] == 2} == {f"s{i:02d}" for i in range(26)} - {"s05"}
    assert sorted(r["name"] for r in got if r["sample"] == 3) == [f"s{i:02d}" for i in range(26)]


def test_missing_services_of_a_long_catalogue_and_null_samples(spark):
    catalogue = spark.range(3000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    hosts = spark.createDataFrame([(1,), (None,)], "sample int")
    active = spark.createDataFrame([(1, "n5"), (None, "n7"), (None, "other"), (1, None)], "sample int, name string")
    got = processes.missing_services(hosts, active, catalogue, ["sample"])
    every = {f"n{i}" for i in range(3000)}
    assert {r["name"] for r in got.where("sample = 1").collect()} == every - {"n5"}
    assert {r["name"] for r in got.where("sample is null").collect()} == every - {"n7"}


def test_services_to_start_follow_catalogue_order(spark):
    hosts, rows, catalogue = fleet(spark)
    longer = catalogue.unionByName(spark.range(100).select(F.lit("later").alias("name"), F.lit(99).alias("position")))
    gaps = processes.service_gap(hosts, rows, ["sample"])
    got = processes.services_to_start(gaps, rows, longer, ["sample"], "position").collect()
    assert [r["name"] for r in got if r["sample"] == 1] == ["s25"]
    assert {r["name"] for r in got if r["sample"] == 2} == {f"s{i:02d}" for i in range(26)} - {"s05", "s00"}
    assert sum(r["sample"] == 3 for r in got) == 26


def test_more_than_the_usual_number_of_services(spark):
    catalogue = spark.range(60).select(F.format_string("s%02d", "id").alias("name"), F.col("id").alias("position"))
    gaps = spark.createDataFrame([(1, 40)], "sample int, gap int")
    active = spark.createDataFrame([(1, "s00")], "sample int, name string")
    got = processes.services_to_start(gaps, active, catalogue, ["sample"], "position").collect()
    assert sorted(r["name"] for r in got) == [f"s{i:02d}" for i in range(1, 41)]
    rows = spark.createDataFrame([(1, p) for p in range(60)], "sample int, pid int")
    hosts = spark.createDataFrame([(1, 40)], "sample int, target int")
    assert processes.cap_to_target(rows, hosts, ["sample"], [F.col("pid")], F.col("target")).count() == 40


def test_restarts_without_ids(spark):
    rows = spark.createDataFrame([("m", "a", None), ("m", "b", 1), ("m", "b", 2)], "machine string, name string, pid int")
    assert {r["name"]: r["restarts"] for r in processes.restarts(rows).collect()} == {"a": 0, "b": 1}


def test_unknown_services(spark):
    _, rows, catalogue = fleet(spark)
    assert [r["name"] for r in processes.unknown_services(rows, catalogue).collect()] == ["alien"]


def test_profile_deviation(spark):
    rows = spark.createDataFrame(
        [("svc", T0, 12.0, 70 * 1024**2), ("other", T0, 1.0, 1)], "name string, ts timestamp, cpu_percent double, rss bigint"
    )
    profiles = spark.createDataFrame([("svc", 10, 64)], "name string, cpu int, mem_mb int")
    [row] = processes.profile_deviation(rows, profiles).collect()
    assert (row["cpu_expected"], row["mem_deviation_mib"]) == (11.5, 6.0)
    assert row["cpu_deviation"] == pytest.approx(0.5)


def test_cap_keeps_oldest_or_newest(spark):
    rows = spark.createDataFrame([(1, p, 100 - p) for p in range(30)], "sample int, pid int, started int")
    hosts = spark.createDataFrame([(1, 3)], "sample int, target int")
    oldest = processes.cap_to_target(rows, hosts, ["sample"], [F.col("started"), F.col("pid")], F.col("target"))
    newest = processes.cap_to_target(rows, hosts, ["sample"], [F.col("started").desc(), F.col("pid")], F.col("target"))
    assert [r["pid"] for r in oldest.orderBy("rank").collect()] == [29, 28, 27]
    assert [r["pid"] for r in newest.orderBy("rank").collect()] == [0, 1, 2]
    assert "WindowGroupLimit" in oldest._jdf.queryExecution().executedPlan().toString()


def test_lifetimes_and_restarts(spark):
    rows = spark.createDataFrame(
        [("m", p, "svc", T0 + timedelta(minutes=i)) for p in (1, 2, 3) for i in range(p)],
        "machine string, pid int, name string, ts timestamp",
    )
    spans = {r["pid"]: (r["samples"], (r["last_seen"] - r["first_seen"]).seconds) for r in processes.lifetimes(rows).collect()}
    assert spans == {1: (1, 0), 2: (2, 60), 3: (3, 120)}
    assert processes.restarts(rows).first()["restarts"] == 2
    assert processes.restarts(rows, approximate=True).first()["restarts"] == 2


def test_hung_runs(spark):
    pattern = [0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 2.0, 0.0]
    rows = [("m", 1, T0 + timedelta(minutes=40 * i), cpu) for i, cpu in enumerate(pattern)]
    rows += [("m", 2, T0 + timedelta(minutes=i), 0.1) for i in range(5)]
    rows += [("m", 1, T0 + timedelta(minutes=40), 0.0)]  # the same instant reported twice
    frame = spark.createDataFrame(rows, "machine string, pid int, ts timestamp, cpu_percent double")
    idle = F.col("cpu_percent") == 0.0

    def runs(least):
        found = processes.hung_processes(frame, idle, least).orderBy("first_idle").collect()
        return [(r["pid"], r["samples"], (r["first_idle"] - T0).seconds // 2400) for r in found]

    assert runs(1) == [(1, 2, 0), (1, 3, 3), (1, 1, 7)]
    assert runs(2) == [(1, 2, 0), (1, 3, 3)]


def test_map_cells(spark):
    frame = spark.createDataFrame([("a",), (None,)], "x string")
    out = processes.map_cells(frame, "x", lambda cells: cells.str.upper(), "y", "string")
    assert [r["y"] for r in out.collect()] == ["A", None]


def test_profile_schema_has_all_columns(spark):
    assert len(spark.createDataFrame([], schemas.SERVICE_PROFILE_SCHEMA).columns) == 9
