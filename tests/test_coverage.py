"""Absent services and slots against plain sets, and merged summaries against exact ones."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hostvane.operators import coverage, processes, sketches

START = datetime(2026, 4, 1)


def fleet(seed, services, n=40, machines=("a", "b", None)):
    rng = random.Random(seed)
    hosts = [(rng.choice(machines), START + timedelta(minutes=rng.randrange(n))) for _ in range(3 * n)] + [("quiet", START), ("a", None)]
    active = [(m, ts, rng.choice([*services, "unknown", None])) for m, ts in hosts for _ in range(rng.randrange(4)) if m != "quiet"]
    return hosts, active


def plain_changes(hosts, active, services):
    out = []
    for machine in {m for m, ts in hosts if m is not None}:
        before = set(services)
        for ts in sorted({t for m, t in hosts if m == machine and t is not None}):
            now = {s for m, t, s in active if m == machine and t == ts and s in services}
            out += [(machine, ts, s, True) for s in now - before] + [(machine, ts, s, False) for s in before - now]
            before = now
    return sorted(out)


def changes(spark, hosts, active, services):
    catalogue = coverage.numbered_catalogue(spark.createDataFrame([(s,) for s in [*services, *services[:2], None]], "service string"))
    bits = coverage.service_bits(
        spark.createDataFrame(hosts, "machine string, ts timestamp"), spark.createDataFrame(active, "machine string, ts timestamp, service string"),
        catalogue, ["machine"],
    )
    return bits, coverage.service_changes(bits, catalogue, ["machine"])


@pytest.mark.parametrize("services", [["s0"], [f"s{k:03}" for k in range(64)], [f"s{k:03}" for k in range(130)]])
def test_changes_of_services(spark, services):
    hosts, active = fleet(len(services), services)
    bits, found = changes(spark, hosts, active, services)
    assert sorted(map(tuple, found.collect())) == plain_changes(hosts, active, set(services))
    words = -(-len(services) // 64)
    assert bits.count() == words * len({(m, t) for m, t in hosts if m is not None and t is not None})


def test_absences_cover_exactly_the_absent_samples(spark):
    services = [f"s{k}" for k in range(5)]
    hosts, active = fleet(7, services)
    _, found = changes(spark, hosts, active, services)
    spans = coverage.absences(found, ["machine"]).collect()
    got = set()
    for machine, ts in {(m, t) for m, t in hosts if m is not None and t is not None}:
        got |= {(machine, ts, r.service) for r in spans if r.machine == machine and r.absent_from <= ts and (r.absent_to is None or ts < r.absent_to)}
    running = {(m, t, s) for m, t, s in active if s in services}
    assert got == {(m, t, s) for m, t in hosts if m is not None and t is not None for s in services} - running
    assert all(r.absent_to is None or r.absent_from < r.absent_to for r in spans)


def test_no_hosts_or_services(spark):
    for hosts, services in (([], ["s"]), ([("a", START)], [])):
        _, found = changes(spark, hosts, [], services)
        assert found.collect() == [] and coverage.absences(found, ["machine"]).collect() == []


def plain_gaps(samples, spans, step):
    out = []
    for machine, start, end in spans:
        at = datetime(1970, 1, 1) + timedelta(seconds=(start - datetime(1970, 1, 1)) // timedelta(seconds=step) * step)
        held = {(t - datetime(1970, 1, 1)) // timedelta(seconds=step) for m, t in samples if m == machine and t is not None}
        run = []
        while at < end:
            if (at - datetime(1970, 1, 1)) // timedelta(seconds=step) in held:
                out, run = out + [(machine, r[0], r[-1], len(r)) for r in [run] if r], []
            else:
                run.append(at)
            at += timedelta(seconds=step)
        out += [(machine, r[0], r[-1], len(r)) for r in [run] if r]
    return sorted(out)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_gaps_without_a_grid(spark, kind):
    rng = random.Random(2)
    samples = [(rng.choice("abc"), START + timedelta(seconds=rng.randrange(7200), microseconds=rng.randrange(10**6))) for _ in range(90)]
    samples += samples[:5] + [("a", None), (None, START), ("c", START + timedelta(days=4))]
    spans = [("a", START, START + timedelta(hours=2)), ("b", START + timedelta(seconds=90), START + timedelta(seconds=3601)), ("empty", START, START + timedelta(minutes=5)), ("c", START, START)]
    got = coverage.coverage_gaps(
        spark.createDataFrame(samples, f"machine string, ts {kind}"), spark.createDataFrame(spans, f"machine string, start {kind}, end {kind}"),
        ["machine"], 60,
    )
    assert got.schema["gap_from"].dataType.simpleString() == kind
    assert sorted(map(tuple, got.collect())) == plain_gaps(samples, spans, 60)


def test_a_gap_of_years_is_one_row(spark):
    samples = spark.createDataFrame([("a", datetime(1970, 1, 1)), ("a", datetime(2090, 1, 1))], "machine string, ts timestamp")
    spans = spark.createDataFrame([("a", datetime(1970, 1, 1), datetime(2090, 1, 2))], "machine string, start timestamp, end timestamp")
    [first, last] = sorted(coverage.coverage_gaps(samples, spans, ["machine"], 1).collect())
    assert first.missing == (datetime(2090, 1, 1) - datetime(1970, 1, 1)) // timedelta(seconds=1) - 1 and last.missing == 86_399


def test_no_samples_and_no_spans(spark):
    samples, spans = spark.createDataFrame([], "machine string, ts timestamp"), spark.createDataFrame([], "machine string, start timestamp, end timestamp")
    assert coverage.coverage_gaps(samples, spans, ["machine"], 60).collect() == []
    assert sketches.quantiles(sketches.quantile_sketches(samples.withColumn("v", F.lit(1.0)), ["machine"], "v")).collect() == []


def test_merged_quantiles(spark):
    rng = random.Random(4)
    rows = [(m, START + timedelta(seconds=rng.randrange(86_400)), rng.choice([rng.gauss(0, 9), 5.0, None])) for m, n in (("few", 150), ("many", 20_000)) for _ in range(n)]
    samples = spark.createDataFrame(rows, "machine string, ts timestamp, v double")
    minutes = sketches.quantile_sketches(samples, ["machine"], "v")
    hours = sketches.rolled_up(minutes, ["machine"], "minute", "hour")
    found = {r.machine: r for r in sketches.quantiles(sketches.rolled_up(hours, ["machine"], "hour", None)).collect()}
    for machine, row in found.items():
        values = sorted(v for m, _, v in rows if m == machine and v is not None)
        assert row.n == len(values)
        for name, rank in sketches.QUANTILES.items():
            below, up_to = sum(v < row[name] for v in values), sum(v <= row[name] for v in values)
            error = 0 if machine == "few" else sketches.RANK_ERROR
            assert below / len(values) <= rank + error and up_to / len(values) >= rank - error


def test_sets_by_day(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), START + timedelta(hours=rng.randrange(96)), rng.choice([f"p{rng.randrange(60)}", None])) for _ in range(900)]
    rows += [("big", START + timedelta(hours=k % 96), f"x{k}") for k in range(30_000)] + [("none", START, None)]
    days = sketches.set_sketches(spark.createDataFrame(rows, "machine string, ts timestamp, name string"), ["machine"], {"names": F.col("name")})
    split = START + timedelta(days=2)
    got = {r.machine: r for r in sketches.new_members(days, ["machine"], "names", F.col("day") < F.lit(split), F.col("day") >= F.lit(split)).collect()}
    total = {r.machine: r.n for r in sketches.united(days, ["machine"], ["names"]).select("machine", sketches.size("names").alias("n")).collect()}
    for machine in ("a", "b", "none"):
        later = {n for m, t, n in rows if m == machine and n and t >= split}
        earlier = {n for m, t, n in rows if m == machine and n and t < split}
        assert (got[machine].members, got[machine].new_members, total[machine]) == (len(later), len(later - earlier), len(later | earlier))
    assert abs(total["big"] / 30_000 - 1) < 0.06


def test_lives_of_a_process(spark):
    def at(*minutes):
        return [("m", 1, "p", START + timedelta(minutes=k)) for k in minutes]

    rows = at(0, 5, 10, 10, 21, 31, 50) + [("m", 2, "p", START), ("m", 2, "p", START), ("m", 1, "p", None), (None, 1, "p", START), ("x", None, "p", START)]
    df = spark.createDataFrame(rows, "machine string, pid int, name string, ts timestamp")
    got = sorted((r.pid, r.life, (r.first_seen - START).seconds // 60, (r.last_seen - START).seconds // 60, r.samples) for r in processes.life_spans(df, "10 minutes").collect())
    assert got == [(1, 1, 0, 10, 4), (1, 2, 21, 31, 2), (1, 3, 50, 50, 1), (2, 1, 0, 0, 2)]
