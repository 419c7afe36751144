import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import files
from hostvane import schemas, work_dir
from hostvane.operators import series
from hostvane.plans import landing_queries, treatment, views
from hostvane.session import STATE_STORE
from hostvane.sources import landing, sinks
from hostvane.streaming import pipeline


def limits(spark):
    return spark.createDataFrame([(files.MACHINE, "cpu", 20.0), (files.MACHINE, "disk", 60.0)], schemas.LIMITS_SCHEMA)


def batch_of(spark, root):
    day = landing.read_agent_csv(spark, landing.day_path(root, 2031, 2, 7))
    return treatment.treat(series.drop_repeats(landing.canonical_agent(day)), limits(spark))


@pytest.mark.parametrize("files_per_trigger", [1, 10])
def test_ingest_equals_batch(spark, tmp_path, files_per_trigger):
    root = files.write_landing(tmp_path)
    out = str(tmp_path / "out")
    day = landing.day_path(root, 2031, 2, 7)
    pipeline.ingest(spark, day, limits(spark), f"{out}/data", f"{out}/check", files_per_trigger).awaitTermination()
    assert (tmp_path / "out" / "data" / "ano=2031" / "mes=02" / "dia=07" / "batch=0").is_dir()
    batch = batch_of(spark, root)
    streamed = pipeline.read_ingested(spark, f"{out}/data").select(*batch.columns)
    assert streamed.count() == 27
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    assert {r[0] for r in streamed.select("status_cpu").distinct().collect()} == {"NORMAL", "ATENCAO", "CRITICO"}


@pytest.mark.parametrize("files_per_trigger", [1, 10])
def test_uploads_hours_late_are_kept_and_compacted(spark, tmp_path, files_per_trigger):
    day = tmp_path / "raw"
    day.mkdir()
    for n in range(4):  # the second machine's only upload is the oldest in time and the last to come
        start = 0 if n == 3 else 3000 + 60 * n
        rows = [files.agent_fields(start + i) for i in range(60)]
        if n == 3:
            rows = [["0a:1b:2c:3d:4e:60", *row[1:]] for row in rows]
        (day / f"{n}.csv").write_text(files.text(rows))
        os.utime(day / f"{n}.csv", (1_900_000_000 + n, 1_900_000_000 + n))
    out = str(tmp_path / "out")
    pipeline.ingest(spark, str(day), limits(spark), f"{out}/data", f"{out}/check", files_per_trigger).awaitTermination()
    assert pipeline.read_ingested(spark, f"{out}/data").count() == 240
    for _ in range(2):
        pipeline.compact(spark, f"{out}/data", f"{out}/curated", "2031-02-07", "2031-02-07")
        assert spark.read.parquet(f"{out}/curated").groupBy("machine").count().count() == 2
    assert spark.read.parquet(f"{out}/curated").count() == 240
    assert sinks.read_curated(spark, f"{out}/curated", start="2031-02-08").count() == 0
    plan = sinks.read_curated(spark, f"{out}/curated", "2031-02-08", "2031-02-09")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [" in plan.toString() and "PartitionFilters: []" not in plan.toString()


def arrivals(spark, tmp_path, parts=4, n=400):
    """Samples of three machines in time order, one file per arrival."""
    rng = random.Random(1)
    rows, totals = [], {}
    for i in range(n):
        machine = rng.choice(["hot", "hot", "a", "b"])
        totals[machine] = totals.get(machine, 0) + rng.randrange(1000)
        rows.append((machine, datetime(2026, 4, 1) + timedelta(seconds=3 * i), totals[machine]))
    schema = "machine string, ts timestamp, counter bigint"
    folder = str(tmp_path / "arrivals")
    size = n // parts
    for p in range(parts):
        spark.createDataFrame(rows[p * size : (p + 1) * size], schema).coalesce(1).write.mode("append").parquet(folder)
    return folder, spark.createDataFrame(rows, schema), schema


@pytest.mark.parametrize("interval", [None, 3.0])
def test_rates_across_batches_equal_batch(spark, tmp_path, interval):
    folder, everything, schema = arrivals(spark, tmp_path)
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(folder)
    )
    out = str(tmp_path / "out")
    pipeline.write_counter_rates(
        stream, {"rate": "counter"}, f"{out}/data", f"{out}/check", interval=interval
    ).awaitTermination()
    assert spark.read.parquet(f"{out}/data").select("batch").distinct().count() == 4
    expected = series.counter_rates(everything, {"rate": "counter"}, interval=interval)
    streamed = pipeline.read_counter_rates(spark, f"{out}/data").drop("late").select(*expected.columns)
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def lots(spark, tmp_path, schema, *parts):
    """One file per list of rows, in order of arrival."""
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for n, rows in enumerate(parts):
        part = tmp_path / f"part{n}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
        [written] = part.glob("part-*.parquet")
        (folder / f"{n}.parquet").write_bytes(written.read_bytes())
        os.utime(folder / f"{n}.parquet", (1_900_000_000 + n, 1_900_000_000 + n))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


COUNTED = "machine string, ts timestamp, counter bigint"


def same_rows(got, expected):
    return sorted(map(tuple, got.select(*expected.columns).collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_late_samples_are_rated_and_correct_their_neighbours(spark, tmp_path):
    start = datetime(2031, 2, 7)
    parts = [
        [("m", start + timedelta(seconds=s), c) for s, c in lot]
        for lot in ([(0, 0), (30, 300)], [(10, 50), (40, 350)], [(-7200, 1)], [(2000, 2310)])
    ]
    stream, out = lots(spark, tmp_path, COUNTED, *parts), str(tmp_path / "out")
    pipeline.write_counter_rates(stream, {"rate": "counter"}, f"{out}/data", f"{out}/check").awaitTermination()
    written = spark.read.parquet(f"{out}/data").where("counter IN (50, 300, 350)")
    versions = sorted(((r.counter, r.rate) for r in written.orderBy("batch").collect()), key=str)
    assert versions == [(300, 10.0), (300, 12.5), (350, 5.0), (50, 5.0)]
    rated = {r["counter"]: (r["rate"], r["late"]) for r in pipeline.read_counter_rates(spark, f"{out}/data").collect()}
    assert rated[1] == (None, False) and rated[0] == (-1 / 7200, False)
    assert {c: rated[c][0] for c in (50, 300, 350, 2310)} == {50: 5.0, 300: 12.5, 350: 5.0, 2310: 1.0}


def disorder(seed, n=240, parts=6):
    """Samples of three machines and of none, some without a time or counter, some twice, in random batches."""
    rng = random.Random(seed)
    rows, start = [], datetime(2026, 4, 1)
    for i in range(n):
        ts = start + timedelta(seconds=rng.choice([3, 60]) * i, microseconds=i)
        rows.append((rng.choice(["hot", "hot", "a", "b", None]), ts if rng.random() > 0.05 else None, rng.choice([i * 10, i * 7, None])))
    shuffled = [[] for _ in range(parts)]
    for i, row in enumerate(rows):
        shuffled[rng.randrange(parts) if rng.random() < 0.3 else i * parts // n].append(row)
    return rows, shuffled


@pytest.mark.parametrize("delay", ["10 days", "10 minutes", "0 seconds"])
def test_disorder_over_many_batches_equals_batch(spark, tmp_path, delay):
    rows, parts = disorder(3)
    stream, out = lots(spark, tmp_path, COUNTED, *parts), str(tmp_path / "out")
    everything = spark.createDataFrame(rows, COUNTED)
    pipeline.write_counter_rates(stream, {"rate": "counter"}, f"{out}/rates", f"{out}/c1", delay=delay).awaitTermination()
    assert same_rows(pipeline.read_counter_rates(spark, f"{out}/rates"), series.counter_rates(everything, {"rate": "counter"}))
    pipeline.write_held(stream, "counter", f"{out}/held", f"{out}/c2", every=3, delay=delay).awaitTermination()
    assert same_rows(pipeline.read_held(spark, f"{out}/held"), series.sample_and_hold(everything, "counter", every=3))


def test_nulls_and_equal_samples_stay(spark, tmp_path):
    ts = datetime(2026, 4, 1)
    parts = [[(None, ts, 1), ("m", None, 2), ("m", ts, 3)], [("m", ts, 3), (None, None, None)], [("m", None, 2), (None, ts, 1)]]
    stream, out = lots(spark, tmp_path, COUNTED, *parts), str(tmp_path / "out")
    pipeline.write_counter_rates(stream, {"rate": "counter"}, f"{out}/data", f"{out}/check").awaitTermination()
    read = pipeline.read_counter_rates(spark, f"{out}/data")
    got = sorted(((r.machine, r.ts, r.counter, r.rate) for r in read.collect()), key=str)
    assert got == sorted(((*row, None) for part in parts for row in part), key=str)


def test_naive_times_come_back(spark, tmp_path):
    schema = "machine string, ts timestamp_ntz, counter bigint, other timestamp"
    ts = datetime(1969, 12, 31, 23, 59, 59, 999_999)
    stream = lots(spark, tmp_path, schema, [("m", ts, 1, ts)], [("m", ts + timedelta(seconds=2), 5, None)])
    out = str(tmp_path / "out")
    pipeline.write_counter_rates(stream, {"rate": "counter"}, f"{out}/data", f"{out}/check").awaitTermination()
    got = sorted(map(tuple, pipeline.read_counter_rates(spark, f"{out}/data").select("ts", "other", "rate").collect()))
    assert got == [(ts, ts, None), (ts + timedelta(seconds=2), None, 2.0)]


def test_idle_machines_keep_their_newest_sample_alone(spark, tmp_path):
    start = datetime(2026, 4, 1)
    parts = [[("m", start, 0), ("m", start + timedelta(seconds=10), 100)], [("x", start, 1)], [("x", start, 2)], [("m", start + timedelta(seconds=5), 40), ("m", start + timedelta(seconds=20), 300)]]
    stream, out = lots(spark, tmp_path, COUNTED, *parts), str(tmp_path / "out")
    pipeline.write_counter_rates(stream, {"rate": "counter"}, f"{out}/data", f"{out}/check", idle="0 seconds").awaitTermination()
    late = spark.read.parquet(f"{out}/data").where("late").collect()
    assert [(r.machine, r.counter) for r in late] == [("m", 40)]
    everything = spark.createDataFrame([row for part in parts for row in part], COUNTED)
    got = pipeline.read_counter_rates(spark, f"{out}/data").where("machine = 'm'")
    assert same_rows(got, series.counter_rates(everything, {"rate": "counter"}).where("machine = 'm'"))


def test_uploads_have_exactly_so_many_rows(spark, tmp_path):
    start = datetime(2026, 4, 1)
    rng, parts, at = random.Random(2), [], 0
    for _ in range(5):
        part = []
        for _ in range(rng.randrange(20, 60)):
            at += 1
            part.append((rng.choice(["hot", "hot", "a", None]), start + timedelta(seconds=at), at))
        parts.append(part)
    stream, out = lots(spark, tmp_path, COUNTED, *parts), str(tmp_path / "out")
    pipeline.write_uploads(stream, f"{out}/data", f"{out}/check", rows=7, timeout="1 hour").awaitTermination()
    flushed = spark.read.parquet(f"{out}/data").drop("trigger")
    assert {r["count"] for r in flushed.groupBy("machine", "batch").count().collect()} == {7}
    flushed = flushed.unionByName(pipeline.waiting_samples(spark, f"{out}/check", stream.schema))
    everything = spark.createDataFrame([row for part in parts for row in part], COUNTED)
    expected = series.batch_numbers(everything.where("machine IS NOT NULL"), 7)
    assert same_rows(flushed.where("machine IS NOT NULL"), expected)
    sizes = {(r.machine, r.batch): r["count"] for r in flushed.groupBy("machine", "batch").count().collect()}
    last = {m: max(b for n, b in sizes if n == m) for m, _ in sizes}
    assert all(n == 7 for (m, b), n in sizes.items() if b < last[m]) and sum(sizes.values()) == at and None in last


def test_uploads_time_out_and_go_on_counting(spark, tmp_path):
    start = datetime(2026, 4, 1)
    parts = [[("m", start, 1), ("m", start, 2), ("m", start, 3)], [("x", start, 4)], [("x", start, 7)], [("m", start, 5), ("m", start, 6)]]
    stream, out = lots(spark, tmp_path, COUNTED, *parts), str(tmp_path / "out")
    pipeline.write_uploads(stream, f"{out}/data", f"{out}/check", rows=2, order=["ts", "counter"], timeout="0 seconds").awaitTermination()
    got = {r.counter: r.batch for r in spark.read.parquet(f"{out}/data").where("machine = 'm'").collect()}
    assert got == {1: 0, 2: 0, 3: 1, 5: 2, 6: 2}


def test_held_values_across_batches_equal_batch(spark, tmp_path):
    folder, everything, schema = arrivals(spark, tmp_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = str(tmp_path / "out")
    pipeline.write_held(stream, "counter", f"{out}/data", f"{out}/check").awaitTermination()
    expected = series.sample_and_hold(everything, "counter")
    streamed = pipeline.read_held(spark, f"{out}/data").select(*expected.columns)
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_minutes_without_a_watermark_equal_batch(spark, tmp_path):
    folder, everything, schema = arrivals(spark, tmp_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "true").parquet(folder)
    out = str(tmp_path / "out")
    pipeline.write_minutes(stream, ["counter"], f"{out}/data", f"{out}/check").awaitTermination()
    expected = series.minute_series(everything, ["counter"])
    got = pipeline.read_minutes(spark, f"{out}/data", ["counter"]).select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_minutes_across_batches_equal_batch(spark, tmp_path):
    folder, everything, schema = arrivals(spark, tmp_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    minutes = pipeline.minute_series(stream, ["counter"])
    out = str(tmp_path / "out")
    pipeline.write_updates(minutes, f"{out}/data", f"{out}/check").awaitTermination()
    latest = pipeline.read_updates(spark, f"{out}/data", minutes.schema, ["machine", "window_start"])
    expected = series.minute_series(everything, ["counter"]).withColumnRenamed("minute", "window_start")
    got = latest.select(*expected.columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_append_mode_emits_closed_windows(spark, tmp_path):
    folder, everything, schema = arrivals(spark, tmp_path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    closed = pipeline.minute_series(stream, ["counter"], delay="1 minute")
    out = str(tmp_path / "out")
    pipeline.write_files(closed, f"{out}/data", f"{out}/check").awaitTermination()
    done = spark.read.parquet(f"{out}/data")
    last = everything.agg(F.max("ts")).first()[0]
    assert 0 < done.count() < series.minute_series(everything, ["counter"]).count()
    assert done.agg(F.max("window_start")).first()[0] < last - timedelta(minutes=1)


def test_work_dir_follows_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = work_dir(spark, "x")
    assert "/hostvane/x-" in path and path != work_dir(spark, "x")
    if root:
        assert path.startswith(root)


DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.fixture(params=[None, DEFAULT_STORE])
def plain(request, spark):
    """A session that names no state store, or Spark's default one; its setting is its own afterwards."""
    session = spark.newSession()
    if request.param is None:
        session.conf.unset(STATE_STORE)
    else:
        session.conf.set(STATE_STORE, request.param)
    yield session
    assert session.conf.get(STATE_STORE, None) == request.param


PLAIN_PARTS = [
    [("m", datetime(2031, 2, 7, 0, 0, 0), 0), ("m", datetime(2031, 2, 7, 0, 0, 30), 300)],
    [("m", datetime(2031, 2, 7, 0, 0, 10), 50), ("x", datetime(2031, 2, 7), 1)],
]


def test_rates_in_a_session_with_the_default_store(plain, tmp_path):
    stream, out = lots(plain, tmp_path, COUNTED, *PLAIN_PARTS), str(tmp_path / "out")
    pipeline.write_counter_rates(stream, {"rate": "counter"}, f"{out}/data", f"{out}/check").awaitTermination()
    got = {r.counter: r.rate for r in pipeline.read_counter_rates(plain, f"{out}/data").collect()}
    assert got == {0: None, 50: 5.0, 300: 12.5, 1: None}


def test_held_values_in_a_session_with_the_default_store(plain, tmp_path):
    stream, out = lots(plain, tmp_path, COUNTED, *PLAIN_PARTS), str(tmp_path / "out")
    pipeline.write_held(stream, "counter", f"{out}/data", f"{out}/check", every=3).awaitTermination()
    got = {r.counter: (r.n, r.held) for r in pipeline.read_held(plain, f"{out}/data").collect()}
    assert got == {0: (1, 0), 50: (2, 0), 300: (3, 300), 1: (1, 1)}


def test_uploads_in_a_session_with_the_default_store(plain, tmp_path):
    stream, out = lots(plain, tmp_path, COUNTED, *PLAIN_PARTS), str(tmp_path / "out")
    pipeline.write_uploads(stream, f"{out}/data", f"{out}/check", rows=2, timeout="1 day").awaitTermination()
    flushed = {(r.counter, r.batch) for r in plain.read.parquet(f"{out}/data").collect()}
    waiting = pipeline.waiting_samples(plain, f"{out}/check", stream.schema).collect()
    assert flushed == {(0, 0), (300, 0)} and {(r.counter, r.batch) for r in waiting} == {(50, 1), (1, 0)}


@pytest.mark.parametrize("name", ["stream_counter_rate", "stream_sample_hold", "stream_uploads", "stream_rate_corrected", "stream_rate_late", "stream_hold_disordered"])
def test_samples_without_a_time_are_in_the_streams(spark, tmp_path, name):
    start = datetime(2026, 4, 1)
    rows = [(i, start + timedelta(hours=i) if i % 5 else None, i % 2, "e", float(i), '{"k": 1}') for i in range(40)]
    spark.createDataFrame(rows, views.EVENT_SCHEMA).write.parquet(str(tmp_path / "events.parquet"))
    got = getattr(landing_queries, name)(spark, str(tmp_path)).collect()
    assert sorted((r.sample_id, r.machine) for r in got) == [(i, i % 2) for i in range(40)]
