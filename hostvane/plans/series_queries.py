"""Rates, held values, gaps, grids, per-minute series and chart series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane import work_dir
from hostvane.functions import scalars, status
from hostvane.operators import coverage, series, sketches
from hostvane.plans import process_queries, views
from hostvane.plans.registry import query

HOST = f"WITH {views.HOST_SQL}"
ORDER = ["ts", "sample_id"]
LAG = "lag({}) OVER (PARTITION BY machine ORDER BY ts, sample_id)"
SECONDS = f"(epoch_us(ts) - epoch_us({LAG.format('ts')}))::DOUBLE / 1e6"


@query(
    f"""{HOST}, d AS (SELECT sample_id, machine, {SECONDS} AS dt, bytes_read - {LAG.format('bytes_read')} AS dr,
    bytes_written - {LAG.format('bytes_written')} AS dw FROM host)
    SELECT sample_id, machine, dr::DOUBLE / nullif(dt, 0) AS read_bps, dw::DOUBLE / nullif(dt, 0) AS write_bps FROM d"""
)
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = views.hosts(spark, sf_dir).select("machine", *ORDER, "bytes_read", "bytes_written")
    counters = {"read_bps": "bytes_read", "write_bps": "bytes_written"}
    rates = series.counter_rates(host, counters, order=ORDER)
    return rates.select("sample_id", "machine", "read_bps", "write_bps")


@query(
    f"""{HOST}, d AS (SELECT sample_id, k - {LAG.format('k')} AS dk FROM host)
    SELECT sample_id, CASE WHEN dk >= 0 THEN dk::DOUBLE / 3 END AS rate FROM d"""
)
def counter_rate_nominal(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = views.hosts(spark, sf_dir).select("machine", *ORDER, "k")
    rates = series.counter_rates(
        host, {"rate": "k"}, order=ORDER, interval=3.0, null_resets=True
    )
    return rates.select("sample_id", "rate")


NUMBERED = f"""{HOST}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY machine ORDER BY ts, sample_id) AS n FROM host)"""


@query(
    f"""{NUMBERED} SELECT sample_id, machine, n,
    last_value(CASE WHEN (n = 1 OR n % 6 = 0) AND k % 3 <> 0 THEN ping_ms END IGNORE NULLS)
    OVER (PARTITION BY machine ORDER BY n ROWS UNBOUNDED PRECEDING) AS held FROM numbered"""
)
def sample_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the measurements failed."""
    ping = F.when(F.col("k") % 3 != 0, F.col("ping_ms")).alias("ping_ms")
    host = views.hosts(spark, sf_dir).select("machine", *ORDER, ping)
    held = series.sample_and_hold(host, "ping_ms", order=ORDER)
    return held.select("sample_id", "machine", "n", "held")


@query(f"{NUMBERED} SELECT sample_id, machine, n FROM numbered")
def running_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = views.hosts(spark, sf_dir).select("machine", *ORDER)
    return series.running_counter(host, order=ORDER).select("sample_id", "machine", "n")


@query(f"{NUMBERED} SELECT sample_id, machine, (n - 1) // 60 AS batch FROM numbered")
def batch_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = views.hosts(spark, sf_dir).select("machine", *ORDER)
    return series.batch_numbers(host, order=ORDER).select("sample_id", "machine", "batch")


@query(
    f"""{HOST}, d AS (SELECT sample_id, machine, {SECONDS} AS elapsed_s FROM host)
    SELECT *, elapsed_s > 7200.0 AS is_gap FROM d"""
)
def sample_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = views.hosts(spark, sf_dir).select("machine", *ORDER)
    gaps = series.sample_gaps(host, 3600.0, order=ORDER)
    return gaps.select("sample_id", "machine", "elapsed_s", "is_gap")


@query(
    f"""{HOST} SELECT machine, ts, sample_id, cpu_pct, disk_used_pct, event_type FROM host
    QUALIFY row_number() OVER (PARTITION BY machine ORDER BY ts DESC, sample_id DESC) = 1"""
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["machine", "ts", "sample_id", "cpu_pct", "disk_used_pct", "event_type"]
    return series.latest_snapshot(views.hosts(spark, sf_dir).select(*columns), order=ORDER)


@query(
    f"""{HOST} SELECT machine, date_trunc('minute', ts) AS minute, count(*) AS samples,
    sum(cpu_pct::DECIMAL(18, 2))::DOUBLE / count(*) AS avg_cpu_pct, max(cpu_pct) AS max_cpu_pct,
    sum(disk_used_pct::DECIMAL(18, 2))::DOUBLE / count(*) AS avg_disk_used_pct, max(disk_used_pct) AS max_disk_used_pct
    FROM host GROUP BY machine, date_trunc('minute', ts)"""
)
def minute_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.minute_series(views.hosts(spark, sf_dir), ["cpu_pct", "disk_used_pct"])


@query(
    """SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 MINUTE)) AS ts FROM events
    EXCEPT SELECT date_trunc('minute', ts) FROM events"""
)
def minute_grid_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("ts")
    first = F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")
    last = F.max("ts") + F.expr("interval 1 microsecond")
    grid = series.time_grid(events.agg(first.alias("start"), last.alias("end")), "start", "end").select("ts")
    minutes = events.select(F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("ts"))
    return series.missing_points(grid, minutes, ["ts"])


@query(
    """WITH spans AS (SELECT user_id AS machine, date_trunc('day', min(ts)) AS a, max(ts) AS b FROM events GROUP BY 1)
    SELECT machine, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM spans
    EXCEPT SELECT user_id, date_trunc('hour', ts) FROM events"""
)
def machine_hour_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("machine"), "ts")
    first = F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")
    last = F.max("ts") + F.expr("interval 1 microsecond")
    spans = events.groupBy("machine").agg(first.alias("start"), last.alias("end"))
    grid = series.time_grid(spans, "start", "end", "1 hour").select("machine", "ts")
    hours = events.select("machine", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return series.missing_points(grid, hours, ["machine", "ts"])


@query(f"{HOST} SELECT ts, sample_id, machine, cpu_pct FROM host ORDER BY ts, sample_id")
def cpu_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chart(views.hosts(spark, sf_dir), cpu_pct=F.col("cpu_pct"))


@query(f"{HOST} SELECT ts, sample_id, machine, freq_cur_mhz FROM host ORDER BY ts, sample_id")
def freq_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chart(views.hosts(spark, sf_dir), freq_cur_mhz=F.col("freq_cur_mhz"))


@query(
    f"""{HOST} SELECT ts, sample_id, machine, mem_free_bytes::DOUBLE / 1073741824 AS gib FROM host
    ORDER BY ts, sample_id"""
)
def mem_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chart(views.hosts(spark, sf_dir), gib=scalars.bytes_to_gib(F.col("mem_free_bytes")))


@query(
    f"""{HOST} SELECT ts, sample_id, 'bytes_read' AS metric, bytes_read AS value FROM host
    UNION ALL SELECT ts, sample_id, 'bytes_written', bytes_written FROM host"""
)
def io_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = series.wide_to_long(views.hosts(spark, sf_dir), ORDER, ["bytes_read", "bytes_written"])
    return long.orderBy(*ORDER, "metric")


@query(
    f"""{HOST}, f AS (SELECT *, cpu_pct > 50 AND freq_cur_mhz < freq_max_mhz * 0.6::DOUBLE AS flag FROM host)
    SELECT ts, sample_id, machine, cpu_pct, flag, CASE WHEN flag THEN cpu_pct END AS flagged FROM f"""
)
def cpu_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = status.cpu_bottleneck(F.col("cpu_pct"), F.col("freq_cur_mhz"), F.col("freq_max_mhz"))
    cpu = F.col("cpu_pct")
    return _chart(views.hosts(spark, sf_dir), cpu_pct=cpu, flag=flag, flagged=series.overlay(flag, cpu))


@query(
    f"""{HOST}, f AS (SELECT *, mem_free_bytes::DOUBLE / 1073741824 AS gib FROM host)
    SELECT ts, sample_id, machine, gib, gib < 48.15::DOUBLE AS flag,
    CASE WHEN gib < 48.15::DOUBLE THEN gib END AS flagged FROM f"""
)
def mem_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    gib = scalars.bytes_to_gib(F.col("mem_free_bytes"))
    flag = status.low_memory(gib)
    return _chart(views.hosts(spark, sf_dir), gib=gib, flag=flag, flagged=series.overlay(flag, gib))


def _chart(host: DataFrame, **columns) -> DataFrame:
    fixed = {name: F.col(name) for name in [*ORDER, "machine"]}
    return series.series(host, fixed | columns, ORDER)


@query(f"{process_queries.PROC} SELECT ts, sample, name, pid, line, cpu_percent FROM proc")
def proc_cpu_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["ts", "sample", "name", "pid", "line", "cpu_percent"]
    rows = views.process_rows(spark, sf_dir)
    return series.series(rows, {c: F.col(c) for c in columns}, columns[:-1])


@query(f"{process_queries.PROC} SELECT ts, sample, name, pid, line, rss::DOUBLE / 1048576 AS rss_mib FROM proc")
def proc_rss_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["ts", "sample", "name", "pid", "line"]
    chosen = {c: F.col(c) for c in columns} | {"rss_mib": scalars.bytes_to_mib(F.col("rss"))}
    return series.series(views.process_rows(spark, sf_dir), chosen, columns)


@query(
    """WITH spans AS (SELECT user_id AS machine, date_trunc('day', min(ts)) AS a, max(ts) AS b FROM events GROUP BY 1),
    missing AS (
      SELECT machine, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM spans
      EXCEPT SELECT user_id, date_trunc('hour', ts) FROM events),
    runs AS (SELECT *, epoch(ts)::BIGINT // 3600 - row_number() OVER (PARTITION BY machine ORDER BY ts) AS run FROM missing)
    SELECT machine, min(ts) AS gap_from, max(ts) AS gap_to, count(*) AS missing FROM runs GROUP BY machine, run"""
)
def machine_gap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same points as ``machine_hour_gaps``, as intervals."""
    events = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("machine"), "ts")
    first = F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")
    last = F.max("ts") + F.expr("interval 1 microsecond")
    spans = events.groupBy("machine").agg(first.alias("start"), last.alias("end"))
    return coverage.coverage_gaps(events, spans, ["machine"], 3600)


@query(
    f"""{HOST} SELECT machine, date_trunc('day', ts) AS day, count(*) AS n, quantile_disc(cpu_pct, 0.5) AS p50,
    quantile_disc(cpu_pct, 0.95) AS p95, quantile_disc(cpu_pct, 0.99) AS p99 FROM host GROUP BY machine, date_trunc('day', ts)"""
)
def day_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per machine and day, from stored sketches of minutes; a day's samples are few enough for exact quantiles."""
    path = work_dir(spark, "sketches")
    sketches.quantile_sketches(views.hosts(spark, sf_dir), ["machine"], "cpu_pct").write.parquet(path)
    hours = sketches.rolled_up(spark.read.parquet(path), ["machine"], "minute", "hour")
    return sketches.quantiles(sketches.rolled_up(hours, ["machine"], "hour", "day"))


@query(
    f"""{HOST} SELECT event_type, count(*) AS n, true AS p50_within, true AS p95_within, true AS p99_within
    FROM host GROUP BY event_type"""
)
def type_quantiles_within_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type of event over all time, from the same stored sketches: whether each quantile's true rank is within the error."""
    path, host = work_dir(spark, "sketches"), views.hosts(spark, sf_dir)
    sketches.quantile_sketches(host, ["event_type"], "cpu_pct").write.parquet(path)
    merged = sketches.quantiles(sketches.rolled_up(spark.read.parquet(path), ["event_type"], "minute", None))
    counts = []
    for name in sketches.QUANTILES:
        counts += [F.count_if(F.col("cpu_pct") < F.col(name)).alias(f"{name}_below"), F.count_if(F.col("cpu_pct") <= F.col(name)).alias(f"{name}_up_to")]
    ranked = host.join(merged, "event_type").groupBy("event_type", "n").agg(*counts)
    error = sketches.RANK_ERROR
    within = [
        ((F.col(f"{name}_below") / F.col("n") <= rank + error) & (F.col(f"{name}_up_to") / F.col("n") >= rank - error)).alias(f"{name}_within")
        for name, rank in sketches.QUANTILES.items()
    ]
    return ranked.select("event_type", "n", *within)
