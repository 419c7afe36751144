"""Landing files, curated files and streams. Each query first lets Spark write the files from the given tables into
the shared work folder, then runs the reader, sink or stream on them."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane import schemas, work_dir
from hostvane.functions import scalars, status
from hostvane.operators import series
from hostvane.plans import status_queries, treatment, views
from hostvane.plans.registry import query
from hostvane.sources import landing, sinks
from hostvane.streaming import pipeline

HOST = f"WITH {views.HOST_SQL}"


def agent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent CSV lines of every event: 26 fields, or 27 where k is odd, with a quoted process list."""
    mac = scalars.mac_text(F.col("machine"))
    empty = F.lit("0")
    by_name = {
        "endereco_mac": mac,
        "nome_usuario": F.lit("user"),
        "percentual_uso_cpu": F.col("cpu_pct").cast("string"),
        "frequencia_cpu_atual_mhz": F.col("freq_cur_mhz").cast("string"),
        "frequencia_cpu_minima_mhz": F.col("freq_min_mhz").cast("string"),
        "frequencia_cpu_maxima_mhz": F.col("freq_max_mhz").cast("string"),
        "memoria_total_bytes": F.col("mem_total_bytes").cast("string"),
        "memoria_disponivel_bytes": F.col("mem_free_bytes").cast("string"),
        "percentual_uso_ram": F.col("ram_used_pct").cast("string"),
        "percentual_uso_swap": F.col("swap_used_pct").cast("string"),
        "percentual_uso_disco": F.col("disk_used_pct").cast("string"),
        "latencia_ping_ms": F.col("ping_ms").cast("string"),
        "processos": F.concat(
            F.lit("\"[{'pid': "), F.col("sample_id").cast("string"), F.lit(", 'name': 'a,b \"\"c\"\"'}]\"")
        ),
    }
    measures = [by_name.get(name, empty) for name, _ in schemas.AGENT_COLUMNS[:-1]]
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    line = F.concat_ws(",", *measures, F.when(F.col("k") % 2 == 1, F.col("k").cast("string")), ts)
    return views.hosts(spark, sf_dir).select(line.alias("value"), "machine", "k", "ts")


def write_uploads(spark: SparkSession, sf_dir: str) -> str:
    """Uploads in order of arrival: a fifth of the machines come after all others, and a quarter comes again."""
    path = work_dir(spark, "uploads")
    lines = agent_lines(spark, sf_dir)
    late = F.col("machine") % 5 == 0
    for part in (lines.where(~late), lines.where(late), lines.where("k % 4 = 0")):
        part.select("value").repartition(4).write.mode("append").text(path)
    return path


def write_landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder with headers, headerless files and every sample uploaded twice."""
    path = work_dir(spark, "landing")
    lines = agent_lines(spark, sf_dir).select("value")
    header = spark.range(1).select(F.lit(",".join(name for name, _ in schemas.AGENT_COLUMNS)).alias("value"))
    lines.unionByName(header).write.text(path)
    lines.write.mode("append").text(path)
    return path


AGENT_SQL = f"""{HOST} SELECT format('{{:012x}}', machine) AS machine, ts, cpu_pct, ram_used_pct, ping_ms,
    CASE WHEN k % 2 = 1 THEN k END AS n_processes, '[{{''pid'': ' || sample_id || ', ''name'': ''a,b "c"''}}]' AS processes
    FROM host QUALIFY row_number() OVER (PARTITION BY machine, ts ORDER BY n_processes IS NULL, cpu_pct DESC) = 1"""
AGENT_COLUMNS = ["machine", "cpu_pct", "ram_used_pct", "ping_ms", "n_processes", "processes"]


def naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.col("ts").cast("timestamp_ntz").alias("ts"), *columns)


@query(AGENT_SQL)
def landing_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = landing.canonical_agent(landing.read_agent_csv(spark, write_landing(spark, sf_dir)))
    return naive(series.drop_repeats(samples.select("ts", *AGENT_COLUMNS)), *AGENT_COLUMNS)


@query("SELECT count(*) * 2 AS linhas FROM events")
def landing_rows_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_agent_csv(spark, write_landing(spark, sf_dir)).agg(F.count(F.lit(1)).alias("linhas"))


@query(
    """SELECT strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia,
    strptime(strftime(ts, '%Y-%m-%dT%H-%M-%S'), '%Y-%m-%dT%H-%M-%S') AS upload_ts,
    format('{:012x}', user_id) AS id_maquina, event_id FROM events"""
)
def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events")
    parts = scalars.date_parts(F.col("ts"))
    name = F.concat_ws(
        "_", F.lit("dados"), scalars.upload_stamp(F.col("ts")), scalars.machine_id(scalars.mac_text(F.col("user_id")))
    )
    path = F.concat_ws("/", F.lit("zone/raw"), *parts.values(), F.concat(name, F.lit(".csv")))
    named = landing.with_object_name(events.select("event_id", path.alias("path")), F.col("path"))
    return named.drop("path").withColumn("upload_ts", F.col("upload_ts").cast("timestamp_ntz"))


@query(
    """SELECT strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia, event_id, user_id
    FROM events"""
)
def curated_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "curated")
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    sinks.write_by_day(events, path, cluster=["user_id"])
    schema = "event_id bigint, user_id bigint, ano string, mes string, dia string"
    return spark.read.schema(schema).parquet(path)


@query(
    """SELECT strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia,
    ceil(count(*) / 100.0)::BIGINT AS objetos FROM events GROUP BY 1, 2, 3"""
)
def list_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of at most 100 samples, counted per day folder from their paths."""
    path = work_dir(spark, "objects")
    events = views.table(spark, sf_dir, "events").select("event_id", "ts")
    keyed = sinks.with_date_keys(events).repartition(*sinks.DAY_KEYS)
    keyed.write.option("maxRecordsPerFile", 100).partitionBy(*sinks.DAY_KEYS).parquet(path)
    listed = landing.list_objects(spark, path, "*.parquet").where("length > 0")
    keys = [F.regexp_extract("path", rf"/{key}=(\d+)/", 1).alias(key) for key in sinks.DAY_KEYS]
    return listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("objetos"))


@query(
    """SELECT event_id, user_id, ts FROM events
    WHERE ts >= (SELECT date_trunc('day', min(ts)) + INTERVAL 2 DAY FROM events)
      AND ts < (SELECT date_trunc('day', min(ts)) + INTERVAL 5 DAY FROM events)"""
)
def curated_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days, read by the folders alone."""
    path = work_dir(spark, "curated")
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    sinks.write_by_day(events, path, cluster=["user_id"])
    first = events.agg(F.to_date(F.min("ts"))).first()[0]
    days = [(first + timedelta(days=n)).isoformat() for n in (2, 4)]
    return sinks.read_curated(spark, path, *days).select("event_id", "user_id", "ts")


@query(
    f"""{HOST} SELECT format('{{:012x}}', machine) AS machine, ts, cpu_pct, ram_used_pct, ping_ms, sample_id FROM host
    WHERE date_trunc('day', ts) = (SELECT date_trunc('day', max(ts)) FROM host)"""
)
def landing_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest day of a landing zone that has a folder for every day."""
    root, (_, newest) = write_zone(spark, sf_dir)
    day = landing.read_agent_csv(spark, landing.day_path(root, newest.year, newest.month, newest.day, keyed=True))
    return _zone_samples(day)


def write_zone(spark: SparkSession, sf_dir: str) -> tuple[str, tuple[date, date]]:
    """A landing zone with all days, written by one job, and its first and last day."""
    root = work_dir(spark, "zone")
    lines = agent_lines(spark, sf_dir)
    sinks.with_date_keys(lines).select("value", *sinks.DAY_KEYS).repartition(*sinks.DAY_KEYS).write.partitionBy(*sinks.DAY_KEYS).text(root)
    return root, tuple(lines.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first())


def _zone_samples(samples: DataFrame) -> DataFrame:
    sample_id = F.regexp_extract("processes", r"'pid': (\d+)", 1).cast("long")
    canonical = landing.canonical_agent(samples).withColumn("sample_id", sample_id)
    return naive(canonical, "machine", "cpu_pct", "ram_used_pct", "ping_ms", "sample_id")


@query(
    f"""{HOST} SELECT format('{{:012x}}', machine) AS machine, ts, cpu_pct, ram_used_pct, ping_ms, sample_id FROM host
    WHERE ts >= (SELECT date_trunc('day', min(ts)) + INTERVAL 3 DAY FROM host)"""
)
def landing_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the fourth day on, up to a year after the last: days without a folder do not matter."""
    root, (first, last) = write_zone(spark, sf_dir)
    days = landing.read_agent_days(spark, root, first + timedelta(days=3), last + timedelta(days=365), keyed=True)
    return _zone_samples(days)


@query(
    """SELECT strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia,
    strptime(strftime(max(ts), '%Y-%m-%dT%H-%M-%S'), '%Y-%m-%dT%H-%M-%S') AS upload_ts,
    format('{:012x}', user_id % 4) AS id_maquina, count(*) AS linhas FROM events GROUP BY 1, 2, 3, 5"""
)
def scanned_object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from the paths of the files that a scan reads: an object per day and machine, users standing for four machines.

    Spark names the files it writes itself, so that an object is a folder here, its name encoded in the folder's.
    """
    root = work_dir(spark, "named")
    events = views.table(spark, sf_dir, "events").withColumn("machine", F.col("user_id") % 4)
    events = sinks.with_date_keys(events)
    keys = [*sinks.DAY_KEYS, "machine"]
    uploads = events.groupBy(*keys).agg(F.max("ts").alias("upload"))
    name = F.concat_ws("_", F.lit("dados"), scalars.upload_stamp(F.col("upload")), scalars.machine_id(scalars.mac_text(F.col("machine"))))
    path = F.concat_ws("/", *sinks.DAY_KEYS, F.concat(name, F.lit(".csv")))
    named = events.join(uploads, keys).select(F.col("event_id").cast("string").alias("value"), path.alias("objeto"))
    named.repartition("objeto").write.partitionBy("objeto").text(root)
    decoded = F.url_decode(F.url_decode(F.col("_metadata.file_path")))
    lines = landing.with_object_name(spark.read.schema("value string").text(root), decoded)
    counted = lines.groupBy(*sinks.DAY_KEYS, "upload_ts", "id_maquina").agg(F.count(F.lit(1)).alias("linhas"))
    return counted.withColumn("upload_ts", F.col("upload_ts").cast("timestamp_ntz"))


@query(
    f"""{HOST} SELECT format('{{:012x}}', machine) AS machine, ts, cpu_pct, freq_cur_mhz, disk_used_pct,
    (100 - ram_used_pct) AS ram_free_pct, 100 - mem_free_bytes::DOUBLE / mem_total_bytes * 100 AS ram_used_pct,
    bytes_read AS read_bps, 'a, "b"' AS processes FROM host"""
)
def simulated_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "simulated")
    by_name = {
        "macAdress": scalars.mac_text(F.col("machine")),
        "usuario": F.lit("user"),
        "porcentagem_uso_da_cpu": F.col("cpu_pct"),
        "frequencia_atual": F.col("freq_cur_mhz").cast("int"),
        "frequencia_min": F.col("freq_min_mhz").cast("int"),
        "frequencia_max": F.col("freq_max_mhz").cast("int"),
        "porcentagem_uso_do_disco": F.col("disk_used_pct"),
        "read_rate_Bps": F.col("bytes_read"),
        "write_rate_Bps": F.col("bytes_written"),
        "memoria_percentual": (100 - F.col("ram_used_pct")).cast("int"),
        "memoria_total": F.col("mem_total_bytes"),
        "memoria_livre": F.col("mem_free_bytes"),
        "processos": F.lit('a, "b"'),
        "data": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    }
    written = views.hosts(spark, sf_dir).select(*[by_name[n].alias(n) for n, _ in schemas.SIMULATED_COLUMNS])
    sinks.overwrite_csv(written, path)
    samples = landing.canonical_simulated(landing.read_simulated_csv(spark, path))
    return naive(samples, "machine", "cpu_pct", "freq_cur_mhz", "disk_used_pct", "ram_free_pct", "ram_used_pct", "read_bps", "processes")


def _text_of(case: str, wording: dict[str, str]) -> str:
    return f"CASE {case} {' '.join(f"WHEN '{code}' THEN '{text}'" for code, text in wording.items())} END"


_SQL_TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER"}
_HEX = "format('{:012x}', machine)"
_TREATED_SQL = {
    "endereco_mac": "array_to_string([" + ", ".join(f"substr({_HEX}, {k}, 2)" for k in range(1, 12, 2)) + "], ':')",
    "nome_usuario": "'user'",
    "percentual_uso_cpu": "cpu_pct",
    "frequencia_cpu_atual_mhz": "freq_cur_mhz",
    "frequencia_cpu_minima_mhz": "freq_min_mhz",
    "frequencia_cpu_maxima_mhz": "freq_max_mhz",
    "memoria_total_bytes": "mem_total_bytes",
    "memoria_disponivel_bytes": "mem_free_bytes",
    "percentual_uso_ram": "ram_used_pct",
    "percentual_uso_swap": "swap_used_pct",
    "percentual_uso_disco": "disk_used_pct",
    "latencia_ping_ms": "ping_ms",
    "processos": """'[{''pid'': ' || sample_id || ', ''name'': ''a,b "c"''}]'""",
    "data_hora_iso": "ts",
    "degradacao": _text_of(status_queries.DEGRADED_CASE, status.DEGRADATION_TEXT),
    "status_cpu": _text_of(status_queries.limit_case("cpu_pct", "(60.0::DOUBLE + n_nationkey)"), status.LIMIT_TEXT),
    "status_ram": _text_of(status_queries.limit_case("ram_used_pct", "(50.0::DOUBLE + n_nationkey)"), status.LIMIT_TEXT),
    "status_swap": _text_of(status_queries.SWAP_CASE, status.SWAP_TEXT),
    "status_disco": _text_of(status_queries.limit_case("disk_used_pct", "(70.0::DOUBLE + n_nationkey)"), status.LIMIT_TEXT),
    "status_ping": _text_of(status_queries.PING_CASE, status.PING_TEXT),
}
#: Measurements that the test files hold as 0.
_TREATED_SQL |= {name: f"0::{_SQL_TYPES[kind]}" for name, kind in schemas.AGENT_COLUMNS if name not in _TREATED_SQL}


@query(
    f"""{HOST} SELECT {', '.join(f'{sql} AS {name}' for name, sql in _TREATED_SQL.items())}
    FROM host LEFT JOIN nation ON n_nationkey = machine"""
)
def treated_agent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout of 26 agent columns and 6 worded labels."""
    path = work_dir(spark, "agent")
    agent_lines(spark, sf_dir).select("value").write.text(path)
    treated = treatment.treat_agent(landing.read_agent_csv(spark, path), views.machine_limits(spark, sf_dir))
    return treated.withColumn("data_hora_iso", F.col("data_hora_iso").cast("timestamp_ntz"))


@query(
    f"""{status_queries.TREATED} SELECT cpu_pct AS cpu, disk_used_pct AS disco, ts AS datahora,
    ram_used_pct AS ram_percentual, status_ram, status_cpu, status_disco, event_type AS periodo FROM treated"""
)
def treated_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "treated")
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datahora")
    written = status_queries.treated_hosts(spark, sf_dir).select(
        F.col("cpu_pct").alias("cpu"), F.col("disk_used_pct").alias("disco"), stamp,
        F.col("ram_used_pct").alias("ram_percentual"), "status_ram", "status_cpu", "status_disco",
        F.col("event_type").alias("periodo"),
    )
    sinks.overwrite_csv(written, path)
    read = landing.read_treated_csv(spark, path)
    return read.withColumn("datahora", F.col("datahora").cast("timestamp_ntz"))


@query(
    """SELECT event_id, user_id, value FROM events UNION ALL SELECT event_id, user_id, value FROM events"""
)
def append_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "csv")
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    sinks.append_csv(events, path)
    sinks.overwrite_csv(events, path)
    sinks.append_csv(events, path)
    schema = "event_id bigint, user_id bigint, value double"
    return spark.read.schema(schema).option("header", "true").csv(path)


@query(
    f"""{HOST} SELECT machine, ts, sample_id, cpu_pct, NULL::INTEGER AS n_processes FROM host
    UNION ALL SELECT machine, ts, sample_id, cpu_pct, k FROM host"""
)
def union_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(views.hosts(spark, sf_dir))


@query(f"{HOST} SELECT machine, ts, max(sample_id) AS sample_id, max_by(cpu_pct, sample_id) AS cpu_pct, "
       "max_by(k, sample_id) AS n_processes FROM host GROUP BY machine, ts")
def landing_union_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.drop_repeats(_versions(views.hosts(spark, sf_dir)))


def _versions(host: DataFrame) -> DataFrame:
    older = host.select("machine", "ts", "sample_id", "cpu_pct")
    newer = host.select("machine", "ts", "sample_id", "cpu_pct", F.col("k").alias("n_processes"))
    return series.append_versions(older, newer)


# Streams ---------------------------------------------------------------------------------------------------------


def staged_events(spark: SparkSession, sf_dir: str, untimed: bool = False) -> str:
    """The events as files that arrive in order of time, in four lots of two; ``untimed`` ones too, as a lot behind them."""
    path = work_dir(spark, "arrivals")
    events = views.table(spark, sf_dir, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last, without = events.agg(F.min(seconds), F.max(seconds), F.count_if(seconds.isNull())).first()
    lot = F.coalesce(F.floor((seconds - first) * 4 / (last - first + 1)), F.lit(4))
    for n in range(5 if untimed and without else 4):
        events.where(lot == n).repartition(2).write.mode("append").parquet(path)
    return path


def host_stream(spark: SparkSession, sf_dir: str, untimed: bool = False) -> DataFrame:
    events = pipeline.stream_parquet(spark, staged_events(spark, sf_dir, untimed), views.EVENT_SCHEMA, files_per_trigger=2)
    return views.host_columns(events).withColumn("ts", F.col("ts").cast("timestamp"))


def finish(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = work_dir(spark, "stream")
    pipeline.write_files(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


@query(
    f"""{status_queries.TREATED} SELECT sample_id, machine, ts, degradacao, status_cpu, status_ram, status_swap,
    status_disco, status_ping, cpu_pct > 50 AND freq_cur_mhz < freq_max_mhz * 0.6::DOUBLE AS bottleneck,
    mem_free_bytes::DOUBLE / 1073741824 < 48.15::DOUBLE AS low_memory, freq_cur_mhz < freq_min_mhz AS below_min,
    CASE WHEN cpu_pct >= 80 THEN 'RED' WHEN cpu_pct >= 60 THEN 'YELLOW' ELSE 'GREEN' END AS severity FROM treated"""
)
def stream_treated(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = host_stream(spark, sf_dir).withColumn("machine_group", views.machine_group())
    treated = treatment.treat(samples, views.limits(spark, sf_dir), key="machine_group").withColumns(
        {
            "bottleneck": status.cpu_bottleneck(F.col("cpu_pct"), F.col("freq_cur_mhz"), F.col("freq_max_mhz")),
            "low_memory": status.low_memory(scalars.bytes_to_gib(F.col("mem_free_bytes"))),
            "below_min": status.below_min_freq(F.col("freq_cur_mhz"), F.col("freq_min_mhz")),
            "severity": status.severity(F.col("cpu_pct")),
        }
    )
    flags = ["bottleneck", "low_memory", "below_min", "severity"]
    return naive(finish(spark, treated), "sample_id", "machine", *schemas.STATUS_COLUMNS, *flags)


@query(AGENT_SQL)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = landing.stream_agent_csv(spark, write_landing(spark, sf_dir), files_per_trigger=2)
    samples = pipeline.drop_repeats(landing.canonical_agent(lines), delay="36500 days")
    return naive(finish(spark, samples), *AGENT_COLUMNS)


def _ingested(spark: SparkSession, sf_dir: str, files_per_trigger: int) -> DataFrame:
    out = work_dir(spark, "ingest")
    limits = views.machine_limits(spark, sf_dir)
    path = write_uploads(spark, sf_dir)
    pipeline.ingest(spark, path, limits, f"{out}/data", f"{out}/checkpoint", files_per_trigger).awaitTermination()
    return naive(pipeline.read_ingested(spark, f"{out}/data"), *AGENT_COLUMNS, "status_cpu")


INGEST_SQL = f"""{HOST} SELECT format('{{:012x}}', machine) AS machine, ts, cpu_pct, ram_used_pct, ping_ms,
    CASE WHEN k % 2 = 1 THEN k END AS n_processes, '[{{''pid'': ' || sample_id || ', ''name'': ''a,b "c"''}}]' AS processes,
    {status_queries.limit_case('cpu_pct', '(60.0::DOUBLE + n_nationkey)')} AS status_cpu
    FROM host LEFT JOIN nation ON n_nationkey = machine
    QUALIFY row_number() OVER (PARTITION BY machine, ts ORDER BY n_processes IS NULL, cpu_pct DESC) = 1"""


@query(INGEST_SQL)
def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch per upload; a fifth of the machines upload after all others."""
    return _ingested(spark, sf_dir, 1)


@query(INGEST_SQL)
def ingest_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir, 10)


@query(
    f"""{HOST} SELECT machine, date_trunc('minute', ts) AS ts, count(*) AS samples,
    sum(cpu_pct::DECIMAL(18, 2))::DOUBLE / count(*) AS avg_cpu_pct, max(cpu_pct) AS max_cpu_pct
    FROM host GROUP BY machine, date_trunc('minute', ts)"""
)
def stream_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "stream")
    stream = host_stream(spark, sf_dir)
    pipeline.write_minutes(stream, ["cpu_pct"], f"{out}/data", f"{out}/checkpoint").awaitTermination()
    series_so_far = pipeline.read_minutes(spark, f"{out}/data", ["cpu_pct"])
    return naive(series_so_far.withColumnRenamed("minute", "ts"), "machine", "samples", "avg_cpu_pct", "max_cpu_pct")


@query(
    f"""{HOST}, d AS (
      SELECT sample_id, machine, bytes_read - lag(bytes_read) OVER (PARTITION BY machine ORDER BY ts, sample_id) AS dr
      FROM host)
    SELECT sample_id, machine, dr::DOUBLE / 3 AS read_bps FROM d"""
)
def stream_counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = host_stream(spark, sf_dir, untimed=True).select("machine", "ts", "sample_id", "bytes_read")
    out, order = work_dir(spark, "stream"), ["ts", "sample_id"]
    pipeline.write_counter_rates(
        stream, {"read_bps": "bytes_read"}, f"{out}/data", f"{out}/checkpoint", order=order, interval=3.0
    ).awaitTermination()
    return pipeline.read_counter_rates(spark, f"{out}/data", order=order).select("sample_id", "machine", "read_bps")


@query(
    f"""{HOST}, numbered AS (SELECT *, row_number() OVER (PARTITION BY machine ORDER BY ts, sample_id) AS n FROM host)
    SELECT sample_id, machine, n, last_value(CASE WHEN (n = 1 OR n % 6 = 0) AND k % 3 <> 0 THEN ping_ms END IGNORE NULLS)
    OVER (PARTITION BY machine ORDER BY n ROWS UNBOUNDED PRECEDING) AS held FROM numbered"""
)
def stream_sample_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ping = F.when(F.col("k") % 3 != 0, F.col("ping_ms")).alias("ping_ms")
    stream = host_stream(spark, sf_dir, untimed=True).select("machine", "ts", "sample_id", ping)
    out = work_dir(spark, "stream")
    pipeline.write_held(
        stream, "ping_ms", f"{out}/data", f"{out}/checkpoint", order=["ts", "sample_id"]
    ).awaitTermination()
    return pipeline.read_held(spark, f"{out}/data").select("sample_id", "machine", "n", "held")


def disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host samples as a stream of four batches: a tenth comes a batch late, a twentieth and those without a time
    in the very last one."""
    path = work_dir(spark, "disordered")
    events = views.table(spark, sf_dir, "events")
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    lot = F.coalesce(F.floor((seconds - first) * 4 / (last - first + 1)), F.lit(3))
    late = F.when(F.col("event_id") % 20 == 7, 3).when(F.col("event_id") % 10 == 3, F.least(lot + 1, F.lit(3))).otherwise(lot)
    staged = events.withColumn("lot", late.cast("int")).repartition(4, "lot")
    staged.write.partitionBy("lot").parquet(f"{path}/lots")
    for n in range(4):  # copied in order of arrival
        part = spark.read.schema(views.EVENT_SCHEMA).parquet(f"{path}/lots/lot={n}").coalesce(1)
        part.write.mode("append").parquet(f"{path}/arrivals")
    stream = pipeline.stream_parquet(spark, f"{path}/arrivals", views.EVENT_SCHEMA, files_per_trigger=1)
    return views.host_columns(stream).withColumn("ts", F.col("ts").cast("timestamp"))


RATE_SQL = f"""{HOST}, d AS (
      SELECT sample_id, machine, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS us, bytes_read - lag(bytes_read) OVER w AS dr
      FROM host WINDOW w AS (PARTITION BY machine ORDER BY ts, sample_id))
    SELECT sample_id, machine, dr::DOUBLE / nullif(us / 1e6::DOUBLE, 0) AS read_bps FROM d"""


def _rated(spark: SparkSession, sf_dir: str, delay: str) -> DataFrame:
    stream = disordered(spark, sf_dir).select("machine", "ts", "sample_id", "bytes_read")
    out, order = work_dir(spark, "stream"), ["ts", "sample_id"]
    pipeline.write_counter_rates(
        stream, {"read_bps": "bytes_read"}, f"{out}/data", f"{out}/checkpoint", order=order, delay=delay
    ).awaitTermination()
    return pipeline.read_counter_rates(spark, f"{out}/data").select("sample_id", "machine", "read_bps")


@query(RATE_SQL)
def stream_rate_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late samples within the delay: placed in the state, their neighbours corrected."""
    return _rated(spark, sf_dir, "40 days")


@query(RATE_SQL)
def stream_rate_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late samples from before the state, which a delay of ten minutes makes of nearly all: rated when read."""
    return _rated(spark, sf_dir, pipeline.DEFAULT_DELAY)


@query(
    f"""{HOST}, numbered AS (SELECT *, row_number() OVER (PARTITION BY machine ORDER BY ts, sample_id) AS n FROM host)
    SELECT sample_id, machine, n, last_value(CASE WHEN (n = 1 OR n % 6 = 0) AND k % 3 <> 0 THEN ping_ms END IGNORE NULLS)
    OVER (PARTITION BY machine ORDER BY n ROWS UNBOUNDED PRECEDING) AS held FROM numbered"""
)
def stream_hold_disordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    ping = F.when(F.col("k") % 3 != 0, F.col("ping_ms")).alias("ping_ms")
    stream = disordered(spark, sf_dir).select("machine", "ts", "sample_id", ping)
    out = work_dir(spark, "stream")
    pipeline.write_held(
        stream, "ping_ms", f"{out}/data", f"{out}/checkpoint", order=["ts", "sample_id"], delay="9 days"
    ).awaitTermination()
    return pipeline.read_held(spark, f"{out}/data").select("sample_id", "machine", "n", "held")


@query(
    f"""{HOST}, numbered AS (SELECT *, row_number() OVER (PARTITION BY machine ORDER BY ts, sample_id) AS n FROM host)
    SELECT sample_id, machine, (n - 1) // 60 AS batch FROM numbered"""
)
def stream_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploads of 60 samples of a machine from triggers of two files, and what the stream still keeps of each machine."""
    stream = pipeline.stream_parquet(spark, staged_events(spark, sf_dir, untimed=True), views.EVENT_SCHEMA, files_per_trigger=2)
    samples = views.host_columns(stream).select("machine", F.col("ts").cast("timestamp").alias("ts"), "sample_id")
    out = work_dir(spark, "stream")
    pipeline.write_uploads(
        samples, f"{out}/data", f"{out}/checkpoint", order=["ts", "sample_id"], timeout="1 day"
    ).awaitTermination()
    columns = ["sample_id", "machine", "batch"]
    flushed = spark.read.schema("machine bigint, sample_id bigint, batch bigint").parquet(f"{out}/data").select(*columns)
    return flushed.unionByName(pipeline.waiting_samples(spark, f"{out}/checkpoint", samples.schema).select(*columns))
