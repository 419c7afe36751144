"""Value-level functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane.functions import calendar, scalars
from hostvane.plans import views
from hostvane.plans.registry import query
from hostvane.sources import landing

HOST = f"WITH {views.HOST_SQL}"
LINES = f"WITH {views.LINES_SQL}"


@query(
    f"""{HOST} SELECT format('{{:012x}}', machine) AS machine, 'u' || machine AS "user", ts, cpu_pct,
    freq_cur_mhz, freq_min_mhz, freq_max_mhz, mem_total_bytes, mem_free_bytes,
    100 - mem_free_bytes::DOUBLE / mem_total_bytes * 100 AS ram_used_pct,
    trunc(mem_free_bytes::DOUBLE / mem_total_bytes * 100) AS ram_free_pct, disk_used_pct,
    bytes_read AS read_bps, bytes_written AS write_bps FROM host"""
)
def canonical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = views.hosts(spark, sf_dir)
    simulated = host.select(
        scalars.mac_text(F.col("machine")).alias("macAdress"),
        F.concat(F.lit("u"), F.col("machine").cast("string")).alias("usuario"),
        F.col("cpu_pct").alias("porcentagem_uso_da_cpu"),
        F.col("freq_cur_mhz").cast("int").alias("frequencia_atual"),
        F.col("freq_min_mhz").cast("int").alias("frequencia_min"),
        F.col("freq_max_mhz").cast("int").alias("frequencia_max"),
        F.col("disk_used_pct").alias("porcentagem_uso_do_disco"),
        F.col("bytes_read").alias("read_rate_Bps"),
        F.col("bytes_written").alias("write_rate_Bps"),
        scalars.free_percent(F.col("mem_free_bytes"), F.col("mem_total_bytes")).alias("memoria_percentual"),
        F.col("mem_total_bytes").alias("memoria_total"),
        F.col("mem_free_bytes").alias("memoria_livre"),
        F.lit("[]").alias("processos"),
        F.col("ts").alias("data"),
    )
    names = ["machine", "user", "cpu_pct", "freq_cur_mhz", "freq_min_mhz", "freq_max_mhz", "mem_total_bytes"]
    names += ["mem_free_bytes", "ram_used_pct", "ram_free_pct", "disk_used_pct", "read_bps", "write_bps"]
    return landing.canonical_simulated(simulated).select(F.col("ts").cast("timestamp_ntz").alias("ts"), *names)


@query(
    f"""{HOST} SELECT sample_id, CASE WHEN k % 3 = 2 THEN NULL ELSE ts END AS parsed FROM host"""
)
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    spelling = (
        F.when(F.col("k") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(F.col("k") % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .otherwise("sem data")
    )
    return views.hosts(spark, sf_dir).select(
        "sample_id", scalars.parse_timestamp(spelling).cast("timestamp_ntz").alias("parsed")
    )


@query(
    f"""{LINES} SELECT sample, line, pid, rss, rss::DOUBLE / 1073741824 AS gib, rss // 1073741824 AS whole_gib,
    rss::DOUBLE / 1048576 AS mib, round(rss::DOUBLE / 1048576, 2) AS mib_2 FROM lines"""
)
def bytes_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rss = F.col("rss")
    return views.process_lines(spark, sf_dir).select(
        *["sample", "line", "pid", "rss"],
        scalars.bytes_to_gib(rss).alias("gib"),
        scalars.whole_gib(rss).alias("whole_gib"),
        scalars.bytes_to_mib(rss).alias("mib"),
        scalars.bytes_to_mib(rss, 2).alias("mib_2"),
    )


@query(
    f"""{HOST} SELECT sample_id, CASE WHEN k % 7 = 0 THEN 0.0::DOUBLE ELSE ping_ms::DOUBLE / (k % 7) * 100 END AS used,
    CASE WHEN k % 7 <> 0 THEN trunc(ping_ms::DOUBLE / (k % 7) * 100)::BIGINT END AS free FROM host"""
)
def safe_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, total = F.col("ping_ms"), F.col("k") % 7
    return views.hosts(spark, sf_dir).select(
        "sample_id",
        scalars.used_percent(part, total).alias("used"),
        scalars.free_percent(part, total).alias("free"),
    )


@query(f"{HOST} SELECT sample_id, least(88.0::DOUBLE, greatest(45.0::DOUBLE, disk_used_pct)) AS disk FROM host")
def clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.hosts(spark, sf_dir).select(
        "sample_id", scalars.clamp(F.col("disk_used_pct"), 45.0, 88.0).alias("disk")
    )


@query("SELECT c_custkey, trunc(c_acctbal)::BIGINT AS whole FROM customer")
def truncate_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey", scalars.truncate(F.col("c_acctbal")).alias("whole")
    )


@query(
    """SELECT event_id, regexp_replace(format('{:012x}', event_id * 1633122123 + user_id),
    '(..)(..)(..)(..)(..)(..)', '\\1:\\2:\\3:\\4:\\5:\\6') AS mac FROM events"""
)
def mac_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id") * 1633122123 + F.col("user_id")
    return views.table(spark, sf_dir, "events").select("event_id", scalars.mac_text(number).alias("mac"))


@query("SELECT event_id, format('{:012x}', event_id * 1633122123 + user_id) AS machine FROM events")
def machine_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id") * 1633122123 + F.col("user_id")
    return views.table(spark, sf_dir, "events").select(
        "event_id", scalars.machine_id(scalars.mac_text(number)).alias("machine")
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name WHEN c_custkey % 4 = 1 THEN c_mktsegment
    WHEN c_custkey % 4 = 2 THEN 'nation-' || c_nationkey ELSE 'desconhecido' END AS usuario FROM customer"""
)
def user_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("c_custkey") % 4
    login = F.when(kind == 0, F.col("c_name"))
    first = F.when(kind <= 1, F.col("c_mktsegment")).when(kind == 2, "")
    second = F.when(kind == 2, F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string"))).otherwise("")
    return views.table(spark, sf_dir, "customer").select(
        "c_custkey", scalars.first_user(login, first, second).alias("usuario")
    )


@query(
    f"""{HOST} SELECT sample_id, coalesce(round(CASE WHEN k % 5 <> 0 THEN freq_cur_mhz / 7 END, 2), 0) AS freq,
    coalesce(CASE WHEN k % 3 <> 0 THEN bytes_read END, 0) AS rate FROM host"""
)
def zero_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = F.when(F.col("k") % 5 != 0, F.col("freq_cur_mhz") / 7)
    rate = F.when(F.col("k") % 3 != 0, F.col("bytes_read"))
    return views.hosts(spark, sf_dir).select(
        "sample_id", scalars.round_or_zero(freq).alias("freq"), scalars.zero_if_missing(rate).alias("rate")
    )


@query(
    """SELECT event_id, CASE WHEN user_id % 4 = 3 THEN 0 ELSE trunc(value)::INTEGER END AS ping_ms FROM events"""
)
def parse_ping(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, kind = F.col("value").cast("string"), F.col("user_id") % 4
    text = (
        F.when(kind == 0, F.concat(F.lit("PING\nResposta: bytes=32 Tempo="), value, F.lit("ms TTL=118")))
        .when(kind == 1, F.concat(F.lit("64 bytes: ttl=118 time="), value, F.lit(" ms\nrtt time=9 ms")))
        .when(kind == 2, F.concat(F.lit("a\nb time= "), value, F.lit("ms\n")))
        .otherwise("Request timed out")
    )
    return views.table(spark, sf_dir, "events").select("event_id", scalars.ping_millis(text).alias("ping_ms"))


@query(
    """SELECT event_id, strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia,
    strftime(ts, '%Y-%m-%dT%H-%M-%S') AS upload,
    day(ts) || '-' || month(ts) || '-' || year(ts) || '-' || hour(ts) || '-' || minute(ts) AS arquivo FROM events"""
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        *[column.alias(name) for name, column in scalars.date_parts(F.col("ts")).items()],
        scalars.upload_stamp(F.col("ts")).alias("upload"),
        scalars.file_stamp(F.col("ts")).alias("arquivo"),
    )


@query(
    """SELECT event_id, value::VARCHAR AS texto, round(value::DECIMAL(18, 2), 1)::DECIMAL(18, 1)::VARCHAR AS curto
    FROM events"""
)
def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        scalars.number_text(F.col("value")).alias("texto"),
        scalars.fixed_text(F.col("value")).alias("curto"),
    )


@query(
    """SELECT event_id, CASE WHEN hour(ts) < 6 THEN 'MADRUGADA' WHEN hour(ts) < 12 THEN 'MANHA'
    WHEN hour(ts) < 18 THEN 'TARDE' ELSE 'NOITE' END AS periodo FROM events"""
)
def day_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", calendar.day_part(F.col("ts")).alias("periodo")
    )


@query(f"SELECT event_id, {views.load_factor_sql('ts')} AS factor FROM events")
def load_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", calendar.load_factor(F.col("ts")).alias("factor")
    )


@query(
    f"""WITH f AS (SELECT event_id, {views.load_factor_sql('ts')} AS factor FROM events)
    SELECT event_id, greatest(1, trunc(26 * factor)::INTEGER) AS expected, trunc(4 + 16 * factor)::INTEGER AS live,
    CASE WHEN factor >= 0.75 THEN 1.15::DOUBLE ELSE 0.9::DOUBLE END AS multiplier FROM f"""
)
def expected_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    factor = calendar.load_factor(F.col("ts"))
    return views.table(spark, sf_dir, "events").select(
        "event_id",
        calendar.expected_services(factor).alias("expected"),
        calendar.live_population(factor).alias("live"),
        calendar.load_multiplier(factor).alias("multiplier"),
    )
