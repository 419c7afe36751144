"""Classification of host samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane.functions import scalars, status
from hostvane.operators import series
from hostvane.plans import treatment, views
from hostvane.plans.registry import query

HOST = f"WITH {views.HOST_SQL}"
LIMITED = f"WITH {views.HOST_SQL}, {views.LIMITS_SQL}"


def limit_case(value: str, limit: str) -> str:
    return (
        f"CASE WHEN {value} >= {limit} THEN 'CRITICO' WHEN {value} >= {limit} - 15 THEN 'ATENCAO' "
        f"WHEN {value} < {limit} - 15 THEN 'NORMAL' END"
    )


SWAP_CASE = (
    "CASE WHEN swap_used_pct <= 5 THEN 'NORMAL' WHEN swap_used_pct <= 20 THEN 'ATENCAO' "
    "WHEN swap_used_pct <= 50 THEN 'ALERTA' ELSE 'CRITICO' END"
)
PING_CASE = "CASE WHEN ping_ms <= 50 THEN 'BAIXA' WHEN ping_ms <= 200 THEN 'MODERADA' ELSE 'ALTA' END"
DEGRADED_CASE = (
    "CASE WHEN freq_cur_mhz <= freq_max_mhz * 0.5::DOUBLE AND cpu_pct > 50 THEN 'DEGRADADA' ELSE 'SEM_INDICIOS' END"
)
TREATED = f"""{LIMITED},
treated AS (
  SELECT *, {DEGRADED_CASE} AS degradacao, {limit_case('cpu_pct', 'limit_cpu')} AS status_cpu,
         {limit_case('ram_used_pct', 'limit_ram')} AS status_ram, {SWAP_CASE} AS status_swap,
         {limit_case('disk_used_pct', 'limit_disk')} AS status_disco, {PING_CASE} AS status_ping
  FROM limited
)"""


def limited_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = views.hosts(spark, sf_dir).withColumn("machine_group", views.machine_group())
    return treatment.attach_limits(samples, views.limits(spark, sf_dir), "machine_group")


def treated_hosts(spark: SparkSession, sf_dir: str, wording: bool = False) -> DataFrame:
    samples = views.hosts(spark, sf_dir).withColumn("machine_group", views.machine_group())
    return treatment.treat(samples, views.limits(spark, sf_dir), key="machine_group", wording=wording)


@query(f"{LIMITED} SELECT sample_id, machine, limit_cpu, limit_ram, limit_disk FROM limited")
def limit_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limited_hosts(spark, sf_dir).select("sample_id", "machine", "limit_cpu", "limit_ram", "limit_disk")


@query(
    f"""{LIMITED} SELECT sample_id, {limit_case('cpu_pct', 'limit_cpu')} AS status_cpu,
    {limit_case('ram_used_pct', 'limit_ram')} AS status_ram,
    {limit_case('disk_used_pct', 'limit_disk')} AS status_disco FROM limited"""
)
def limit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limited_hosts(spark, sf_dir).select(
        "sample_id",
        status.limit_status(F.col("cpu_pct"), F.col("limit_cpu")).alias("status_cpu"),
        status.limit_status(F.col("ram_used_pct"), F.col("limit_ram")).alias("status_ram"),
        status.limit_status(F.col("disk_used_pct"), F.col("limit_disk")).alias("status_disco"),
    )


@query(f"{HOST} SELECT sample_id, {SWAP_CASE} AS status_swap FROM host")
def swap_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.hosts(spark, sf_dir).select(
        "sample_id", status.swap_status(F.col("swap_used_pct")).alias("status_swap")
    )


@query(
    f"""{HOST}, coded AS (SELECT sample_id, {PING_CASE} AS status_ping FROM host)
    SELECT sample_id, status_ping, CASE status_ping WHEN 'BAIXA' THEN 'Baixa latência'
      WHEN 'MODERADA' THEN 'Latência moderada (Alerta)' ELSE 'Latêcia alta (Critico)' END AS texto FROM coded"""
)
def ping_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = views.hosts(spark, sf_dir).select(
        "sample_id", status.ping_status(F.col("ping_ms")).alias("status_ping")
    )
    return coded.withColumn("texto", status.label_text(F.col("status_ping"), status.PING_TEXT))


@query(
    f"""{HOST} SELECT sample_id, CASE WHEN cpu_pct >= 80 THEN 'RED' WHEN cpu_pct >= 60 THEN 'YELLOW'
    ELSE 'GREEN' END AS severity FROM host"""
)
def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.hosts(spark, sf_dir).select("sample_id", status.severity(F.col("cpu_pct")).alias("severity"))


@query(f"{HOST} SELECT sample_id, {DEGRADED_CASE} AS degradacao FROM host")
def cpu_degradation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.hosts(spark, sf_dir).select(
        "sample_id",
        status.cpu_degradation(F.col("cpu_pct"), F.col("freq_cur_mhz"), F.col("freq_max_mhz")).alias("degradacao"),
    )


@query(f"{HOST} SELECT sample_id, cpu_pct > 50 AND freq_cur_mhz < freq_max_mhz * 0.6::DOUBLE AS flag FROM host")
def cpu_bottleneck(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.hosts(spark, sf_dir).select(
        "sample_id",
        status.cpu_bottleneck(F.col("cpu_pct"), F.col("freq_cur_mhz"), F.col("freq_max_mhz")).alias("flag"),
    )


@query(
    f"""{HOST} SELECT sample_id, mem_free_bytes::DOUBLE / 1073741824 AS free_gib,
    mem_free_bytes::DOUBLE / 1073741824 < 48.15::DOUBLE AS flag FROM host"""
)
def low_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    free = scalars.bytes_to_gib(F.col("mem_free_bytes"))
    return views.hosts(spark, sf_dir).select(
        "sample_id", free.alias("free_gib"), status.low_memory(free).alias("flag")
    )


@query(f"{HOST} SELECT sample_id, freq_cur_mhz < freq_min_mhz AS flag FROM host")
def below_min_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.hosts(spark, sf_dir).select(
        "sample_id", status.below_min_freq(F.col("freq_cur_mhz"), F.col("freq_min_mhz")).alias("flag")
    )


@query(
    f"""{HOST} SELECT sample_id, machine, cpu_pct FROM host
    WHERE cpu_pct > 50 AND freq_cur_mhz < freq_max_mhz * 0.6::DOUBLE"""
)
def flagged_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = status.cpu_bottleneck(F.col("cpu_pct"), F.col("freq_cur_mhz"), F.col("freq_max_mhz"))
    flagged = series.keep_flagged(views.hosts(spark, sf_dir).withColumn("flag", flag), "flag")
    return flagged.select("sample_id", "machine", "cpu_pct")


@query(
    f"""{TREATED} SELECT sample_id, machine, ts, cpu_pct, ram_used_pct, swap_used_pct, disk_used_pct, ping_ms,
    degradacao, status_cpu, status_ram, status_swap, status_disco, status_ping FROM treated"""
)
def treated_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treated_hosts(spark, sf_dir).select(
        *["sample_id", "machine", "ts", "cpu_pct", "ram_used_pct", "swap_used_pct", "disk_used_pct", "ping_ms"],
        *["degradacao", "status_cpu", "status_ram", "status_swap", "status_disco", "status_ping"],
    )


@query(
    f"""{TREATED}, long AS (
      SELECT machine, 'status_cpu' AS component, status_cpu AS status FROM treated
      UNION ALL SELECT machine, 'status_ram', status_ram FROM treated
      UNION ALL SELECT machine, 'status_swap', status_swap FROM treated
      UNION ALL SELECT machine, 'status_disco', status_disco FROM treated
      UNION ALL SELECT machine, 'status_ping', status_ping FROM treated
      UNION ALL SELECT machine, 'degradacao', degradacao FROM treated)
    SELECT machine, component, status, count(*) AS samples FROM long WHERE status IS NOT NULL
    GROUP BY machine, component, status"""
)
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatment.status_counts(treated_hosts(spark, sf_dir))


@query(
    f"""{TREATED} SELECT machine, 'status_cpu' AS component,
    CASE status_cpu WHEN 'CRITICO' THEN 'CRÍTICO' WHEN 'ATENCAO' THEN 'ATENÇÃO' ELSE 'Normal' END AS status,
    count(*) AS samples FROM treated WHERE status_cpu IS NOT NULL GROUP BY ALL"""
)
def status_counts_worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in the wording that users see."""
    return treatment.status_counts(treated_hosts(spark, sf_dir, wording=True), statuses=["status_cpu"])


def _light(value: str) -> str:
    return f"CASE WHEN {value} >= 80 THEN 'RED' WHEN {value} >= 60 THEN 'YELLOW' ELSE 'GREEN' END"


def _text(value: str) -> str:
    return f"round({value}::DECIMAL(18, 2), 1)::DECIMAL(18, 1)::VARCHAR"


@query(
    f"""{HOST} SELECT machine, ts, sample_id, {_text('cpu_pct')} AS cpu_text, {_text('ram_used_pct')} AS ram_text,
    {_text('disk_used_pct')} AS disk_text, {_light('cpu_pct')} AS cpu_severity, {_light('ram_used_pct')} AS ram_severity,
    {_light('disk_used_pct')} AS disk_severity, freq_cur_mhz, mem_free_bytes // 1073741824 AS mem_free_gib, ping_ms
    FROM host QUALIFY row_number() OVER (PARTITION BY machine ORDER BY ts DESC, sample_id DESC) = 1"""
)
def machine_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treatment.machine_overview(views.hosts(spark, sf_dir), order=["ts", "sample_id"])
