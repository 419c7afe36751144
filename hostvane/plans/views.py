"""Telemetry views over the given tables, and the same views as SQL text for the comparison queries.

Events are read as host samples (a user is a machine), order lines as process rows (an order is a sample), nations as
limits and services, suppliers as service profiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane.functions import scalars

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)

#: About 0.64 GiB, so that the free memory of a sample runs from 0 to 64 GiB.
FREE_STEP = 687_194_767


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def host_columns(events: DataFrame) -> DataFrame:
    """Host samples from event rows; works on a batch and on a stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.withColumn("k", k).select(
        F.col("user_id").alias("machine"),
        "ts",
        F.col("event_id").alias("sample_id"),
        "event_type",
        "k",
        F.least("value", F.lit(100.0)).alias("cpu_pct"),
        (1200 + 30 * F.col("k")).cast("double").alias("freq_cur_mhz"),
        F.lit(1500.0).alias("freq_min_mhz"),
        F.lit(4200.0).alias("freq_max_mhz"),
        F.lit(100 * FREE_STEP).alias("mem_total_bytes"),
        (F.col("k").cast("bigint") * FREE_STEP).alias("mem_free_bytes"),
        (100.0 - F.col("k")).alias("ram_used_pct"),
        F.col("k").cast("double").alias("swap_used_pct"),
        F.col("k").cast("double").alias("disk_used_pct"),
        F.col("value").cast("int").alias("ping_ms"),
        (F.col("event_id") * 1000 + F.col("k")).alias("bytes_read"),
        (F.col("event_id") * 500 - F.col("k") * 40).alias("bytes_written"),
    )


def hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_columns(table(spark, sf_dir, "events"))


HOST_SQL = f"""
host AS (
  SELECT user_id AS machine, ts, event_id AS sample_id, event_type, k,
         least(value, 100.0::DOUBLE) AS cpu_pct,
         (1200 + 30 * k)::DOUBLE AS freq_cur_mhz, 1500.0::DOUBLE AS freq_min_mhz, 4200.0::DOUBLE AS freq_max_mhz,
         {100 * FREE_STEP}::BIGINT AS mem_total_bytes, k::BIGINT * {FREE_STEP} AS mem_free_bytes,
         (100.0::DOUBLE - k) AS ram_used_pct, k::DOUBLE AS swap_used_pct, k::DOUBLE AS disk_used_pct,
         trunc(value)::INTEGER AS ping_ms,
         event_id * 1000 + k AS bytes_read, event_id * 500 - k * 40 AS bytes_written
  FROM (SELECT *, json_extract(props, '$.k')::INTEGER AS k FROM events)
)"""


def process_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process rows as far as one order line gives them: no time and no machine."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("sample"),
        F.col("l_partkey").alias("pid"),
        F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("name"),
        F.concat(F.lit("NATION_"), F.pmod("l_partkey", F.lit(30)).cast("string")).alias("service"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("cpu_percent"),
        F.floor(F.col("l_extendedprice") * 10240).alias("rss"),
        (F.floor(F.col("l_extendedprice") * 10240) * 2).alias("vms"),
        (F.col("l_linenumber") * F.lit(1024)).cast("bigint").alias("read_bps"),
        (F.col("l_quantity").cast("bigint") * 2048).alias("write_bps"),
        (F.col("l_tax") * 100).alias("memory_percent"),
        (F.col("l_discount") == 0).alias("idle"),
        F.col("l_returnflag").alias("username"),
        F.col("l_shipdate").alias("started"),
    )


def sample_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sample: machine, time and the CPU the host reported."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("sample"),
        F.col("o_custkey").alias("machine"),
        F.col("o_orderdate").alias("ts"),
        F.pmod(F.floor("o_totalprice"), F.lit(101)).cast("double").alias("cpu_pct"),
    )


def process_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_lines(spark, sf_dir).join(sample_headers(spark, sf_dir).drop("cpu_pct"), "sample")


LINES_SQL = """
lines AS (
  SELECT l_orderkey AS sample, l_partkey AS pid, 'P' || l_suppkey AS name,
         'NATION_' || (l_partkey % 30) AS service, l_linenumber AS line, l_quantity AS cpu_percent,
         floor(l_extendedprice * 10240)::BIGINT AS rss, floor(l_extendedprice * 10240)::BIGINT * 2 AS vms,
         l_linenumber::BIGINT * 1024 AS read_bps, trunc(l_quantity)::BIGINT * 2048 AS write_bps,
         l_tax * 100 AS memory_percent, l_discount = 0 AS idle, l_returnflag AS username, l_shipdate AS started
  FROM lineitem
)"""

HEADERS_SQL = """
headers AS (
  SELECT o_orderkey AS sample, o_custkey AS machine, o_orderdate AS ts,
         (floor(o_totalprice)::BIGINT % 101)::DOUBLE AS cpu_pct
  FROM orders
)"""

PROC_SQL = f"""{LINES_SQL}, {HEADERS_SQL},
proc AS (SELECT l.*, h.machine, h.ts FROM lines l JOIN headers h USING (sample))"""


def limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits per group of machines and component. Machines fall into 27 groups, two of which have no limits."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("machine_group"))
    base = F.map_from_arrays(
        F.array(F.lit("cpu"), F.lit("ram"), F.lit("disk")), F.array(F.lit(60.0), F.lit(50.0), F.lit(70.0))
    )
    return nation.select("machine_group", F.explode(base).alias("component", "base")).select(
        "machine_group", "component", (F.col("base") + F.col("machine_group")).alias("limit")
    )


def machine_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits by the hexadecimal id of a machine; few machines have any."""
    limits_by_group = limits(spark, sf_dir)
    machine = scalars.machine_id(scalars.mac_text(F.col("machine_group").cast("bigint")))
    return limits_by_group.select(machine.alias("machine"), "component", "limit")


def machine_group() -> Column:
    return F.pmod(F.col("machine"), F.lit(27)).cast("int")


LIMITS_SQL = """
limits AS (
  SELECT n_nationkey AS machine_group, 60.0::DOUBLE + n_nationkey AS limit_cpu,
         50.0::DOUBLE + n_nationkey AS limit_ram, 70.0::DOUBLE + n_nationkey AS limit_disk
  FROM nation
),
limited AS (SELECT host.*, limit_cpu, limit_ram, limit_disk
            FROM host LEFT JOIN limits ON machine % 27 = machine_group)"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("name"),
        (F.pmod("s_suppkey", F.lit(60)) + 1).cast("int").alias("cpu"),
        (F.lit(64) + F.pmod("s_suppkey", F.lit(200))).cast("int").alias("mem_mb"),
        (F.pmod("s_suppkey", F.lit(50)) * 2).cast("int").alias("disk_kbps"),
    )


PROFILES_SQL = """
profiles AS (
  SELECT 'P' || s_suppkey AS name, (s_suppkey % 60 + 1)::INTEGER AS cpu, (64 + s_suppkey % 200)::INTEGER AS mem_mb,
         (s_suppkey % 50 * 2)::INTEGER AS disk_kbps
  FROM supplier
)"""


def services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service catalogue, in start order."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("service"), F.col("n_nationkey").alias("position")
    )


def load_factor_sql(ts: str) -> str:
    return f"""(CASE WHEN isodow({ts}) = 7 THEN 0.15::DOUBLE WHEN isodow({ts}) = 6 THEN 0.5::DOUBLE
      WHEN hour({ts}) BETWEEN 6 AND 9 OR hour({ts}) BETWEEN 16 AND 19 THEN 1.0::DOUBLE
      WHEN hour({ts}) BETWEEN 10 AND 15 THEN 0.75::DOUBLE ELSE 0.3::DOUBLE END)"""


def target_sql(ts: str) -> str:
    return f"greatest(1, trunc({load_factor_sql(ts)} * 26)::INTEGER)"
