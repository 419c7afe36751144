"""Process lists and process rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hostvane import work_dir
from hostvane.functions import calendar, process_text, scalars
from hostvane.operators import coverage, processes, sketches
from hostvane.plans import analysis, views
from hostvane.plans.registry import query

LINES = f"WITH {views.LINES_SQL}"
PROC = f"WITH {views.PROC_SQL}"
SAMPLE_TOTAL = 16 * scalars.GIB
FIELDS = ["pid", "name", "username", "cpu_percent", "rss", "vms", "line"]
FULL_ORDER = ["started", "pid", "name", "line", "cpu_percent", "rss", "memory_percent", "idle", "username"]


def _literal(p: Column) -> Column:
    """One process in Python spelling, with None, True, apostrophes and misleading words inside values."""
    user = (
        F.when(p["username"] == "R", "None")
        .when(p["username"] == "A", "'NoneSuch: None, True'")
        .otherwise('''"it's"''')
    )
    parts = [
        F.lit("{'pid': "), p["pid"].cast("string"),
        F.lit(", 'name': '"), p["name"],
        F.lit("', 'username': "), user,
        F.lit(", 'cpu_percent': "), p["cpu_percent"].cast("string"),
        F.lit(", 'memory_info': {'rss': "), p["rss"].cast("string"),
        F.lit(", 'vms': "), p["vms"].cast("string"),
        F.lit("}}"),
    ]
    return F.concat(*parts)


def _agent_literal(p: Column) -> Column:
    parts = [
        F.lit(r"{'username': 'PC\\user', 'memory_info': pmem(rss="), p["rss"].cast("string"),
        F.lit(", vms="), p["vms"].cast("string"),
        F.lit(r", private=0), 'exe': 'C:\\Program Files (x86)\\"), p["name"],
        F.lit(r".exe', 'cmdline': ['run(a=1)', '--id="), p["pid"].cast("string"),
        F.lit("'], 'cpu_percent': "), p["cpu_percent"].cast("string"),
        F.lit(", 'status': 'running', 'num_threads': "), p["line"].cast("string"),
        F.lit(", 'pid': "), p["pid"].cast("string"),
        F.lit(", 'name': '"), p["name"],
        F.lit("', 'cpu_times': pcputimes(user="), p["cpu_percent"].cast("string"),
        F.lit(", system=1.5), 'create_time': None, 'memory_percent': 3.5}"),
    ]
    return F.concat(*parts)


def sample_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process lists as arrays, one per sample."""
    return processes.build_lists(views.process_lines(spark, sf_dir), ["sample"], FIELDS, ["pid", "name", "line"])


def sample_texts(spark: SparkSession, sf_dir: str, literal=_literal) -> DataFrame:
    """Samples with their process list as agents write it."""
    text = F.concat(F.lit("["), F.array_join(F.transform("processes", literal), ", "), F.lit("]"))
    return sample_lists(spark, sf_dir).select("sample", text.alias("processos"))


def with_empty_samples(texts: DataFrame, headers: DataFrame) -> DataFrame:
    """Add the samples that have no process, whose list is ``[]``."""
    return headers.join(texts, "sample", "left").withColumn("processos", F.coalesce("processos", F.lit("[]")))


USER_CASE = "CASE username WHEN 'A' THEN 'NoneSuch: None, True' WHEN 'N' THEN 'it''s' END"


@query(
    f"""{PROC} SELECT sample, ts, pid, name, {USER_CASE} AS username, cpu_percent, rss AS memory_info_rss,
    vms AS memory_info_vms FROM proc"""
)
def parse_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = sample_texts(spark, sf_dir).join(views.sample_headers(spark, sf_dir).select("sample", "ts"), "sample")
    parsed = stamped.select("sample", "ts", process_text.parse_list(F.col("processos")).alias("lista"))
    return processes.flatten_struct(processes.explode_list(parsed, "lista", ["sample", "ts"]), "memory_info")


@query(
    f"""{PROC} SELECT ts AS data, pid, name, {USER_CASE} AS username, cpu_percent, rss AS memory_info_rss,
    vms AS memory_info_vms FROM proc"""
)
def process_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = views.sample_headers(spark, sf_dir).select("sample", F.col("ts").alias("data"))
    return analysis.process_rows(sample_texts(spark, sf_dir).join(headers, "sample"))


@query(f"{LINES} SELECT sample, pid, replace(name, 'P', 'nullP') AS name, cpu_percent FROM lines")
def parse_processes_plain_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    def plain(p: Column) -> Column:
        return F.concat(
            F.lit("{'pid': "), p["pid"].cast("string"), F.lit(", 'name': 'None"), p["name"],
            F.lit("', 'cpu_percent': "), p["cpu_percent"].cast("string"), F.lit("}"),
        )

    schema = "array<struct<pid:bigint,name:string,cpu_percent:double>>"
    parsed = sample_texts(spark, sf_dir, plain).select(
        "sample", process_text.parse_list(F.col("processos"), schema, safe=False).alias("lista")
    )
    return processes.explode_list(parsed, "lista", ["sample"])


@query(
    f"""{LINES} SELECT sample, pid, name, 'PC\\user' AS username, 'C:\\Program Files (x86)\\' || name || '.exe' AS exe,
    '--id=' || pid AS argument, line AS num_threads, rss, vms, cpu_percent AS cpu_user, 3.5::DOUBLE AS memory_percent
    FROM lines"""
)
def agent_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = sample_texts(spark, sf_dir, _agent_literal).select(
        "sample", process_text.parse_agent_list(F.col("processos")).alias("lista")
    )
    return processes.explode_list(parsed, "lista", ["sample"]).select(
        *["sample", "pid", "name", "username", "exe"],
        F.col("cmdline")[1].alias("argument"),
        "num_threads",
        F.col("memory_info.rss").alias("rss"),
        F.col("memory_info.vms").alias("vms"),
        F.col("cpu_times.user").alias("cpu_user"),
        "memory_percent",
    )


@query(
    """SELECT o_orderkey AS sample, count(l_orderkey)::INTEGER AS qtd_processos
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def process_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = process_text.parse_list(F.col("processos"), "array<struct<pid:bigint>>")
    texts = with_empty_samples(sample_texts(spark, sf_dir), views.sample_headers(spark, sf_dir).select("sample"))
    return texts.select("sample", process_text.list_size(parsed).alias("qtd_processos"))


@query(f"{LINES} SELECT sample, pid, name, username, cpu_percent, rss, vms, line FROM lines")
def process_lists_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = sample_lists(spark, sf_dir).select("sample", process_text.list_to_text(F.col("processes")).alias("texto"))
    schema = (
        "array<struct<pid:bigint,name:string,username:string,cpu_percent:double,rss:bigint,vms:bigint,line:int>>"
    )
    parsed = text.select("sample", process_text.parse_list(F.col("texto"), schema).alias("lista"))
    return processes.explode_list(parsed, "lista", ["sample"])


@query(
    f"""{LINES} SELECT sample, count(*)::INTEGER AS n_processes, sum(cpu_percent) AS sum_cpu, sum(rss)::BIGINT AS sum_rss,
    string_agg(DISTINCT name, ',' ORDER BY name) AS names FROM lines GROUP BY sample"""
)
def list_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = sample_texts(spark, sf_dir).select(
        "sample", process_text.parse_list(F.col("processos")).alias("processes")
    )
    totals = processes.list_totals(nested, "processes")
    return totals.select(
        "sample", "n_processes", "sum_cpu", "sum_rss", F.array_join("active_names", ",").alias("names")
    )


@query(f"{LINES} SELECT sample, pid, name, memory_percent FROM lines WHERE memory_percent >= 2.5")
def heavy_by_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = processes.build_lists(
        views.process_lines(spark, sf_dir), ["sample"], ["pid", "name", "memory_percent"], ["pid", "name"]
    )
    kept = lists.select("sample", processes.heavy_in_list(F.col("processes")).alias("heavy"))
    return processes.explode_list(kept, "heavy", ["sample"])


@query(
    f"""{LINES} SELECT sample, pid, name, round(rss::DOUBLE / 1048576, 2) AS memoria_mb,
    (rss::DOUBLE / 1048576) / ({SAMPLE_TOTAL}::DOUBLE / 1048576) * 100 AS porcentagem_ram
    FROM lines WHERE rss > {SAMPLE_TOTAL}::DOUBLE * 0.05::DOUBLE"""
)
def heavy_by_rss(spark: SparkSession, sf_dir: str) -> DataFrame:
    heavy = processes.heavy_by_rss(views.process_lines(spark, sf_dir), F.lit(SAMPLE_TOTAL))
    return heavy.select("sample", "pid", "name", "memoria_mb", "porcentagem_ram")


@query(
    f"""{LINES} SELECT sample, count(*) AS n_processes, sum(cpu_percent) AS sum_cpu, sum(rss)::BIGINT AS sum_rss,
    sum(read_bps)::BIGINT AS sum_read_bps, sum(write_bps)::BIGINT AS sum_write_bps FROM lines GROUP BY sample"""
)
def host_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processes.host_totals(views.process_lines(spark, sf_dir), ["sample"])


@query(
    f"""WITH {views.LINES_SQL}, {views.HEADERS_SQL},
    totals AS (SELECT sample, sum(cpu_percent) AS sum_cpu FROM lines GROUP BY sample)
    SELECT sample, machine, cpu_pct, least(100.0::DOUBLE, coalesce(sum_cpu, 0) / 16) AS cpu_explained,
    cpu_pct - least(100.0::DOUBLE, coalesce(sum_cpu, 0) / 16) AS cpu_unexplained
    FROM headers LEFT JOIN totals USING (sample)"""
)
def cpu_unexplained(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = processes.host_totals(views.process_lines(spark, sf_dir), ["sample"])
    hosts = views.sample_headers(spark, sf_dir).drop("ts")
    return processes.explain_cpu(hosts, totals, ["sample"])


@query(
    f"""WITH {views.LINES_SQL}, {views.HEADERS_SQL},
    totals AS (SELECT sample, sum(rss)::BIGINT AS sum_rss FROM lines GROUP BY sample),
    used AS (SELECT sample, least({62 * scalars.GIB}, {12 * scalars.GIB} + coalesce(sum_rss, 0))::BIGINT AS u
             FROM headers LEFT JOIN totals USING (sample))
    SELECT sample, u AS mem_used_expected, {64 * scalars.GIB} - u AS mem_available_expected FROM used"""
)
def memory_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = processes.host_totals(views.process_lines(spark, sf_dir), ["sample"])
    hosts = views.sample_headers(spark, sf_dir).select("sample")
    return processes.reconcile_memory(hosts, totals, ["sample"], F.lit(64 * scalars.GIB))


GAPS = f"""
gaps AS (
  SELECT sample, machine, coalesce(active, 0) AS active, {views.target_sql('ts')} AS target,
         {views.target_sql('ts')} - coalesce(active, 0) AS gap
  FROM headers LEFT JOIN (SELECT sample, count(*) AS active FROM lines GROUP BY sample) USING (sample)
)"""


@query(f"WITH {views.LINES_SQL}, {views.HEADERS_SQL}, {GAPS} SELECT * FROM gaps")
def service_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = views.sample_headers(spark, sf_dir).select("sample", "machine", "ts")
    return processes.service_gap(hosts, views.process_lines(spark, sf_dir), ["sample"]).drop("ts")


@query(f"{LINES} SELECT sample, service, count(*) AS processes FROM lines GROUP BY sample, service")
def active_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processes.active_names(views.process_lines(spark, sf_dir), ["sample"], "service")


@query(f"{LINES} SELECT sample, count(DISTINCT service) AS n_names FROM lines GROUP BY sample")
def active_set_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processes.active_name_counts(views.process_lines(spark, sf_dir), ["sample"], "service")


@query(
    f"""{PROC}, {views.PROFILES_SQL},
    e AS (SELECT p.*, mem_mb, disk_kbps, greatest(0.1::DOUBLE, least(100.0::DOUBLE, cpu *
          (CASE WHEN {views.load_factor_sql('ts')} >= 0.75 THEN 1.15::DOUBLE ELSE 0.9::DOUBLE END))) AS cpu_expected
          FROM proc p JOIN profiles USING (name))
    SELECT sample, pid, name, cpu_expected, cpu_percent - cpu_expected AS cpu_deviation,
    rss::DOUBLE / 1048576 - mem_mb AS mem_deviation_mib,
    (read_bps + write_bps)::DOUBLE / 1024 - disk_kbps AS disk_deviation_kbps FROM e"""
)
def profile_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = processes.profile_deviation(views.process_rows(spark, sf_dir), views.profiles(spark, sf_dir))
    return compared.select(
        *["sample", "pid", "name", "cpu_expected", "cpu_deviation", "mem_deviation_mib", "disk_deviation_kbps"]
    )


@query(
    f"""WITH {views.LINES_SQL}, {views.HEADERS_SQL} SELECT sample, n_name AS service FROM headers, nation
    WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE l.sample = headers.sample AND l.service = n_name)"""
)
def missing_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processes.missing_services(
        views.sample_headers(spark, sf_dir),
        views.process_lines(spark, sf_dir),
        views.services(spark, sf_dir),
        ["sample"],
        "service",
    )


@query(
    f"""WITH {views.LINES_SQL}, {views.HEADERS_SQL}, {GAPS},
    absent AS (
      SELECT sample, gap, n_name, row_number() OVER (PARTITION BY sample ORDER BY n_nationkey) AS r
      FROM gaps, nation
      WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE l.sample = gaps.sample AND l.service = n_name))
    SELECT sample, n_name AS service FROM absent WHERE r <= gap"""
)
def services_to_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = views.sample_headers(spark, sf_dir).select("sample", "ts")
    lines = views.process_lines(spark, sf_dir)
    gaps = processes.service_gap(hosts, lines, ["sample"])
    return processes.services_to_start(
        gaps, lines, views.services(spark, sf_dir), ["sample"], "position", "service"
    )


@query(
    f"""{LINES} SELECT sample, pid, line, service FROM lines
    WHERE service NOT IN (SELECT n_name FROM nation)"""
)
def unknown_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = processes.unknown_services(
        views.process_lines(spark, sf_dir), views.services(spark, sf_dir), ["service"]
    )
    return unknown.select("sample", "pid", "line", "service")


@query(
    f"""{PROC} SELECT machine, pid, name, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS samples
    FROM proc GROUP BY machine, pid, name"""
)
def lifetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processes.lifetimes(views.process_rows(spark, sf_dir))


@query(
    f"""{PROC} SELECT machine, service AS name, greatest(count(DISTINCT CASE WHEN line < 4 THEN pid END) - 1, 0) AS restarts
    FROM proc GROUP BY machine, service"""
)
def restarts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines from the fourth on have no process id, and some groups consist of such lines alone."""
    rows = views.process_rows(spark, sf_dir).drop("name").withColumnRenamed("service", "name")
    return processes.restarts(rows.withColumn("pid", F.when(F.col("line") < 4, F.col("pid"))))


@query(
    f"""{PROC}, keyed AS (SELECT machine % 40 AS machine, pid % 25 AS pid, ts, idle FROM proc),
    instants AS (SELECT machine, pid, ts, bool_and(idle) AS idle FROM keyed GROUP BY machine, pid, ts),
    numbered AS (
      SELECT *, row_number() OVER w - sum(idle::INTEGER) OVER w AS run FROM instants
      WINDOW w AS (PARTITION BY machine, pid ORDER BY ts ROWS UNBOUNDED PRECEDING))
    SELECT machine, pid, min(ts) AS first_idle, max(ts) AS last_idle, count(*) AS samples
    FROM numbered WHERE idle GROUP BY machine, pid, run HAVING count(*) >= 2"""
)
def hung_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stand for 40 machines and parts for 25 process ids, so that processes are seen again and again."""
    machine, pid = (F.col("machine") % 40).alias("machine"), (F.col("pid") % 25).alias("pid")
    rows = views.process_rows(spark, sf_dir).select(machine, pid, "ts", "idle")
    return processes.hung_processes(rows, F.col("idle"), min_samples=2)


@query(f"{LINES} SELECT DISTINCT sample, NULL::BIGINT AS pid FROM lines WHERE sample % 7 = 0")
def unreadable_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh sample's list is cut off."""
    texts = sample_texts(spark, sf_dir)
    cut = F.expr("substr(processos, 1, length(processos) - 2)")
    texts = texts.withColumn("processos", F.when(F.col("sample") % 7 == 0, cut).otherwise(F.col("processos")))
    parsed = texts.withColumn("lista", process_text.parse_list(F.col("processos")))
    rejected = processes.unreadable_lists(parsed, "processos", "lista")
    return rejected.select("sample", F.lit(None).cast("long").alias("pid"))


CAP_ORDER = ", ".join(FULL_ORDER)


@query(
    f"""{PROC}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY sample ORDER BY {CAP_ORDER}) AS rank FROM proc)
    SELECT sample, pid, name, line, rank FROM ranked WHERE rank <= {views.target_sql('ts')}"""
)
def cap_to_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = calendar.expected_services(calendar.load_factor(F.col("ts")))
    hosts = views.sample_headers(spark, sf_dir).select("sample", "ts")
    kept = processes.cap_to_target(
        views.process_lines(spark, sf_dir), hosts, ["sample"], [F.col(c) for c in FULL_ORDER], target
    )
    return kept.select("sample", "pid", "name", "line", "rank")


def _name_form(names: pd.Series) -> pd.Series:
    """The decomposed Unicode form of a name, for which there is no built-in function."""
    return ("é " + names).str.normalize("NFD")


@query(f"{LINES} SELECT sample, pid, line, 'e' || chr(769) || ' ' || name AS label FROM lines")
def map_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.process_lines(spark, sf_dir).select("sample", "pid", "line", "name")
    return processes.map_cells(lines, "name", _name_form, "label", "string").drop("name")


ABSENT = f"""WITH {views.LINES_SQL}, {views.HEADERS_SQL},
    instants AS (SELECT DISTINCT machine % 40 AS machine, ts FROM headers),
    active AS (SELECT DISTINCT h.machine % 40 AS machine, ts, service FROM lines JOIN headers h USING (sample)),
    grid AS (SELECT i.machine, i.ts, n_name AS service, a.service IS NOT NULL AS running
             FROM instants i CROSS JOIN nation LEFT JOIN active a
             ON a.machine = i.machine AND a.ts = i.ts AND a.service = n_name),
    changed AS (SELECT *, running <> coalesce(lag(running) OVER w, true) AS changes FROM grid
                WINDOW w AS (PARTITION BY machine, service ORDER BY ts))"""


def _service_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stand for 40 machines, so that a machine has many samples."""
    hosts = views.sample_headers(spark, sf_dir).withColumn("machine", F.col("machine") % 40)
    active = views.process_rows(spark, sf_dir).withColumn("machine", F.col("machine") % 40)
    numbered = coverage.numbered_catalogue(views.services(spark, sf_dir))
    return coverage.service_changes(coverage.service_bits(hosts, active, numbered, ["machine"]), numbered, ["machine"])


@query(f"{ABSENT} SELECT machine, ts, service, running FROM changed WHERE changes")
def service_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _service_changes(spark, sf_dir)


@query(
    f"""{ABSENT}, run AS (SELECT *, sum(changes::INTEGER) OVER (PARTITION BY machine, service ORDER BY ts) AS r FROM changed),
    span AS (SELECT machine, service, r, running, min(ts) AS absent_from FROM run GROUP BY machine, service, r, running)
    SELECT machine, service, absent_from, absent_to FROM (
      SELECT *, lead(absent_from) OVER (PARTITION BY machine, service ORDER BY r) AS absent_to FROM span) WHERE NOT running"""
)
def service_absences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.absences(_service_changes(spark, sf_dir), ["machine"])


@query(
    f"""{PROC}, keyed AS (SELECT machine % 40 AS machine, pid % 25 AS pid, name, ts FROM proc),
    cut AS (SELECT *, ts > lag(ts) OVER w + INTERVAL 30 DAY AS apart FROM keyed
            WINDOW w AS (PARTITION BY machine, pid, name ORDER BY ts)),
    numbered AS (SELECT *, 1 + sum(coalesce(apart, false)::INTEGER) OVER (PARTITION BY machine, pid, name ORDER BY ts
                 RANGE UNBOUNDED PRECEDING) AS life FROM cut)
    SELECT machine, pid, name, life::BIGINT AS life, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS samples
    FROM numbered GROUP BY machine, pid, name, life"""
)
def life_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A process that is absent for more than thirty days starts a new life."""
    machine, pid = (F.col("machine") % 40).alias("machine"), (F.col("pid") % 25).alias("pid")
    rows = views.process_rows(spark, sf_dir).select(machine, pid, "name", "ts")
    return processes.life_spans(rows, "30 days")


@query(
    f"""{PROC}, keyed AS (SELECT machine % 40 AS machine, pid, ts, service FROM proc),
    half AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM keyed),
    later AS (SELECT DISTINCT machine, service FROM keyed, half WHERE date_trunc('month', ts) > middle),
    earlier AS (SELECT DISTINCT machine, service FROM keyed, half WHERE date_trunc('month', ts) <= middle)
    SELECT machine, count(l.service) AS members, count(l.service) FILTER (NOT EXISTS (
      SELECT 1 FROM earlier e WHERE e.machine = m.machine AND e.service = l.service)) AS new_members
    FROM (SELECT DISTINCT machine FROM keyed) m LEFT JOIN later l USING (machine) GROUP BY machine"""
)
def new_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Services of the second half of the time that a machine did not have in the first, from stored monthly sketches."""
    rows = views.process_rows(spark, sf_dir).withColumn("machine", F.col("machine") % 40)
    stored = work_dir(spark, "sets")
    members = {"services": F.col("service"), "pids": F.col("pid")}
    sketches.set_sketches(rows, ["machine"], members, step="month").write.parquet(stored)
    months = spark.read.parquet(stored)
    middle = rows.agg((F.min("ts") + (F.max("ts") - F.min("ts")) / 2)).scalar()
    return sketches.new_members(months, ["machine"], "services", F.col("month") <= middle, F.col("month") > middle)


@query(
    f"""{PROC} SELECT machine, count(DISTINCT name) AS names, greatest(count(DISTINCT pid) - 1, 0) AS restarts
    FROM proc GROUP BY machine"""
)
def restarts_from_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and restarts over all months, merged from monthly sketches; the sets are small enough to be exact."""
    rows, stored = views.process_rows(spark, sf_dir), work_dir(spark, "sets")
    members = {"names": F.col("name"), "pids": F.col("pid")}
    sketches.set_sketches(rows, ["machine"], members, step="month").write.parquet(stored)
    united = sketches.united(spark.read.parquet(stored), ["machine"], list(members))
    restarted = F.greatest(sketches.size("pids") - 1, F.lit(0).cast("bigint"))
    return united.select("machine", sketches.size("names").alias("names"), restarted.alias("restarts"))


def _wider(p: Column) -> Column:
    """One process with fields that no schema has: a number, now and then a text, and a nested one."""
    nice = F.when(p["line"] % 3 == 0, F.lit("'high'")).otherwise(p["line"].cast("string"))
    return F.concat(
        F.lit("{'pid': "), p["pid"].cast("string"), F.lit(", 'name': '"), p["name"], F.lit("', 'nice': "), nice,
        F.when(p["line"] % 2 == 0, F.concat(F.lit(", 'net': {'sent': ["), p["vms"].cast("string"), F.lit(", None], 'up': True}"))).otherwise(F.lit("")),
        F.lit(", 'memory_info': pmem(rss="), p["rss"].cast("string"), F.lit(", vms=1)}"),
    )


def _open_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = sample_texts(spark, sf_dir, _wider).select("sample", process_text.parse_open_list(F.col("processos")).alias("lista"))
    return processes.open_rows(lists, "lista", ["sample"], {"pid": "bigint", "name": "string", "nice": "bigint", "gpu": "double"})


@query(
    f"""{LINES} SELECT sample, pid, name, CASE WHEN line % 3 <> 0 THEN line END::BIGINT AS nice, NULL::DOUBLE AS gpu,
    CASE WHEN line % 3 = 0 THEN 'high' ELSE line::VARCHAR END AS nice_text,
    CASE WHEN line % 2 = 0 THEN vms END AS sent, line % 2 = 0 AS has_net, 'pmem(rss=' || rss || ', vms=1)' AS memory FROM lines"""
)
def open_process_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known fields typed, and unknown ones read from what was kept."""

    def kept(path: str, kind: str) -> Column:
        return F.try_variant_get("process", path, kind)

    return _open_rows(spark, sf_dir).select(
        "sample", "pid", "name", "nice", "gpu", kept("$.nice", "string").alias("nice_text"),
        kept("$.net.sent[0]", "bigint").alias("sent"), F.coalesce(kept("$.net.up", "boolean"), F.lit(False)).alias("has_net"),
        kept("$.memory_info", "string").alias("memory"),
    )


@query(
    f"""{LINES} SELECT 'pid' AS field, count(*) AS processes, 'BIGINT' AS types FROM lines
    UNION ALL SELECT 'name', count(*), 'STRING' FROM lines UNION ALL SELECT 'memory_info', count(*), 'STRING' FROM lines
    UNION ALL SELECT 'nice', count(*), 'BIGINT,STRING' FROM lines
    UNION ALL SELECT 'net', count(*), 'OBJECT<sent: ARRAY<BIGINT>, up: BOOLEAN>' FROM lines WHERE line % 2 = 0"""
)
def list_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processes.list_fields(_open_rows(spark, sf_dir))
