"""Process lists and process rows: exploding, filtering, totals per sample, lifetimes and the expected fleet."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hostvane.functions import calendar, scalars
from hostvane.operators import ordered

HEAVY_MEMORY_PCT = 2.5
HEAVY_RSS_SHARE = 0.05
HOST_CPUS = 16
BASELINE_BYTES = 12 * scalars.GIB
RESERVED_BYTES = 2 * scalars.GIB


# Lists ---------------------------------------------------------------------------------------------------------


def explode_list(samples: DataFrame, processes: str, keep: Sequence[str]) -> DataFrame:
    """One row per process; samples with an empty or unreadable list give none.

    The outer form with a test on the position keeps the same rows as a plain explode, but spares the filter the
    optimizer derives from a plain explode, which would parse every list a second time.
    """
    exploded = samples.select(*keep, F.posexplode_outer(processes).alias("__pos", "__process"))
    return exploded.where(F.col("__pos").isNotNull()).select(*keep, "__process.*")


def open_rows(samples: DataFrame, processes: str, keep: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """One row per process of a list of VARIANT: ``fields`` maps names to types, NULL where a process has no such value, and
    ``process`` is the whole of it, with all other fields. Samples with an empty or unreadable list give none."""
    exploded = samples.select(*keep, F.posexplode_outer(processes).alias("__pos", "process")).where(F.col("__pos").isNotNull())
    typed = [F.try_variant_get("process", f"$['{name}']", kind).alias(name) for name, kind in fields.items()]
    return exploded.select(*keep, *typed, "process")


def list_fields(rows: DataFrame, process: str = "process") -> DataFrame:
    """Which fields the processes of a table have: ``field``, in how many processes, and their types; from one pass."""
    fields = rows.sparkSession.tvf.variant_explode(F.col(process).outer())
    named = rows.select(process).lateralJoin(fields).where(F.col("key").isNotNull())
    kinds = F.array_join(F.array_sort(F.collect_set(F.schema_of_variant("value"))), ",")
    return named.groupBy(F.col("key").alias("field")).agg(F.count(F.lit(1)).alias("processes"), kinds.alias("types"))


def unreadable_lists(samples: DataFrame, text: str, parsed: str) -> DataFrame:
    """Samples whose list has text but could not be read, for a table of rejects: ``explode_list`` gives no rows for
    them. ``parsed`` is the column that the text was parsed into."""
    return samples.where(F.col(text).isNotNull() & F.col(parsed).isNull()).drop(parsed)


def flatten_struct(rows: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by one column per field, prefixed with its name."""
    fields = [f.name for f in rows.schema[column].dataType.fields]
    flat: list[Column] = []
    for name in rows.columns:
        if name == column:
            flat += [F.col(column)[field].alias(f"{column}_{field}") for field in fields]
        else:
            flat.append(F.col(name))
    return rows.select(*flat)


def heavy_in_list(processes: Column, cutoff: float = HEAVY_MEMORY_PCT) -> Column:
    """Processes from ``cutoff`` percent of memory on, filtered inside the list, before any explode."""
    return F.filter(processes, lambda p: p["memory_percent"] >= cutoff)


def list_totals(samples: DataFrame, processes: str) -> DataFrame:
    """Totals and distinct names of each sample's own list, added up exactly as from rows. Row-local: no explode, no shuffle."""
    items = F.col(processes)

    def add_cpu(total: Column, p: Column) -> Column:
        value = F.coalesce(p["cpu_percent"].cast("double"), F.lit(0.0))
        near = F.abs(value) < 1e16
        exact = F.when(near, value.cast("decimal(28,12)")).otherwise(F.lit(0))
        return F.struct(
            (total["exact"] + exact).cast("decimal(38,12)").alias("exact"),
            (total["rest"] + F.when(near, 0.0).otherwise(value)).alias("rest"),
        )

    none = F.struct(F.lit(0).cast("decimal(38,12)").alias("exact"), F.lit(0.0).alias("rest"))

    def add_rss(total: Column, p: Column) -> Column:
        return total + F.coalesce(p["memory_info"]["rss"], F.lit(0))

    return samples.withColumns(
        {
            "n_processes": F.when(items.isNotNull(), F.size(items)),
            "sum_cpu": F.aggregate(items, none, add_cpu, lambda t: t["exact"].cast("double") + t["rest"]),
            "sum_rss": F.aggregate(items, F.lit(0).cast("bigint"), add_rss),
            "active_names": F.array_sort(F.array_distinct(F.transform(items, lambda p: p["name"]))),
        }
    )


def build_lists(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """Collect process rows into sorted lists, one per sample, however many rows a sample has.

    A list is one cell, as in the files, so a sample has to fit into a row; what grows with the data is the number of
    samples. Rows are the form for everything else.
    """
    record = F.struct(*[F.col(f) for f in [*sort, *[f for f in fields if f not in sort]]])
    listed = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(record)).alias("__list"))
    ordered_fields = F.transform("__list", lambda p: F.struct(*[p[f].alias(f) for f in fields]))
    return listed.select(*keys, ordered_fields.alias("processes"))


# Rows ----------------------------------------------------------------------------------------------------------


def heavy_by_rss(rows: DataFrame, total_bytes: Column, share: float = HEAVY_RSS_SHARE, rss: str = "rss") -> DataFrame:
    """Rows whose resident memory exceeds a share of the machine's, with size in MiB and share in percent."""
    mib = scalars.bytes_to_mib(F.col(rss))
    return rows.where(F.col(rss) > total_bytes * F.lit(share)).withColumns(
        {
            "memoria_mb": F.round(mib, 2),
            "porcentagem_ram": mib / scalars.bytes_to_mib(total_bytes) * 100,
        }
    )


def host_totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_processes"),
        scalars.exact_sum(F.col("cpu_percent")).alias("sum_cpu"),
        F.sum("rss").alias("sum_rss"),
        F.sum("read_bps").alias("sum_read_bps"),
        F.sum("write_bps").alias("sum_write_bps"),
    )


def explain_cpu(hosts: DataFrame, totals: DataFrame, on: Sequence[str], cpus: int = HOST_CPUS) -> DataFrame:
    """CPU the processes account for, at most 100, and the remainder of the reported value."""
    explained = F.least(F.lit(100.0), F.coalesce(F.col("sum_cpu"), F.lit(0.0)) / cpus)
    return (
        hosts.join(totals.select(*on, "sum_cpu"), list(on), "left")
        .withColumn("cpu_explained", explained)
        .withColumn("cpu_unexplained", F.col("cpu_pct") - F.col("cpu_explained"))
        .drop("sum_cpu")
    )


def reconcile_memory(
    hosts: DataFrame,
    totals: DataFrame,
    on: Sequence[str],
    total_bytes: Column,
    baseline: int = BASELINE_BYTES,
    reserved: int = RESERVED_BYTES,
) -> DataFrame:
    """Memory the processes account for on top of the system's own, and what is left."""
    expected = F.least(total_bytes - reserved, baseline + F.coalesce(F.col("sum_rss"), F.lit(0)))
    return (
        hosts.join(totals.select(*on, "sum_rss"), list(on), "left")
        .withColumn("mem_used_expected", expected.cast("bigint"))
        .withColumn("mem_available_expected", (total_bytes - F.col("mem_used_expected")).cast("bigint"))
        .drop("sum_rss")
    )


def service_gap(
    hosts: DataFrame, rows: DataFrame, on: Sequence[str], ts: str = "ts", total: int = calendar.SERVICE_COUNT
) -> DataFrame:
    """Active processes per sample against the calendar's target. Samples without processes count as 0."""
    counted = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("active"))
    target = calendar.expected_services(calendar.load_factor(F.col(ts)), total)
    return (
        hosts.join(counted, list(on), "left")
        .withColumn("active", F.coalesce(F.col("active"), F.lit(0)))
        .withColumn("target", target)
        .withColumn("gap", F.col("target") - F.col("active"))
    )


def active_names(rows: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    """The set of names active in each sample, as rows, with the number of processes behind each name."""
    return rows.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("processes"))


def active_name_counts(rows: DataFrame, keys: Sequence[str], name: str = "name") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count_distinct(F.col(name)).alias("n_names"))


def lifetimes(rows: DataFrame, keys: Sequence[str] = ("machine", "pid", "name"), ts: str = "ts") -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("samples")
    )


def life_spans(
    rows: DataFrame, gap: str, keys: Sequence[str] = ("machine", "pid", "name"), ts: str = "ts"
) -> DataFrame:
    """Lives of a process: being absent for longer than ``gap`` ends one and starts another.

    ``life`` numbers them from 1 and ``samples`` counts rows. Rows without key or time are in no life; NULL keys are dropped.
    """
    known = rows.where(ordered.complete([*keys, ts]))
    lives = known.groupBy(*keys, F.session_window(F.col(ts).cast("timestamp"), gap).alias("__session")).agg(
        F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"), F.count(F.lit(1)).alias("samples")
    )
    numbered = ordered.with_running_counts(lives.drop("__session"), keys, ["first_seen"], {"life": F.lit(True)})
    return numbered.select(*keys, "life", "first_seen", "last_seen", "samples")


def restarts(
    rows: DataFrame, keys: Sequence[str] = ("machine", "name"), pid: str = "pid", approximate: bool = False
) -> DataFrame:
    """Starts after the first one: process ids are never reused, so each further id is a restart. No ids: 0."""
    ids = F.approx_count_distinct(pid) if approximate else F.count_distinct(F.col(pid))
    return rows.groupBy(*keys).agg(F.greatest(ids - 1, F.lit(0).cast("bigint")).alias("restarts"))


def hung_processes(
    rows: DataFrame,
    idle: Column,
    min_samples: int = 1,
    keys: Sequence[str] = ("machine", "pid"),
    ts: str = "ts",
) -> DataFrame:
    """Runs of at least ``min_samples`` consecutive instants at which a process was seen idle.

    Rows of a process at one instant are combined first (idle only if all are), before any shuffle; rows without a
    process or a time are in no sequence. Within a run of idle instants, row number minus idle count is constant,
    which makes a run a plain group.
    """
    rows = rows.where(ordered.complete([*keys, ts]))
    width = ordered.slice_width(rows, keys, ts)
    instants = rows.groupBy(*keys, ts).agg(F.bool_and(F.coalesce(idle, F.lit(False))).alias("__idle"))
    counts = {"__n": F.lit(True), "__idle_n": F.col("__idle")}
    numbered = ordered.with_running_counts(instants, keys, [ts], counts, width)
    return (
        numbered.where(F.col("__idle") & F.col("__n").isNotNull())
        .groupBy(*keys, (F.col("__n") - F.col("__idle_n")).alias("__run"))
        .agg(F.min(ts).alias("first_idle"), F.max(ts).alias("last_idle"), F.count(F.lit(1)).alias("samples"))
        .where(F.col("samples") >= min_samples)
        .drop("__run")
    )


def first_per_sample(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each sample with their rank; each task keeps only that many before the shuffle."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rank") <= most)


def cap_to_target(
    rows: DataFrame,
    hosts: DataFrame,
    on: Sequence[str],
    order: Sequence[Column],
    target: Column,
) -> DataFrame:
    """Keep each sample's first processes up to its target; pass a descending order to drop the oldest instead.

    ``hosts`` supplies the columns the target needs. The greatest target is read from them first, so that every task
    cuts its part of a sample to that many rows before the shuffle; the sample's own target is applied after it.
    """
    targets = hosts.select(*on, target.alias("__target"))
    most = targets.agg(F.max("__target")).first()[0] or 0
    kept = first_per_sample(rows, on, order, most)
    return kept.join(hosts, list(on)).where(F.col("rank") <= target)


# Expected fleet --------------------------------------------------------------------------------------------------


def profile_deviation(
    rows: DataFrame, profiles: DataFrame, ts: str = "ts", on: Sequence[str] = ("name",)
) -> DataFrame:
    """Observed minus expected CPU (base times load multiplier), MiB and, where both sides have it, disk KiB per second
    (read and written), for every process with a profile."""
    disk = "disk_kbps" in profiles.columns and {"read_bps", "write_bps"} <= set(rows.columns)
    expected = profiles.select(
        *on,
        F.col("cpu").alias("__cpu"),
        F.col("mem_mb").alias("__mem"),
        *[F.col("disk_kbps").alias("__disk")] * disk,
    )
    boost = calendar.load_multiplier(calendar.load_factor(F.col(ts)))
    joined = rows.join(expected, list(on))
    if disk:
        moved = (F.coalesce("read_bps", F.lit(0)) + F.coalesce("write_bps", F.lit(0))) / 1024
        joined = joined.withColumn("disk_deviation_kbps", moved - F.col("__disk")).drop("__disk")
    return (
        joined
        .withColumns(
            {
                "cpu_expected": scalars.clamp(F.col("__cpu") * boost, 0.1, 100.0),
                "mem_deviation_mib": scalars.bytes_to_mib(F.col("rss")) - F.col("__mem"),
            }
        )
        .withColumn("cpu_deviation", F.col("cpu_percent") - F.col("cpu_expected"))
        .drop("__cpu", "__mem")
    )


def unknown_services(rows: DataFrame, profiles: DataFrame, on: Sequence[str] = ("name",)) -> DataFrame:
    """Process rows whose name is in no profile."""
    return rows.join(profiles.select(*on), list(on), "left_anti")


def missing_services(
    hosts: DataFrame, active: DataFrame, profiles: DataFrame, keys: Sequence[str], name: str = "name"
) -> DataFrame:
    """Profile names that are not active in a sample, for every sample of ``hosts``, also those without any process.

    The catalogue travels as one array value of the plan. Only its names are grouped per sample, so a sample's set is
    no longer than the catalogue; the result has one row per sample and absent name, which is what was asked for.
    ``service_gap`` gives the count, ``services_to_start`` the part that matters next. NULL keys match NULL keys.
    """
    everything = profiles.select(name).distinct().select(F.array_sort(F.collect_list(name))).scalar()
    absent = F.array_except(everything, F.coalesce("__running", F.array().cast("array<string>")))
    with_running = _with_running(hosts.select(*keys), active, profiles, keys, name)
    return with_running.select(*keys, F.explode(absent).alias(name))


def services_to_start(
    gaps: DataFrame, active: DataFrame, profiles: DataFrame, keys: Sequence[str], position: str, name: str = "name"
) -> DataFrame:
    """The first ``gap`` absent services of each sample in catalogue order: what would be started next."""
    order = F.struct(F.min(position).alias("position"), F.col(name).alias("name"))
    catalogue = profiles.where(F.col(name).isNotNull()).groupBy(name).agg(order.alias("__entry"))
    everything = catalogue.select(F.array_sort(F.collect_list("__entry"))["name"]).scalar()
    short = _with_running(gaps.where(F.col("gap") > 0).select(*keys, "gap"), active, profiles, keys, name)
    absent = F.array_except(everything, F.coalesce("__running", F.array().cast("array<string>")))
    return short.select(*keys, F.explode(F.slice(absent, F.lit(1), F.col("gap"))).alias(name))


def _with_running(
    samples: DataFrame, active: DataFrame, profiles: DataFrame, keys: Sequence[str], name: str
) -> DataFrame:
    """Add the set of catalogue names active in each sample (NULL: none); each task reduces its part first."""
    known = active.select(*keys, name).join(profiles.select(name).distinct(), name, "left_semi")
    running = known.groupBy(*keys).agg(F.collect_set(name).alias("__running"))
    running = running.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "__running")
    same = F.lit(True)
    for key in keys:
        same = same & samples[key].eqNullSafe(running[f"__key_{key}"])
    return samples.join(running, same, "left").drop(*[f"__key_{k}" for k in keys])


# Arbitrary functions ---------------------------------------------------------------------------------------------


def map_cells(df: DataFrame, column: str, function, out: str, dtype: str | T.DataType) -> DataFrame:
    """Apply a Python function from Series to Series to a column, in Arrow batches. For what built-ins cannot express."""

    @F.pandas_udf(dtype)
    def mapped(cells: pd.Series) -> pd.Series:
        return function(cells)

    return df.withColumn(out, mapped(F.col(column)))
