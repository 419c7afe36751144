"""Operators along time: rates, held values, gaps, grids, per-minute series and chart series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvane.functions import scalars
from hostvane.operators import ordered

SAMPLE_HOLD_EVERY = 6
BATCH_ROWS = 60


def counter_rates(
    samples: DataFrame,
    counters: dict[str, str],
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    interval: float | None = None,
    null_resets: bool = False,
    width: Column | None = None,
) -> DataFrame:
    """Rates per second from growing counters: ``counters`` maps rate column to counter column.

    ``interval`` is the nominal sampling interval; without it the elapsed time is used. The first sample of a
    machine, and samples with no time elapsed, have a NULL rate. A counter that was reset gives a negative rate,
    or NULL with ``null_resets``.
    """
    take = {f"__prev_{counter}": counter for counter in counters.values()}
    paired = ordered.with_previous(samples, keys, order, take, width, elapsed="__elapsed")
    elapsed = F.col("__elapsed") if interval is None else F.lit(float(interval))
    rates = {}
    for rate, counter in counters.items():
        delta = F.col(counter) - F.col(f"__prev_{counter}")
        value = F.try_divide(delta.cast("double"), elapsed)
        rates[rate] = F.when(delta >= 0, value) if null_resets else value
    return paired.withColumns(rates).drop("__elapsed", *take)


def sample_and_hold(
    samples: DataFrame,
    value: str,
    out: str = "held",
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    every: int = SAMPLE_HOLD_EVERY,
    width: Column | None = None,
) -> DataFrame:
    """Measure on the first and then every ``every``-th sample of a machine; repeat the last measurement in between.

    A measurement that is NULL is none: the one before it goes on.
    """
    width = ordered.slice_width(samples, keys, order[0]) if width is None else width
    numbered = ordered.with_running_counts(samples, keys, order, {"n": F.lit(True)}, width)
    due = (F.col("n") == 1) | (F.col("n") % every == 0)
    measured = numbered.withColumn("__measured", F.when(due, F.col(value)))
    return ordered.with_last_known(measured, keys, order, "__measured", out, width).drop("__measured")


def running_counter(
    samples: DataFrame,
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    out: str = "n",
    width: Column | None = None,
) -> DataFrame:
    return ordered.with_running_counts(samples, keys, order, {out: F.lit(True)}, width)


def batch_numbers(
    samples: DataFrame,
    rows: int = BATCH_ROWS,
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    width: Column | None = None,
) -> DataFrame:
    """Number of the upload each sample belongs to when a machine flushes every ``rows`` samples."""
    numbered = running_counter(samples, keys, order, "__n", width)
    return numbered.withColumn("batch", F.floor((F.col("__n") - 1) / rows)).drop("__n")


def sample_gaps(
    samples: DataFrame,
    nominal_seconds: float,
    tolerance: float = 2.0,
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    width: Column | None = None,
) -> DataFrame:
    """Elapsed seconds since the previous sample, and whether that is more than ``tolerance`` intervals."""
    paired = ordered.with_previous(samples, keys, order, {}, width, elapsed="elapsed_s")
    return paired.withColumn("is_gap", F.col("elapsed_s") > tolerance * nominal_seconds)


def latest_snapshot(
    samples: DataFrame, keys: Sequence[str] = ("machine",), order: Sequence[str] = ("ts",)
) -> DataFrame:
    return ordered.last_row(samples, keys, order)


def minute_series(
    samples: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = ("machine",),
    ts: str = "ts",
    step: str = "minute",
) -> DataFrame:
    """Mean and peak per machine and minute (or any unit ``date_trunc`` knows), plus the sample count."""
    bucket = F.date_trunc(step, F.col(ts)).cast(samples.schema[ts].dataType)
    aggregates = [F.count(F.lit(1)).alias("samples")]
    for value in values:
        aggregates += [
            scalars.exact_avg(F.col(value)).alias(f"avg_{value}"),
            F.max(value).alias(f"max_{value}"),
        ]
    return samples.groupBy(*keys, bucket.alias(step)).agg(*aggregates)


def time_grid(spans: DataFrame, start: str, end: str, step: str = "1 minute", out: str = "ts") -> DataFrame:
    """Every point of each span, end excluded, in steps that count from midnight.

    Days are generated first and spread over the cluster, then the points of each day.
    """
    day, one_day, one_step = F.col("__day"), F.expr("interval 1 day"), F.expr(f"interval {step}")
    days = F.sequence(F.date_trunc("day", F.col(start)), F.date_trunc("day", F.col(end)), one_day)
    spread = spans.withColumn("__day", F.explode(days)).repartition(*spans.columns, "__day")
    points = F.explode(F.sequence(day, day + one_day - one_step, one_step))
    return (
        spread.withColumn(out, points)
        .withColumn(out, F.col(out).cast(spans.schema[start].dataType))
        .where((F.col(out) >= F.col(start)) & (F.col(out) < F.col(end)))
        .drop("__day")
    )


def missing_points(grid: DataFrame, samples: DataFrame, on: Sequence[str]) -> DataFrame:
    """Grid points without a sample. Samples are reduced to distinct points before the join."""
    return grid.join(samples.select(*on).distinct(), list(on), "left_anti")


def series(samples: DataFrame, columns: dict[str, Column], order: Sequence[str] = ("ts",)) -> DataFrame:
    """Chart series: chosen columns, sorted along time by a range shuffle."""
    return samples.select(*[column.alias(name) for name, column in columns.items()]).orderBy(*order)


def overlay(flag: Column, value: Column) -> Column:
    """The value where the flag holds, else NULL: the highlighted points of a chart without a self-join."""
    return F.when(flag, value)


def wide_to_long(
    samples: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value"
) -> DataFrame:
    return samples.unpivot(list(ids), list(values), name, value)


def keep_flagged(samples: DataFrame, flag: str) -> DataFrame:
    return samples.where(F.col(flag))


def append_versions(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns a frame lacks are NULL."""
    combined, *rest = frames
    for frame in rest:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def drop_repeats(
    samples: DataFrame, keys: Sequence[str] = ("machine", "ts"), decide: Sequence[str] | None = None
) -> DataFrame:
    """One row per machine and instant from overlapping uploads.

    A copy with more filled columns wins (a later agent version), then the greatest row, so the choice does not
    depend on arrival order; ``decide`` limits which columns count. Nearly every key is unique, so rows are shuffled
    first and sorted once, behind the shuffle.
    """
    others = [c for c in samples.columns if c not in keys]
    decide = others if decide is None else list(decide)
    others = [*decide, *[c for c in others if c not in decide]]
    filled = sum((F.col(c).isNotNull().cast("int") for c in decide), F.lit(0))
    best = F.max(F.struct(filled.alias("__filled"), *others)).alias("__row")
    return samples.repartition(*keys).groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in samples.columns]
    )
