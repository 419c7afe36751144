"""Summaries that are stored once and merged for any range: quantiles of values, and sets of names or process ids.

Both are exact while they hold few items and have a stated error above that. A roll-up reads stored sketches, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a quantile sketch: exact up to about so many values, then a rank error of some 1.3 % (99 % of the time).
KLL_K = 200
RANK_ERROR = 0.0133
#: A set is exact below two to this power of members; above, one standard error is about 1.6 %.
THETA_LG = 12
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def quantile_sketches(samples: DataFrame, keys: Sequence[str], value: str, ts: str = "ts", step: str = "minute") -> DataFrame:
    """Per key and minute (or any unit of ``date_trunc``): number of values that are not NULL, and their sketch."""
    bucket = F.date_trunc(step, F.col(ts)).cast(samples.schema[ts].dataType).alias(step)
    known = samples.where(F.col(value).isNotNull())
    return known.groupBy(*keys, bucket).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("sketch")
    )


def rolled_up(sketches: DataFrame, keys: Sequence[str], step: str, to: str | None) -> DataFrame:
    """Merge stored sketches of a unit to a longer one, or over all time (``to`` NULL)."""
    unit = [] if to is None else [F.date_trunc(to, F.col(step)).cast(sketches.schema[step].dataType).alias(to)]
    return sketches.groupBy(*keys, *unit).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, wanted: dict[str, float] | None = None) -> DataFrame:
    """Columns of quantiles in place of the sketch."""
    found = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(rank)) for name, rank in (wanted or QUANTILES).items()}
    return sketches.withColumns(found).drop("sketch")


def set_sketches(rows: DataFrame, keys: Sequence[str], members: dict[str, Column], ts: str = "ts", step: str = "day") -> DataFrame:
    """Per key and day (or any unit): a sketch of every set of ``members``; NULL is no member."""
    bucket = F.date_trunc(step, F.col(ts)).cast(rows.schema[ts].dataType).alias(step)
    sketches = [F.theta_sketch_agg(column, F.lit(THETA_LG)).alias(name) for name, column in members.items()]
    return rows.groupBy(*keys, bucket).agg(*sketches)


def united(sketches: DataFrame, keys: Sequence[str], members: Sequence[str]) -> DataFrame:
    """The union of stored sketches per key: select the range of days first."""
    return sketches.groupBy(*keys).agg(*[F.theta_union_agg(name, F.lit(THETA_LG)).alias(name) for name in members])


def size(sketch: str | Column) -> Column:
    return F.theta_sketch_estimate(sketch)


def new_members(sketches: DataFrame, keys: Sequence[str], member: str, earlier: Column, later: Column) -> DataFrame:
    """How many members of the later days are in none of the earlier ones, per key, from stored sketches alone."""
    either = sketches.where(earlier | later).groupBy(*keys).agg(
        F.theta_union_agg(F.when(earlier, F.col(member)), F.lit(THETA_LG)).alias("__earlier"),
        F.theta_union_agg(F.when(later, F.col(member)), F.lit(THETA_LG)).alias("__later"),
    )
    return either.select(*keys, size("__later").alias("members"), size(F.theta_difference("__later", "__earlier")).alias("new_members"))
