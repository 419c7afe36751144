"""Ordered computations per key that never need a whole key in one task.

A window partitioned by machine puts every row of a machine into one task, which fails once a single machine
holds a large share of the data. The two primitives here cut each key into time slices. Rows are shuffled by
(key, slice), so one task sees one slice; what has to cross a slice border is a summary with one row per
(key, slice), pre-aggregated before its own small shuffle and joined back on (key, slice).

The width of a slice follows the data: a scalar subquery counts rows per key and day, reading only key and time, and
scales the day so that the busiest key has about ``TARGET_ROWS`` rows in a slice. Sparse data thus gets wide slices and
few summary rows, and a hot key is cut as finely as it needs. Pass ``width`` (microseconds) to fix it instead and save
that count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SLICE = "__slice"
_MICROS = "__micros"
_PREV = "__prev"
_CARRY = "__carry"

DAY_MICROS = 86_400 * 1_000_000

#: Rows of one key a task should hold at once.
TARGET_ROWS = 1_000_000

#: Rows without a time have no place in the order; they are spread over this many slices of their own.
_UNTIMED_SLICES = 4096


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970. Naive timestamps are read field by field, so no session zone gets involved."""
    column = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(column)
    minutes = (F.unix_date(F.to_date(column)) * F.lit(24).cast("bigint") + F.hour(column)) * 60 + F.minute(column)
    return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), column) * 1_000_000).cast("bigint")


def slice_width(df: DataFrame, keys: Sequence[str], ts: str, target_rows: int = TARGET_ROWS) -> Column:
    """Width in microseconds, as a scalar subquery over the whole input.

    Widening is exact: a slice of several days cannot hold more than that many times the busiest day. Narrowing
    assumes an even rate within the busiest day, so a burst may exceed the target by as much as it exceeds that rate.
    """
    days = _timed(df, list(keys), ts).groupBy(*keys, F.floor(F.col(_MICROS) / DAY_MICROS).alias(_SLICE))
    busiest = F.greatest(F.max("__rows"), F.lit(1))
    width = F.greatest(F.lit(1.0), F.floor(float(DAY_MICROS) * target_rows / busiest).cast("double"))
    return days.agg(F.count(F.lit(1)).alias("__rows")).agg(width).scalar()


def _timed(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Only rows that take part in the order, so a summary reads few columns and NULLs are filtered at the scan."""
    return df.where(complete([*keys, ts])).withColumn(_MICROS, micros(df, ts))


def _detail_slices(df: DataFrame, keys: list[str], order: list[str], width: Column) -> DataFrame:
    """All rows with their slice, those without a time spread over slices that no summary contains."""
    untimed = -1 - F.pmod(F.xxhash64(*keys, *order), F.lit(_UNTIMED_SLICES)) - 2**62
    timed = df.withColumn(_MICROS, micros(df, order[0]))
    return timed.withColumn(_SLICE, F.coalesce(F.floor(F.col(_MICROS) / width), untimed))


def _summary_slices(df: DataFrame, keys: list[str], order: list[str], width: Column) -> DataFrame:
    return _timed(df, keys, order[0]).withColumn(_SLICE, F.floor(F.col(_MICROS) / width))


def complete(columns: Sequence[str]) -> Column:
    """True where none of the columns is NULL, in a form that reaches the scan."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    take: Mapping[str, str],
    width: Column | None = None,
    elapsed: str | None = None,
) -> DataFrame:
    """Attach columns of the preceding row of the same key: ``take`` maps new name to source column.

    ``order`` starts with the timestamp; ``elapsed`` names a column for the seconds since the preceding row. The first
    row of a key, and rows without key or time, get NULL.
    """
    keys, order = list(keys), list(order)
    width = slice_width(df, keys, order[0]) if width is None else width
    fields = {**{name: F.col(source) for name, source in take.items()}, _MICROS: F.col(_MICROS)}
    row = F.struct(*[column.alias(name) for name, column in fields.items()])

    within = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    detail = _detail_slices(df, keys, order, width).withColumn(_PREV, F.lag(row).over(within))

    if len(order) == 1:
        # With the time alone as order, each field has a fixed-width buffer: hash aggregation, no local sort.
        last_of_slice = F.struct(*[F.max_by(column, order[0]).alias(name) for name, column in fields.items()])
    else:
        last_of_slice = F.max_by(row, F.struct(*order))
    last = _summary_slices(df, keys, order, width).groupBy(*keys, _SLICE).agg(last_of_slice.alias("__last"))
    borders = last.select(
        *keys, _SLICE, F.lag("__last").over(Window.partitionBy(*keys).orderBy(_SLICE)).alias(_CARRY)
    ).where(F.col(_CARRY).isNotNull())

    joined = detail.join(borders, [*keys, _SLICE], "left")
    previous = F.when(complete([*keys, order[0]]), F.coalesce(F.col(_PREV), F.col(_CARRY)))
    attached = {name: F.col(f"{_PREV}.{name}") for name in take}
    if elapsed:
        attached[elapsed] = (F.col(_MICROS) - F.col(f"{_PREV}.{_MICROS}")) / 1e6
    return joined.select(*df.columns, _MICROS, previous.alias(_PREV)).select(
        *df.columns, *[column.alias(name) for name, column in attached.items()]
    )


def with_running_counts(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counts: Mapping[str, Column],
    width: Column | None = None,
) -> DataFrame:
    """Attach running counts per key: for each name, how many rows up to and including this one meet the condition.

    A condition of ``lit(True)`` is the row number. Rows with equal order columns are numbered in an arbitrary
    but gapless way, so pass enough tie-breaks. Rows without key or time get NULL.
    """
    keys, order = list(keys), list(order)
    width = slice_width(df, keys, order[0]) if width is None else width
    ones = {name: F.when(condition, 1).otherwise(0).cast("bigint") for name, condition in counts.items()}

    within = (
        Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    detail = _detail_slices(df, keys, order, width).select(
        *df.columns, _SLICE, *[F.sum(one).over(within).alias(name) for name, one in ones.items()]
    )

    totals = (
        _summary_slices(df, keys, order, width)
        .groupBy(*keys, _SLICE)
        .agg(*[F.sum(one).alias(name) for name, one in ones.items()])
    )
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, _SLICE, *[F.sum(name).over(before).alias(f"__before_{name}") for name in ones])

    joined = detail.join(offsets, [*keys, _SLICE], "left")
    known = complete([*keys, order[0]])
    return joined.select(
        *df.columns,
        *[
            F.when(known, F.col(name) + F.coalesce(F.col(f"__before_{name}"), F.lit(0))).alias(name)
            for name in ones
        ],
    )


def with_last_known(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, width: Column | None = None
) -> DataFrame:
    """Attach the last value of a column that is not NULL, up to and including this row, of the same key.

    ``order`` starts with the timestamp. Rows without key or time get NULL.
    """
    keys, order = list(keys), list(order)
    width = slice_width(df, keys, order[0]) if width is None else width
    so_far = Window.unboundedPreceding, Window.currentRow
    within = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(*so_far)
    detail = _detail_slices(df, keys, order, width).withColumn(_PREV, F.last(value, ignorenulls=True).over(within))

    known = _summary_slices(df.where(F.col(value).isNotNull()), keys, order, width)
    position = order[0] if len(order) == 1 else F.struct(*order)
    last = known.groupBy(*keys, _SLICE).agg(F.max_by(value, position).alias("__last"))
    # every slice takes over from the nearest earlier one that has a value
    slices = _summary_slices(df, keys, order, width).select(*keys, _SLICE).distinct().join(last, [*keys, _SLICE], "left")
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(*keys, _SLICE, F.last("__last", ignorenulls=True).over(before).alias(_CARRY))

    joined = detail.join(carried, [*keys, _SLICE], "left")
    attached = F.when(complete([*keys, order[0]]), F.coalesce(F.col(_PREV), F.col(_CARRY)))
    return joined.select(*df.columns, attached.alias(out))


def last_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key.

    The greatest first order column per key is found by hash aggregation over key and time alone; only rows that have
    it are sorted and compared by the other order columns. NULL keys are keys, and a NULL time comes before all others.
    """
    newest = df.groupBy(*keys).agg(F.max(order[0]).alias("__newest"))
    newest = newest.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "__newest")
    same = df[order[0]].eqNullSafe(newest["__newest"])
    for key in keys:
        same = same & df[key].eqNullSafe(newest[f"__key_{key}"])
    latest = df.join(newest, same, "left_semi")
    grouped = latest.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
    return grouped.select(*[F.col("__row")[c].alias(c) for c in df.columns])
