"""What is absent, as intervals: services that are not running, and slots of time without samples.

Nothing here is as large as samples times services or machines times slots. The services of a sample are bits of whole
numbers, whose difference from the sample before gives starts and stops; slots that are covered give the gaps between them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostvane.operators import ordered
from hostvane.session import written

#: Services in a word.
WORD = 64


def numbered_catalogue(catalogue: DataFrame, name: str = "service") -> DataFrame:
    """Distinct names with a word and a bit each, in order of the name. The numbers come from one sorted array."""
    listed = catalogue.where(F.col(name).isNotNull()).agg(F.array_sort(F.collect_set(name)).alias("__names"))
    numbered = listed.select(F.posexplode("__names").alias("__position", name))
    return numbered.select(name, F.floor(F.col("__position") / WORD).alias("word"), (F.col("__position") % WORD).alias("bit"))


def service_bits(
    hosts: DataFrame, active: DataFrame, numbered: DataFrame, keys: Sequence[str], ts: str = "ts", name: str = "service"
) -> DataFrame:
    """One row per key, instant and word of the catalogue: ``bits`` of the services that are active in any of its samples.

    Samples without services have empty words; those without key or time take no part, nor do names outside the catalogue.
    """
    at = [*keys, ts]
    words = numbered.select("word").distinct()
    instants = hosts.where(ordered.complete(at)).select(*at).distinct()
    # a word or two for every sample, whatever the length of the catalogue
    empty = instants.withColumn("word", F.explode(words.agg(F.array_sort(F.collect_list("word"))).scalar())).withColumn("bits", F.lit(0).cast("bigint"))
    known = active.where(ordered.complete(at)).join(numbered, name)
    running = known.groupBy(*at, "word").agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit AS INT))")).alias("bits"))
    return empty.unionByName(running.select(*at, "word", "bits")).groupBy(*at, "word").agg(F.bit_or("bits").alias("bits"))


def service_changes(
    bits: DataFrame, numbered: DataFrame, keys: Sequence[str], ts: str = "ts", name: str = "service", width: Column | None = None
) -> DataFrame:
    """Starts (``running`` true) and stops of services, one row each, against the instant before.

    At the first instant of a key everything counts as running before, so that what is absent there stops there. The words
    are written to the shared folder once, as several parts of the plan read them.
    """
    bits = written(bits, "service-bits")
    before = ordered.with_previous(bits, [*keys, "word"], [ts], {"__before": "bits"}, width)
    full = numbered.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit AS INT))")).alias("__full"))
    changed = before.join(full, "word").withColumn("__changed", F.col("bits").bitwiseXOR(F.coalesce("__before", "__full")))
    changed = changed.where(F.col("__changed") != 0)
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda b: F.getbit("__changed", b) == 1)
    rows = changed.withColumn("bit", F.explode(places)).withColumn("running", F.getbit("bits", F.col("bit")) == 1)
    return rows.join(numbered, ["word", "bit"]).select(*keys, ts, name, "running")


def absences(changes: DataFrame, keys: Sequence[str], ts: str = "ts", name: str = "service", width: Column | None = None) -> DataFrame:
    """Intervals in which a service is absent: from a stop up to the next start, or to NULL when it is still absent at the end.

    Changes are written to the shared folder once, as several parts of the plan read them."""
    keys, changes = [*keys, name], written(changes, "service-changes")
    ended = ordered.with_previous(changes, keys, [ts], {"absent_from": ts}, width).where("running")
    open_ones = ordered.last_row(changes, keys, [ts]).where(~F.col("running"))
    return ended.select(*keys, "absent_from", F.col(ts).alias("absent_to")).unionByName(
        open_ones.select(*keys, F.col(ts).alias("absent_from"), F.lit(None).cast(changes.schema[ts].dataType).alias("absent_to"))
    )


def coverage_gaps(
    samples: DataFrame,
    spans: DataFrame,
    keys: Sequence[str],
    step_seconds: int,
    ts: str = "ts",
    start: str = "start",
    end: str = "end",
    width: Column | None = None,
) -> DataFrame:
    """Runs of slots without a sample, per key: ``gap_from`` and ``gap_to`` (first and last missing slot) and ``missing``.

    Slots are ``step_seconds`` long and count from 1970 (so those that divide a day count from midnight); a span has the
    slots from that of ``start`` up to, not including, ``end``. Keys of ``spans`` without samples are one gap; samples
    outside the span, and those without key or time, do not count. Memory does not depend on the length of a span.
    """
    micro = step_seconds * 1_000_000
    keys = list(keys)
    slot = lambda df, column: F.floor(ordered.micros(df, column) / micro)
    limits = spans.where(ordered.complete([*keys, start, end])).select(
        *keys, slot(spans, start).alias("__first"), F.ceil(ordered.micros(spans, end) / micro).alias("__end")
    )
    covered = samples.where(ordered.complete([*keys, ts])).select(*keys, slot(samples, ts).alias("__slot")).distinct()
    inside = covered.join(limits, keys).where("__slot >= __first AND __slot < __end").select(*keys, "__slot")
    # both ends of a span stand as covered slots just outside it
    ends = limits.select(*keys, F.explode(F.array(F.col("__first") - 1, F.col("__end"))).alias("__slot"))
    timed = written(inside.unionByName(ends).withColumn("__at", F.timestamp_micros(F.col("__slot") * micro)), "covered-slots")
    steps = ordered.with_previous(timed, keys, ["__at"], {"__before": "__slot"}, width)
    missing = F.col("__slot") - F.col("__before") - 1
    kind = samples.schema[ts].dataType
    return steps.where(missing > 0).select(
        *keys,
        _moment((F.col("__before") + 1) * micro).cast(kind).alias("gap_from"),
        _moment((F.col("__slot") - 1) * micro).cast(kind).alias("gap_to"),
        missing.alias("missing"),
    )


def _moment(micros: Column) -> Column:
    return F.timestamp_micros(micros.cast("bigint"))
