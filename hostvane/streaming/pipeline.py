"""Streams over files as they arrive.

File sinks commit through their checkpoint, and each ``foreachBatch`` writer overwrites what is named after its batch, so
a batch that is run again replaces its own output. Machines go offline and upload hours later: ``ingest`` and
``write_minutes`` therefore use no watermark; they keep every row, or its part of a sum, and their readers merge.
Checkpoints and state belong on storage all executors share.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hostvane import schemas
from hostvane.functions import scalars
from hostvane.operators import ordered, series
from hostvane.plans import treatment
from hostvane.sources import landing, sinks
from hostvane.streaming import stateful

DEFAULT_DELAY = "10 minutes"
DEFAULT_IDLE = "7 days"


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def drop_repeats(
    samples: DataFrame, keys: Sequence[str] = ("machine", "ts"), ts: str = "ts", delay: str = DEFAULT_DELAY
) -> DataFrame:
    """Keep the first copy of each sample; a key is remembered for ``delay``, which bounds the state.

    Samples older than the watermark are dropped by Spark: only for sources that are never later than ``delay``.
    """
    return samples.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def minute_series(
    samples: DataFrame,
    values: Sequence[str],
    keys: Sequence[str] = ("machine",),
    ts: str = "ts",
    delay: str = DEFAULT_DELAY,
    width: str = "1 minute",
) -> DataFrame:
    """Mean, peak and count per machine and window; the watermark lets finished windows leave the state.

    Samples older than the watermark are dropped by Spark; ``write_minutes`` counts them, however late.
    """
    aggregates = [F.count(F.lit(1)).alias("samples")]
    for value in values:
        aggregates += [
            scalars.exact_sum(F.col(value)).alias(f"sum_{value}"),
            F.max(value).alias(f"max_{value}"),
        ]
    windowed = samples.withWatermark(ts, delay).groupBy(*keys, F.window(ts, width).alias("__window"))
    return windowed.agg(*aggregates).select(
        *keys,
        F.col("__window.start").alias("window_start"),
        "samples",
        *[
            column
            for value in values
            for column in (
                F.try_divide(F.col(f"sum_{value}"), F.col("samples")).alias(f"avg_{value}"),
                F.col(f"max_{value}"),
            )
        ],
    )


def write_files(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = True, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append to parquet. ``available_now`` works off what is there and stops; otherwise the stream keeps running."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def write_updates(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the groups each batch changed into a folder per batch; ``read_updates`` gives the current state."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_updates(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The newest version of every group written by ``write_updates``."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    versions = spark.read.schema(with_batch).parquet(path)
    return ordered.last_row(versions, keys, ["batch"]).drop("batch")


def write_minutes(
    stream: DataFrame,
    values: Sequence[str],
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("machine",),
    ts: str = "ts",
    step: str = "minute",
    available_now: bool = True,
) -> StreamingQuery:
    """Sums, peaks and counts per machine and minute of each batch; ``read_minutes`` adds the batches up.

    No watermark and no state: a late sample adds to its minute whenever it comes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        bucket = F.date_trunc(step, F.col(ts)).cast(batch.schema[ts].dataType).alias(step)
        aggregates = [F.count(F.lit(1)).alias("samples")]
        for value in values:
            aggregates += [
                scalars.exact_sum(F.col(value)).alias(f"sum_{value}"),
                F.count(value).alias(f"n_{value}"),
                F.max(value).alias(f"max_{value}"),
            ]
        parts = batch.groupBy(*keys, bucket).agg(*aggregates)
        parts.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _start(stream, write, checkpoint, available_now)


def read_minutes(
    spark: SparkSession, path: str, values: Sequence[str], keys: Sequence[str] = ("machine",), step: str = "minute"
) -> DataFrame:
    """The series so far, in the shape of the batch operator."""
    parts = spark.read.parquet(path)
    aggregates = [F.sum("samples").alias("samples")]
    for value in values:
        mean = F.try_divide(scalars.exact_sum(F.col(f"sum_{value}")), F.sum(f"n_{value}"))
        aggregates += [mean.alias(f"avg_{value}"), F.max(f"max_{value}").alias(f"max_{value}")]
    return parts.groupBy(*keys, step).agg(*aggregates)


def _start(stream: DataFrame, write, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _start_with_state(stream: DataFrame, write, checkpoint: str, available_now: bool) -> StreamingQuery:
    with stateful.state_store(stream.sparkSession):
        return _start(stream, write, checkpoint, available_now)


SAMPLE_KEYS = ("machine", "ts")


def ingest(
    spark: SparkSession,
    landing_path: str,
    limits: DataFrame,
    out: str,
    checkpoint: str,
    files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Landing files to treated samples: read, bring to the canonical model, classify, write by day.

    ``files_per_trigger`` is the flush size: how many uploads make up a batch. Each batch writes its own subfolder of
    every day it has rows of, and replaces it when it runs again. Copies of a sample within a batch are merged at once,
    those of different batches by ``read_ingested`` or for good by ``compact``: no row is lost for coming late.
    """
    samples = landing.canonical_agent(landing.stream_agent_csv(spark, landing_path, files_per_trigger))

    def write(batch: DataFrame, batch_id: int) -> None:
        treated = sinks.with_date_keys(treatment.treat(series.drop_repeats(batch, SAMPLE_KEYS), limits))
        parts = treated.withColumn("batch", F.lit(batch_id)).hint("rebalance", *sinks.DAY_KEYS)
        writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*sinks.DAY_KEYS, "batch").parquet(out)

    return _start(samples, write, checkpoint, available_now)


def read_ingested(spark: SparkSession, out: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per sample of what ``ingest`` has written, of the days from ``start`` to ``end`` (ISO dates, inclusive).

    The copy that wins is the one the batch operator chooses; labels follow from it.
    """
    treated = sinks.read_curated(spark, out, start, end).drop("batch", *sinks.DAY_KEYS)
    measured = [c for c in treated.columns if c not in (*SAMPLE_KEYS, *schemas.STATUS_COLUMNS)]
    return series.drop_repeats(treated, SAMPLE_KEYS, decide=measured)


def compact(spark: SparkSession, out: str, curated: str, start: str, end: str) -> None:
    """Write days that are closed, with one row per sample, as few files sorted by machine. May be run again."""
    merged = read_ingested(spark, out, start, end)
    sinks.write_by_day(merged, curated, mode="overwrite", replace_days=True)


def write_counter_rates(
    stream: DataFrame,
    counters: dict[str, str],
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    interval: float | None = None,
    delay: str = DEFAULT_DELAY,
    idle: str = DEFAULT_IDLE,
    available_now: bool = True,
) -> StreamingQuery:
    """Rates across batches, corrected when samples come late; ``read_counter_rates`` gives the current ones.

    The state store keeps, per machine, the samples within ``delay`` of its newest and the one before them, and for machines
    silent for ``idle`` the newest alone. A late sample is rated against its neighbours in time and the rate of the one
    behind it is written again; one from before the state is written without a rate and marked ``late``, and rated when the
    result is read. All columns of the stream are kept in the state: select those that are needed first.
    """
    def processor(schema: T.StructType) -> stateful.CounterRates:
        return stateful.CounterRates(schema, keys, order, counters, interval, _span(delay), _span(idle))

    _write_spec(stream.sparkSession, path, counters=counters, keys=list(keys), order=list(order), interval=interval)
    return _start_with_state(stateful.with_state(stream, keys, processor), _into(path), checkpoint, available_now)


def read_counter_rates(spark: SparkSession, path: str, keys: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """Every sample with its current rates: those of ``series.counter_rates``, in whatever order samples arrived.

    Machines with samples from before the state are rated anew, in the slices of the batch operator; all others keep what
    was written. ``keys`` and ``order`` are known from the writer.
    """
    spec = _read_spec(spark, path)
    newest, late = _newest(spark, path, spec["keys"])
    columns = [c for c in newest.columns if c not in (*spec["counters"], stateful.SEQ)]
    again = series.counter_rates(
        newest.join(late, spec["keys"], "left_semi").select(*columns), spec["counters"], spec["keys"], spec["order"], spec["interval"]
    )
    return newest.join(late, spec["keys"], "left_anti").drop(stateful.SEQ).unionByName(again)


def write_held(
    stream: DataFrame,
    value: str,
    path: str,
    checkpoint: str,
    out: str = "held",
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    every: int = series.SAMPLE_HOLD_EVERY,
    delay: str = DEFAULT_DELAY,
    idle: str = DEFAULT_IDLE,
    available_now: bool = True,
) -> StreamingQuery:
    """Sample-and-hold across batches, by the samples' own time; ``read_held`` gives the current values.

    State and late samples as for the rates; numbers and held values behind a sample that comes late are written again.
    """
    def processor(schema: T.StructType) -> stateful.HeldValues:
        return stateful.HeldValues(schema, keys, order, value, out, every, _span(delay), _span(idle))

    _write_spec(stream.sparkSession, path, value=value, out=out, keys=list(keys), order=list(order), every=every)
    return _start_with_state(stateful.with_state(stream, keys, processor), _into(path), checkpoint, available_now)


def read_held(spark: SparkSession, path: str) -> DataFrame:
    """Every sample with its number and held value: those of ``series.sample_and_hold``, in whatever order samples arrived."""
    spec = _read_spec(spark, path)
    newest, late = _newest(spark, path, spec["keys"])
    columns = [c for c in newest.columns if c not in ("n", spec["out"], stateful.SEQ)]
    again = series.sample_and_hold(
        newest.join(late, spec["keys"], "left_semi").select(*columns), spec["value"], spec["out"], spec["keys"], spec["order"], spec["every"]
    )
    return newest.join(late, spec["keys"], "left_anti").drop(stateful.SEQ).unionByName(again)


def write_uploads(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    rows: int = series.BATCH_ROWS,
    keys: Sequence[str] = ("machine",),
    order: Sequence[str] = ("ts",),
    timeout: str = DEFAULT_DELAY,
    available_now: bool = True,
) -> StreamingQuery:
    """Flush a machine's samples ``rows`` at a time, whatever the triggers: each flush has a number per machine, ``batch``.

    What is left goes as one smaller upload once nothing of the machine has arrived for ``timeout``, which is noticed with
    the next arrival of any machine; until then ``waiting_samples`` shows it. Samples count as they arrive.
    """
    flushed = stateful.with_state(stream, keys, lambda schema: stateful.Uploads(schema, order, rows, _span(timeout)))
    return _start_with_state(flushed, _into(path, "trigger"), checkpoint, available_now)


def waiting_samples(spark: SparkSession, checkpoint: str, schema: T.StructType, keys: Sequence[str] = ("machine",)) -> DataFrame:
    """Samples that ``write_uploads`` still buffers, with the number that their upload will get; ``schema`` is the stream's."""
    waiting = stateful.kept(spark, checkpoint, "buffer")
    numbers = stateful.kept(spark, checkpoint, "number").select(F.col("key").alias("__key"), F.col("value.n").alias("batch"))
    same = F.lit(True)
    for key in keys:
        same = same & F.col("key")[key].eqNullSafe(F.col("__key")[key])
    times = {f.name: f.dataType for f in schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    return stateful.with_times(waiting.join(numbers, same).select("value.*", "batch"), times)


def _span(text: str) -> timedelta:
    """A duration such as '10 minutes'."""
    number, unit = text.split()
    return timedelta(**{unit.rstrip("s") + "s": float(number)})


def _into(path: str, folder: str = "batch"):
    """Each batch into its own folder, replaced when it runs again; batches without rows leave none."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{folder}={batch_id}")

    return write


def _write_spec(spark: SparkSession, path: str, **spec) -> None:
    """What a reader has to know, next to the data, in a folder that readers of the data pass over."""
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_spec")


def _read_spec(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/_spec").first()[0])


def _newest(spark: SparkSession, path: str, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The newest version of every sample (NULL keys are keys), and the keys that have samples from before the state."""
    versions = spark.read.parquet(path)
    row = F.max_by(F.struct(*[c for c in versions.columns if c not in (*keys, stateful.SEQ, "batch")]), "batch")
    newest = versions.groupBy(*keys, stateful.SEQ).agg(row.alias("__row")).select(*keys, stateful.SEQ, "__row.*")
    return newest, versions.where(stateful.LATE).select(*keys).distinct()
