"""State per machine that a stream keeps from batch to batch: recent samples, held values, upload buffers.

Each operator is a ``StatefulProcessor`` whose state lies in RocksDB (``state_store``). A batch reads and writes the
state of the machines it has rows of, and no other. The clock is the time of the batch, not that of the samples: it carries
the watermark, so no sample is dropped for being late, a batch that runs again sees the same clock, and timers fire as soon
as anything arrives behind their time.

The rows of one machine in one batch are held in memory while they are sorted; the number of files in a trigger bounds them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta
from threading import Lock

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hostvane.operators import ordered
from hostvane.session import ROCKSDB, STATE_STORE

ARRIVAL, ARRIVED = "__arrival", "__arrived"
SEQ, LATE = "seq", "late"

_STARTING = Lock()


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB if the session names Spark's default store or none.

    The default store has no room for the several states of a processor. A stream takes the session's settings over as it
    starts and notes its store in the checkpoint, so the session gets its own setting back.
    """
    with _STARTING:
        own = spark.conf.get(STATE_STORE, None)
        if own is not None and not own.endswith(".HDFSBackedStateStoreProvider"):
            yield
            return
        spark.conf.set(STATE_STORE, ROCKSDB)
        try:
            yield
        finally:
            if own is None:
                spark.conf.unset(STATE_STORE)
            else:
                spark.conf.set(STATE_STORE, own)


def with_state(stream: DataFrame, keys: Sequence[str], processor: Callable[[T.StructType], StatefulProcessor]) -> DataFrame:
    """Run a processor per key; NULL keys are a key. ``processor`` makes one for the schema it is given, in which times are
    microseconds since 1970, so that no zone gets involved.
    """
    times = {f.name: f.dataType for f in stream.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    clocked = stream.withColumn(ARRIVAL, F.current_timestamp()).withColumn(ARRIVED, F.unix_millis(ARRIVAL))
    plain = clocked.withColumns({name: ordered.micros(stream, name) for name in times}).withWatermark(ARRIVAL, "1 millisecond")
    made = processor(plain.drop(ARRIVAL, ARRIVED).schema)
    result = plain.groupBy(*keys).transformWithState(made, made.emitted, "Append", "eventTime")
    return with_times(result, times)


def with_times(df: DataFrame, times: dict[str, T.DataType]) -> DataFrame:
    """Microseconds back to times."""
    return df.withColumns({name: _time(name, kind) for name, kind in times.items()})


def kept(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """What a stream keeps under a name for every key, as of its last batch: key, value."""
    reader = spark.read.format("statestore").option("stateVarName", name)
    state = reader.load(checkpoint)
    return state.select("key", F.col("list_element" if "list_element" in state.columns else "value").alias("value"))


def _time(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(name)
    seconds = F.col(name).cast("decimal(20,0)") / 1_000_000
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


class _Timer:
    """One timer per key, moved on with every batch that has rows of the key."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle, self.at = handle, handle.getValueState("timer", "at long")

    def set(self, at: int) -> None:
        held = self.at.get()
        if held is not None:
            self.handle.deleteTimer(held[0])
        self.handle.registerTimer(at)
        self.at.update((at,))

    def clear(self) -> None:
        self.at.clear()


class RecentSamples(StatefulProcessor):
    """Outputs of a sample that follow from the sample before it in time, corrected when samples come late.

    State: the samples within ``delay`` of the machine's newest, with the outputs they have been given, and the one before
    them (the base). A sample that comes between them is put in its place, and every later one whose outputs change is
    written again, with the same number ``seq``. A sample from before the base is written with ``late`` = true and without
    outputs: readers work those out from what has been written. When nothing of a machine has arrived for ``idle``, only its
    newest sample stays.
    """

    def __init__(self, schema: T.StructType, keys: Sequence[str], order: Sequence[str], outputs: T.StructType, delay: timedelta, idle: timedelta):
        self.columns = [f.name for f in schema.fields]
        self.state = T.StructType([T.StructField(SEQ, T.LongType()), *schema.fields, *outputs.fields])
        self.emitted = T.StructType([*schema.fields, *outputs.fields, T.StructField(SEQ, T.LongType()), T.StructField(LATE, T.BooleanType())])
        self.keys, self.order, self.names = list(keys), list(order), [f.name for f in outputs.fields]
        self.delay, self.idle = delay // timedelta(microseconds=1), idle // timedelta(milliseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")
        self.base = handle.getValueState("base", self.state)
        self.recent = handle.getListState("recent", self.state)
        self.timer = _Timer(handle)

    def outputs(self, before: dict | None, sample: dict) -> tuple:
        raise NotImplementedError

    def _place(self, sample: dict) -> tuple:
        """Place in the order; NULLs come first, as in a window, and equal ones as they arrived."""
        return (*((sample[c] is not None, sample[c]) for c in self.order), sample[SEQ])

    def _emit(self, sample: dict, late: bool = False) -> Row:
        return Row(**{name: sample[name] for name in self.emitted.names[:-1]}, **{LATE: late})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        named = lambda values: dict(zip(self.state.names, values, strict=True))
        number = (self.count.get() or (0,))[0]
        held = self.base.get()
        base = named(held) if held is not None else None
        recent = [named(values) for values in self.recent.get()]
        newest, out = 0, []
        for row in rows:
            newest = max(newest, row[ARRIVED])
            sample = {SEQ: number, **{c: row[c] for c in self.columns}, **dict.fromkeys(self.names)}
            number += 1
            if sample[self.order[0]] is None or any(sample[k] is None for k in self.keys):
                out.append(self._emit(sample))
            elif base is not None and self._place(sample) < self._place(base):
                out.append(self._emit(sample, late=True))
            else:
                recent.append({**sample, "new": True})
        recent.sort(key=self._place)
        before = base
        for sample in recent:
            values = self.outputs(before, sample)
            if sample.pop("new", False) or values != tuple(sample[n] for n in self.names):
                sample.update(zip(self.names, values, strict=True))
                out.append(self._emit(sample))
            before = sample
        self.count.update((number,))
        self._keep(base, recent)
        self.timer.set(newest + self.idle)
        yield from out

    def _keep(self, base: dict | None, recent: list[dict], everything: bool = False) -> None:
        values = lambda sample: tuple(sample[n] for n in self.state.names)
        if recent:
            floor = recent[-1][self.order[0]] - self.delay
            old = [s for s in recent if everything or s[self.order[0]] < floor]
            if old:
                self.base.update(values(old[-1]))
            if len(old) < len(recent):
                self.recent.put([values(s) for s in recent[len(old) :]])
            else:
                self.recent.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._keep(None, [dict(zip(self.state.names, values, strict=True)) for values in self.recent.get()], everything=True)
        self.timer.clear()
        return iter(())

    def close(self) -> None:
        pass


class CounterRates(RecentSamples):
    """Rates per second from growing counters, as ``series.counter_rates`` gives them."""

    def __init__(self, schema, keys, order, counters: dict[str, str], interval: float | None, delay: timedelta, idle: timedelta):
        super().__init__(schema, keys, order, T.StructType([T.StructField(rate, T.DoubleType()) for rate in counters]), delay, idle)
        self.counters, self.interval = counters, interval

    def outputs(self, before: dict | None, sample: dict) -> tuple:
        if before is None:
            return (None,) * len(self.counters)
        ts = self.order[0]
        elapsed = (sample[ts] - before[ts]) / 1e6 if self.interval is None else float(self.interval)
        pairs = [(before[c], sample[c]) for c in self.counters.values()]
        return tuple(None if a is None or b is None or not elapsed else float(b - a) / elapsed for a, b in pairs)


class HeldValues(RecentSamples):
    """The number of a sample and the value held at it, as ``series.sample_and_hold`` gives them."""

    def __init__(self, schema, keys, order, value: str, out: str, every: int, delay: timedelta, idle: timedelta):
        outputs = T.StructType([T.StructField("n", T.LongType()), T.StructField(out, schema[value].dataType)])
        super().__init__(schema, keys, order, outputs, delay, idle)
        self.value, self.out, self.every = value, out, every

    def outputs(self, before: dict | None, sample: dict) -> tuple:
        n = 1 if before is None else before["n"] + 1
        measured = sample[self.value] if n == 1 or n % self.every == 0 else None
        return n, measured if measured is not None or before is None else before[self.out]


class Uploads(StatefulProcessor):
    """Buffers a machine's samples and lets them go ``rows`` at a time, as an upload with a number.

    What is left goes as an upload of its own when nothing of the machine has arrived for ``timeout``. Samples are taken in
    the order of arrival, by ``order`` within a batch.
    """

    def __init__(self, schema: T.StructType, order: Sequence[str], rows: int, timeout: timedelta):
        self.columns, self.schema, self.order = [f.name for f in schema.fields], schema, list(order)
        self.emitted = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        self.rows, self.timeout = rows, timeout // timedelta(milliseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.number = handle.getValueState("number", "n long")
        self.buffer = handle.getListState("buffer", self.schema)
        self.timer = _Timer(handle)

    def _emit(self, values: tuple, number: int) -> Row:
        return Row(**dict(zip(self.columns, values, strict=True)), batch=number)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        arrived = list(rows)
        own = [tuple(row[c] for c in self.columns) for row in arrived]
        places = [self.columns.index(c) for c in self.order]
        own.sort(key=lambda values: tuple((values[k] is not None, values[k]) for k in places))
        waiting = [*self.buffer.get(), *own]
        number = (self.number.get() or (0,))[0]
        full = len(waiting) // self.rows
        for k, values in enumerate(waiting[: full * self.rows]):
            yield self._emit(values, number + k // self.rows)
        self.number.update((number + full,))
        rest = waiting[full * self.rows :]
        if rest:
            self.buffer.put(rest)
        else:
            self.buffer.clear()
        self.timer.set(max(row[ARRIVED] for row in arrived) + self.timeout)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        waiting = list(self.buffer.get())
        number = (self.number.get() or (0,))[0]
        self.timer.clear()
        if waiting:
            self.buffer.clear()
            self.number.update((number + 1,))
        for values in waiting:
            yield self._emit(values, number)

    def close(self) -> None:
        pass
