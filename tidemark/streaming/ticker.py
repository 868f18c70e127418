"""Batches that close by themselves: keyed state with timers, so an idle key's open batch is not held for ever.

A batch is open from the close of the one before. A message closes it when it is the ``size``-th or comes ``max_wait`` or more after the
batch was opened; and every ``tick`` a batch that holds messages and is that old is closed without one. Ticks are the multiples of
``tick`` since 1970, so what a tick closes does not depend on how the stream was cut into micro-batches.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.operators.batching import BATCH_SECONDS, BATCH_SIZE

# The functions of this module travel to the executors by value, so these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Seconds between two looks at the open batches; a fixed value.
TICK_SECONDS = 10
BY_SIZE, BY_AGE, BY_TICK = "size", "age", "tick"

STATE = "batch_no bigint, opened bigint, pending bigint, first bigint, last bigint, latest bigint"


@dataclass
class OpenBatch:
    """The batch a key is filling. Times are microseconds since 1970; ``latest`` is that of the last message."""

    batch_no: int
    opened: int
    pending: int = 0
    first: int | None = None
    last: int | None = None
    latest: int = 0

    def closed(self, reason: str, at: int, messages: int, first: int | None, last: int | None) -> tuple:
        row = (self.batch_no, messages, first, last, self.opened, at, reason)
        self.batch_no, self.opened, self.pending, self.first, self.last = self.batch_no + 1, at, 0, None, None
        return row


def next_tick(opened: int, wait: int, tick: int) -> int:
    """The first tick at which a batch is old enough."""
    due = opened + wait
    return due if tick <= 0 else -(-due // tick) * tick


def cut(batch: OpenBatch, arrivals: np.ndarray, times: np.ndarray, horizon: int | None, size: int, wait: int, tick: int) -> Iterator[tuple]:
    """Close batches over messages in arrival order, and then by the ticks up to ``horizon``, if one is given.

    Works from close to close, not from message to message. Times that run backwards count as the latest before them. A message at the very
    time of a tick comes after it.
    """
    if len(times):
        times = np.maximum.accumulate(np.maximum(times, max(batch.latest, batch.opened)))
        batch.latest = int(times[-1])
    at, n = 0, len(times)
    while True:
        due, tau = batch.opened + wait, next_tick(batch.opened, wait, tick)
        filled = at + size - batch.pending - 1
        late = at + int(np.searchsorted(times[at:], due))
        held = batch.pending + late - at
        if filled < n and filled < late:
            stop, reason, when = filled + 1, BY_SIZE, int(times[filled])
        elif late < n and (held == 0 or times[late] < tau):
            stop, when = late + 1, int(times[late])
            reason = BY_SIZE if held + 1 >= size else BY_AGE
        elif held and (late < n or (horizon is not None and tau < horizon)):
            stop, reason, when = late, BY_TICK, tau
        else:
            break
        first = batch.first if batch.pending else int(arrivals[at])
        last = int(arrivals[stop - 1]) if stop > at else batch.last
        yield batch.closed(reason, when, batch.pending + stop - at, first, last)
        at = stop
    if at < n:
        batch.first = batch.first if batch.pending else int(arrivals[at])
        batch.last = int(arrivals[-1])
        batch.pending += n - at


class Beat(DataSource):
    """A stream without rows whose offset is the time. After a restart, Spark looks at timers only once a source has moved on."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_beat"

    def schema(self) -> str:
        return "beat bigint"

    def streamReader(self, schema) -> BeatReader:  # noqa: N802 (Spark's name)
        return BeatReader()


class BeatReader(DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802 (Spark's name)
        return {"ms": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"ms": time.time_ns() // 1_000_000}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return iter(())


CLOSED = [
    T.StructField("batch_no", T.LongType()),
    T.StructField("messages", T.LongType()),
    T.StructField("first_arrival", T.LongType()),
    T.StructField("last_arrival", T.LongType()),
    T.StructField("opened_at", T.LongType()),
    T.StructField("closed_at", T.LongType()),
    T.StructField("closed_by", T.StringType()),
]


def closed_batches(
    messages: DataFrame,
    keys: list[str],
    arrival: str = "arrival",
    clock: str | None = None,
    size: int = BATCH_SIZE,
    max_wait_seconds: float = BATCH_SECONDS,
    tick_seconds: float = TICK_SECONDS,
    late_by: str = "0 seconds",
    beat: bool = True,
) -> DataFrame:
    """One row for each batch of a stream that closes: keys, ``batch_no``, ``messages``, its first and last arrival, when it was opened and closed, and what closed it.

    Without a ``clock`` column, messages count as of the time Spark takes them up, and timers run on the wall clock: an idle key's batch closes at
    the first trigger after its tick. With one, they count as of that time, and timers run on the stream's watermark, ``late_by`` behind the latest message
    of any key; then the same messages give the same batches in every replay. Times are timestamps without a zone, in UTC.

    Batch numbers count from 0 per key. The first batch of a key opens with its first message. Open batches and their timers are kept in
    the state store, so a restarted query closes what the stopped one left open. Messages with a NULL key, arrival or clock raise an error.

    On the wall clock, a second source without rows, the ``beat``, lets timers run from the start of a restarted query, and not only from its first
    message. Checkpoints written without it are continued with ``beat=False``.

    Only keys, arrival and clock are shuffled. The messages of one key in one micro-batch meet in one task, so a micro-batch has to be
    bounded by the source; for a backlog of any size, cut it with ``batches_by_size_or_age``.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    wait, tick = (int(round(seconds * 1_000_000)) for seconds in (max_wait_seconds, tick_seconds))
    event_time = clock is not None
    missing = F.raise_error(F.lit("keys, arrival and clock must not be NULL"))
    narrow = messages.select(*[F.coalesce(F.col(k), missing).alias(k) for k in keys], F.coalesce(F.col(arrival).cast("bigint"), missing.cast("bigint")).alias("_arrival"), *([F.coalesce(F.col(clock).cast("timestamp"), missing.cast("timestamp")).alias("_time")] if event_time else []))
    if event_time:
        narrow = narrow.withWatermark("_time", late_by)
    elif beat:
        messages.sparkSession.dataSource.register(Beat)
        beats = messages.sparkSession.readStream.format(Beat.name()).load()
        narrow = narrow.union(beats.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in narrow.schema]))

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        now = (state.getCurrentWatermarkMs() if event_time else state.getCurrentProcessingTimeMs()) * 1000
        arrivals, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not state.hasTimedOut:
            for frame in frames:
                arrivals.append(frame["_arrival"].to_numpy(np.int64))
                times.append(frame["_time"].to_numpy("datetime64[us]").astype(np.int64) if event_time else np.full(len(frame), now))
        order = np.argsort(np.concatenate(arrivals), kind="stable")
        arrivals, times = np.concatenate(arrivals)[order], np.concatenate(times)[order]
        if state.exists:
            batch = OpenBatch(*state.get)
        elif len(times):
            batch = OpenBatch(0, int(times[0]), latest=int(times[0]))
        else:
            return
        # What is due by the clock closes; a key that has just had messages is judged by these first.
        rows = list(cut(batch, arrivals, times, now, size, wait, tick))
        state.update((batch.batch_no, batch.opened, batch.pending, batch.first, batch.last, batch.latest))
        if batch.pending:
            due = -(-next_tick(batch.opened, wait, tick) // 1000)
            if event_time:
                state.setTimeoutTimestamp(max(due, now // 1000 + 1))
            else:
                state.setTimeoutDuration(max(due - now // 1000, 1))
        if rows:
            frame = pd.DataFrame(rows, columns=[f.name for f in CLOSED])
            for k, value in reversed(list(zip(keys, key, strict=True))):
                frame.insert(0, k, value)
            yield frame

    key_fields = [narrow.schema[k] for k in keys]
    made = narrow.groupBy(*keys).applyInPandasWithState(step, T.StructType([*key_fields, *CLOSED]), STATE, "append", "EventTimeTimeout" if event_time else "ProcessingTimeTimeout")
    return made.withColumns({c: F.timestamp_micros(c).cast("timestamp_ntz") for c in ("opened_at", "closed_at")})
