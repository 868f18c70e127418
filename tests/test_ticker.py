"""Batches that close by themselves, against a loop over messages, and live with timers on the wall clock."""

import time
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.streaming.ticker import OpenBatch, closed_batches, cut, next_tick

SECOND = 1_000_000


def loop(times, horizon, size, wait, tick):
    """Message by message, looking at the clock before each: (batch number, messages, closed at, closed by)."""
    out, no, opened, pending = [], 0, times[0], 0

    def look(now, strict):
        nonlocal no, opened, pending
        due = next_tick(opened, wait, tick)
        if pending and (due < now if strict else due <= now):
            out.append((no, pending, due, "tick"))
            no, opened, pending = no + 1, due, 0

    for t in times:
        look(t, False)
        pending += 1
        if pending >= size or t - opened >= wait:
            out.append((no, pending, t, "size" if pending >= size else "age"))
            no, opened, pending = no + 1, t, 0
    look(horizon, True)
    return out, pending


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 7), st.integers(1, 25), st.integers(0, 12), st.integers(0, 60), st.lists(st.integers(0, 60), max_size=3))
def test_cut_equals_the_loop_however_it_is_split(gaps, size, wait, tick, beyond, splits):
    times = np.cumsum(np.array([100, *gaps], np.int64))
    horizon = int(times[-1]) + beyond
    expected, pending = loop(times.tolist(), horizon, size, wait, tick)
    batch, found, at = OpenBatch(0, int(times[0]), latest=int(times[0])), [], 0
    arrivals = np.arange(len(times))
    for end in [*sorted(min(s, len(times)) for s in splits), len(times)]:
        found += cut(batch, arrivals[at:end], times[at:end], horizon if end == len(times) else None, size, wait, tick)
        at = end
    assert [(r[0], r[1], r[5], r[6]) for r in found] == expected
    assert batch.pending == pending
    rows = [i for r in found for i in range(r[2], r[3] + 1)]  # first and last arrivals cover every closed message once
    assert rows == list(range(len(rows))) and len(rows) + pending == len(times)


def test_times_that_run_backwards_count_as_the_latest(at):
    batch = OpenBatch(0, 10 * SECOND, latest=10 * SECOND)
    assert list(cut(batch, np.arange(3), np.array([20, 5, 21]) * SECOND, None, 3, 60 * SECOND, 0)) == [(0, 3, 0, 2, 10 * SECOND, 21 * SECOND, "size")]


def land(spark, folder, name, rows):
    spark.createDataFrame(rows, "stream string, arrival bigint").coalesce(1).write.parquet(f"{folder}/in/{name}")


def live(spark, folder):
    messages = spark.readStream.schema("stream string, arrival bigint").parquet(f"{folder}/in/*")
    closed = closed_batches(messages, ["stream"], size=3, max_wait_seconds=4, tick_seconds=1)
    return closed.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="1 second").start()


def closed_rows(spark, folder, n, seconds):
    """Rows of the sink once there are ``n``, with how long it took."""
    began = time.time()
    while True:
        try:
            rows = spark.read.parquet(f"{folder}/out").collect()
        except Exception:
            rows = []
        if len(rows) >= n or time.time() - began > seconds:
            return {(r["stream"], r["batch_no"]): (r["messages"], r["closed_by"]) for r in rows}
        time.sleep(0.5)


def taken(query, rows, seconds=60):
    """Wait until the query has read so many rows; with timers on the wall clock it never runs out of micro-batches."""
    until = time.time() + seconds
    while sum(p["numInputRows"] for p in query.recentProgress) < rows and time.time() < until:
        time.sleep(0.2)


def test_an_idle_batch_closes_without_a_message_and_after_a_restart(spark, tmp_path):
    land(spark, tmp_path, "a", [("s", 1), ("s", 2), ("s", 3), ("s", 4), ("t", 1)])
    query = live(spark, tmp_path)
    try:
        assert closed_rows(spark, tmp_path, 3, 60) == {("s", 0): (3, "size"), ("s", 1): (1, "tick"), ("t", 0): (1, "tick")}
        land(spark, tmp_path, "b", [("u", 1), ("u", 2)])
        taken(query, 7)
    finally:
        query.stop()
    query = live(spark, tmp_path)  # the open batch of u and its timer come from the state store
    try:
        assert closed_rows(spark, tmp_path, 4, 60)[("u", 0)] == (2, "tick")
    finally:
        query.stop()


def test_event_time_needs_whole_rows(spark, tmp_path):
    shape = "stream string, arrival bigint, at timestamp_ntz"
    spark.createDataFrame([(None, 1, datetime(2025, 1, 1))], shape).write.parquet(f"{tmp_path}/in")
    closed = closed_batches(spark.readStream.schema(shape).parquet(f"{tmp_path}/in"), ["stream"], clock="at")
    query = closed.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="must not be NULL"):
        query.awaitTermination(60)


def test_empty_stream_closes_nothing(spark, tmp_path):
    shape = "stream string, arrival bigint, at timestamp_ntz"
    spark.createDataFrame([], shape).write.parquet(f"{tmp_path}/in")
    closed = closed_batches(spark.readStream.schema(shape).parquet(f"{tmp_path}/in"), ["stream"], clock="at")
    query = closed.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    assert query.awaitTermination(60)
    assert spark.read.schema(closed.schema).parquet(f"{tmp_path}/out").count() == 0
