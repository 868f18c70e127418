"""Batches closed by size or by age, cut in parallel.

A batch is open from the message that closed the one before it. The message that closes the
batch opened at message i is therefore a function of i alone: the earlier of the size-th message
after i and the first message at least ``max_wait`` later than i. Batch ends are the chain of
that function, starting at a virtual message at the start time.

The chain is followed in chunks of consecutive messages. A chunk also gets the ``size`` messages
before it, since one of those, or none, is the last close before the chunk. Every chunk works out,
for each of them, the last close inside the chunk and how many closes lie before it. Composing
these small tables along the chunks gives the true entry of each chunk, and each chunk then
numbers its own rows. No task holds more than a chunk, whatever a key's share of the data.
"""

from __future__ import annotations

import sys
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.audit import unix_micros
from tidemark.operators.batching import BATCH_SECONDS, BATCH_SIZE, number_messages
from tidemark.operators.running import CELL_BITS
from tidemark.session import cut_lineage, written

# The functions of this module travel to the executors by value, so these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_ROWS = 1 << 19
# Chunk tables composed in one task; with this many groups again at the top, a key may hold
# CHUNK_ROWS * FAN * FAN messages before the last step grows beyond FAN tables.
FAN = 512


def batches_by_size_or_age(
    df: DataFrame,
    keys: list[str],
    arrival: str = "arrival",
    clock: str = "enqueued_time",
    size: int = BATCH_SIZE,
    max_wait_seconds: float = BATCH_SECONDS,
    start_time: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
    fan: int = FAN,
    cell_bits: int = CELL_BITS,
    opened: DataFrame | None = None,
) -> DataFrame:
    """Batch number of every message, as ``keys, arrival, message_no, batch_no, opens_next``.

    ``opens_next`` holds the time of a message that closes its batch, and is NULL for the others.

    ``clock`` must not run backwards in arrival order; a task that sees it do so raises. The age
    test counts from the close of the previous batch, so the first message after a long idle time
    closes a batch by itself. ``start_time`` (UTC, zone-free timestamp text) opens the first
    batch; by default the first message of the key does. ``opened`` continues from an earlier cut:
    the frame ``open_batches`` makes of it. Its keys ignore ``start_time``.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    chunk_rows = max(chunk_rows, 2 * size)
    fan = max(2, min(fan, 4 * chunk_rows // size))
    wait = int(round(max_wait_seconds * 1_000_000))
    first_open = None
    if start_time is not None:
        first_open = (datetime.fromisoformat(start_time) - datetime(1970, 1, 1)) // timedelta(microseconds=1)

    # Only the ordering columns take part; wide payloads stay out of these shuffles.
    narrow = df.select(*keys, arrival, _micros(df, clock).alias("_t"))
    no_key = F.raise_error(F.lit("keys and arrival must not be NULL")).cast("bigint")
    position = (F.coalesce("message_no", no_key) - 1).alias("_pos")
    # Numbered once for both passes over the chunks; sorted positions and times compress well.
    numbered = written(number_messages(narrow, keys, arrival, cell_bits).select(*keys, arrival, "_t", position), "numbered")
    own = F.expr(f"_pos div {chunk_rows}")
    in_tail = F.col("_pos") % chunk_rows >= chunk_rows - size
    chunks = F.explode(F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own)))
    chunked = numbered.withColumn("_chunk", chunks)
    if opened is not None:
        # A batch still open is a virtual message in front, as many positions back as it has messages.
        virtual = opened.select(
            *keys,
            F.lit(None).cast(df.schema[arrival].dataType).alias(arrival),
            _micros(opened, "opened_at").alias("_t"),
            (-1 - F.col("pending")).alias("_pos"),
            F.lit(0).cast("bigint").alias("_chunk"),
        )
        chunked = chunked.unionByName(virtual)

    key_fields = [df.schema[k] for k in keys]
    table_schema = T.StructType([*key_fields, *_longs("_step", "_entry", "_exit", "_closes")])
    entry_schema = T.StructType([*key_fields, *_longs("_step", "_entry", "_before")])
    result_schema = T.StructType([*key_fields, df.schema[arrival], *_longs("message_no", "batch_no", "_close")])

    def chunk_table(rows: pa.Table) -> pa.Table:
        """For every possible last close before the chunk: the last one in it, and how many on the way."""
        chunk = _first(rows, "_chunk")
        pos, t, _ = _ordered(rows, chunk, first_open)
        start = chunk * chunk_rows
        # With nothing but the tail of the chunk before, the key ends there.
        entries = (pos < start) & (pos[-1] >= start)
        last, closes = _chain_ends(_next_close(pos, t, size, wait))
        n = int(entries.sum())
        columns = {"_entry": pos[entries], "_exit": pos[last[entries]], "_closes": closes[entries]}
        return _keyed(rows, keys, n, _step=np.full(n, chunk), **columns)

    def compose(rows: pa.Table) -> pa.Table:
        """The tables of consecutive steps as the table of one larger step."""
        steps = _steps(rows)
        entry = steps[0][1]
        at, closes = entry, np.zeros(len(entry), dtype=np.int64)
        for _, entries, exits, counts in steps:
            row = np.searchsorted(entries, at)
            at, closes = exits[row], closes + counts[row]
        group = np.full(len(entry), steps[0][0] // fan)
        return _keyed(rows, keys, len(entry), _step=group, _entry=entry, _exit=at, _closes=closes)

    def follow(rows: pa.Table) -> pa.Table:
        """The true entry of every step of a group, given that of its first step."""
        steps = _steps(rows)
        at, before = _first(rows, "_known"), _first(rows, "_before")
        if at is None:  # the start of the key: a single entry
            at = int(steps[0][1][0])
        found = []
        for step, entries, exits, counts in steps:
            found.append((step, at, before))
            row = int(np.searchsorted(entries, at))
            at, before = int(exits[row]), before + int(counts[row])
        step, entry, closes = (np.array(c, dtype=np.int64) for c in zip(*found, strict=True))
        return _keyed(rows, keys, len(found), _step=step, _entry=entry, _before=closes)

    def number_rows(rows: pa.Table) -> pa.Table:
        """Batch numbers of the chunk's own messages, given the last close before it."""
        chunk = _first(rows, "_chunk")
        pos, t, order = _ordered(rows, chunk, first_open)
        following = _next_close(pos, t, size, wait)
        closing = np.zeros(len(pos) + 1, dtype=np.int64)
        at = following[int(np.searchsorted(pos, _first(rows, "_entry")))]
        while at < len(pos):
            closing[at + 1] = 1  # the row after a closing message is in the next batch
            at = following[at]
        batch_no = _first(rows, "_before") + np.cumsum(closing[:-1])
        mine = pos >= chunk * chunk_rows
        arrivals = rows.column(arrival).take(pa.array(order[mine[len(pos) - len(order) :]]))
        close = pa.array(t[mine], mask=closing[1:][mine] == 0)
        columns = {arrival: arrivals, "message_no": pos[mine] + 1, "batch_no": batch_no[mine], "_close": close}
        return _keyed(rows, keys, len(arrivals), **columns)

    tables = cut_lineage(chunked.drop(arrival).groupBy(*keys, "_chunk").applyInArrow(chunk_table, table_schema))
    group = F.expr(f"_step div {fan}").alias("_group")
    groups = tables.groupBy(*keys, group).applyInArrow(compose, table_schema)
    top = groups.withColumns({"_known": F.lit(None).cast("bigint"), "_before": F.lit(0).cast("bigint")})
    if opened is not None:
        numbers = opened.select(*keys, F.col("batch_no").alias("_open_no"))
        top = top.join(numbers, keys, "left").withColumn("_before", F.coalesce("_open_no", "_before")).drop("_open_no")
    group_entries = top.groupBy(*keys).applyInArrow(follow, entry_schema)
    known = group_entries.select(*keys, F.col("_step").alias("_group"), F.col("_entry").alias("_known"), "_before")
    chunk_entries = (
        tables.withColumn("_group", group)
        .join(known, [*keys, "_group"])
        .groupBy(*keys, "_group")
        .applyInArrow(follow, entry_schema)
        .withColumnRenamed("_step", "_chunk")
    )
    # A sort-merge join keeps the large side from being broadcast, and its order serves the grouping.
    numbered = (
        chunked.join(chunk_entries.hint("merge"), [*keys, "_chunk"])
        .groupBy(*keys, "_chunk")
        .applyInArrow(number_rows, result_schema)
    )
    return numbered.withColumn("opens_next", _micros_to_time(F.col("_close"))).drop("_close")


def open_batches(
    cut: DataFrame,
    messages: DataFrame,
    keys: list[str],
    clock: str = "enqueued_time",
    opened: DataFrame | None = None,
) -> DataFrame:
    """The batch left open per key after a cut: ``keys, opened_at, pending, batch_no``.

    ``messages`` is what was cut and ``opened`` what was open before. One row per key; keys that
    got no message keep their open batch.
    """
    ends = cut.groupBy(*keys).agg(
        F.max("opens_next").alias("closed_at"),
        F.max("message_no").alias("_last"),
        F.max(F.when(F.col("opens_next").isNotNull(), F.col("message_no"))).alias("_closing"),
        F.max("batch_no").alias("_batch"),
    )
    state = ends.join(messages.groupBy(*keys).agg(F.min(clock).alias("_first")), keys)
    if opened is not None:
        before = opened.select(*keys, "opened_at", F.col("pending").alias("_pending"), F.col("batch_no").alias("_before"))
        state = state.join(before, keys, "full")
    else:
        nothing = {"opened_at": F.lit(None).cast("timestamp_ntz"), "_pending": F.lit(0), "_before": F.lit(0)}
        state = state.withColumns(nothing)
    pending = F.coalesce("_last", F.lit(0)) - F.coalesce("_closing", F.lit(0))
    carried = F.when(F.col("_closing").isNull(), F.coalesce("_pending", F.lit(0))).otherwise(0)
    ended = (F.col("_closing") == F.col("_last")).cast("bigint")
    return state.select(
        *keys,
        F.coalesce("closed_at", "opened_at", F.col("_first").cast("timestamp_ntz")).alias("opened_at"),
        (pending + carried).cast("bigint").alias("pending"),
        F.coalesce(F.col("_batch") + F.coalesce(ended, F.lit(0)), F.col("_before")).cast("bigint").alias("batch_no"),
    )


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def _micros(df: DataFrame, clock: str) -> Column:
    if isinstance(df.schema[clock].dataType, T.TimestampNTZType):
        return unix_micros(F.col(clock))
    return F.unix_micros(clock)


def _micros_to_time(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _first(rows: pa.Table, column: str) -> int:
    return rows.column(column)[0].as_py()


def _keyed(rows: pa.Table, keys: list[str], n: int, **columns) -> pa.Table:
    """Columns of ``n`` rows, after the key of the group they belong to."""
    repeat = pa.array(np.zeros(n, dtype=np.int64))
    return pa.table({**{k: rows.column(k).take(repeat) for k in keys}, **columns})


def _ordered(rows: pa.Table, chunk: int, first_open: int | None):
    """Positions and times in order, with the order; the first chunk starts with a virtual message."""
    pos = rows.column("_pos").to_numpy()
    order = np.argsort(pos)
    pos, t = pos[order], rows.column("_t").to_numpy()[order]
    if chunk == 0 and pos[0] >= 0:
        pos = np.concatenate(([-1], pos))
        t = np.concatenate(([t[0] if first_open is None else first_open], t))
    if (np.diff(t) < 0).any():
        raise ValueError("the clock runs backwards in arrival order")
    return pos, t, order


def _next_close(pos: np.ndarray, t: np.ndarray, size: int, wait: int) -> np.ndarray:
    """Row that closes the batch opened at each row; the row count where it lies further on."""
    rows = np.arange(len(t))
    by_size = rows + size
    if pos[0] < -1:  # an open batch, whose messages so far count as well
        by_size[0] = pos[0] + size + 1
    by_age = np.maximum(np.searchsorted(t, t + wait, side="left"), rows + 1)
    return np.minimum(np.minimum(by_size, by_age), len(t))


def _chain_ends(following: np.ndarray):
    """Last row of the chain from each row, and the number of steps to it, by pointer doubling."""
    rows = np.arange(len(following))
    inside = following < len(following)
    last = np.where(inside, following, rows)
    steps = inside.astype(np.int64)
    while True:
        further = last[last]
        if (further == last).all():
            return last, steps
        steps = steps + steps[last]
        last = further


def _steps(rows: pa.Table):
    """The tables of a group in step order, each as arrays sorted by entry."""
    step, entry, exits, closes = (rows.column(c).to_numpy() for c in ("_step", "_entry", "_exit", "_closes"))
    order = np.lexsort((entry, step))
    step = step[order]
    cuts = np.flatnonzero(np.diff(step)) + 1
    parts = [np.split(column[order], cuts) for column in (entry, exits, closes)]
    return [(int(s[0]), *part) for s, *part in zip(np.split(step, cuts), *parts, strict=True)]
