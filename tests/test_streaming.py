import time
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import audit as A
from tidemark.operators import checkpoints as C
from tidemark.operators.age_batches import batches_by_size_or_age
from tidemark.operators.failures import decide
from tidemark.plans import streams
from tidemark.sources.streams import file_stream
from tidemark.streaming.cutting import BatchCutter
from tidemark.streaming.progress import LatestProgress, recent_progress, statuses
from tidemark.streaming.retry import RetryPolicy, triaged_retry
from tidemark.streaming.runner import Deduplicated, drain, start_route, start_routes, wait_all
from tidemark.streaming.sink import Lake, Route, RouteSink, read_control, read_table

ROUTE = Route("SOURCE_1", "TARGET_1", "ns", "topic1", "$Default", "lake", "ingest", "table1")
QUICK = {"sleep": lambda seconds: None}


class Feed:
    """A folder of message files; every call of ``add`` appends one file."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, str(folder), 0

    def add(self, sequence_numbers, partitions=3):
        rows = [
            (f"msg_{i}", str(i % partitions), i, str(i * 2), None, {"n": bytearray(str(i), "ascii")}, None)
            for i in sequence_numbers
        ]
        frame = self.spark.createDataFrame(rows, schemas.RAW_MESSAGE).coalesce(1)
        self.files += 1
        frame.write.mode("append").parquet(self.folder)
        return self

    def stream(self, route=None):
        return file_stream(self.spark, self.folder, max_files=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in").add(range(10)).add(range(10, 25))


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def run(feed, sink):
    query = start_route(feed.stream(), sink)
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()
    return query


def landed(spark, lake, route=ROUTE):
    return sorted(r.sequence_number for r in read_table(spark, lake.target(route), schemas.TARGET).collect())


def levels(spark, lake, route=ROUTE):
    control = read_table(spark, lake.control, schemas.CONTROL)
    return {r.partition_id: r.waterlevel for r in C.resume_points(C.entries_of(control, route.control_key)).collect()}


def audit(spark, lake):
    return read_table(spark, lake.audit, schemas.BATCH_AUDIT)


@pytest.mark.parametrize("cache", [False, True])
def test_stream_lands_rows_levels_and_audit(spark, feed, lake, cache):
    run(feed, RouteSink(ROUTE, lake, cache=cache))
    assert landed(spark, lake) == list(range(25))
    assert levels(spark, lake) == {"0": 48, "1": 44, "2": 46}
    rows = audit(spark, lake).orderBy("batch_id").collect()
    assert [(r.messages, r.partitions, r.success, r.attempts) for r in rows] == [(10, 3, True, 1), (15, 3, True, 1)]
    total = A.stats_rollup(audit(spark, lake)).filter("mapping IS NULL").first()
    assert (total.messages_processed, total.batches_processed) == (25, 2)
    metadata = C.typed_metadata(read_control(spark, lake, ROUTE)).filter("waterlevel = 48").first()
    assert metadata.sequence_number == 24


def test_restart_reads_only_what_is_new(spark, feed, lake):
    run(feed, RouteSink(ROUTE, lake))
    run(feed, RouteSink(ROUTE, lake))
    assert audit(spark, lake).count() == 2
    feed.add(range(25, 30))
    run(feed, RouteSink(ROUTE, lake))
    assert landed(spark, lake) == list(range(30))
    assert audit(spark, lake).count() == 3


def test_crash_between_target_and_control_is_replayed(spark, feed, lake):
    class Crashing(RouteSink):
        def write_control(self, messages, batch_id):
            if batch_id == 1:
                raise RuntimeError("lost the driver")
            return super().write_control(messages, batch_id)

    with pytest.raises(StreamingQueryException, match="lost the driver"):
        run(feed, Crashing(ROUTE, lake))
    assert landed(spark, lake) == list(range(25))  # batch 1 is written but not committed
    assert levels(spark, lake) == {"0": 18, "1": 14, "2": 16}
    run(feed, RouteSink(ROUTE, lake))
    assert landed(spark, lake) == list(range(25))  # neither lost nor doubled
    assert levels(spark, lake) == {"0": 48, "1": 44, "2": 46}


def test_sink_that_fails_twice(spark, feed, lake):
    calls = []

    class Flaky(RouteSink):
        def write_target(self, rows, batch_id):
            calls.append(batch_id)
            if len(calls) < 3:
                raise ConnectionError("connection reset")
            super().write_target(rows, batch_id)

    run(feed, Flaky(ROUTE, lake, retry=RetryPolicy(**QUICK)))
    assert calls == [0, 0, 0, 1]
    assert landed(spark, lake) == list(range(25))
    assert [r.attempts for r in audit(spark, lake).orderBy("batch_id").collect()] == [3, 1]
    errors = read_table(spark, lake.failures, schemas.FAILURES).orderBy("attempt").collect()
    assert [(r.attempt, r.error_type) for r in errors] == [(1, "ConnectionError"), (2, "ConnectionError")]


def test_sink_that_always_fails_writes_no_checkpoint(spark, feed, lake):
    calls = []

    def dead(rows, batch_id):
        calls.append(batch_id)
        return False

    with pytest.raises(StreamingQueryException, match="processor returned failure"):
        run(feed, RouteSink(ROUTE, lake, processor=dead, retry=RetryPolicy(**QUICK)))
    assert calls == [0, 0, 0]
    assert levels(spark, lake) == {} and [(r.success, r.attempts) for r in audit(spark, lake).collect()] == [(False, 3)]
    run(feed, RouteSink(ROUTE, lake))
    assert landed(spark, lake) == list(range(25))


def test_fatal_error_is_not_retried(spark, feed, lake):
    calls = []

    def refused(rows, batch_id):
        calls.append(batch_id)
        raise PermissionError("Access denied")

    with pytest.raises(StreamingQueryException, match="Access denied"):
        run(feed, RouteSink(ROUTE, lake, processor=refused, retry=triaged_retry(**QUICK)))
    assert calls == [0]


def test_dead_letters_keep_every_message(spark, feed, lake):
    class Picky(RouteSink):
        def write_target(self, rows, batch_id):
            if batch_id == 0:
                raise ValueError("cannot write")
            super().write_target(rows, batch_id)

    run(feed, Picky(ROUTE, lake, retry=RetryPolicy(attempts=2, **QUICK), on_failure="dead_letter"))
    assert landed(spark, lake) == list(range(10, 25))
    dead = spark.read.parquet(lake.dead_letters(ROUTE))
    assert sorted(r.sequence_number for r in dead.collect()) == list(range(10))
    assert [r.error for r in dead.select("error").distinct().collect()] == ["cannot write"]
    rows = audit(spark, lake).orderBy("batch_id").collect()
    assert [(r.success, r.checkpoints_updated, r.attempts) for r in rows] == [(False, 0, 2), (True, 3, 1)]


def test_empty_batches_write_nothing(spark, tmp_path, lake):
    feed = Feed(spark, tmp_path / "none").add([])
    run(feed, RouteSink(ROUTE, lake))
    assert landed(spark, lake) == [] and levels(spark, lake) == {} and audit(spark, lake).isEmpty()


def test_copies_in_a_batch_land_once(spark, tmp_path, lake):
    feed = Feed(spark, tmp_path / "in").add([1, 2, 2, 3, 3, 3])
    run(feed, RouteSink(ROUTE, lake, drop_copies=True))
    assert landed(spark, lake) == [1, 2, 3]
    assert audit(spark, lake).first().messages == 3


def test_copies_are_kept_unless_asked(spark, tmp_path, lake):
    run(Feed(spark, tmp_path / "in").add([1, 2, 2]), RouteSink(ROUTE, lake))
    assert landed(spark, lake) == [1, 2, 2]


@pytest.mark.parametrize("start, expected", [("earliest", [2, *range(5, 25)]), ("latest", [n for n in range(5, 25) if n % 3 < 2])])
def test_cold_start_from_the_control_log(spark, feed, lake, start, expected):
    points = spark.createDataFrame([("0", 6), ("1", 8)], "partition_id string, waterlevel bigint")
    run(feed, RouteSink(ROUTE, lake, resume=points, start_position=start))
    assert landed(spark, lake) == sorted(expected)


def test_cold_start_keeps_what_an_earlier_run_landed(spark, feed, lake):
    run(feed, RouteSink(ROUTE, lake))
    before = levels(spark, lake)
    points = C.resume_points(C.entries_of(read_control(spark, lake, ROUTE), ROUTE.control_key)).select("partition_id", "waterlevel")
    feed.add(range(25, 30)).add(range(30, 33))
    # A new checkpoint, so batch numbers start again; the resume points are read while the control log grows.
    run(feed, RouteSink(ROUTE, lake, resume=points, checkpoint=f"{lake.root}/fresh"))
    assert landed(spark, lake) == list(range(33))
    after = levels(spark, lake)
    assert all(after[p] >= level for p, level in before.items()) and len(after) == 3
    assert audit(spark, lake).filter("success").agg({"messages": "sum"}).first()[0] == 33


def test_one_source_with_two_targets(spark, feed, lake):
    other = Route("SOURCE_1", "TARGET_2", "ns", "topic1", "$Default", "lake", "ingest", "table2")
    wait_all(start_routes([ROUTE, other], lake, feed.stream).values())
    assert landed(spark, lake) == landed(spark, lake, other) == list(range(25))
    for route in (ROUTE, other):
        own = read_control(spark, lake, route)
        assert {r.target_table for r in own.collect()} == {route.table} and levels(spark, lake, route) == {"0": 48, "1": 44, "2": 46}
    with pytest.raises(ValueError, match="twice"):
        start_routes([ROUTE, ROUTE], lake, feed.stream)


def test_failed_tries_are_audited(spark, feed, lake):
    def fail(rows, batch_id):
        raise ValueError("no table")

    with pytest.raises(StreamingQueryException):
        run(feed, RouteSink(ROUTE, lake, processor=fail))
    assert [(r.success, r.messages, r.checkpoints_updated) for r in audit(spark, lake).collect()] == [(False, 10, 0)]
    run(feed, RouteSink(ROUTE, lake))
    assert sorted((r.success, r.messages) for r in audit(spark, lake).collect()) == [(False, 10), (True, 10), (True, 15)]


def test_messages_without_partition_go_to_the_dead_letters(spark, feed, lake):
    batch = spark.read.parquet(feed.folder)
    RouteSink(ROUTE, lake)(batch.withColumn("partition_id", F.when(F.col("sequence_number") > 2, F.col("partition_id"))), 0)
    assert landed(spark, lake) == list(range(3, 25))
    letters = spark.read.parquet(lake.dead_letters(ROUTE))
    assert {(r.sequence_number, r.error) for r in letters.collect()} == {(n, "partition_id is NULL") for n in range(3)}


def test_processor_callback_gets_target_rows(spark, feed, lake):
    seen = {}
    run(feed, RouteSink(ROUTE, lake, processor=lambda rows, n: seen.update({n: (rows.columns, rows.count())})))
    assert seen == {0: (schemas.TARGET.names, 10), 1: (schemas.TARGET.names, 15)}


def test_two_routes_side_by_side(spark, feed, lake):
    other = Route("SOURCE_2", "TARGET_1", "ns", "topic2", "$Default", "lake", "ingest", "table1")
    queries = start_routes([ROUTE, other], lake, feed.stream)
    wait_all(queries.values())
    assert landed(spark, lake) == sorted([*range(25), *range(25)])  # both streams share one table
    assert levels(spark, lake) == levels(spark, lake, other) == {"0": 48, "1": 44, "2": 46}
    assert {r.status for r in statuses(spark, queries).collect()} == {"stopped"}
    assert recent_progress(spark, queries).filter("input_rows > 0").count() == 4


def test_one_failure_stops_the_others(spark, feed, lake):
    bad = Route("SOURCE_2", "TARGET_2", "ns", "topic2", "$Default", "lake", "ingest", "table2")

    def make(route, lake):
        def fail(rows, batch_id):
            raise ValueError("broken route")

        return RouteSink(route, lake, processor=fail if route is bad else None, retry=RetryPolicy(attempts=1))

    queries = start_routes([ROUTE, bad], lake, feed.stream, every="1 second", make_sink=make)
    with pytest.raises(StreamingQueryException, match="broken route"):
        wait_all(queries.values())
    assert not any(q.isActive for q in queries.values())
    found = {r.mapping: r.status for r in statuses(spark, queries).collect()}
    assert found == {ROUTE.mapping: "stopped", bad.mapping: "failed"}
    assert tuple(A.health_rollup(statuses(spark, queries)).first()) == (2, 0)


def test_drain_lands_everything_before_it_stops(spark, feed, lake):
    listener = LatestProgress()
    spark.streams.addListener(listener)
    try:
        query = start_route(feed.stream(), RouteSink(ROUTE, lake), every="1 second")
        drain(query)
        deadline = time.time() + 30  # events arrive on a thread of their own
        while ROUTE.mapping not in listener.ended and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert not query.isActive
    assert listener.ended == {ROUTE.mapping: None}
    assert listener.progress[ROUTE.mapping]["batch_id"] >= 1
    assert landed(spark, lake) == list(range(25))


def test_batches_span_micro_batches_and_survive_a_crash(spark, tmp_path, at):
    schema = "k string, arrival bigint, t timestamp_ntz"
    rows = [("hot" if i % 3 else f"k{i % 2}", i, at(2 * i + (i > 60) * 500)) for i in range(100)]
    for low, high in [(0, 17), (17, 18), (18, 70), (70, 100)]:
        part = spark.createDataFrame(rows[low:high], schema).coalesce(1)
        part.write.mode("append").parquet(str(tmp_path / "in"))
    crashes = []

    class Crashing(BatchCutter):
        def open_folder(self, batch_id):
            if batch_id == 2 and not crashes:
                crashes.append(batch_id)
                raise RuntimeError("crash before the open batches")
            return super().open_folder(batch_id)

    cutter = Crashing(str(tmp_path / "cut"), ["k"], clock="t", size=7, max_wait_seconds=40)

    def run_all():
        query = (
            file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, max_files=1)
            .writeStream.foreachBatch(cutter)
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start()
        )
        wait_all([query])

    with pytest.raises(StreamingQueryException, match="crash before the open batches"):
        run_all()
    run_all()
    whole = batches_by_size_or_age(spark.createDataFrame(rows, schema), ["k"], clock="t", size=7, max_wait_seconds=40)
    expected = {(r.k, r.arrival): r.batch_no for r in whole.collect()}
    assert {(r.k, r.arrival): r.batch_no for r in cutter.rows(spark).collect()} == expected


def _deduplicate(spark, tmp_path, stream, checkpoint="cp", fail_at=()):
    """Lands a deduplicated stream; the batches in ``fail_at`` fail after their rows are written."""
    failing = set(fail_at)
    run = uuid.uuid4().hex if checkpoint != "cp" else "first"

    def land(rows, batch_id):
        rows.write.mode("overwrite").parquet(str(tmp_path / "rows" / run / f"batch_id={batch_id}"))
        if batch_id in failing:
            failing.remove(batch_id)
            raise RuntimeError("lost after the rows")

    sink = Deduplicated(str(tmp_path / "keys"), str(tmp_path / checkpoint), land, "enqueued_time", "1 hour")
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
    assert query.awaitTermination(120)


def _landed(spark, tmp_path):
    return sorted(r.sequence_number for r in spark.read.parquet(str(tmp_path / "rows" / "*" / "*")).collect())


def _timed(stream):
    """Message 6 is hours older than those before it."""
    time = F.when(F.col("sequence_number") == 6, F.lit("2025-10-17 06:00:00")).otherwise(F.lit("2025-10-17 12:00:00"))
    return stream.withColumn("enqueued_time", time.cast("timestamp_ntz"))


def test_stream_deduplication_across_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in").add(range(5)).add(range(3, 8)).add([6, 7])
    _deduplicate(spark, tmp_path, _timed(feed.stream()))
    assert _landed(spark, tmp_path) == list(range(8))


def test_deliveries_are_written_by_the_tasks_that_read_them(spark, tmp_path, monkeypatch, at):
    """A delivery holds a share of all messages: dealt to one task, that task grows with the input."""
    rows = [(i, at(i), i % 3, ["click", "view"][i % 2], 1.0, '{"k": 1}') for i in range(400)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").repartition(7).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(streams, "shared_folder", lambda spark, label: str(tmp_path / label))
    landed = streams.stream_dedup(spark, str(tmp_path))
    assert sorted(r["sequence_number"] for r in landed.collect()) == list(range(400))
    delivered = spark.read.parquet(str(tmp_path / "dedup" / "delivered"))
    assert delivered.count() == sum(5 if i % 3 == 0 else 2 for i in range(400))
    assert len(list((tmp_path / "dedup" / "delivered").rglob("*.parquet"))) > 5
    assert len(list((tmp_path / "dedup" / "rows").glob("batch_id=*"))) == 5


def test_stream_deduplication_survives_a_crash_and_a_new_checkpoint(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in").add(range(5)).add(range(3, 8))
    with pytest.raises(StreamingQueryException):
        _deduplicate(spark, tmp_path, _timed(feed.stream()), fail_at=[1])
    _deduplicate(spark, tmp_path, _timed(feed.stream()))
    assert _landed(spark, tmp_path) == list(range(8))
    _deduplicate(spark, tmp_path, _timed(feed.stream()), "cp2")
    assert _landed(spark, tmp_path) == list(range(8))


def test_stream_deduplication_reads_the_keys_of_batches_it_meets_only(spark, tmp_path, at):
    shape = "partition_id string, sequence_number bigint, enqueued_time timestamp_ntz"
    sink = Deduplicated(str(tmp_path / "keys"), str(tmp_path / "none"), lambda rows, batch_id: None, "enqueued_time", "1 hour")
    met = []
    inner = sink.met
    sink.met = lambda *args: met.append([f.rsplit("=", 1)[-1] for f in inner(*args)]) or inner(*args)
    batches = [
        [("0", i, at(i)) for i in range(10)],
        [("0", i, at(i)) for i in range(10, 20)],  # in order: nothing to look up
        [("1", 5, at(5)), ("0", 25, at(25))],  # the same number in another partition
        [("0", 15, at(15)), ("0", 30, at(30))],  # a copy, between batches 1 and 2
        [("0", 12, at(90_000))],  # the same number a day later is a message of its own
        [("0", None, at(12))],
    ]
    fresh = []
    sink.land = lambda rows, batch_id: fresh.append(sorted(-1 if r["sequence_number"] is None else r["sequence_number"] for r in rows.collect()))
    for k, rows in enumerate(batches):
        sink(spark.createDataFrame(rows, shape), k)
    assert met == [[], [], [], ["1", "2"], [], []]
    assert fresh == [list(range(10)), list(range(10, 20)), [5, 25], [30], [12], [-1]]
    sink(spark.createDataFrame(batches[3], shape), 3)  # a replay does not take its own keys for others'
    assert fresh[-1] == [30]


def test_waits_grow_and_are_bounded():
    policy = RetryPolicy()
    assert [policy.wait_after(n) for n in (1, 2, 3, 4, 5)] == [1, 2, 4, 8, 10]
    assert [triaged_retry().wait_after(n) for n in (1, 2, 6)] == [2, 2, 30]
    with pytest.raises(ValueError):
        RetryPolicy(attempts=11)


def test_retry_raises_the_last_error():
    waits, errors = [], []

    def act():
        raise ValueError(f"try {len(errors) + 1}")

    policy = RetryPolicy(attempts=3, sleep=waits.append)
    with pytest.raises(ValueError, match="try 3"):
        policy.call(act, lambda n, e: errors.append(n))
    assert (waits, errors) == ([1, 2], [1, 2, 3])
    assert decide(ValueError("x")).confidence == 0.0
