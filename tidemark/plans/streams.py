"""End-to-end streaming runs over the events table."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.envelope import metadata_field
from tidemark.operators import checkpoints as C
from tidemark.plans import inputs as I
from tidemark.session import shared_folder, written
from tidemark.sources.partitioned import partitioned_stream, write_partitioned
from tidemark.sources.streams import file_stream
from tidemark.streaming.cutting import BatchCutter
from tidemark.streaming.fanout import FanOut, start_fan_out
from tidemark.streaming.manifest import Manifest
from tidemark.streaming.retry import triaged_retry
from tidemark.streaming.runner import Deduplicated, drain, start_route, wait_all
from tidemark.streaming.sink import Lake, Route, RouteSink, read_control, read_landed, read_table
from tidemark.streaming.ticker import closed_batches

ROUTES = [
    Route(f"SOURCE_{n}", f"TARGET_{n}", "ns0", kind, "$Default", "lake", "ingest", f"{kind}_events")
    for n, kind in enumerate(["click", "view", "purchase", "signup", "error"])
]


def _events(spark, sf_dir, max_files=1000):
    schema = I.table(spark, sf_dir, "events").schema
    # As a pattern, the path may be one file or a folder of files; a stream takes no plain file.
    return file_stream(spark, f"{sf_dir}/events.parque[t]", schema, max_files=max_files)


def _messages(events, *more):
    return events.selectExpr(
        *more,
        "concat(event_type, ' ', props) AS body",
        "cast(user_id % 4 AS string) AS partition_id",
        "event_id AS sequence_number",
        "CASE WHEN event_id % 11 = 0 THEN 'invalid' ELSE cast(event_id * 64 AS string) END AS offset",
        "ts AS enqueued_time",
        "map('type', encode(event_type, 'UTF-8')) AS properties",
    )


def _fan_out(spark, sf_dir, lake, make_sink=RouteSink):
    """One scan of the events, each type landing in its route, until they are drained."""
    events = _events(spark, sf_dir)
    messages = _messages(events, "event_type")
    wait_all([start_fan_out(messages, FanOut(ROUTES, lake, lambda r: F.col("event_type") == r.hub, f"{lake.root}/checkpoints/events", make_sink))])


def _run(spark, sf_dir) -> Lake:
    lake = Lake(shared_folder(spark, "lake"))
    _fan_out(spark, sf_dir, lake)
    return lake


def _landed(spark, lake):
    landed = [read_landed(spark, lake, r).withColumn("target_table", F.lit(r.table)) for r in ROUTES]
    return reduce(DataFrame.unionByName, landed).drop("ingestion_timestamp")


def stream_target(spark, sf_dir):
    """Rows of all targets."""
    return _landed(spark, _run(spark, sf_dir))


STREAM_TARGET = """
SELECT concat(event_type, ' ', props) AS event_body, CAST(user_id % 4 AS VARCHAR) AS partition_id,
  event_id AS sequence_number, ts AS enqueued_time, concat('{"type":"', event_type, '"}') AS properties,
  CAST(NULL AS VARCHAR) AS system_properties, concat(event_type, '_events') AS target_table FROM events"""


def stream_resume(spark, sf_dir):
    """Resume points in the control log a run leaves behind."""
    control = read_table(spark, _run(spark, sf_dir).control, schemas.CONTROL)
    rows = C.typed_metadata(control).withColumn("group", metadata_field(F.col("metadata"), "consumer_group"))
    return rows.groupBy("eventhub", "target_table", "partition_id", "group").agg(
        F.max("waterlevel").alias("waterlevel"), F.max("sequence_number").alias("sequence_number")
    )


STREAM_RESUME = """
SELECT event_type AS eventhub, concat(event_type, '_events') AS target_table, CAST(user_id % 4 AS VARCHAR) AS partition_id,
  '$Default' AS "group", CASE WHEN max(event_id) % 11 = 0 THEN max(event_id) ELSE max(event_id) * 64 END AS waterlevel,
  max(event_id) AS sequence_number FROM events GROUP BY event_type, user_id % 4"""


def stream_audit(spark, sf_dir):
    """What the audit says about a run."""
    audit = read_table(spark, _run(spark, sf_dir).audit, schemas.BATCH_AUDIT)
    return audit.groupBy("mapping", "success").agg(
        F.sum("messages").alias("messages"), F.max("partitions").alias("partitions"), F.max("attempts").alias("attempts")
    )


STREAM_AUDIT = """
SELECT concat('SOURCE_', n, '->TARGET_', n) AS mapping, true AS success, messages, partitions, 1 AS attempts FROM (
  SELECT list_position(['click', 'view', 'purchase', 'signup', 'error'], event_type) - 1 AS n, count(*) AS messages,
    count(DISTINCT user_id % 4) AS partitions FROM events GROUP BY event_type)"""


class _HalfSink(RouteSink):
    """Loses the third route's batch between the target rows and the control rows."""

    def write_control(self, messages, batch_id):
        if self.route == ROUTES[2]:
            raise RuntimeError("crash before the control rows")
        return super().write_control(messages, batch_id)


def fan_out_replay(spark, sf_dir):
    """One of five routes of a scan fails; the replay lands it alone. Every route's rows, and how often its batch landed."""
    lake = Lake(shared_folder(spark, "lake"))
    try:
        _fan_out(spark, sf_dir, lake, _HalfSink)
    except StreamingQueryException as error:
        if "crash before the control rows" not in str(error):
            raise
    _fan_out(spark, sf_dir, lake)
    audit = read_table(spark, lake.audit, schemas.BATCH_AUDIT).filter("success").groupBy("mapping").agg(F.count("*").alias("landings"))
    tables = spark.createDataFrame([(r.table, r.mapping) for r in ROUTES], "target_table string, mapping string")
    return _landed(spark, lake).join(F.broadcast(tables), "target_table").join(F.broadcast(audit), "mapping").drop("properties", "system_properties")


FAN_OUT_REPLAY = """
SELECT concat(event_type, ' ', props) AS event_body, CAST(user_id % 4 AS VARCHAR) AS partition_id, event_id AS sequence_number, ts AS enqueued_time,
  concat(event_type, '_events') AS target_table, concat('SOURCE_', n, '->TARGET_', n) AS mapping, 1::BIGINT AS landings
FROM (SELECT *, list_position(['click', 'view', 'purchase', 'signup', 'error'], event_type) - 1 AS n FROM events)"""


class _CrashingSink(RouteSink):
    """Loses its first micro-batch between the target rows and the control rows."""

    def write_control(self, messages, batch_id):
        raise RuntimeError("crash before the control rows")


def stream_replay(spark, sf_dir):
    """A run that dies after writing target rows, and the run that takes over."""
    everything = Route("SOURCE_ALL", "TARGET_ALL", "ns0", "all", "$Default", "lake", "ingest")
    lake = Lake(shared_folder(spark, "lake"))
    try:
        wait_all([start_route(_messages(_events(spark, sf_dir)), _CrashingSink(everything, lake))])
    except StreamingQueryException as error:
        if "crash before the control rows" not in str(error):
            raise
    wait_all([start_route(_messages(_events(spark, sf_dir)), RouteSink(everything, lake))])
    rows = read_landed(spark, lake, everything)
    return rows.select("event_body", "partition_id", "sequence_number", "enqueued_time")


STREAM_REPLAY = """
SELECT concat(event_type, ' ', props) AS event_body, CAST(user_id % 4 AS VARCHAR) AS partition_id,
  event_id AS sequence_number, ts AS enqueued_time FROM events"""


def _replayed(spark, sf_dir, folder, files):
    """The events as a stream of several micro-batches in the order of their ids: one file of consecutive events after the other."""
    events = I.table(spark, sf_dir, "events")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    if low is None:
        low, high = 0, 0
    part = F.floor((F.col("event_id") - low) * files / (high - low + 1))
    for n in range(files):  # written one by one: the file source goes by the time of writing
        events.filter(part == n).coalesce(1).write.parquet(f"{folder}/replay/part={n}")
    return file_stream(spark, f"{folder}/replay/*", events.schema, max_files=1)


def stream_batches(spark, sf_dir):
    """A stream cut into batches of at most 80 messages or eight hours per event type, across several micro-batches."""
    folder = shared_folder(spark, "cut")
    cutter = BatchCutter(folder, ["event_type"], "event_id", "ts", size=80, max_wait_seconds=8 * 3600)
    events = _replayed(spark, sf_dir, folder, files=3)
    checkpoint = f"{folder}/checkpoint"
    started = events.writeStream.foreachBatch(cutter).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    wait_all([started.start()])
    return cutter.rows(spark)


STREAM_BATCHES = """WITH RECURSIVE numbered AS (
  SELECT event_type, event_id, ts AS t, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events),
opened AS (SELECT event_type, n, t, t + INTERVAL 8 HOUR AS due FROM numbered
  UNION ALL SELECT event_type, 0 AS n, min(t) AS t, min(t) + INTERVAL 8 HOUR AS due FROM numbered GROUP BY event_type),
following AS (SELECT o.event_type, o.n, least(o.n + 80, coalesce(d.n, o.n + 80)) AS closing
  FROM opened o ASOF LEFT JOIN numbered d ON o.event_type = d.event_type AND o.due <= d.t),
chain AS (SELECT event_type, closing FROM following WHERE n = 0
  UNION ALL SELECT f.event_type, f.closing FROM chain c JOIN following f ON c.event_type = f.event_type AND c.closing = f.n)
SELECT m.event_type, m.event_id,
  coalesce(CAST(sum(CASE WHEN c.closing IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY m.event_type ORDER BY m.n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS batch_no
FROM numbered m LEFT JOIN chain c ON c.event_type = m.event_type AND c.closing = m.n"""


class _Flaky:
    """Processor (G1) that fails on the first try of every batch, and on every try of the batch it cannot take."""

    def __init__(self, write, dead_batch):
        self.write, self.dead_batch, self.tried = write, dead_batch, set()

    def __call__(self, rows, batch_id):
        if batch_id == self.dead_batch:
            raise ValueError("schema mismatch")
        if batch_id not in self.tried:
            self.tried.add(batch_id)
            raise TimeoutError("timed out")
        self.write(rows, batch_id)


def guarded_sink(spark, sf_dir):
    """Batches whose first write times out are tried again; one with a fatal error is not, and goes to the dead letters. Messages, tries and errors by how their batch ended."""
    folder = shared_folder(spark, "guarded")
    route = Route("SOURCE_G", "TARGET_G", "ns0", "guarded", "$Default", "lake", "ingest")
    lake = Lake(f"{folder}/lake")
    stream = _messages(_replayed(spark, sf_dir, folder, files=4))
    sink = RouteSink(route, lake, retry=triaged_retry(3, sleep=lambda seconds: None), on_failure="dead_letter")
    sink.processor = _Flaky(sink.write_target, dead_batch=2)
    wait_all([start_route(stream, sink)])
    landed = read_landed(spark, lake, route).select(F.lit(True).alias("success"), "event_body", "sequence_number")
    letters = spark.read.parquet(lake.dead_letters(route)).select(F.lit(False).alias("success"), F.col("body").alias("event_body"), "sequence_number")
    audit = read_table(spark, lake.audit, schemas.BATCH_AUDIT).groupBy("success").agg(F.count("*").alias("batches"), F.max("attempts").alias("attempts"), F.max("error").alias("error"))
    noted = read_table(spark, lake.failures, schemas.FAILURES).withColumn("success", F.col("error_type") == "TimeoutError").groupBy("success").agg(F.count("*").alias("failures"))
    return landed.unionByName(letters).join(F.broadcast(audit), "success").join(F.broadcast(noted), "success")


GUARDED_SINK = """
WITH bounds AS (SELECT min(event_id) AS low, max(event_id) AS high FROM events),
placed AS (SELECT *, floor((event_id - low) * 4 / (high - low + 1)::DOUBLE) <> 2 AS success FROM events, bounds)
SELECT success, concat(event_type, ' ', props) AS event_body, event_id AS sequence_number, CASE WHEN success THEN 3 ELSE 1 END::BIGINT AS batches,
  CASE WHEN success THEN 2 ELSE 1 END AS attempts, CASE WHEN success THEN NULL ELSE 'schema mismatch' END AS error,
  CASE WHEN success THEN 3 ELSE 1 END::BIGINT AS failures FROM placed"""


def stream_partitions(spark, sf_dir):
    """A partitioned source read by offsets, at most a quarter of it in a micro-batch, stopped and restarted after three partitions have grown and a fourth has appeared."""
    folder = shared_folder(spark, "partitions")
    route = Route("SOURCE_P", "TARGET_P", "ns0", "partitions", "$Default", "lake", "ingest")
    lake = Lake(f"{folder}/lake")
    messages = _messages(I.table(spark, sf_dir, "events"))
    low, high = messages.agg(F.min("sequence_number"), F.max("sequence_number")).first()
    low, high = low or 0, high or 0
    late = F.col("sequence_number") > F.lit((low + high) // 2)
    for arrived in (~late & (F.col("partition_id") != "3"), late):
        write_partitioned(messages.filter(arrived), f"{folder}/in", span=max(1, (high - low) // 10))
        stream = partitioned_stream(spark, f"{folder}/in", lake.checkpoint(route), max_messages=high - low + 1)
        drain(start_route(stream, RouteSink(route, lake), every="0 seconds"))
    rows = read_landed(spark, lake, route).select("event_body", "partition_id", "sequence_number", "enqueued_time")
    reached = C.typed_metadata(read_control(spark, lake, route)).groupBy("partition_id").agg(F.max("sequence_number").alias("reached"))
    return rows.join(F.broadcast(reached), "partition_id")


STREAM_PARTITIONS = """
SELECT concat(event_type, ' ', props) AS event_body, CAST(user_id % 4 AS VARCHAR) AS partition_id, event_id AS sequence_number,
  ts AS enqueued_time, max(event_id) OVER (PARTITION BY user_id % 4) AS reached FROM events
WHERE user_id % 4 <> 3 OR event_id > (SELECT (min(event_id) + max(event_id)) // 2 FROM events)"""


class _DyingSink(RouteSink):
    """Dies in its fourth micro-batch, between the target rows and the control rows."""

    def write_control(self, messages, batch_id):
        if batch_id == 3:
            raise RuntimeError("crash before the control rows")
        return super().write_control(messages, batch_id)


def landed_resume(spark, sf_dir):
    """What readers see of a run that dies in its fourth micro-batch, and, after it was merged, restarted and merged again, what lies beyond resume points."""
    folder = shared_folder(spark, "landed")
    route = Route("SOURCE_L", "TARGET_L", "ns0", "landed", "$Default", "lake", "ingest")
    lake = Lake(f"{folder}/lake")
    stream = _messages(_replayed(spark, sf_dir, folder, files=6))
    try:
        wait_all([start_route(stream, _DyingSink(route, lake))])
    except StreamingQueryException as error:
        if "crash before the control rows" not in str(error):
            raise
    manifest = Manifest(spark, lake, route)
    wanted = ["event_body", "partition_id", "sequence_number", "enqueued_time"]
    seen = written(read_landed(spark, lake, route).select(F.lit("crash").alias("seen"), *wanted), "seen")
    manifest.compact(file_messages=1000)
    wait_all([start_route(stream, RouteSink(route, lake))])
    manifest.compact(file_messages=1000)
    manifest.expire()
    points = read_control(spark, lake, route).groupBy("partition_id").agg(F.max(metadata_field(F.col("metadata"), "sequence_number").cast("bigint")).alias("last"))
    half = points.select("partition_id", F.expr("last div 2").alias("sequence_number"))
    return seen.unionByName(read_landed(spark, lake, route, after=half).select(F.lit("resume").alias("seen"), *wanted))


LANDED_RESUME = """
WITH bounds AS (SELECT min(event_id) AS low, max(event_id) AS high FROM events),
points AS (SELECT user_id % 4 AS p, max(event_id) // 2 AS reached FROM events GROUP BY 1),
landed AS (SELECT concat(event_type, ' ', props) AS event_body, CAST(user_id % 4 AS VARCHAR) AS partition_id, event_id AS sequence_number,
  ts AS enqueued_time, user_id % 4 AS p FROM events)
SELECT 'crash' AS seen, event_body, partition_id, sequence_number, enqueued_time FROM landed, bounds
WHERE floor((sequence_number - low) * 6 / (high - low + 1)::DOUBLE) < 3
UNION ALL SELECT 'resume', event_body, partition_id, sequence_number, enqueued_time FROM landed JOIN points USING (p) WHERE sequence_number > reached"""


def stream_ticker(spark, sf_dir):
    """Batches of 200 streams closed by size (4 messages), age (a day) or a tick (every six hours), replayed on event time."""
    folder = shared_folder(spark, "ticker")
    events = _replayed(spark, sf_dir, folder, files=6).withColumn("stream", F.concat_ws("-", "event_type", (F.col("user_id") % 40).cast("string")))
    closed = closed_batches(events, ["stream"], "event_id", "ts", size=4, max_wait_seconds=86400, tick_seconds=21600)
    started = closed.writeStream.format("parquet").option("path", f"{folder}/closed").option("checkpointLocation", f"{folder}/checkpoint")
    wait_all([started.trigger(availableNow=True).start()])
    return read_table(spark, f"{folder}/closed", closed.schema)


# Message by message: a tick that is due closes the open batch before the message, then the message joins the batch and may close it.
_DUE = "make_timestamp(CAST(ceil(epoch_us(opened + INTERVAL 1 DAY) / 21600000000::DOUBLE) AS BIGINT) * 21600000000::BIGINT)"
STREAM_TICKER = f"""WITH RECURSIVE numbered AS MATERIALIZED (
  SELECT concat_ws('-', event_type, user_id % 40) AS stream, event_id, ts AS t,
    row_number() OVER (PARTITION BY concat_ws('-', event_type, user_id % 40) ORDER BY event_id) AS n FROM events),
chain AS (
  SELECT stream, 0::BIGINT AS n, min(t) AS opened, 0::BIGINT AS pending, -1::BIGINT AS batch_no, 0::BIGINT AS next_no, NULL::TIMESTAMP AS opened_at,
    NULL::TIMESTAMP AS closed_at, NULL::VARCHAR AS closed_by, NULL::TIMESTAMP AS ticked_at FROM numbered GROUP BY stream
  UNION ALL
  SELECT stream, n, CASE WHEN closed_by IS NOT NULL THEN t ELSE begun END, CASE WHEN closed_by IS NOT NULL THEN 0 ELSE held + 1 END, no,
    CASE WHEN closed_by IS NOT NULL THEN no + 1 ELSE no END, begun, CASE WHEN closed_by IS NOT NULL THEN t END, closed_by, ticked_at
  FROM (
    SELECT *, CASE WHEN held + 1 >= 4 THEN 'size' WHEN t >= begun + INTERVAL 1 DAY THEN 'age' END AS closed_by
    FROM (
      SELECT c.stream, m.n, m.t, CASE WHEN c.pending > 0 AND {_DUE} <= m.t THEN {_DUE} END AS ticked_at,
        coalesce(CASE WHEN c.pending > 0 AND {_DUE} <= m.t THEN {_DUE} END, c.opened) AS begun,
        CASE WHEN c.pending > 0 AND {_DUE} <= m.t THEN 0 ELSE c.pending END AS held,
        CASE WHEN c.pending > 0 AND {_DUE} <= m.t THEN c.next_no + 1 ELSE c.next_no END AS no
      FROM chain c JOIN numbered m ON c.stream = m.stream AND m.n = c.n + 1) AS told) AS judged),
told AS (SELECT c.*, m.event_id, lead(c.ticked_at) OVER (PARTITION BY c.stream ORDER BY c.n) AS next_tick, c.n = max(c.n) OVER (PARTITION BY c.stream) AS is_last
  FROM chain c JOIN numbered m ON c.stream = m.stream AND c.n = m.n),
ended AS (
  SELECT *, CASE WHEN is_last AND pending > 0 AND {_DUE} < (SELECT date_trunc('milliseconds', max(ts)) FROM events) THEN {_DUE} ELSE next_tick END AS tick_close FROM told)
SELECT stream, batch_no, count(*) AS messages, min(event_id) AS first_arrival, max(event_id) AS last_arrival, min(opened_at) AS opened_at,
  coalesce(max(closed_at), max(tick_close)) AS closed_at, coalesce(max(closed_by), CASE WHEN max(tick_close) IS NOT NULL THEN 'tick' END) AS closed_by
FROM ended GROUP BY stream, batch_no HAVING coalesce(max(closed_at), max(tick_close)) IS NOT NULL"""


# Deliveries of the deduplicated stream.
BATCHES = 5


def stream_dedup(spark, sf_dir):
    """X11: every message delivered twice, a third of them five times, in micro-batches of no order; one copy of each lands."""
    events = I.table(spark, sf_dir, "events")
    folder = shared_folder(spark, "dedup")
    copies = F.when(F.col("sequence_number") % 3 == 0, F.sequence(F.lit(1), F.lit(5))).otherwise(F.sequence(F.lit(1), F.lit(2)))
    delivered = _messages(events).drop("properties").select("*", F.explode(copies).alias("delivery"))
    batch = F.pmod(F.xxhash64("sequence_number", "delivery"), F.lit(BATCHES))

    def land(rows, batch_id):
        rows.drop("delivery").write.mode("overwrite").parquet(f"{folder}/rows/batch_id={batch_id}")

    checkpoint = f"{folder}/checkpoint"
    sink = Deduplicated(f"{folder}/keys", checkpoint, land, "enqueued_time", "1 hour")
    # Five deliveries, a micro-batch each. Copies of a message lie in different ones, and so do early and late times. Each is written
    # by the tasks that read the events, so none of them grows with a delivery.
    for n in range(BATCHES):
        delivered.filter(batch == n).write.mode("append").parquet(f"{folder}/delivered")
        stream = file_stream(spark, f"{folder}/delivered", delivered.schema)
        wait_all([stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()])
    return read_table(spark, f"{folder}/rows", delivered.drop("delivery").schema)


STREAM_DEDUP = """
SELECT concat(event_type, ' ', props) AS body, CAST(user_id % 4 AS VARCHAR) AS partition_id, event_id AS sequence_number,
  CASE WHEN event_id % 11 = 0 THEN 'invalid' ELSE CAST(event_id * 64 AS VARCHAR) END AS offset, ts AS enqueued_time FROM events"""


QUERIES = {
    "stream_batches": (stream_batches, STREAM_BATCHES),
    "fan_out_replay": (fan_out_replay, FAN_OUT_REPLAY),
    "guarded_sink": (guarded_sink, GUARDED_SINK),
    "landed_resume": (landed_resume, LANDED_RESUME),
    "stream_partitions": (stream_partitions, STREAM_PARTITIONS),
    "stream_ticker": (stream_ticker, STREAM_TICKER),
    "stream_replay": (stream_replay, STREAM_REPLAY),
    "stream_dedup": (stream_dedup, STREAM_DEDUP),
    "stream_target": (stream_target, STREAM_TARGET),
    "stream_resume": (stream_resume, STREAM_RESUME),
    "stream_audit": (stream_audit, STREAM_AUDIT),
}
