"""Streams, control log, routes and failures derived from the test tables.

Each input exists twice, as a DataFrame and as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit as A
from tidemark.operators.batching import batches_by_size
from tidemark.session import configure

BATCH = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of 30 streams, one of which holds a third of them.

    Some offsets are no numbers and some sequence numbers are missing. Arrival swaps neighbours,
    so the last arrival is not always the highest sequence number.
    """
    hub = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id % 30 END"
    return table(spark, sf_dir, "events").selectExpr(
        f"concat('ns', ({hub}) % 3) AS eventhub_namespace",
        f"concat('nation_', {hub}) AS eventhub",
        "cast(event_id % 4 AS string) AS partition_id",
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id END AS sequence_number",
        """CASE WHEN event_id % 11 = 0 THEN 'invalid' WHEN event_id % 13 = 0 THEN NULL
           ELSE cast(event_id * 64 AS string) END AS offset""",
        "ts AS enqueued_time",
        "event_type AS body",
        "props AS properties",
        "event_id - event_id % 8 + (event_id * 5 + 3) % 8 AS arrival",
        "event_id",
        "value",
    )


MESSAGES = """messages AS (
  SELECT concat('ns', hub_no % 3) AS eventhub_namespace, concat('nation_', hub_no) AS eventhub,
    CAST(event_id % 4 AS VARCHAR) AS partition_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id END AS sequence_number,
    CASE WHEN event_id % 11 = 0 THEN 'invalid' WHEN event_id % 13 = 0 THEN NULL
      ELSE CAST(event_id * 64 AS VARCHAR) END AS "offset",
    ts AS enqueued_time, event_type AS body, props AS properties,
    event_id - event_id % 8 + (event_id * 5 + 3) % 8 AS arrival, event_id, value, hub_no
  FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id % 30 END AS hub_no FROM events)),
valid AS (SELECT * FROM messages WHERE sequence_number IS NOT NULL)"""


def valid_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).filter("sequence_number IS NOT NULL")


def control_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One control row per message of the first 28 streams, half way through their offsets.

    Some rows name no partition, some step back below an earlier waterlevel, and some metadata
    is absent or malformed.
    """
    return (
        messages(spark, sf_dir)
        .filter("eventhub NOT IN ('nation_28', 'nation_29')")
        .selectExpr(
            "enqueued_time AS ts_inserted",
            "eventhub_namespace",
            "eventhub",
            "'lake' AS target_db",
            "'ingest' AS target_schema",
            "eventhub AS target_table",
            "CASE WHEN event_id % 89 = 0 THEN NULL ELSE partition_id END AS partition_id",
            "event_id * 32 - CASE WHEN event_id % 7 = 0 THEN 50000 ELSE 0 END AS waterlevel",
            """CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '{bad'
               ELSE concat('{"sequence_number":', event_id, ',"consumer_group":"group', event_id % 2, '"}') END
               AS metadata""",
        )
    )


CONTROL = f"""{MESSAGES},
control AS (
  SELECT enqueued_time AS ts_inserted, eventhub_namespace, eventhub, 'lake' AS target_db,
    'ingest' AS target_schema, eventhub AS target_table,
    CASE WHEN event_id % 89 = 0 THEN NULL ELSE partition_id END AS partition_id,
    event_id * 32 - CASE WHEN event_id % 7 = 0 THEN 50000 ELSE 0 END AS waterlevel,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '{{bad'
      ELSE concat('{{"sequence_number":', event_id, ',"consumer_group":"group', event_id % 2, '"}}') END AS metadata
  FROM messages WHERE hub_no < 28)"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").alias("n")
    region = table(spark, sf_dir, "region").alias("r")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "concat('SOURCE_', n_nationkey) AS source_key",
        "cast(n_nationkey AS bigint) AS route_no",
        "lower(replace(r_name, ' ', '-')) AS namespace",
        "lower(n_name) AS name",
        "CASE WHEN n_nationkey % 11 = 7 THEN NULL ELSE '$Default' END AS consumer_group",
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('TARGET_', s_suppkey) AS target_key",
        "s_suppkey AS route_no",
        "'lake' AS database",
        "concat('region', s_nationkey % 5) AS schema_name",
        "CASE WHEN s_suppkey % 9 = 4 THEN '' ELSE concat('table_', s_suppkey) END AS table_name",
        "1000 * (1 + s_suppkey % 3) AS batch_size",
    )


ROUTES = """sources AS (
  SELECT concat('SOURCE_', n_nationkey) AS source_key, CAST(n_nationkey AS BIGINT) AS route_no,
    lower(replace(r_name, ' ', '-')) AS namespace, lower(n_name) AS name,
    CASE WHEN n_nationkey % 11 = 7 THEN NULL ELSE '$Default' END AS consumer_group
  FROM nation JOIN region ON n_regionkey = r_regionkey),
all_targets AS (
  SELECT concat('TARGET_', s_suppkey) AS target_key, s_suppkey AS route_no, 'lake' AS database,
    concat('region', s_nationkey % 5) AS schema_name,
    CASE WHEN s_suppkey % 9 = 4 THEN '' ELSE concat('table_', s_suppkey) END AS table_name,
    CAST(1000 * (1 + s_suppkey % 3) AS BIGINT) AS batch_size
  FROM supplier),
targets AS (SELECT * FROM all_targets WHERE table_name <> ''),
routes AS (SELECT *, concat(source_key, '->', target_key) AS mapping FROM sources JOIN targets USING (route_no))"""


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches_by_size(valid_messages(spark, sf_dir), ["eventhub"], size=BATCH)


BATCHED = f"""{MESSAGES},
batched AS (
  SELECT *, (message_no - 1) // {BATCH} AS batch_no FROM (
    SELECT *, row_number() OVER (PARTITION BY eventhub ORDER BY arrival) AS message_no FROM valid))"""


def batch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the batches by size, every fifth of which failed."""
    facts = A.audit_batches(batched(spark, sf_dir), ["eventhub", "batch_no"])
    return facts.selectExpr(
        "concat(eventhub, '->lake') AS mapping",
        "batch_no AS batch_id",
        "started",
        "ended",
        "messages",
        "partitions",
        "batch_no % 5 <> 3 AS success",
        "CASE WHEN batch_no % 5 <> 3 THEN partitions WHEN batch_no % 2 = 0 THEN 1 ELSE 0 END AS checkpoints_updated",
        "CASE WHEN batch_no % 5 = 3 THEN concat('write of batch ', batch_no, ' timed out') END AS error",
    )


AUDIT = f"""{BATCHED},
audit AS (
  SELECT concat(eventhub, '->lake') AS mapping, batch_no AS batch_id, started, ended, messages, partitions,
    batch_no % 5 <> 3 AS success,
    CASE WHEN batch_no % 5 <> 3 THEN partitions WHEN batch_no % 2 = 0 THEN 1 ELSE 0 END AS checkpoints_updated,
    CASE WHEN batch_no % 5 = 3 THEN concat('write of batch ', batch_no, ' timed out') END AS error
  FROM (SELECT eventhub, batch_no, min(enqueued_time) AS started, max(enqueued_time) AS ended,
          count(*) AS messages, count(DISTINCT partition_id) AS partitions
        FROM batched GROUP BY ALL))"""

# Error types and messages that failures are made of.
ERRORS = [
    ("TimeoutError", "Gave up on the broker: timed out while it was rebalancing"),
    ("PermissionError", "The key of this writer has expired, access denied"),
    ("ValueError", "Unexpected marker in the second frame"),
    ("HttpError", "503 Service Unavailable from the ingest endpoint"),
    ("HttpError", "429 Too Many Requests: rate limit reached"),
    ("CatalogError", "Table lake.ingest.events does not exist"),
    ("ConstraintError", "NOT NULL constraint failed on column partition_id"),
    ("DatabaseError", "database is locked by another writer"),
    ("ConnectionError", "Temporary failure in DNS name resolution"),
    ("TokenError", "Failed to retrieve a token from the identity service"),
    ("QuotaError", "Quota exceeded for this workspace"),
    (
        "PoolError",
        "No free slot after waiting for one of the pooled connections of this client; connection pool exhausted",
    ),
]


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as failed writes; messages end with the event's own properties."""
    types = ", ".join(f"'{t}'" for t, _ in ERRORS)
    texts = ", ".join(f"'{m}'" for _, m in ERRORS)
    pick = f"cast(user_id % {len(ERRORS)} + 1 AS int)"
    return (
        table(spark, sf_dir, "events")
        .filter("event_type = 'error'")
        .selectExpr(
            "ts",
            "event_id",
            "concat('component_', user_id % 7) AS operation",
            f"element_at(array({types}), {pick}) AS error_type",
            f"concat(element_at(array({texts}), {pick}), ' ', props) AS message",
        )
    )


FAILURES = f"""failures AS (
  SELECT ts, event_id, concat('component_', user_id % 7) AS operation,
    ([{", ".join(f"'{t}'" for t, _ in ERRORS)}])[user_id % {len(ERRORS)} + 1] AS error_type,
    concat(([{", ".join(f"'{m}'" for _, m in ERRORS)}])[user_id % {len(ERRORS)} + 1], ' ', props) AS message
  FROM events WHERE event_type = 'error'),
signed AS (SELECT *, concat(error_type, ':', left(message, 100)) AS signature FROM failures)"""


# What each error of ERRORS must lead to, written by hand: how its signature starts, retry or not, why, wait and confidence.
DECISIONS = f"""{FAILURES},
expected(start, should_retry, reasoning, suggested_wait_seconds, confidence) AS (VALUES
  ('TimeoutError:', true, 'network timeout', 2, 0.9::DOUBLE),
  ('PermissionError:', false, 'authentication or authorization failure', 2, 0.9),
  ('ValueError:', false, 'no rule matched; stopping for safety', 1, 0.0),
  ('HttpError:503', true, 'service unavailable', 5, 0.9),
  ('HttpError:429', true, 'rate limited', 10, 0.9),
  ('CatalogError:', false, 'resource not found', 2, 0.9),
  ('ConstraintError:', false, 'schema mismatch or constraint violation', 2, 0.9),
  ('DatabaseError:', true, 'resource locked or busy', 2, 0.9),
  ('ConnectionError:', true, 'name resolution failure', 2, 0.9),
  ('TokenError:', false, 'no rule matched; stopping for safety', 1, 0.0),
  ('QuotaError:', false, 'quota exceeded', 2, 0.9),
  ('PoolError:', true, 'connection pool exhausted', 5, 0.9)),
decided AS (
  SELECT signature, occurrences, should_retry, reasoning, suggested_wait_seconds, confidence
  FROM (SELECT signature, count(*) AS occurrences FROM signed GROUP BY signature)
  JOIN expected ON starts_with(signature, start))"""
