"""Queries that cut streams into batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import batching as B
from tidemark.operators.age_batches import batches_by_size_or_age
from tidemark.operators.joins import lookup_join
from tidemark.operators.running import arrival_order
from tidemark.plans import inputs as I


def batches_by_size(spark, sf_dir):
    """W3, X1"""
    return I.batched(spark, sf_dir).select("eventhub", "arrival", "message_no", "batch_no")


BATCHES_BY_SIZE = f"WITH {I.BATCHED} SELECT eventhub, arrival, message_no, batch_no FROM batched"


def batches_by_route_size(spark, sf_dir):
    """Every stream has the batch size of its target."""
    sources = I.sources(spark, sf_dir).select("route_no", F.col("name").alias("eventhub"))
    sizes = sources.join(I.targets(spark, sf_dir).select("route_no", "batch_size"), "route_no")
    routed = lookup_join(I.valid_messages(spark, sf_dir), sizes, ["eventhub"], "inner", "sequence_number")
    small = routed.withColumn("size", F.expr("batch_size div 20"))
    return B.batches_by_size(small, ["eventhub"], size="size").select("eventhub", "arrival", "size", "batch_no")


BATCHES_BY_ROUTE_SIZE = f"""WITH {I.MESSAGES}, {I.ROUTES}
SELECT eventhub, arrival, size, (row_number() OVER (PARTITION BY eventhub ORDER BY arrival) - 1) // size AS batch_no
FROM (SELECT v.eventhub, v.arrival, t.batch_size // 20 AS size
      FROM valid v JOIN sources s ON v.eventhub = s.name JOIN all_targets t ON s.route_no = t.route_no)"""


def batch_argmax(spark, sf_dir):
    """A2, P7"""
    return B.batch_waterlevels(I.batched(spark, sf_dir), ["eventhub", "batch_no", "partition_id"])


def _ranked(order):
    return f"""(SELECT *, row_number() OVER (PARTITION BY eventhub, batch_no, partition_id ORDER BY {order}) AS r
  FROM batched) WHERE r = 1"""


BATCH_ARGMAX = f"""WITH {I.BATCHED}
SELECT eventhub, batch_no, partition_id, sequence_number, "offset",
  coalesce(TRY_CAST("offset" AS BIGINT), sequence_number) AS waterlevel
FROM {_ranked("sequence_number DESC, arrival")}"""


def batch_last_arrival(spark, sf_dir):
    """A3"""
    by = ["eventhub", "batch_no", "partition_id"]
    return B.last_arrivals(I.batched(spark, sf_dir), by, ["sequence_number"])


BATCH_LAST_ARRIVAL = f"""WITH {I.BATCHED}
SELECT eventhub, batch_no, partition_id, sequence_number FROM {_ranked("arrival DESC")}"""


def first_messages(spark, sf_dir):
    """A4, U2"""
    by = ["eventhub", "partition_id"]
    return B.first_arrivals(I.messages(spark, sf_dir), by, ["offset", "sequence_number", "enqueued_time"])


FIRST_MESSAGES = f"""WITH {I.MESSAGES}
SELECT eventhub, partition_id, "offset", sequence_number, enqueued_time FROM (
  SELECT *, row_number() OVER (PARTITION BY eventhub, partition_id ORDER BY arrival) AS r FROM messages) WHERE r = 1"""


def batches_size_or_age(spark, sf_dir):
    """At most 50 messages or six hours, per stream."""
    cut = batches_by_size_or_age(
        I.messages(spark, sf_dir), ["eventhub"], "event_id", "enqueued_time", size=50, max_wait_seconds=6 * 3600
    )
    return cut.drop("opens_next")


BATCHES_SIZE_OR_AGE = f"""WITH RECURSIVE {I.MESSAGES},
numbered AS (SELECT eventhub, event_id, enqueued_time AS t,
    row_number() OVER (PARTITION BY eventhub ORDER BY event_id) AS n FROM messages),
opened AS (SELECT eventhub, n, t, t + INTERVAL 6 HOUR AS due FROM numbered
  UNION ALL SELECT eventhub, 0 AS n, min(t) AS t, min(t) + INTERVAL 6 HOUR AS due FROM numbered GROUP BY eventhub),
following AS (SELECT o.eventhub, o.n, least(o.n + 50, coalesce(d.n, o.n + 50)) AS closing
  FROM opened o ASOF LEFT JOIN numbered d ON o.eventhub = d.eventhub AND o.due <= d.t),
chain AS (SELECT eventhub, closing FROM following WHERE n = 0
  UNION ALL SELECT f.eventhub, f.closing FROM chain c JOIN following f ON c.eventhub = f.eventhub AND c.closing = f.n)
SELECT m.eventhub, m.event_id, m.n AS message_no,
  coalesce(CAST(sum(CASE WHEN c.closing IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY m.eventhub ORDER BY m.n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS batch_no
FROM numbered m LEFT JOIN chain c ON c.eventhub = m.eventhub AND c.closing = m.n"""


def replay_dedup(spark, sf_dir):
    """Every message delivered twice, and a third of them three times more."""
    valid = I.valid_messages(spark, sf_dir)
    later = F.col("arrival") + F.lit(10**12)
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2), F.lit(3), F.lit(4))).otherwise(F.array(F.lit(1)))
    again = valid.withColumn("copy", F.explode(copies)).withColumn("arrival", later * F.col("copy")).drop("copy")
    kept = B.drop_redelivered(valid.unionByName(again), ["eventhub", "partition_id", "sequence_number"])
    return kept.select("eventhub", "partition_id", "sequence_number", "offset", "body", "arrival")


REPLAY_DEDUP = f"""WITH {I.MESSAGES},
delivered AS (SELECT eventhub, partition_id, sequence_number, "offset", body, arrival FROM valid
  UNION ALL SELECT eventhub, partition_id, sequence_number, "offset", body, (arrival + 1000000000000) * copy
  FROM valid, (SELECT unnest([1, 2, 3, 4]) AS copy) WHERE copy = 1 OR event_id % 3 = 0)
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (
  PARTITION BY eventhub, partition_id, sequence_number ORDER BY arrival) AS r FROM delivered) WHERE r = 1"""


def arrival_batches(spark, sf_dir):
    """Orders carry no arrival number and many share a date."""
    ordered = arrival_order(
        I.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), ["o_orderdate", "o_orderkey"]
    )
    return B.batches_by_size(ordered, ["o_orderstatus"]).select("o_orderkey", "o_orderstatus", "message_no", "batch_no")


ARRIVAL_BATCHES = """
SELECT o_orderkey, o_orderstatus, message_no, (message_no - 1) // 1000 AS batch_no FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS message_no FROM orders)"""


QUERIES = {
    "batches_by_size": (batches_by_size, BATCHES_BY_SIZE),
    "batches_by_route_size": (batches_by_route_size, BATCHES_BY_ROUTE_SIZE),
    "batch_argmax": (batch_argmax, BATCH_ARGMAX),
    "batch_last_arrival": (batch_last_arrival, BATCH_LAST_ARRIVAL),
    "first_messages": (first_messages, FIRST_MESSAGES),
    "batches_size_or_age": (batches_size_or_age, BATCHES_SIZE_OR_AGE),
    "replay_dedup": (replay_dedup, REPLAY_DEDUP),
    "arrival_batches": (arrival_batches, ARRIVAL_BATCHES),
}
