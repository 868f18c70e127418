"""Audit, statistics, health, failure triage and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import audit as A
from tidemark.operators import failures as T
from tidemark.plans import inputs as I


def batch_audit(spark, sf_dir):
    """A13, with running totals"""
    return A.with_totals(I.batch_audit(spark, sf_dir), ["mapping"])


BATCH_AUDIT = f"""WITH {I.AUDIT}
SELECT *, CAST(sum(messages * CAST(success AS BIGINT)) OVER w AS BIGINT) AS total_messages,
  CAST(sum(CAST(success AS BIGINT)) OVER w AS BIGINT) AS total_batches
FROM audit WINDOW w AS (PARTITION BY mapping ORDER BY batch_id)"""

TOTALS = """CAST(coalesce(sum(messages) FILTER (WHERE success), 0) AS BIGINT) AS messages_processed,
  count(*) FILTER (WHERE success) AS batches_processed, count(*) FILTER (WHERE NOT success) AS batches_failed,
  min(started) AS started_at, max(ended) FILTER (WHERE success) AS last_activity,
  (epoch_us(max(ended)) - epoch_us(min(started))) / 1000000.0 AS runtime_seconds"""


def _rate(count):
    return f"CASE WHEN runtime_seconds > 0 THEN round({count} / runtime_seconds, 6) ELSE 0.0 END"


def mapping_stats(spark, sf_dir):
    """A5, A6, A7"""
    return A.mapping_stats(I.batch_audit(spark, sf_dir))


MAPPING_STATS = f"""WITH {I.AUDIT}, totals AS (SELECT mapping, {TOTALS} FROM audit GROUP BY mapping)
SELECT * REPLACE (CAST(runtime_seconds AS DOUBLE) AS runtime_seconds),
  CAST({_rate("messages_processed")} AS DOUBLE) AS messages_per_second FROM totals"""


def mapping_errors(spark, sf_dir):
    """A7"""
    return A.mapping_errors(I.batch_audit(spark, sf_dir))


MAPPING_ERRORS = f"WITH {I.AUDIT} SELECT mapping, batch_id, ended AS ts, error FROM audit WHERE NOT success"


def route_rollup(spark, sf_dir):
    """A8"""
    return A.stats_rollup(I.batch_audit(spark, sf_dir))


ROUTE_ROLLUP = f"""WITH {I.AUDIT}, totals AS (SELECT mapping, {TOTALS} FROM audit GROUP BY ROLLUP (mapping))
SELECT * REPLACE (CAST(runtime_seconds AS DOUBLE) AS runtime_seconds),
  CAST({_rate("messages_processed")} AS DOUBLE) AS messages_per_second,
  CAST({_rate("batches_processed")} AS DOUBLE) AS batches_per_second FROM totals"""


def health_rollup(spark, sf_dir):
    """One status per supplier."""
    status = "CASE WHEN s_acctbal < 0 THEN 'failed' WHEN s_nationkey % 5 = 0 THEN 'stopped' ELSE 'running' END AS status"
    return A.health_rollup(I.table(spark, sf_dir, "supplier").selectExpr(status))


HEALTH_ROLLUP = """
SELECT count(*) AS total_mappings, count(*) FILTER (WHERE s_acctbal >= 0 AND s_nationkey % 5 <> 0) AS healthy_mappings
FROM supplier"""


def trace_filter(spark, sf_dir):
    """failed batches that took longer than four hours."""
    return A.trace_filter(I.batch_audit(spark, sf_dir), success=False, slower_than_ms=4 * 3600 * 1000)


TRACE_FILTER = f"""WITH {I.AUDIT}
SELECT *, CAST((epoch_us(ended) - epoch_us(started)) / 1000.0 AS DOUBLE) AS duration_ms FROM audit
WHERE NOT success AND epoch_us(ended) - epoch_us(started) > 14400000000"""


def partition_trace(spark, sf_dir):
    """What each batch held of one partition."""
    facts = A.audit_batches(I.batched(spark, sf_dir), ["eventhub", "batch_no", "partition_id"])
    return A.trace_filter(facts, partition="0").drop("partitions")


PARTITION_TRACE = f"""WITH {I.BATCHED}
SELECT eventhub, batch_no, partition_id, min(enqueued_time) AS started, max(enqueued_time) AS ended, count(*) AS messages,
  CAST((epoch_us(max(enqueued_time)) - epoch_us(min(enqueued_time))) / 1000.0 AS DOUBLE) AS duration_ms
FROM batched WHERE partition_id = '0' GROUP BY ALL"""


def checkpoint_success(spark, sf_dir):
    """A14"""
    return A.checkpoint_success_rates(I.batch_audit(spark, sf_dir), ["mapping"])


CHECKPOINT_SUCCESS = f"""WITH {I.AUDIT}
SELECT mapping, CAST(sum(partitions) AS BIGINT) AS partitions, CAST(sum(checkpoints_updated) AS BIGINT) AS checkpoints_updated,
  round(sum(checkpoints_updated) / sum(partitions), 6) AS checkpoint_success_rate FROM audit GROUP BY mapping"""


def throughput_windows(spark, sf_dir):
    """A14"""
    return A.throughput(I.messages(spark, sf_dir), "enqueued_time", "1 hour", ["eventhub"])


THROUGHPUT_WINDOWS = f"""WITH {I.MESSAGES}
SELECT date_trunc('hour', enqueued_time) AS window_start, eventhub, count(*) AS messages FROM messages GROUP BY ALL"""


def error_rate(spark, sf_dir):
    """A14"""
    return A.error_rates(I.messages(spark, sf_dir), ["eventhub"], F.col("body") == "error")


ERROR_RATE = f"""WITH {I.MESSAGES}
SELECT eventhub, count(*) AS total, count(*) FILTER (WHERE body = 'error') AS errors,
  round(avg(CASE WHEN body = 'error' THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM messages GROUP BY eventhub"""


def latency_percentiles(spark, sf_dir):
    """A14"""
    exact = A.latency_percentiles(I.messages(spark, sf_dir), ["eventhub"], "value")
    return exact.select("eventhub", *[F.round(p, 6).alias(p) for p in A.LATENCY_PERCENTILES])


LATENCY_PERCENTILES = f"""WITH {I.MESSAGES}
SELECT eventhub, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99 FROM messages GROUP BY eventhub"""


def error_triage(spark, sf_dir):
    """F5, P14, P15"""
    return I.failures(spark, sf_dir).select(
        "event_id",
        T.error_kind(F.col("message")).alias("kind"),
        X.error_signature(F.col("error_type"), F.col("message")).alias("signature"),
        X.truncated(F.col("message"), 100).alias("sample"),
        T.lacks_permission(F.concat("error_type", F.lit(" "), "message")).alias("lacks_permission"),
    )


ERROR_TRIAGE = f"""WITH {I.FAILURES}
SELECT event_id, signature, left(message, 100) AS sample,
  CASE WHEN regexp_matches(lower(message), '{"|".join(T.CREDENTIAL_KEYWORDS)}') THEN 'credential'
    WHEN regexp_matches(lower(message), '{"|".join(T.PERMISSION_KEYWORDS)}') THEN 'permission' ELSE 'other' END AS kind,
  regexp_matches(lower(concat(error_type, ' ', message)), '{"|".join(T.RUN_PERMISSION_KEYWORDS)}') AS lacks_permission
FROM signed"""


def failure_decisions(spark, sf_dir):
    """X9, J7"""
    decided = T.classify_failures(I.failures(spark, sf_dir), spread="event_id")
    return decided.select("event_id", "signature", "should_retry", "reasoning", "suggested_wait_seconds", "confidence")


FAILURE_DECISIONS = f"""WITH {I.DECISIONS}
SELECT event_id, signature, should_retry, reasoning, CAST(suggested_wait_seconds AS BIGINT) AS suggested_wait_seconds,
  confidence FROM signed JOIN decided USING (signature)"""


def triage_rules(spark, sf_dir):
    """Failures judged by a table of one rule for each customer's key, before the built-in ones."""
    customers = I.table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS priority",
        """concat('"k": ', c_custkey, '\\\\}$') AS pattern""",
        "c_custkey % 2 = 1 AS should_retry",
        "0.5D AS confidence",
        "concat('customer ', c_custkey) AS reasoning",
        "c_custkey % 30 AS suggested_wait_seconds",
    )
    rules = customers.unionByName(T.rule_table(spark, first=1 << 40))
    decided = T.classify_failures(I.failures(spark, sf_dir), rules=rules, spread="event_id")
    return decided.select("event_id", "signature", "should_retry", "reasoning", "suggested_wait_seconds", "confidence")


TRIAGE_RULES = f"""WITH {I.DECISIONS},
first AS (SELECT signature, arg_min(message, (ts, message)) AS message FROM signed GROUP BY signature),
judged AS (
  SELECT d.signature, c_custkey, coalesce(c_custkey % 2 = 1, d.should_retry) AS should_retry, coalesce(concat('customer ', c_custkey), reasoning) AS reasoning,
    CAST(coalesce(c_custkey % 30, suggested_wait_seconds) AS BIGINT) AS suggested_wait_seconds,
    CASE WHEN c_custkey IS NULL THEN confidence ELSE 0.5::DOUBLE END AS confidence
  FROM decided d JOIN first USING (signature) LEFT JOIN customer ON c_custkey = TRY_CAST(regexp_extract(message, '"k": (\\d+)\\}}$', 1) AS BIGINT))
SELECT event_id, signature, should_retry, reasoning, suggested_wait_seconds, confidence FROM signed JOIN judged USING (signature)"""


def decision_stats(spark, sf_dir):
    """A12"""
    return T.decision_stats(I.failures(spark, sf_dir))


DECISION_STATS = f"""WITH {I.DECISIONS}
SELECT count(*) AS analyses, count(*) AS cached_decisions, CAST(sum(occurrences) - count(*) AS BIGINT) AS cache_hits,
  CAST(sum(occurrences) FILTER (WHERE should_retry) AS BIGINT) AS retry_decisions,
  CAST(sum(occurrences) FILTER (WHERE NOT should_retry) AS BIGINT) AS stop_decisions,
  round(sum(confidence * occurrences) / sum(occurrences), 6) AS average_confidence,
  round((sum(occurrences) - count(*)) / sum(occurrences), 6) AS hit_rate FROM decided"""


QUERIES = {
    "batch_audit": (batch_audit, BATCH_AUDIT),
    "mapping_stats": (mapping_stats, MAPPING_STATS),
    "mapping_errors": (mapping_errors, MAPPING_ERRORS),
    "route_rollup": (route_rollup, ROUTE_ROLLUP),
    "health_rollup": (health_rollup, HEALTH_ROLLUP),
    "trace_filter": (trace_filter, TRACE_FILTER),
    "partition_trace": (partition_trace, PARTITION_TRACE),
    "checkpoint_success": (checkpoint_success, CHECKPOINT_SUCCESS),
    "throughput_windows": (throughput_windows, THROUGHPUT_WINDOWS),
    "error_rate": (error_rate, ERROR_RATE),
    "latency_percentiles": (latency_percentiles, LATENCY_PERCENTILES),
    "error_triage": (error_triage, ERROR_TRIAGE),
    "failure_decisions": (failure_decisions, FAILURE_DECISIONS),
    "triage_rules": (triage_rules, TRIAGE_RULES),
    "decision_stats": (decision_stats, DECISION_STATS),
}
