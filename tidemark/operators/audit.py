"""Batch audit rows and the statistics, health and dashboard views over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.percentiles import exact_percentiles
from tidemark.operators.running import running_totals
from tidemark.session import cut_lineage

LATENCY_PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def audit_batches(batched: DataFrame, by: list[str], time: str = "enqueued_time") -> DataFrame:
    """Facts of each batch: size, partitions, first and last message time."""
    return batched.groupBy(*by).agg(
        F.min(time).alias("started"),
        F.max(time).alias("ended"),
        F.count("*").alias("messages"),
        F.count_distinct("partition_id").alias("partitions"),
    )


def with_totals(audit: DataFrame, by: list[str], order: str = "batch_id") -> DataFrame:
    """Running totals of messages and batches that succeeded, per mapping."""
    audit = cut_lineage(audit)  # small beside the messages it was made of, and read twice below
    ok = F.col("success").cast("bigint")
    return running_totals(audit, by, order, {"total_messages": F.col("messages") * ok, "total_batches": ok})


def runtime_seconds(started: Column, ended: Column) -> Column:
    return (unix_micros(ended) - unix_micros(started)) / F.lit(1_000_000.0)


def unix_micros(time: Column) -> Column:
    """Microseconds between 1970 and a zone-free timestamp, whatever the session time zone is."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), time)


def rate(count: Column, seconds: Column) -> Column:
    """Count per second; 0.0 when no time has passed."""
    return F.when(seconds > 0, F.round(count / seconds, 6)).otherwise(F.lit(0.0))


def _totals() -> list[Column]:
    ok = F.col("success")
    return [
        F.coalesce(F.sum(F.when(ok, F.col("messages"))), F.lit(0)).alias("messages_processed"),
        F.count_if(ok).alias("batches_processed"),
        F.count_if(~ok).alias("batches_failed"),
        F.min("started").alias("started_at"),
        F.max(F.when(ok, F.col("ended"))).alias("last_activity"),
        runtime_seconds(F.min("started"), F.max("ended")).alias("runtime_seconds"),
    ]


def mapping_stats(audit: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals and rate of each mapping."""
    return (
        audit.groupBy(*(by or ["mapping"]))
        .agg(*_totals())
        .withColumn("messages_per_second", rate(F.col("messages_processed"), F.col("runtime_seconds")))
    )


def mapping_errors(audit: DataFrame) -> DataFrame:
    """Every error with its time and mapping (A7). Rows, not a list per mapping: errors are unbounded."""
    return audit.filter(~F.col("success")).select("mapping", "batch_id", F.col("ended").alias("ts"), "error")


def stats_rollup(audit: DataFrame) -> DataFrame:
    """Mapping totals plus one row, with NULL mapping, for all of them."""
    seconds = F.col("runtime_seconds")
    return (
        audit.rollup("mapping")
        .agg(*_totals())
        .withColumn("messages_per_second", rate(F.col("messages_processed"), seconds))
        .withColumn("batches_per_second", rate(F.col("batches_processed"), seconds))
    )


def health_rollup(statuses: DataFrame) -> DataFrame:
    """Mappings in all and those whose status is running."""
    return statuses.agg(
        F.count("*").alias("total_mappings"), F.count_if(F.col("status") == "running").alias("healthy_mappings")
    )


def duration_ms(started: Column, ended: Column) -> Column:
    return (unix_micros(ended) - unix_micros(started)) / F.lit(1000.0)


def trace_filter(
    audit: DataFrame,
    success: bool | None = None,
    slower_than_ms: float | None = None,
    mapping: str | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Audit rows by outcome, duration, mapping and, for rows per partition, the partition."""
    rows = audit.withColumn("duration_ms", duration_ms(F.col("started"), F.col("ended")))
    if success is not None:
        rows = rows.filter(F.col("success") == success)
    if slower_than_ms is not None:
        rows = rows.filter(F.col("duration_ms") > slower_than_ms)
    if mapping is not None:
        rows = rows.filter(F.col("mapping") == mapping)
    if partition is not None:
        rows = rows.filter(F.col("partition_id") == partition)
    return rows


def throughput(messages: DataFrame, time: str, every: str, by: list[str] | None = None) -> DataFrame:
    """Messages per time window."""
    return (
        messages.groupBy(F.window(time, every).alias("_w"), *(by or []))
        .agg(F.count("*").alias("messages"))
        .select(F.col("_w.start").alias("window_start"), *(by or []), "messages")
    )


def error_rates(rows: DataFrame, by: list[str], is_error: Column) -> DataFrame:
    """Share of rows that are errors, per component."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if(is_error).alias("errors"),
        F.round(F.avg(F.when(is_error, 1.0).otherwise(0.0)), 6).alias("error_rate"),
    )


def checkpoint_success_rates(audit: DataFrame, by: list[str]) -> DataFrame:
    """Share of the partitions seen whose waterlevel was saved."""
    return audit.groupBy(*by).agg(
        F.sum("partitions").alias("partitions"),
        F.sum("checkpoints_updated").alias("checkpoints_updated"),
        F.round(F.sum("checkpoints_updated") / F.sum("partitions"), 6).alias("checkpoint_success_rate"),
    )


def latency_percentiles(rows: DataFrame, by: list[str], latency: str, **options) -> DataFrame:
    """Exact p50, p95 and p99 per component."""
    return exact_percentiles(rows, by, latency, LATENCY_PERCENTILES, **options)
