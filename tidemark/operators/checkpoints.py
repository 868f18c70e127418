"""The control log: one row per partition and batch, and what it says about where to resume."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.envelope import checkpoint_metadata, is_empty_json, metadata_field, with_columns_of
from tidemark.operators.joins import lookup_join

# Marks of the two ends of a stream.
START_MARKS = {"earliest": "-1", "latest": "@latest"}


@dataclass(frozen=True)
class ControlKey:
    """One stream-to-table mapping in the control log. The consumer group is not part of it."""

    namespace: str
    hub: str
    database: str
    schema: str
    table: str

    def columns(self) -> dict[str, str]:
        values = [self.namespace, self.hub, self.database, self.schema, self.table]
        return dict(zip(schemas.CONTROL_KEY, values, strict=True))


def entries_of(control: DataFrame, key: ControlKey, consumer_group: str | None = None) -> DataFrame:
    """Control rows of one mapping that name a partition (F2).

    Plain equalities, so they reach the Parquet scan. ``consumer_group`` additionally reads the
    group out of the metadata.
    """
    rows = control.filter(F.col("partition_id").isNotNull())
    for name, value in key.columns().items():
        rows = rows.filter(F.col(name) == value)
    if consumer_group is not None:
        rows = rows.filter(metadata_field(F.col("metadata"), "consumer_group") == consumer_group)
    return rows


def resume_points(control: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Highest waterlevel per partition (A1): right whatever the clocks of the writers say.

    ``by`` defaults to the partition; give the key columns as well to resolve all mappings at once.
    """
    by = by or ["partition_id"]
    return control.filter(F.col("partition_id").isNotNull()).groupBy(*by).agg(F.max("waterlevel").alias("waterlevel"))


def latest_points(control: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Waterlevel of the newest row per partition (W1), the older resume rule.

    Differs from ``resume_points`` where a later row holds a lower waterlevel. Of rows with the
    same time, the highest waterlevel counts. An aggregate, so no partition's rows are sorted
    in one task.
    """
    by = by or ["partition_id"]
    return (
        control.filter(F.col("partition_id").isNotNull())
        .groupBy(*by)
        .agg(_newest())
        .select(*by, _newest_time(control).alias("ts_inserted"), _newest_level().alias("waterlevel"))
    )


# Time and waterlevel as one number, ordered by time and then waterlevel, NULL first in both. A hash aggregate keeps a
# decimal in its buffer but no struct, for which it would sort all rows.
LEVELS = 1 << 65
NO_TIME = -(1 << 60)
LOWEST = 1 << 63


def _newest() -> Column:
    micros = F.coalesce(F.unix_micros(F.col("ts_inserted").cast("timestamp")), F.lit(NO_TIME))
    level = F.coalesce(F.expr(f"cast(waterlevel AS decimal(19,0)) + {LOWEST} + 1"), F.lit(0).cast("decimal(19,0)"))
    return F.max((micros.cast("decimal(19,0)") * F.expr(f"{LEVELS}") + level).cast("decimal(38,0)")).alias("_newest")


def _newest_time(control: DataFrame) -> Column:
    micros = F.expr(f"(_newest - pmod(_newest, {LEVELS})) div {LEVELS}")
    return F.when(micros != NO_TIME, F.timestamp_micros(micros)).cast(control.schema["ts_inserted"].dataType)


def _newest_level() -> Column:
    return F.expr(f"CASE WHEN pmod(_newest, {LEVELS}) > 0 THEN cast(pmod(_newest, {LEVELS}) - {LOWEST} - 1 AS bigint) END")


def resume_disagreements(control: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Partitions where the two resume rules differ; one pass over the log."""
    by = by or ["partition_id"]
    return (
        control.filter(F.col("partition_id").isNotNull())
        .groupBy(*by)
        .agg(
            F.max("waterlevel").alias("highest_waterlevel"),
            _newest(),
        )
        .select(*by, "highest_waterlevel", _newest_level().alias("latest_waterlevel"))
        .filter("highest_waterlevel <> latest_waterlevel")
    )


def latest_status(control: DataFrame, key: ControlKey) -> DataFrame:
    """Time and waterlevel of the newest control row of a mapping, partitions aside."""
    rows = control
    for name, value in key.columns().items():
        rows = rows.filter(F.col(name) == value)
    return rows.orderBy(F.desc("ts_inserted"), F.desc("waterlevel")).limit(1).select("ts_inserted", "waterlevel")


def checkpoint_listing(points: DataFrame, namespace: Column, hub: Column, consumer_group: Column) -> DataFrame:
    """Resume points in the shape a stream client wants: offset as text beside the number (S3)."""
    return points.select(
        namespace.alias("fully_qualified_namespace"),
        hub.alias("eventhub_name"),
        consumer_group.alias("consumer_group"),
        "partition_id",
        F.col("waterlevel").cast("string").alias("offset"),
        F.col("waterlevel").alias("sequence_number"),
    )


def start_positions(partitions: DataFrame, points: DataFrame, on: list[str], start_position: str = "latest") -> DataFrame:
    """Where each partition starts to read (S2): after its resume point, else at the given end.

    ``starts_at`` is the offset to continue after, or the mark of an end of the stream.
    """
    mark = F.lit(START_MARKS[start_position])
    known = lookup_join(partitions, points.select(*on, "waterlevel"), on, "left")
    return known.select(
        *partitions.columns,
        F.coalesce(F.col("waterlevel").cast("string"), mark).alias("starts_at"),
        F.col("waterlevel").isNotNull().alias("resumed"),
    )


def ordered_listing(control: DataFrame) -> DataFrame:
    """Partition and waterlevel of every control row in text order of the partition."""
    return control.select("partition_id", "waterlevel").orderBy("partition_id", "waterlevel")


def unseen_messages(
    messages: DataFrame,
    points: DataFrame,
    on: list[str],
    position: Column,
    start_position: str = "earliest",
    spread: str = "sequence_number",
) -> DataFrame:
    """Messages beyond their partition's resume point.

    A partition without one follows ``start_position``: ``earliest`` keeps all of it; ``latest``
    keeps none of it, which is what a reader that starts now sees of the messages already there.
    """
    if start_position not in ("earliest", "latest"):
        raise ValueError(f"unknown start position: {start_position}")
    resumed = lookup_join(messages, points.select(*on, F.col("waterlevel").alias("_resume")), on, "left", spread)
    unknown = F.lit(start_position == "earliest")
    seen_to = F.col("_resume")
    return resumed.filter(F.when(seen_to.isNull(), unknown).otherwise(position > seen_to)).select(*messages.columns)


def control_rows(
    waterlevels: DataFrame, key: ControlKey | None = None, ts_inserted: Column | None = None
) -> DataFrame:
    """Rows to append to the control log, one per partition.

    ``waterlevels`` holds partition_id and waterlevel, the key columns unless ``key`` is given,
    and optionally metadata as JSON text. Empty metadata is stored as NULL.
    """
    if key is not None:
        waterlevels = waterlevels.withColumns({n: F.lit(v) for n, v in key.columns().items()})
    if ts_inserted is None:
        ts_inserted = F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
        )
    if "metadata" in waterlevels.columns:
        metadata = F.col("metadata")
        waterlevels = waterlevels.withColumn("metadata", F.when(~is_empty_json(metadata), metadata))
    return with_columns_of(waterlevels.withColumn("ts_inserted", ts_inserted), schemas.CONTROL)


def with_checkpoint_metadata(waterlevels: DataFrame, namespace: Column, hub: Column, group: Column) -> DataFrame:
    """Add the standard metadata object to waterlevels that still carry offset and sequence number."""
    return waterlevels.withColumn(
        "metadata", checkpoint_metadata(F.col("sequence_number"), F.col("offset"), namespace, hub, group)
    )


def with_partition_metadata(waterlevels: DataFrame, metadata: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Attach metadata given for some of the partitions; the others get NULL."""
    return lookup_join(waterlevels, metadata, on or ["partition_id"], "left", spread="waterlevel")


def required_columns(rows: DataFrame) -> DataFrame:
    """Raise in the writing task when a strict control row lacks a required value."""
    return rows.withColumns(
        {
            name: F.coalesce(F.col(name), F.raise_error(F.lit(f"{name} must not be NULL")).cast(rows.schema[name].dataType))
            for name in schemas.CONTROL_REQUIRED
        }
    )


def lenient_rows(rows: DataFrame) -> DataFrame:
    """Status rows with the insert time filled in where absent."""
    now = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    complete = with_columns_of(rows, schemas.CONTROL)
    return complete.withColumn("ts_inserted", F.coalesce("ts_inserted", now))


def legacy_status_rows(statuses: DataFrame, ts_inserted: Column | None = None) -> DataFrame:
    """Status rows of the older writer: text waterlevels, partition "0" by default."""
    typed = statuses.withColumn("waterlevel", F.trim(F.col("waterlevel").cast("string")).cast("bigint"))
    partition = F.col("partition_id") if "partition_id" in statuses.columns else F.lit(None).cast("string")
    return control_rows(typed.withColumn("partition_id", F.coalesce(partition, F.lit("0"))), ts_inserted=ts_inserted)


def typed_metadata(control: DataFrame) -> DataFrame:
    """Control rows with the sequence number read back from their metadata.

    The waterlevel is an offset; the sequence number of the same message is only in the JSON.
    """
    return control.withColumn("sequence_number", metadata_field(F.col("metadata"), "sequence_number", "bigint"))


def purge_summary(control: DataFrame) -> DataFrame:
    """Number of control rows; zero after a purge (A10)."""
    return control.agg(F.count("*").alias("checkpoint_count"))
