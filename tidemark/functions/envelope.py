"""Message envelope to target row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.text import as_json, body_text


def is_empty_json(column: Column) -> Column:
    """Whether JSON text holds nothing: blank, null or an empty object."""
    return column.rlike(r"^\s*(\{\s*\}|null)?\s*$")


def properties_json(column: Column, data_type: T.DataType) -> Column:
    """Properties as JSON text; a missing or empty map is NULL.

    Text input is taken as JSON already encoded by the producer.
    """
    if isinstance(data_type, T.StringType):
        return F.when(~is_empty_json(column), column)
    if isinstance(data_type, T.MapType):
        return F.when(F.size(column) > 0, as_json(column, data_type))
    return as_json(column, data_type)


def utc_timestamp(column: Column, data_type: T.DataType) -> Column:
    """Enqueued time as a zone-free UTC timestamp (P5).

    ISO text may carry an offset; casting it straight to a zone-free type would ignore the
    offset, so it goes through an instant first.
    """
    if isinstance(data_type, T.TimestampNTZType):
        return column
    # Text without an offset is UTC already, whatever the session time zone is.
    if isinstance(data_type, T.StringType):
        has_offset = column.rlike(r"(?i)(z|[+-]\d{2}:?\d{2})\s*$") & column.contains(":")
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.try_cast("timestamp").cast("timestamp_ntz"))
        return F.when(has_offset, utc).otherwise(column.try_cast("timestamp_ntz"))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz"))


def parse_offset(offset: Column, sequence_number: Column) -> Column:
    """Offset text as a number, or the sequence number when it is none.

    Single underscores between digits are accepted as separators.
    """
    plain = F.regexp_replace(offset, r"(?<=\d)_(?=\d)", "")
    digits = F.when(offset.contains("_"), plain).otherwise(offset)
    return F.coalesce(digits.try_cast("bigint"), sequence_number)


def checkpoint_metadata(
    sequence_number: Column, offset: Column, namespace: Column, hub: Column, consumer_group: Column
) -> Column:
    """JSON object stored beside a waterlevel; absent values are JSON nulls."""
    values = [sequence_number, offset, namespace, hub, consumer_group]
    fields = [v.cast(f.dataType).alias(f.name) for v, f in zip(values, schemas.METADATA.fields, strict=True)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def metadata_field(metadata: Column, name: str, data_type: str = "string") -> Column:
    """Typed read of one key of a JSON column; malformed JSON gives NULL."""
    return F.get_json_object(metadata, f"$.{name}").try_cast(data_type)


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to a schema; columns the input lacks become typed NULLs."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def valid_messages(messages: DataFrame) -> DataFrame:
    """Drop messages without a sequence number; zero is a valid one (F1)."""
    return messages.filter(F.col("sequence_number").isNotNull())


def to_target_rows(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Flatten message envelopes to target rows.

    ``ingested_at`` is one value per micro-batch, the current time by default.
    """
    types = {f.name: f.dataType for f in messages.schema.fields}
    if ingested_at is None:
        ingested_at = F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
        )
    columns = {}
    if "body" in types:
        columns["event_body"] = body_text(F.col("body"), types["body"])
    for name in ("partition_id", "sequence_number"):
        if name in types:
            columns[name] = F.col(name)
    if "enqueued_time" in types:
        columns["enqueued_time"] = utc_timestamp(F.col("enqueued_time"), types["enqueued_time"])
    for name in ("properties", "system_properties"):
        if name in types:
            columns[name] = properties_json(F.col(name), types[name])
    columns["ingestion_timestamp"] = ingested_at
    flat = messages.select(*[c.alias(name) for name, c in columns.items()])
    return with_columns_of(flat, schemas.TARGET)
