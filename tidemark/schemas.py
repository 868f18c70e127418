"""Table schemas shared by every operator.

Column names, types and their order are fixed values: existing target and control tables
must stay readable.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_MESSAGE = T.StructType(
    [
        T.StructField("body", T.StringType()),
        T.StructField("partition_id", T.StringType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("offset", T.StringType()),
        T.StructField("enqueued_time", T.TimestampNTZType()),
        T.StructField("properties", T.MapType(T.StringType(), T.BinaryType())),
        T.StructField("system_properties", T.MapType(T.StringType(), T.BinaryType())),
    ]
)

TARGET = T.StructType(
    [
        T.StructField("event_body", T.StringType()),
        T.StructField("partition_id", T.StringType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("enqueued_time", T.TimestampNTZType()),
        T.StructField("properties", T.StringType()),
        T.StructField("system_properties", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampNTZType()),
    ]
)

CONTROL = T.StructType(
    [
        T.StructField("ts_inserted", T.TimestampNTZType()),
        T.StructField("eventhub_namespace", T.StringType()),
        T.StructField("eventhub", T.StringType()),
        T.StructField("target_db", T.StringType()),
        T.StructField("target_schema", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("partition_id", T.StringType()),
        T.StructField("waterlevel", T.LongType()),
        T.StructField("metadata", T.StringType()),
    ]
)

# The five columns that name one stream-to-table mapping in the control log.
CONTROL_KEY = ["eventhub_namespace", "eventhub", "target_db", "target_schema", "target_table"]

# Columns that a strict control table does not accept as NULL.
CONTROL_REQUIRED = [*CONTROL_KEY, "partition_id", "waterlevel"]

# Keys of the JSON object kept in CONTROL.metadata.
METADATA = T.StructType(
    [
        T.StructField("sequence_number", T.LongType()),
        T.StructField("offset_string", T.StringType()),
        T.StructField("fully_qualified_namespace", T.StringType()),
        T.StructField("eventhub_name", T.StringType()),
        T.StructField("consumer_group", T.StringType()),
    ]
)

BATCH_AUDIT = T.StructType(
    [
        T.StructField("mapping", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("started", T.TimestampNTZType()),
        T.StructField("ended", T.TimestampNTZType()),
        T.StructField("messages", T.LongType()),
        T.StructField("partitions", T.LongType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("checkpoints_updated", T.LongType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)

FAILURES = T.StructType(
    [
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("mapping", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

SOURCES = T.StructType(
    [
        T.StructField("source_key", T.StringType()),
        T.StructField("route_no", T.LongType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("consumer_group", T.StringType()),
    ]
)

TARGETS = T.StructType(
    [
        T.StructField("target_key", T.StringType()),
        T.StructField("route_no", T.LongType()),
        T.StructField("database", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("batch_size", T.LongType()),
    ]
)
