"""Message streams (S1) and where they start."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = schemas.RAW_MESSAGE,
    file_format: str = "parquet",
    max_files: int | None = None,
    name_pattern: str | None = None,
) -> DataFrame:
    """Messages from files that appear in a folder; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_pattern is not None:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.load(folder)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str = "latest",
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """Messages from a Kafka-protocol endpoint, in the raw message shape.

    Needs the Kafka connector on the cluster. ``start`` is ``latest``, ``earliest`` or the text
    made by ``starting_offsets``; it counts only until the query has a checkpoint of its own.
    ``max_offsets`` bounds a micro-batch (X1).
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("includeHeaders", "true")
        .options(**options)
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return from_kafka(reader.load())


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records as raw messages: the log position is both offset and sequence number.

    A header that occurs twice keeps its last value.
    """
    headers = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    names = F.array_distinct(F.transform(headers, lambda h: h["key"]))

    def last_value(name):
        same = F.filter(headers, lambda h: h["key"] == name)
        return F.element_at(F.transform(same, lambda h: h["value"]), -1)

    properties = F.map_from_arrays(names, F.transform(names, last_value))
    return records.select(
        F.col("value").alias("body"),
        F.col("partition").cast("string").alias("partition_id"),
        F.col("offset").alias("sequence_number"),
        F.col("offset").cast("string").alias("offset"),
        F.col("timestamp").alias("enqueued_time"),
        properties.alias("properties"),
        F.create_map(
            F.lit("topic"), F.encode("topic", "UTF-8"), F.lit("key"), F.col("key")
        ).alias("system_properties"),
    )


def starting_offsets(points: DataFrame, topic: str, partitions: int, start_position: str = "latest") -> str:
    """Start offsets for ``kafka_stream`` from resume points.

    Reading continues after each waterlevel; partitions without one start at the given end of
    the log. Read from one mapping's resume points: one row per partition of the topic.
    """
    edge = {"latest": -1, "earliest": -2}[start_position]
    offsets = {str(p): edge for p in range(partitions)}
    rows = points.filter(F.col("partition_id").isin(list(offsets))).select("partition_id", "waterlevel").collect()
    offsets.update({r["partition_id"]: r["waterlevel"] + 1 for r in rows})
    return json.dumps({topic: offsets})
