import json
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.envelope import to_target_rows
from tidemark.operators import checkpoints as C
from tidemark.sources import streams, tables
from tidemark.streaming.sink import Lake, Route, RouteSink, read_control, read_table

KEY = C.ControlKey("ns", "hub", "lake", "ingest", "t")


@pytest.fixture
def name():
    return f"t{uuid.uuid4().hex}"


def test_target_table(spark, tmp_path, name):
    table = tables.create_target_table(spark, name, "ingest", "events", str(tmp_path / "t"))
    assert tables.create_target_table(spark, name, "ingest", "events") == table  # there already
    rows = spark.createDataFrame([("msg_0", "0", 100)], "body string, partition_id string, sequence_number bigint")
    tables.append_target(table, to_target_rows(rows))
    tables.append_target(table, to_target_rows(rows.limit(0)))
    found = spark.table(table)
    assert [f.dataType for f in found.schema] == [f.dataType for f in schemas.TARGET]
    assert found.count() == 1 and found.first().properties is None


def test_control_table_and_purge(spark, tmp_path, name):
    table = tables.create_control_table(spark, name, "control", "levels", str(tmp_path / "c"))
    levels = spark.createDataFrame([("1", 5), ("0", 7)], "partition_id string, waterlevel bigint")
    tables.append_control(table, C.control_rows(levels, KEY))
    assert [tuple(r) for r in tables.list_control(spark, table).collect()] == [("0", 7), ("1", 5)]
    bad = C.control_rows(levels.withColumn("partition_id", F.lit(None).cast("string")), KEY)
    with pytest.raises(Exception, match="partition_id must not be NULL"):
        tables.append_control(table, bad)
    assert tables.purge_control(spark, table).first()[0] == 0
    assert spark.table(table).isEmpty()


def test_status_table_is_lenient(spark, tmp_path, name):
    table = tables.create_status_table(spark, name, "control", location=str(tmp_path / "s"))
    tables.append_status(table, spark.createDataFrame([(None, 3)], "partition_id string, waterlevel bigint"))
    row = spark.table(table).first()
    assert row.partition_id is None and row.waterlevel == 3 and row.ts_inserted is not None


def test_names_need_all_parts():
    with pytest.raises(ValueError):
        tables.table_name("db", " ", "t")


def test_starting_offsets(spark):
    points = spark.createDataFrame([("0", 41), ("2", 0), ("x", 9)], "partition_id string, waterlevel bigint")
    assert json.loads(streams.starting_offsets(points, "hub", 3)) == {"hub": {"0": 42, "1": -1, "2": 1}}
    assert json.loads(streams.starting_offsets(points, "hub", 2, "earliest"))["hub"] == {"0": 42, "1": -2}


@pytest.fixture
def records(spark):
    return spark.sql(
        """SELECT CAST('k' AS binary) AS key, X'FF41' AS value, 'hub' AS topic, 3 AS partition, 17L AS offset,
             timestamp '2025-10-17 12:00:00' AS timestamp,
             array(struct('h' AS key, CAST('old' AS binary) AS value), struct('h' AS key, CAST('new' AS binary) AS value)) AS headers
           UNION ALL SELECT NULL, X'42', 'hub', 0, 1L, timestamp '2025-10-17 12:00:00', NULL"""
    )


def test_kafka_records_as_messages(records):
    rows = {r.sequence_number: r for r in to_target_rows(streams.from_kafka(records)).collect()}
    assert rows[17].event_body == "�A" and rows[17].partition_id == "3"
    assert rows[17].properties == '{"h":"new"}'
    assert json.loads(rows[17].system_properties) == {"topic": "hub", "key": "k"}
    assert rows[1].properties is None


def test_kafka_records_through_the_sink(spark, records, tmp_path, at):
    route = Route("S", "T", "ns", "hub", "$Default", "lake", "ingest")
    lake = Lake(str(tmp_path))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        RouteSink(route, lake)(streams.from_kafka(records), 7)
        rows = read_table(spark, lake.target(route), schemas.TARGET).orderBy("sequence_number").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r.partition_id, r.sequence_number) for r in rows] == [("0", 1), ("3", 17)]
    assert rows[0].enqueued_time == at(0)  # the time of the instant in UTC
    assert {r.partition_id: r.waterlevel for r in read_control(spark, lake, route).collect()} == {"0": 1, "3": 17}
