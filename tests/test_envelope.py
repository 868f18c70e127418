import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import envelope as E
from tidemark.functions import text as X

BODY = '{"meter":"north-7","read_at":"2025-10-17T11:59:30Z","litres":18.5,"flags":["low"]}'
NOW = datetime(2025, 10, 17, 12, 0, 1)


def raw(spark, **values):
    row = {
        "body": BODY,
        "partition_id": "0",
        "sequence_number": 100,
        "offset": "200",
        "enqueued_time": datetime(2025, 10, 17, 12),
        "properties": {"key": bytearray(b"value")},
        "system_properties": {"offset": bytearray(b"0"), "sequence_number": bytearray(b"100")},
    }
    row.update(values)
    return spark.createDataFrame([tuple(row.values())], schemas.RAW_MESSAGE)


def landed(spark, **values):
    return E.to_target_rows(raw(spark, **values), F.lit(NOW)).first()


def test_full_envelope(spark):
    row = landed(spark)
    assert row.event_body == BODY
    assert (row.partition_id, row.sequence_number) == ("0", 100)
    assert row.enqueued_time == datetime(2025, 10, 17, 12)
    assert json.loads(row.properties) == {"key": "value"}
    assert json.loads(row.system_properties) == {"offset": "0", "sequence_number": "100"}
    assert row.ingestion_timestamp == NOW


def test_columns_and_types_of_target(spark):
    frame = E.to_target_rows(raw(spark))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schemas.TARGET]


@pytest.mark.parametrize("empty", [None, {}])
def test_absent_properties_are_null(spark, empty):
    row = landed(spark, properties=empty, system_properties=empty)
    assert row.properties is None and row.system_properties is None


def test_absent_time_stays_null(spark):
    assert landed(spark, enqueued_time=None).enqueued_time is None


def test_zero_sequence_is_valid_and_null_is_not(spark):
    frame = raw(spark, sequence_number=0).unionByName(raw(spark, sequence_number=None))
    assert [r.sequence_number for r in E.valid_messages(frame).collect()] == [0]


@pytest.mark.parametrize("data", [b"\xff\xfe", b"a\xffb", b"\xe2\x82", b"\xf0\x28\x8c\xbc", b"\xc3\xa9", b""])
def test_utf8_replacement(spark, data):
    frame = spark.createDataFrame([(bytearray(data),)], "b binary")
    assert frame.select(X.utf8(F.col("b"))).first()[0] == data.decode("utf-8", errors="replace")


def test_binary_body(spark):
    frame = spark.createDataFrame([(bytearray(b"caf\xc3\xa9"), 1)], "body binary, sequence_number bigint")
    row = E.to_target_rows(frame, F.lit(NOW)).first()
    assert row.event_body == "café"
    assert row.partition_id is None and row.properties is None  # absent columns


def test_nested_bytes(spark):
    nested = F.create_map(
        F.encode("k", "UTF-8"),
        F.array(
            F.struct(F.encode(F.lit("value"), "UTF-8").alias("deep"), F.lit(1).alias("n")),
            F.struct(F.lit(None).cast("binary").alias("deep"), F.lit(None).cast("int").alias("n")),
            F.lit(None).cast("struct<deep:binary,n:int>"),
        ),
    )
    frame = spark.createDataFrame([("top",)], "k string").select(nested.alias("v"))
    found = frame.select(E.as_json(F.col("v"), frame.schema["v"].dataType)).first()[0]
    assert json.loads(found) == {"top": [{"deep": "value", "n": 1}, {"deep": None, "n": None}, None]}


def test_byte_keys_that_decode_alike_keep_the_later(spark):
    frame = spark.sql("SELECT map(X'FF', 'first', X'FE', 'second') AS m")
    found = frame.select(X.bytes_to_text(F.col("m"), frame.schema["m"].dataType)).first()[0]
    assert found == {"�": "second"}


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-10-17T20:00:00Z", datetime(2025, 10, 17, 20)),
        ("2025-10-17T20:00:00+02:00", datetime(2025, 10, 17, 18)),
        ("2025-10-17T20:00:00.25", datetime(2025, 10, 17, 20, 0, 0, 250000)),
        ("2025-10-17", datetime(2025, 10, 17)),
        ("soon", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_text_is_utc(spark, text, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(text,)], "t string")
        assert frame.select(E.utc_timestamp(F.col("t"), T.StringType())).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "offset, expected",
    [("12345", 12345), ("invalid", 100), (None, 100), ("", 100), (" 7 ", 7), ("1_000", 1000), ("1__0", 100), ("3.5", 100),
     ("-1", -1), ("9223372036854775807", 9223372036854775807)],
)
def test_offset_with_fallback(spark, offset, expected):
    frame = spark.createDataFrame([(offset, 100)], "o string, s bigint")
    assert frame.select(E.parse_offset(F.col("o"), F.col("s"))).first()[0] == expected


def test_metadata_keeps_nulls_and_reads_back(spark):
    frame = spark.createDataFrame([(5, None, "ns", "hub", None)], "s bigint, o string, n string, h string, g string")
    made = frame.select(E.checkpoint_metadata(*[F.col(c) for c in "sonhg"]).alias("m"))
    assert json.loads(made.first().m) == {
        "sequence_number": 5,
        "offset_string": None,
        "fully_qualified_namespace": "ns",
        "eventhub_name": "hub",
        "consumer_group": None,
    }
    assert made.select(E.metadata_field(F.col("m"), "sequence_number", "bigint")).first()[0] == 5


def test_malformed_metadata_reads_as_null(spark):
    frame = spark.createDataFrame([("{bad",), (None,), ('{"sequence_number":"x"}',)], "m string")
    found = frame.select(E.metadata_field(F.col("m"), "sequence_number", "bigint")).collect()
    assert [r[0] for r in found] == [None, None, None]


@pytest.mark.parametrize("secret, shown", [("abcdefgh", "***efgh"), ("abcd", "***"), ("", "***"), (None, "***")])
def test_masking(spark, secret, shown):
    frame = spark.createDataFrame([(secret,)], "s string")
    assert frame.select(X.mask_secret(F.col("s"))).first()[0] == shown


def test_labels(spark):
    frame = spark.createDataFrame([("hub", "c1", "ns", "md:db?token=secret")], "h string, c string, n string, u string")
    row = frame.select(
        X.channel_name(F.col("h"), F.col("c")),
        X.channel_label(F.col("n"), F.col("h")),
        X.mapping_label(F.col("h"), F.col("c")),
        X.mask_connection(F.col("u")),
        X.error_signature(F.lit("ValueError"), F.repeat(F.lit("x"), F.lit(300))),
    ).first()
    assert list(row) == ["hub-dev-default-c1", "ns/hub", "hub->c1", "md:db?token=***", "ValueError:" + "x" * 100]
