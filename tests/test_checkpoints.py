import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checkpoints as C
from tidemark.operators.joins import lookup_join, salted_join

KEY = C.ControlKey("broker.example", "topic1", "lake", "ingest", "table1")


def control(spark, at, rows):
    """Control rows of KEY: (seconds, partition, waterlevel[, metadata[, changed key columns]])."""
    made = []
    for seconds, partition, waterlevel, *more in rows:
        key = {**KEY.columns(), **(more[1] if len(more) > 1 else {})}
        made.append((at(seconds), *key.values(), partition, waterlevel, more[0] if more else None))
    return spark.createDataFrame(made, schemas.CONTROL)


def points(df):
    return {r.partition_id: r.waterlevel for r in df.collect()}


def test_newest_row_is_found_without_sorting(spark, at):
    rows = [(1, "0", -5), (1, "0", -9), (-4e9, "1", 2**63 - 1), (-4e9, "1", -(2**63)), (3, "2", 4), (2, "2", 9)]
    latest = C.latest_points(control(spark, at, rows))
    assert points(latest) == {"0": -5, "1": 2**63 - 1, "2": 4}
    assert {r.partition_id: r.ts_inserted for r in latest.collect()} == {"0": at(1), "1": at(-4e9), "2": at(3)}
    for df in (latest, C.resume_disagreements(control(spark, at, rows))):
        assert "Sort" not in df._jdf.queryExecution().executedPlan().toString()


def test_newest_row_with_nulls(spark):
    empty = dict.fromkeys(schemas.CONTROL.names)
    rows = [{**empty, "partition_id": "0", "waterlevel": w} for w in (7, None, 3)] + [{**empty, "partition_id": "1"}]
    assert points(C.latest_points(spark.createDataFrame([tuple(r.values()) for r in rows], schemas.CONTROL))) == {"0": 7, "1": None}


def test_three_partitions(spark, at):
    log = control(spark, at, [(0, "0", 100), (0, "1", 150), (0, "2", 120)])
    assert points(C.resume_points(C.entries_of(log, KEY))) == {"0": 100, "1": 150, "2": 120}


def test_highest_against_latest(spark, at):
    log = control(spark, at, [(1, "0", 100), (2, "0", 500), (3, "0", 300), (1, "1", 750), (0, "1", 20)])
    assert points(C.resume_points(log)) == {"0": 500, "1": 750}
    assert points(C.latest_points(log)) == {"0": 300, "1": 750}
    rows = C.resume_disagreements(log).collect()
    assert [tuple(r) for r in rows] == [("0", 500, 300)]


def test_same_time_takes_the_higher(spark, at):
    assert points(C.latest_points(control(spark, at, [(1, "0", 5), (1, "0", 9), (1, "0", 7)]))) == {"0": 9}


@pytest.mark.parametrize("column", schemas.CONTROL_KEY)
def test_other_mappings_are_excluded(spark, at, column):
    log = control(spark, at, [(0, "0", 10), (1, "0", 99, None, {column: "other"})])
    assert points(C.resume_points(C.entries_of(log, KEY))) == {"0": 10}


def test_rows_without_partition_are_excluded(spark, at):
    log = control(spark, at, [(0, None, 1000), (0, "1", 5)])
    assert points(C.resume_points(C.entries_of(log, KEY))) == {"1": 5}


def test_no_rows(spark, at):
    log = control(spark, at, [(0, "0", 1)]).limit(0)
    assert C.resume_points(C.entries_of(log, KEY)).isEmpty()
    assert C.latest_status(log, KEY).isEmpty()


def test_extremes_and_text_partitions(spark, at):
    values = {"a": 9223372036854775807, "b": 1000000000, "c-0": 0}
    log = control(spark, at, [(0, p, w) for p, w in values.items()])
    assert points(C.resume_points(log)) == values


def test_consumer_group_filter(spark, at):
    log = control(spark, at, [(0, "0", 5, '{"consumer_group":"a"}'), (0, "0", 9, '{"consumer_group":"b"}'), (0, "0", 20)])
    assert points(C.resume_points(C.entries_of(log, KEY, "a"))) == {"0": 5}


def test_listing_for_clients(spark, at):
    found = C.checkpoint_listing(
        C.resume_points(control(spark, at, [(0, "0", 12345)])), F.lit(KEY.namespace), F.lit(KEY.hub), F.lit("$Default")
    ).first()
    assert (found.partition_id, found.offset, found.sequence_number) == ("0", "12345", 12345)


def test_latest_status(spark, at):
    row = C.latest_status(control(spark, at, [(1, "0", 5), (9, "1", 3), (4, "0", 8)]), KEY).first()
    assert (row.ts_inserted, row.waterlevel) == (at(9), 3)


def test_listing_is_in_text_order(spark, at):
    found = C.ordered_listing(control(spark, at, [(0, "10", 1), (0, "9", 2), (0, "1", 3)])).collect()
    assert [r.partition_id for r in found] == ["1", "10", "9"]


@pytest.mark.parametrize("start, expected", [("earliest", [6, 7, 1]), ("latest", [6, 7])])
@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_unseen_messages(spark, at, start, expected, broadcast_rows, monkeypatch):
    monkeypatch.setattr(lookup_join, "__defaults__", ("left", None, broadcast_rows))
    messages = spark.createDataFrame([("0", n) for n in (4, 5, 6, 7)] + [("new", 1)], "partition_id string, sequence_number bigint")
    log = C.resume_points(control(spark, at, [(0, "0", 5), (0, "1", 50)]))
    found = C.unseen_messages(messages, log, ["partition_id"], F.col("sequence_number"), start)
    assert sorted(r.sequence_number for r in found.collect()) == sorted(expected)
    assert found.columns == messages.columns


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    large = spark.range(500).select(F.expr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 11 <> 0 THEN id % 7 END").alias("k"), "id")
    lookup = spark.range(4).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    expected = sorted(map(str, large.join(lookup, ["k"], how).collect()))
    for share in (1, 7, 10_000):  # no key is hot, some are, all are
        assert sorted(map(str, salted_join(large, lookup, ["k"], how, "id", share).collect())) == expected
    assert sorted(map(str, lookup_join(large, lookup, ["k"], how).collect())) == expected


def test_wide_lookups_are_measured_before_they_are_collected(spark, monkeypatch):
    wide = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1 << 20).alias("v"), F.array(F.struct("id")).alias("a"))
    monkeypatch.setattr(type(wide), "toArrow", lambda self: pytest.fail("collected"))
    joined = lookup_join(spark.range(300).select((F.col("id") % 150).alias("k")), wide, ["k"], "inner")
    assert joined.agg(F.count("*"), F.sum(F.length("v"))).first() == (200, 200 << 20)


def test_control_rows_with_partial_metadata(spark, at):
    levels = spark.createDataFrame([("0", 100), ("1", 150)], "partition_id string, waterlevel bigint")
    metadata = spark.createDataFrame([("0", '{"sequence_number":100}'), ("9", "{}")], "partition_id string, metadata string")
    rows = C.control_rows(C.with_partition_metadata(levels, metadata), KEY, F.lit(at(0))).orderBy("partition_id").collect()
    assert [r.metadata for r in rows] == ['{"sequence_number":100}', None]
    assert rows[0].ts_inserted == at(0) and rows[0].target_table == "table1"


def test_empty_metadata_is_null(spark):
    levels = spark.createDataFrame([("0", 1, "{ }")], "partition_id string, waterlevel bigint, metadata string")
    assert C.control_rows(levels, KEY).first().metadata is None


def test_strict_rows_refuse_nulls(spark):
    levels = spark.createDataFrame([("0", None)], "partition_id string, waterlevel bigint")
    with pytest.raises(Exception, match="waterlevel must not be NULL"):
        C.required_columns(C.control_rows(levels, KEY)).collect()


def test_lenient_rows_fill_the_time(spark, at):
    rows = spark.createDataFrame([(None, "0"), (at(5), "1")], "ts_inserted timestamp_ntz, partition_id string")
    found = {r.partition_id: r for r in C.lenient_rows(rows).collect()}
    assert found["0"].ts_inserted is not None and found["1"].ts_inserted == at(5)
    assert found["0"].waterlevel is None


def test_legacy_status_defaults(spark, at):
    rows = spark.createDataFrame([("42",)], "waterlevel string").withColumns(
        {n: F.lit(v) for n, v in KEY.columns().items()}
    )
    found = C.legacy_status_rows(rows, F.lit(at(0))).first()
    assert (found.partition_id, found.waterlevel, found.eventhub) == ("0", 42, "topic1")


def test_key_filters_reach_the_scan(spark, at, tmp_path):
    control(spark, at, [(0, "0", 1)]).write.parquet(str(tmp_path / "c"))
    points = C.resume_points(C.entries_of(spark.read.parquet(str(tmp_path / "c")), KEY))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = points._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "EqualTo(eventhub,topic1)" in scan and "IsNotNull(partition_id)" in scan
    assert "metadata" not in scan and "ts_inserted" not in scan


@pytest.mark.parametrize("start, mark", [("latest", "@latest"), ("earliest", "-1")])
def test_start_positions(spark, at, start, mark):
    partitions = spark.createDataFrame([("0",), ("1",)], "partition_id string")
    found = C.start_positions(partitions, C.resume_points(control(spark, at, [(0, "0", 0)])), ["partition_id"], start)
    assert {tuple(r) for r in found.collect()} == {("0", "0", True), ("1", mark, False)}
