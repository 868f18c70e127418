"""The manifest of a lake: what readers see of batches, crashes and merged generations."""

from pathlib import Path

import pytest

from tidemark.streaming.manifest import Manifest
from tidemark.streaming.sink import Lake, Route, RouteSink, read_control, read_landed

ROUTE = Route("S", "T", "ns", "hub", "$Default", "db", "sc", "tbl")


def messages(spark, at, numbers, partitions=2):
    rows = [(f"b{i}", str(i % partitions), i, str(i * 64), at(i), None, None) for i in numbers]
    return spark.createDataFrame(rows, "body string, partition_id string, sequence_number bigint, offset string, enqueued_time timestamp_ntz, properties map<string,binary>, system_properties map<string,binary>")


def lake_of(tmp_path):
    return Lake(str(tmp_path / "lake"))


def numbers(frame):
    return sorted(r["sequence_number"] for r in frame.collect())


def land(spark, at, lake, batches, run="run-1", first=0):
    sink = RouteSink(ROUTE, lake)
    sink.run = run
    for k, batch in enumerate(batches, first):
        sink(messages(spark, at, batch), k) if k else sink.land(sink.accepted(messages(spark, at, batch)), k)


def test_a_batch_is_visible_once_it_is_entered(spark, at, tmp_path):
    lake = lake_of(tmp_path)
    assert numbers(read_landed(spark, lake, ROUTE)) == []
    land(spark, at, lake, [range(10)])

    class Dying(RouteSink):
        def write_audit(self, *args, **kwargs):
            raise RuntimeError("dead")

    for broken in ("write_control", "write_audit"):
        sink = RouteSink(ROUTE, lake)
        sink.run = "run-1"

        def die(*args, **kwargs):
            raise RuntimeError("dead")

        setattr(sink, broken, die)
        with pytest.raises(RuntimeError, match="dead"):
            sink(messages(spark, at, range(10, 20)), 1)
        assert numbers(read_landed(spark, lake, ROUTE)) == list(range(10))
        assert len(read_control(spark, lake, ROUTE).collect()) == 2
    land(spark, at, lake, [range(10, 20)], first=1)
    assert numbers(read_landed(spark, lake, ROUTE)) == list(range(20))


def test_generations_replace_batches(spark, at, tmp_path):
    lake = lake_of(tmp_path)
    manifest = Manifest(spark, lake, ROUTE)
    assert manifest.compact() is None and manifest.expire() == 0
    land(spark, at, lake, [range(k * 10, k * 10 + 10) for k in range(8)])
    control = len(read_control(spark, lake, ROUTE).collect())
    before = read_landed(spark, lake, ROUTE)
    assert len(manifest.paths()) == 8
    assert manifest.compact(file_messages=40) == 1
    assert len(manifest.paths()) <= 3 and numbers(read_landed(spark, lake, ROUTE)) == list(range(80))
    assert numbers(before) == list(range(80))  # a reader that began earlier still has its folders
    land(spark, at, lake, [range(80, 90)], first=8)
    assert numbers(read_landed(spark, lake, ROUTE)) == list(range(90))
    assert len(read_control(spark, lake, ROUTE).collect()) == control + 2
    assert manifest.compact(file_messages=40) == 2 and manifest.compact() is None
    gone = manifest.expire()
    assert gone == 3 * 9 + 3  # log, target and control of nine batches, and the first generation of both tables and of the list
    assert numbers(read_landed(spark, lake, ROUTE)) == list(range(90)) and len(read_control(spark, lake, ROUTE).collect()) == control + 2
    assert not list(Path(lake.root).glob("target/**/batch_id=*"))


def test_a_merged_batch_is_still_committed(spark, at, tmp_path):
    lake = lake_of(tmp_path)
    manifest = Manifest(spark, lake, ROUTE)
    land(spark, at, lake, [range(5), range(5, 9)])
    assert manifest.is_committed("run-1", 1) and not manifest.is_committed("run-1", 2) and not manifest.is_committed("run-2", 0)
    manifest.compact()
    manifest.expire()
    assert manifest.is_committed("run-1", 1) and not manifest.is_committed("run-1", 2)
    land(spark, at, lake, [range(100, 105)], run="run-2")  # a new checkpoint counts its batches from 0 again
    assert numbers(read_landed(spark, lake, ROUTE)) == [*range(9), *range(100, 105)]


def test_a_compaction_that_dies_changes_nothing(spark, at, tmp_path, monkeypatch):
    lake = lake_of(tmp_path)
    manifest = Manifest(spark, lake, ROUTE)
    land(spark, at, lake, [range(10), range(10, 20)])
    monkeypatch.setattr(manifest, "generations", "/proc/cannot/write")
    with pytest.raises(Exception):  # noqa: B017 (whatever the file system says)
        manifest.compact()
    again = Manifest(spark, lake, ROUTE)
    assert numbers(again.read()) == list(range(20))
    assert again.compact() == 1 and numbers(again.read()) == list(range(20))


def test_resume_opens_only_what_lies_beyond(spark, at, tmp_path):
    lake = lake_of(tmp_path)
    manifest = Manifest(spark, lake, ROUTE)
    land(spark, at, lake, [range(k * 10, k * 10 + 10) for k in range(10)])
    points = spark.createDataFrame([("0", 84), ("1", 91)], "partition_id string, sequence_number bigint")
    expected = [i for i in range(100) if i > (84, 91)[i % 2]]
    assert [p.rsplit("=", 1)[-1] for p in manifest.paths(points)] == ["8", "9"]
    assert numbers(read_landed(spark, lake, ROUTE, after=points)) == expected
    manifest.compact(file_messages=10)
    every, beyond = manifest.paths(), manifest.paths(points)
    assert len(every) >= 8 and len(beyond) <= 5
    opened = read_landed(spark, lake, ROUTE, after=points)
    assert len(opened.inputFiles()) == len(beyond) and numbers(opened) == expected
    only_one = spark.createDataFrame([("0", 99)], "partition_id string, sequence_number bigint")
    assert numbers(read_landed(spark, lake, ROUTE, after=only_one)) == list(range(1, 100, 2))  # no point: read whole
