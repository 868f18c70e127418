"""The partitioned source: planning on its own, and as a stream that is stopped and restarted."""

import json
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.sources import partitioned as P
from tidemark.sources.partitioned import MessageReader, partitioned_stream, write_partitioned

NOON = datetime(2025, 10, 17, 12)


def file_of(folder, partition, first, n):
    at = folder / f"partition={partition}"
    at.mkdir(parents=True, exist_ok=True)
    numbers = list(range(first, first + n))
    pq.write_table(pa.table({"sequence_number": numbers, "offset": [str(i * 64) for i in numbers], "enqueued_time": pa.array([NOON] * n, pa.timestamp("us")), "body": [f"{partition}-{i}" for i in numbers]}), at / f"{first:020d}.parquet")


def reader(folder, **options):
    return MessageReader({"path": str(folder), **options})


def read(source, start, end):
    return {p: [i for r in ranges for b in source.read(r) for i in b.column("sequence_number").to_pylist()] for p, ranges in by_partition(source.partitions(start, end)).items()}


def by_partition(ranges):
    out = {}
    for r in ranges:
        out.setdefault(r.partition, []).append(r)
    return out


def test_positions_move_per_partition_within_the_cap(tmp_path):
    file_of(tmp_path, "a", 0, 60)
    file_of(tmp_path, "a", 60, 40)
    file_of(tmp_path, "b", 500, 10)
    source = reader(tmp_path, maxMessages="30")
    at, seen, rounds = source.initialOffset(), {"a": [], "b": []}, 0
    assert at == {"a": 0, "b": 500}
    while (then := source.latestOffset()) != at:
        assert 0 < sum(then[p] - at[p] for p in then) <= 30
        for p, numbers in read(source, at, then).items():
            seen[p] += numbers
        source.commit(then)
        at, rounds = then, rounds + 1
    assert rounds == 4 and seen == {"a": list(range(100)), "b": list(range(500, 510))}


def test_ranges_open_only_the_files_that_hold_them(tmp_path):
    for k in range(10):
        file_of(tmp_path, "a", k * 10, 10)
    ranges = reader(tmp_path).partitions({"a": 25}, {"a": 41})
    assert [f.rsplit("/", 1)[-1] for r in ranges for f in r.files] == [f"{k:020d}.parquet" for k in (20, 30, 40)]


def test_long_ranges_are_split_over_tasks(tmp_path, monkeypatch):
    monkeypatch.setattr(P, "TASK_MESSAGES", 16)
    file_of(tmp_path, "a", 0, 50)
    source = reader(tmp_path)
    assert [(r.start, r.end) for r in source.partitions({"a": 0}, {"a": 50})] == [(0, 16), (16, 32), (32, 48), (48, 50)]
    assert read(source, {"a": 0}, {"a": 50}) == {"a": list(range(50))}


@pytest.mark.parametrize(("start", "expected"), [("earliest", {"a": 5, "b": 0}), ("latest", {"a": 15, "b": 3}), ('{"a": 9}', {"a": 9, "b": 0})])
def test_start_positions(tmp_path, start, expected):
    file_of(tmp_path, "a", 5, 10)
    file_of(tmp_path, "b", 0, 3)
    assert reader(tmp_path, startingOffsets=start).initialOffset() == expected


@pytest.mark.parametrize(("new", "numbers"), [("earliest", [7, 8, 9]), ("latest", None)])
def test_partitions_that_appear_later(tmp_path, new, numbers):
    file_of(tmp_path, "a", 0, 3)
    source = reader(tmp_path, newPartitions=new)
    at = source.latestOffset()
    file_of(tmp_path, "z", 7, 3)
    then = source.latestOffset()
    assert read(source, at, then).get("z") == numbers


def test_restart_goes_on_where_the_log_of_offsets_ends(tmp_path):
    file_of(tmp_path / "in", "a", 0, 100)
    offsets = tmp_path / "checkpoint" / "offsets"
    offsets.mkdir(parents=True)
    (offsets / "9").write_text('v1\n{"batchWatermarkMs":0}\n{"a": 30}')
    (offsets / "10").write_text('v1\n{"batchWatermarkMs":0}\n{"a": 40}')
    source = reader(tmp_path / "in", maxMessages="5", checkpoint=str(tmp_path / "checkpoint"))
    assert source.latestOffset() == {"a": 45}


def test_positions_do_not_run_backwards(tmp_path):
    source = reader(tmp_path)
    source.commit({"a": 5})
    with pytest.raises(RuntimeError, match="behind what has landed"):
        source.commit({"a": 4})


def test_an_empty_folder_has_no_positions(tmp_path):
    source = reader(tmp_path / "none")
    assert source.initialOffset() == {} and source.latestOffset() == {} and source.partitions({}, {}) == []


def test_unknown_policy_is_refused(tmp_path):
    with pytest.raises(ValueError, match="newPartitions"):
        reader(tmp_path, newPartitions="sometimes")


def landed(spark, folder):
    return sorted((r["partition_id"], r["sequence_number"], r["offset"], r["body"]) for r in spark.read.parquet(f"{folder}/out").collect())


def run(spark, folder, **options):
    stream = partitioned_stream(spark, f"{folder}/in", f"{folder}/checkpoint", **options)
    query = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    return batches


def test_stream_restarts_per_partition(spark, tmp_path):
    shape = "partition_id string, sequence_number bigint, offset string, enqueued_time timestamp_ntz, body string"

    def rows(partition, numbers):
        return [(partition, i, str(i * 64), NOON, f"{partition}-{i}") for i in numbers]

    first = rows("0", range(20)) + rows("1", range(100, 105))
    write_partitioned(spark.createDataFrame(first, shape), f"{tmp_path}/in", span=10)
    # Reading starts after the resume point of partition 0, and at the beginning of the one that has none.
    points = spark.createDataFrame([("0", 4)], "partition_id string, sequence_number bigint")
    batches = run(spark, tmp_path, max_messages=8, start=points)
    assert sum(batches) == 20 and max(batches) <= 8
    assert landed(spark, tmp_path) == sorted((p, n, o, b) for p, n, o, _, b in first if (p, n) > ("0", 4))

    more = rows("0", range(20, 23)) + rows("2", range(50, 54))  # 1 has nothing new, 2 is new
    write_partitioned(spark.createDataFrame(more, shape), f"{tmp_path}/in", span=10)
    batches = run(spark, tmp_path, max_messages=5)
    assert sum(batches) == 7 and max(batches) <= 5
    assert landed(spark, tmp_path) == sorted((p, n, o, b) for p, n, o, _, b in first + more if (p, n) > ("0", 4))
    last = max((tmp_path / "checkpoint" / "offsets").glob("[0-9]*"), key=lambda f: int(f.name))
    assert json.loads(last.read_text().splitlines()[-1]) == {"0": 23, "1": 105, "2": 54}
