"""A partitioned, resumable message stream as a Spark data source.

Messages lie in files below one folder per partition, ``partition=<id>/<number>.parquet``, where the number is the sequence number of the file's first
row; the rows of a file ascend, and so do the files of a partition. A position is the sequence number from which a
partition is read next. The stream's offset is the map from partition to position, so a restart goes on in each partition where
that partition was left, whatever the others did, and a task reads a range of one partition from the files that hold it.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The reader travels to the executors by value, so these need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "partitioned_messages"
SCHEMA = "partition_id string, sequence_number bigint, offset string, enqueued_time timestamp, body string"
# Messages that one task reads at most.
TASK_MESSAGES = 50_000


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class Range(InputPartition):
    """Messages of one partition from one number up to another, and the files they lie in."""

    def __init__(self, partition: str, start: int, end: int, files: list[str]):
        super().__init__((partition, start, end))
        self.partition, self.start, self.end, self.files = partition, start, end, files


class PartitionedMessages(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> MessageReader:  # noqa: N802 (Spark's name)
        return MessageReader(self.options)


class MessageReader(DataSourceStreamReader):
    """Plans ranges of sequence numbers on the driver and reads them in tasks."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.most = int(options.get("maxMessages", 0))
        self.start = options.get("startingOffsets", "earliest")
        self.new = options.get("newPartitions", "earliest")
        self.checkpoint = options.get("checkpoint")
        if self.new not in ("earliest", "latest"):
            raise ValueError(f"newPartitions must be earliest or latest, not {self.new}")
        # The number after the last row of each partition's last file. Files do not change once they are there.
        self.ends: dict[str, tuple[str, int]] = {}
        self.planned: dict[str, int] | None = None
        self.landed: dict[str, int] = {}

    def files(self) -> dict[str, list[tuple[int, str]]]:
        """Per partition, its files with the number of their first row, in order."""
        fs, root = filesystem(self.path)
        found: dict[str, list[tuple[int, str]]] = {}
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            folder = info.path.rsplit("/", 2)[-2]
            if info.is_file and info.extension == "parquet" and folder.startswith("partition=") and not info.base_name.startswith(("_", ".")):
                found.setdefault(folder.removeprefix("partition="), []).append((int(info.base_name.removesuffix(".parquet")), info.path))
        return {p: sorted(f) for p, f in found.items()}

    def edge(self, partition: str, files: list[tuple[int, str]], where: str) -> int:
        """The first number of a partition, or the one after its last, which is in the footer of its last file."""
        if where == "earliest":
            return files[0][0]
        first, path = files[-1]
        if self.ends.get(partition, ("", 0))[0] != path:
            footer = pq.ParquetFile(path, filesystem=filesystem(self.path)[0]).metadata
            place = footer.schema.names.index("sequence_number")
            highest = [footer.row_group(i).column(place).statistics.max for i in range(footer.num_row_groups) if footer.row_group(i).num_rows]
            self.ends[partition] = (path, max(highest, default=first - 1) + 1)
        return self.ends[partition][1]

    def initialOffset(self) -> dict:  # noqa: N802 (Spark's name)
        found = self.files()
        if self.start in ("earliest", "latest"):
            return {p: self.edge(p, f, self.start) for p, f in found.items()}
        return {p: self.edge(p, f, self.new) for p, f in found.items()} | {p: int(n) for p, n in json.loads(self.start).items()}

    def known(self) -> dict[str, int]:
        """Where the last planned micro-batch ends. Spark does not say so after a restart; its log of offsets does."""
        if self.planned is None and self.checkpoint:
            fs, root = filesystem(self.checkpoint)
            logs = [i for i in fs.get_file_info(pafs.FileSelector(f"{root}/offsets", allow_not_found=True)) if i.base_name.isdigit()]
            if logs:
                with fs.open_input_stream(max(logs, key=lambda i: int(i.base_name)).path) as log:
                    self.planned = json.loads(log.read().decode().splitlines()[-1])
        if self.planned is None:
            self.planned = self.initialOffset()
        return self.planned

    def latestOffset(self) -> dict:  # noqa: N802
        """Where the next micro-batch ends: the cap is dealt out to the partitions by what each has waiting."""
        here, found = dict(self.known()), self.files()
        for p, f in found.items():
            here.setdefault(p, self.edge(p, f, self.new))
        waiting = {p: max(0, self.edge(p, f, "latest") - here[p]) for p, f in found.items()}
        total = sum(waiting.values())
        if self.most and total > self.most:
            # Shares are rounded up, so no partition with something waiting stands still for long; the furthest behind comes first.
            left = self.most
            for p in sorted(waiting, key=lambda p: (-waiting[p], p)):
                waiting[p] = min(left, -(-waiting[p] * self.most // total))
                left -= waiting[p]
        self.planned = {p: here[p] + waiting.get(p, 0) for p in here}
        return self.planned

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out, found = [], self.files()
        for p, upto in sorted(end.items()):
            files = found.get(p, [])
            begin = start.get(p)
            if begin is None:  # a partition that was not there before
                begin = self.edge(p, files, self.new) if files else upto
            for low in range(begin, upto, TASK_MESSAGES):
                high = min(upto, low + TASK_MESSAGES)
                holding = [path for i, (first, path) in enumerate(files) if first < high and (i + 1 == len(files) or files[i + 1][0] > low)]
                if holding:
                    out.append(Range(p, low, high, holding))
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        names = ["partition_id", "sequence_number", "offset", "enqueued_time", "body"]
        fs, _ = filesystem(self.path)
        wanted = (pc.field("sequence_number") >= partition.start) & (pc.field("sequence_number") < partition.end)
        for path in partition.files:
            for batch in ds.dataset(path, filesystem=fs, format="parquet").to_batches(columns=names[1:], filter=wanted, batch_size=8192):
                if batch.num_rows:
                    own = pa.array([partition.partition] * batch.num_rows, pa.string())
                    times = batch.column("enqueued_time").cast(pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
                    columns = [own, batch.column("sequence_number"), batch.column("offset").cast(pa.string()), times, batch.column("body").cast(pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, names)

    def commit(self, end: dict) -> None:
        """Everything before ``end`` has landed; no partition may run backwards."""
        behind = {p: n for p, n in end.items() if n < self.landed.get(p, n)}
        if behind:
            raise RuntimeError(f"positions behind what has landed: {behind}")
        self.landed = dict(end)


def partitioned_stream(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    max_messages: int | None = None,
    start: str | DataFrame = "earliest",
    new_partitions: str = "earliest",
) -> DataFrame:
    """Messages of a partitioned folder, in the raw message shape without properties.

    ``checkpoint`` is the checkpoint folder of the query that will read the stream, as its only source: positions are taken up from there after a
    restart. ``max_messages`` bounds a micro-batch (X1), counted in sequence numbers; a trigger that runs once, like ``availableNow``, takes one such
    micro-batch, so a backlog is drained by a repeating one. ``start`` is ``earliest``, ``latest`` or resume points (``partition_id``,
    ``sequence_number``), one row per partition: reading begins after each, and at ``new_partitions`` where there is none (S2). It counts only until
    the query has a checkpoint. Partitions that appear later begin at ``new_partitions``. Folders have to be reachable as paths
    from the driver and the executors; each trigger lists the folder.
    """
    spark.dataSource.register(PartitionedMessages)
    if isinstance(start, DataFrame):
        start = json.dumps({r["partition_id"]: r["sequence_number"] + 1 for r in start.select("partition_id", "sequence_number").collect()})
    options = {"path": folder, "checkpoint": checkpoint, "startingOffsets": start, "newPartitions": new_partitions, "maxMessages": max_messages or 0}
    return spark.readStream.format(NAME).options(**options).load().withColumn("enqueued_time", F.col("enqueued_time").cast("timestamp_ntz"))


def write_partitioned(messages: DataFrame, folder: str, span: int = TASK_MESSAGES) -> None:
    """Append messages to a partitioned folder, in files of at most ``span`` sequence numbers.

    A file appears under its name once it is whole. Numbers must not repeat within a partition, nor lie before those already there.
    """

    def write(rows: pa.Table) -> pa.Table:
        fs, root = filesystem(folder)
        rows = rows.sort_by("sequence_number")
        first = rows.column("sequence_number")[0].as_py()
        at = f"{root}/partition={rows.column('partition_id')[0].as_py()}"
        fs.create_dir(at, recursive=True)
        pq.write_table(rows.drop(["partition_id", "span"]), f"{at}/.{first:020d}.tmp", filesystem=fs)
        fs.move(f"{at}/.{first:020d}.tmp", f"{at}/{first:020d}.parquet")
        return pa.table({"messages": [rows.num_rows]})

    wanted = messages.select("partition_id", F.floor(F.col("sequence_number") / span).alias("span"), "sequence_number", "offset", "enqueued_time", "body")
    wanted.groupBy("partition_id", "span").applyInArrow(write, "messages bigint").agg(F.sum("messages")).collect()
