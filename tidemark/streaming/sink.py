"""Micro-batch sink: target rows, then control rows, the audit row, and the entry in the manifest.

Every write of a micro-batch replaces one folder named after the mapping, the run and the batch. Spark
replays a batch that was not committed under the same number, so a replay replaces what the
failed try left behind and nothing is written twice or lost. Batch numbers start again with a new
Spark checkpoint; the run, which is the checkpoint's own id, keeps such batches apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.envelope import parse_offset, to_target_rows, valid_messages
from tidemark.operators.batching import highest_message
from tidemark.operators.checkpoints import (
    control_rows,
    required_columns,
    unseen_messages,
    with_checkpoint_metadata,
)
from tidemark.session import written
from tidemark.streaming.lake import Lake, Route, read_table, route_folder, run_of
from tidemark.streaming.manifest import Manifest
from tidemark.streaming.retry import RetryPolicy


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def read_control(spark: SparkSession, lake: Lake, route: Route) -> DataFrame:
    """Control rows of the committed batches of one route; input of ``entries_of`` (F2)."""
    return Manifest(spark, lake, route).read(table="control")


def read_landed(spark: SparkSession, lake: Lake, route: Route, after: DataFrame | None = None) -> DataFrame:
    """Target rows of the committed batches of one route; with ``after`` those beyond resume points."""
    return Manifest(spark, lake, route).read(after)


class RouteSink:
    """Function for ``foreachBatch`` that lands one route's micro-batches.

    ``processor`` takes the target rows and the batch number in place of the table write (G1);
    returning False is a failure. ``resume`` holds resume points for a start without a Spark
    checkpoint: messages up to them are left out (J5). ``checkpoint`` is the folder of the query's Spark checkpoint, by default that of
    the route in the lake. ``on_failure`` is ``raise``, which leaves
    the batch uncommitted for replay, or ``dead_letter``, which keeps its messages in a table of
    their own and goes on without a checkpoint (S5, X7). ``drop_copies`` lands messages that occur
    twice in a micro-batch once (X11), at the price of a shuffle of the batch. ``cache`` keeps a
    micro-batch, in memory or on disk, between the passes for target and control rows; it pays for
    sources that are slow to read twice, such as brokers, and for shuffled batches.
    """

    def __init__(
        self,
        route: Route,
        lake: Lake,
        processor: Callable[[DataFrame, int], bool | None] | None = None,
        retry: RetryPolicy | None = None,
        on_failure: str = "raise",
        drop_copies: bool = False,
        cache: bool = False,
        resume: DataFrame | None = None,
        start_position: str = "earliest",
        checkpoint: str | None = None,
    ):
        if on_failure not in ("raise", "dead_letter"):
            raise ValueError(f"unknown failure policy: {on_failure}")
        self.route = route
        self.lake = lake
        self.processor = processor or self.write_target
        self.retry = retry or RetryPolicy()
        self.on_failure = on_failure
        self.drop_copies = drop_copies
        self.cache = cache
        # Resolved once: the tables they come from go on growing.
        self.resume = None if resume is None else written(resume, "resume")
        self.checkpoint = checkpoint or lake.checkpoint(route)
        self.run: str | None = None
        self.zones: DataFrame | None = None
        self.start_position = start_position

    def batch_folder(self, table: str, batch_id: int) -> str:
        return f"{route_folder(table, self.route)}/run={self.run or 'manual'}/batch_id={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.run is None or batch_id == 0:
            first, self.run = self.run is None, run_of(batch.sparkSession, self.checkpoint)
            # Only the first batch after a start can be one that landed whole before Spark noted it.
            if first and self.run != "manual" and Manifest(batch.sparkSession, self.lake, self.route).is_committed(self.run, batch_id):
                return
        self.write_unplaced(batch, batch_id)
        messages = self.accepted(batch)
        if messages.isEmpty():
            return  # nothing to write, no checkpoint (F3)
        if self.drop_copies:
            messages = messages.dropDuplicates(["partition_id", "sequence_number"])
        if not self.cache:
            return self.land(messages, batch_id)
        messages = messages.persist()
        try:
            self.land(messages, batch_id)
        finally:
            messages.unpersist()

    def land(self, messages: DataFrame, batch_id: int) -> None:
        """Target rows, control rows, audit row and manifest entry of one micro-batch, in this order."""
        spark = messages.sparkSession
        started = _now()
        rows = to_target_rows(messages, F.lit(started))

        def process():
            if self.processor(rows, batch_id) is False:
                raise RuntimeError("batch processor returned failure")

        errors: list[tuple] = []

        def note(attempt: int, error: Exception):
            errors.append((_now(), attempt, error))

        try:
            _, attempts = self.retry.call(process, note)
        except Exception as error:
            self.write_failures(spark, errors)
            if self.on_failure == "raise":
                seen = messages.agg(F.count("*").alias("messages"), F.count_distinct("partition_id").alias("partitions")).first()
                self.write_audit(spark, batch_id, started, seen.asDict(), False, len(errors), str(error), f"failed-{uuid.uuid4().hex}")
                raise
            counts = self.write_dead_letters(messages, batch_id, str(error))
            self.write_audit(spark, batch_id, started, counts, False, len(errors), str(error))
            return
        self.write_failures(spark, errors)
        counts = self.write_control(messages, batch_id)
        self.write_audit(spark, batch_id, started, counts, True, attempts, None)
        self.commit(spark, batch_id)

    def accepted(self, batch: DataFrame) -> DataFrame:
        """Messages of the batch to land: valid, and not seen before the start."""
        position = parse_offset(F.col("offset"), F.col("sequence_number"))
        messages = valid_messages(batch).filter("partition_id IS NOT NULL")
        if self.resume is not None:
            messages = unseen_messages(messages, self.resume, ["partition_id"], position, self.start_position)
        return messages.withColumn("_position", position)

    def write_target(self, rows: DataFrame, batch_id: int) -> None:
        folder = self.batch_folder(self.lake.target(self.route), batch_id)
        rows.write.mode("overwrite").parquet(folder)

    def write_control(self, messages: DataFrame, batch_id: int) -> dict:
        """Control rows of the batch in one write (S6, S15), and its size as seen by that pass.

        A pass over three columns of the batch, aggregated to one row per partition.
        """
        route = self.route
        seen = Observation()
        reached = (
            messages.groupBy("partition_id")
            .agg(
                highest_message(["sequence_number", "offset"], "_position").alias("_m"),
                F.count("*").alias("messages"),
                F.min("sequence_number").alias("low"),
                F.max("sequence_number").alias("high"),
            )
            .select("partition_id", "_m.*", "messages", "low", "high")
            .withColumn("waterlevel", parse_offset(F.col("offset"), F.col("sequence_number")))
            .observe(seen, F.sum("messages").alias("messages"), F.count("*").alias("partitions"))
            .persist()  # one row per partition, for the control rows and for the manifest
        )
        self.zones = reached
        described = with_checkpoint_metadata(
            reached, F.lit(route.namespace), F.lit(route.hub), F.lit(route.consumer_group)
        )
        rows = required_columns(control_rows(described, route.control_key))
        rows.write.mode("overwrite").parquet(self.batch_folder(self.lake.control, batch_id))
        return seen.get

    def commit(self, spark: SparkSession, batch_id: int) -> None:
        """Enter the batch in the manifest, which makes it visible to readers: the last write of a batch."""
        if self.zones is not None:
            Manifest(spark, self.lake, self.route).commit(self.zones, self.run or "manual", batch_id)
            self.zones.unpersist()
            self.zones = None

    def write_dead_letters(self, messages: DataFrame, batch_id: int, error: str) -> dict:
        """The messages of a batch that could not be written, with the reason."""
        folder = f"{self.batch_folder(self.lake.dead_letters(self.route), batch_id)}/reason=write"
        messages.drop("_position").withColumn("error", F.lit(error)).write.mode("overwrite").parquet(folder)
        letters = messages.sparkSession.read.parquet(folder)
        counts = letters.agg(F.count("*").alias("messages"), F.count_distinct("partition_id").alias("partitions"))
        return counts.first().asDict()

    def write_unplaced(self, batch: DataFrame, batch_id: int) -> None:
        """Messages of no partition have no checkpoint to reach; they go to the dead letters, with the reason."""
        unplaced = valid_messages(batch).filter("partition_id IS NULL")
        if not unplaced.isEmpty():
            folder = self.batch_folder(self.lake.dead_letters(self.route), batch_id)
            unplaced.withColumn("error", F.lit("partition_id is NULL")).write.mode("overwrite").parquet(f"{folder}/reason=no_partition")

    def write_audit(
        self,
        spark: SparkSession,
        batch_id: int,
        started: datetime,
        counts: dict,
        success: bool,
        attempts: int,
        error: str | None,
        attempt: str = "final",
    ) -> None:
        """The audit row of a try, in a folder of that try: one that fails and is replayed stays beside the final one."""
        messages, partitions = counts["messages"], counts["partitions"]
        updated = partitions if success else 0
        row = (self.route.mapping, batch_id, started, _now(), messages, partitions, success, updated, attempts, error)
        frame = spark.createDataFrame([row], schemas.BATCH_AUDIT).coalesce(1)
        folder = f"{route_folder(self.lake.audit, self.route)}/run={self.run or 'manual'}/batch={batch_id}"
        frame.write.mode("overwrite").parquet(f"{folder}/attempt={attempt}")

    def write_failures(self, spark: SparkSession, errors: list) -> None:
        """One row per failed attempt, to be triaged over all streams."""
        if not errors:
            return
        rows = [
            (ts, self.route.mapping, "write_batch", attempt, type(error).__name__, str(error))
            for ts, attempt, error in errors
        ]
        frame = spark.createDataFrame(rows, schemas.FAILURES).coalesce(1)
        frame.write.mode("append").parquet(route_folder(self.lake.failures, self.route))
