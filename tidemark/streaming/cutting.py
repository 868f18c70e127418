"""Batches by size or age over a live stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.age_batches import batches_by_size_or_age, open_batches
from tidemark.operators.batching import BATCH_SECONDS, BATCH_SIZE


class BatchCutter:
    """Function for ``foreachBatch`` that numbers the messages of a stream in batches.

    A batch may span micro-batches: the one left open per key is written beside the numbered rows
    and taken up by the next micro-batch. Both writes replace a folder named after the micro-batch,
    so a replay repeats them. Micro-batches have to follow the arrival order.
    """

    def __init__(
        self,
        folder: str,
        keys: list[str],
        arrival: str = "arrival",
        clock: str = "enqueued_time",
        size: int = BATCH_SIZE,
        max_wait_seconds: float = BATCH_SECONDS,
    ):
        self.folder = folder
        self.keys = keys
        self.arrival = arrival
        self.clock = clock
        self.size = size
        self.max_wait_seconds = max_wait_seconds

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        narrow = messages.select(*self.keys, self.arrival, self.clock)
        opened = spark.read.parquet(self.open_folder(batch_id - 1)) if batch_id else None
        cut = batches_by_size_or_age(
            narrow, self.keys, self.arrival, self.clock, self.size, self.max_wait_seconds, opened=opened
        )
        rows = f"{self.folder}/rows/batch_id={batch_id}"
        cut.write.mode("overwrite").parquet(rows)
        left_open = open_batches(spark.read.schema(cut.schema).parquet(rows), narrow, self.keys, self.clock, opened)
        left_open.write.mode("overwrite").parquet(self.open_folder(batch_id))

    def open_folder(self, batch_id: int) -> str:
        return f"{self.folder}/open/batch_id={batch_id}"

    def rows(self, spark: SparkSession) -> DataFrame:
        """Keys, arrival and batch number of every message cut so far."""
        return spark.read.parquet(f"{self.folder}/rows").select(*self.keys, self.arrival, "batch_no")
