"""Routes, the folders they land in, and reading these."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.checkpoints import ControlKey
from tidemark.session import folder_exists


@dataclass(frozen=True)
class Route:
    """One stream and the table it lands in."""

    source_key: str
    target_key: str
    namespace: str
    hub: str
    consumer_group: str
    database: str
    schema: str
    table: str = "events"

    @property
    def mapping(self) -> str:
        return f"{self.source_key}->{self.target_key}"

    @property
    def control_key(self) -> ControlKey:
        return ControlKey(self.namespace, self.hub, self.database, self.schema, self.table)


@dataclass(frozen=True)
class Lake:
    """Folders of the tables below one root that all executors can reach."""

    root: str

    def target(self, route: Route) -> str:
        return f"{self.root}/target/{route.database}/{route.schema}/{route.table}"

    @property
    def control(self) -> str:
        return f"{self.root}/control"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def failures(self) -> str:
        return f"{self.root}/failures"

    def dead_letters(self, route: Route) -> str:
        return f"{self.root}/dead_letters/{route.database}/{route.schema}/{route.table}"

    def checkpoint(self, route: Route) -> str:
        return f"{self.root}/checkpoints/{route.source_key}/{route.target_key}"


def route_folder(table: str, route: Route) -> str:
    return f"{table}/source_key={route.source_key}/target_key={route.target_key}"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: the same after every restart on it. Without a checkpoint, ``manual``."""
    if not folder_exists(spark, f"{checkpoint}/metadata"):
        return "manual"
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def read_table(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All folders of a table, whether their batches are committed or not (see ``Manifest``); empty before the first one is written."""
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder).select(*schema.names)
