"""What a route has landed: a log of committed micro-batches, merged generations, and zone maps of both.

A micro-batch is landed once its entry is in the log, which is written after its target and control rows. Readers go by the log, so the
rows of a batch that died on the way are invisible. An entry has, per partition, the smallest and the largest sequence
number, so a reader that resumes opens only what lies beyond its resume points.

``compact`` merges the folders of all logged batches into few files in the order of partition and sequence number, and writes a
generation: the list of these files with their zone maps, and up to which batch each run is merged. It counts from the moment it is written
whole; batches landed meanwhile stay in the log. ``expire`` removes the folders that a generation before the last has merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.operators.joins import lookup_join
from tidemark.session import folder_exists, remove_folder, subfolders
from tidemark.streaming.lake import Lake, Route, read_table, route_folder

TARGET, CONTROL = "target", "control"
MERGED = "merged"  # kind of the rows that say up to which batch a run is merged
TEXT, NUMBER = T.StringType(), T.LongType()
ZONE = {"partition_id": TEXT, "low": NUMBER, "high": NUMBER, "messages": NUMBER}
BATCH = {"run": TEXT, "batch_id": NUMBER}
LOG = T.StructType([T.StructField(name, kind) for name, kind in {**ZONE, **BATCH}.items()])
GENERATION = T.StructType([T.StructField(name, kind) for name, kind in {"kind": TEXT, "path": TEXT, **ZONE, **BATCH, "generation": NUMBER}.items()])
# Messages in a merged file at most, about.
FILE_MESSAGES = 1_000_000


class Manifest:
    """The committed batches of one route."""

    def __init__(self, spark: SparkSession, lake: Lake, route: Route):
        self.spark, self.lake, self.route = spark, lake, route
        self.log = route_folder(f"{lake.root}/manifest/log", route)
        self.generations = route_folder(f"{lake.root}/manifest/generations", route)
        self.tables = {TARGET: (route_folder(lake.target(route), route), schemas.TARGET), CONTROL: (route_folder(lake.control, route), schemas.CONTROL)}

    def merged_folder(self, table: str) -> str:
        return route_folder(f"{self.lake.root}/merged/{table}", self.route)

    def commit(self, zones: DataFrame, run: str, batch_id: int) -> None:
        """Enter a batch, from ``zones(partition_id, low, high, messages)``. Entering it again replaces the entry."""
        zones.select(*ZONE).coalesce(1).write.mode("overwrite").parquet(f"{self.log}/run={run}/batch_id={batch_id}")

    def is_committed(self, run: str, batch_id: int) -> bool:
        """Whether a batch is in the log, whole, or merged."""
        if folder_exists(self.spark, f"{self.log}/run={run}/batch_id={batch_id}/_SUCCESS"):
            return True
        return folder_exists(self.spark, self.generations) and not self.merged().filter((F.col("run") == run) & (F.col("upto") >= batch_id)).isEmpty()

    def generation(self) -> DataFrame:
        """Rows of the last generation; none before the first."""
        every = read_table(self.spark, self.generations, GENERATION)
        last = every.agg(F.max("generation")).first()[0]
        return every.filter(F.col("generation") == F.lit(last))

    def merged(self) -> DataFrame:
        return self.generation().filter(F.col("kind") == MERGED).select("run", F.col("batch_id").alias("upto"))

    def logged(self) -> DataFrame:
        """Entries of the log that no generation covers: one row per batch and partition."""
        merged = F.broadcast(self.merged())  # one row per run
        return read_table(self.spark, self.log, LOG).join(merged, "run", "left").filter("upto IS NULL OR batch_id > upto").drop("upto")

    def entries(self, table: str = TARGET) -> DataFrame:
        """Zones of all that has landed: ``path``, ``partition_id``, ``low``, ``high``, ``messages``. A path is a file of the generation or a batch's folder."""
        folder, _ = self.tables[table]
        path = F.concat(F.lit(f"{folder}/run="), "run", F.lit("/batch_id="), F.col("batch_id").cast("string"))
        zones = list(ZONE)
        return self.generation().filter(F.col("kind") == table).select("path", *zones).unionByName(self.logged().select(path.alias("path"), *zones))

    def paths(self, after: DataFrame | None = None, table: str = TARGET) -> list[str]:
        """Files and folders to open: those that reach beyond the resume points ``after(partition_id, sequence_number)``, if given.

        Their number is that of the batches since the last generation and of its files, not of all batches.
        """
        wanted = self.entries(table)
        if after is not None:
            points = after.select("partition_id", F.col("sequence_number").alias("_reached"))
            wanted = lookup_join(wanted, points, ["partition_id"]).filter("_reached IS NULL OR high IS NULL OR high > _reached")
        return sorted(r["path"] for r in wanted.select("path").distinct().collect())

    def read(self, after: DataFrame | None = None, table: str = TARGET) -> DataFrame:
        """Landed rows; with ``after``, one row per partition, those beyond the resume points. Partitions without one are read whole."""
        _, schema = self.tables[table]
        paths = self.paths(after, table)
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        if after is None:
            return rows
        points = after.select("partition_id", F.col("sequence_number").alias("_reached"))
        return lookup_join(rows, points, ["partition_id"]).filter("_reached IS NULL OR sequence_number IS NULL OR sequence_number > _reached").select(*schema.names)

    def compact(self, file_messages: int = FILE_MESSAGES) -> int | None:
        """Merge what the log and the last generation hold into a new generation; its number, or None if the log is empty.

        One at a time for a route: of two, the later one fails when it writes the generation.
        """
        number = (self.generation().agg(F.max("generation")).first()[0] or 0) + 1
        log = self.logged().select("run", "batch_id", "messages").collect()  # as of now; batches that land later stay in the log
        if not log:
            return None
        upto: dict[str, int] = {r["run"]: r["batch_id"] for r in self.merged().withColumnRenamed("upto", "batch_id").collect()}
        for r in log:
            upto[r["run"]] = max(upto.get(r["run"], -1), r["batch_id"])
        rows = self.spark.createDataFrame(list(upto.items()), "run string, batch_id bigint").select(F.lit(MERGED).alias("kind"), "run", "batch_id")
        total = self.entries().agg(F.sum("messages")).first()[0] or 0
        files = max(1, -(-total // file_messages))
        for table, (_, schema) in self.tables.items():
            here = f"{self.merged_folder(table)}/generation={number}"
            landed = self.read(table=table)
            if table == TARGET:
                landed = landed.repartitionByRange(files, "partition_id", "sequence_number").sortWithinPartitions("partition_id", "sequence_number")
                position = F.col("sequence_number")
            else:
                landed, position = landed.coalesce(1), F.lit(None).cast("bigint")
            landed.write.mode("overwrite").parquet(here)
            zones = self.spark.read.schema(schema).parquet(here).groupBy(F.input_file_name().alias("path"), "partition_id").agg(F.min(position).alias("low"), F.max(position).alias("high"), F.count("*").alias("messages"))
            rows = rows.unionByName(zones.withColumn("kind", F.lit(table)), allowMissingColumns=True)
        names = [n for n in GENERATION.names if n != "generation"]
        rows.select(*names).coalesce(1).write.mode("errorifexists").parquet(f"{self.generations}/generation={number}")
        return number

    def expire(self) -> int:
        """Remove the folders of merged batches and of generations before the last; how many. Readers of the last generation do not use them."""
        merged = {r["run"]: r["upto"] for r in self.merged().collect()}
        if not merged:
            return 0
        number = self.generation().agg(F.max("generation")).first()[0]
        done = [
            path
            for top in (self.log, *[folder for folder, _ in self.tables.values()])
            for run, below in self._below(top)
            for batch, path in self._below(below)
            if run in merged and int(batch) <= merged[run]
        ]
        old = [path for top in (self.generations, *map(self.merged_folder, self.tables)) for g, path in self._below(top) if int(g) < number]
        return sum(remove_folder(self.spark, path) for path in done + old)

    def _below(self, folder: str) -> list[tuple[str, str]]:
        """Values and paths of the folders in a folder that are named ``key=value``."""
        named = [(path.rsplit("/", 1)[-1], path) for path in subfolders(self.spark, folder)]
        return [(name.split("=", 1)[1], path) for name, path in named if "=" in name]
