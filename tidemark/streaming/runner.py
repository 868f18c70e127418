"""Running routes as streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import folder_exists, subfolders, written
from tidemark.streaming.sink import Lake, Route, RouteSink, run_of


def start_route(stream: DataFrame, sink: RouteSink, every: str | None = None) -> StreamingQuery:
    """Start the query of one route.

    ``every`` is the trigger interval, the bound on a batch's age (X2). Without it the query
    takes what is there now and ends. Restarting on the same lake continues after the last
    committed batch (X5).
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    # The query's jobs run in a pool of their own, which counts if the session's scheduler mode is FAIR.
    context = stream.sparkSession.sparkContext
    pool = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", sink.route.mapping)
    try:
        return _started(stream, sink, trigger)
    finally:
        context.setLocalProperty("spark.scheduler.pool", pool)


def _started(stream: DataFrame, sink: RouteSink, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.queryName(sink.route.mapping)
        .foreachBatch(sink)
        .option("checkpointLocation", sink.checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_routes(
    routes: Iterable[Route],
    lake: Lake,
    open_stream: Callable[[Route], DataFrame],
    every: str | None = None,
    make_sink: Callable[[Route, Lake], RouteSink] = RouteSink,
) -> dict[str, StreamingQuery]:
    """One query per route, by mapping label (X6). A stream that cannot start stops the others.

    One source may have several targets. The same mapping twice is refused.
    """
    queries: dict[str, StreamingQuery] = {}
    routes = list(routes)
    if len({route.mapping for route in routes}) < len(routes):
        raise ValueError("a mapping occurs twice")
    try:
        for route in routes:
            queries[route.mapping] = start_route(open_stream(route), make_sink(route, lake), every)
    except Exception:
        stop_all(queries.values())
        raise
    return queries


def wait_all(queries: Iterable[StreamingQuery], poll_seconds: float = 1) -> None:
    """Wait for all queries; the first to fail stops the rest and its error is raised."""
    running = list(queries)
    pending = list(running)
    try:
        while pending:
            ended = [q for q in pending if not q.isActive]
            for query in ended:
                query.awaitTermination()  # raises the error it ended with
            pending = [q for q in pending if q not in ended]
            if pending:
                time.sleep(poll_seconds)
    except Exception:
        stop_all(running)
        raise


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        query.stop()


def drain(query: StreamingQuery) -> None:
    """Land everything that has arrived, then stop."""
    query.processAllAvailable()
    query.stop()


class Deduplicated:
    """Function for ``foreachBatch`` that hands on messages without those delivered again within ``delay`` (X11).

    A copy is a message whose keys a message of an earlier micro-batch has, at most ``delay`` away in ``time``, or an earlier one of the same
    micro-batch. Everything else is handed on, however late it is: a first delivery is never dropped. Messages with a NULL
    key cannot be told to be copies and stay.

    ``land`` must replace what a failed try of the same batch left behind. The keys of a batch are written after it, in a folder
    of the run (see ``run_of``) and the batch; a try that fails in between is repeated, so no message is lost. Beside them goes a zone map: per
    value of the other keys, the range of the last key and of ``time``. A batch reads the keys of only those batches whose zones it
    meets within ``delay``, so one of a stream that comes in order reads none. Zones are kept by day, and only the days in reach are read.
    """

    def __init__(self, folder: str, checkpoint: str, land: Callable[[DataFrame, int], None], time: str, delay: str, keys: Iterable[str] = ("partition_id", "sequence_number")):
        self.folder, self.checkpoint, self.land, self.time, self.keys = folder, checkpoint, land, time, list(keys)
        self.delay = F.expr(f"INTERVAL '{delay}'")
        self.zones = f"{folder.rstrip('/')}-zones"
        self.run: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.run is None or batch_id == 0:
            self.run = run_of(spark, self.checkpoint)
        run = self.run
        batch = batch.persist()
        try:
            fresh = self.fresh(batch, run, batch_id).persist()
            try:
                self.land(fresh, batch_id)
                kept = fresh.select(*self.keys, F.col(self.time).alias("_time")).dropna(subset=self.keys)
                days = F.explode(F.sequence(F.to_date("from"), F.to_date("upto"))).alias("day")
                zones = self.zones_of(kept, "_time").select("*", days, F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch_id"))
                zones.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "run", "batch_id").parquet(self.zones)
                kept.write.mode("overwrite").parquet(self.batch_folder(run, batch_id))
            finally:
                fresh.unpersist()
        finally:
            batch.unpersist()

    def fresh(self, batch: DataFrame, run: str, batch_id: int) -> DataFrame:
        told = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
        once = batch.filter(told).dropDuplicates(self.keys)
        met = self.met(once, run, batch_id)
        if met:
            known = T.StructType([*[batch.schema[k] for k in self.keys], T.StructField("_time", batch.schema[self.time].dataType)])
            landed = batch.sparkSession.read.schema(known).parquet(*met).select(*[F.col(k).alias(f"_seen_{k}") for k in self.keys], "_time")
            near = F.col("_time").between(F.col(self.time) - self.delay, F.col(self.time) + self.delay)
            same = reduce(and_, [F.col(k) == F.col(f"_seen_{k}") for k in self.keys])
            once = once.join(landed, same & near, "left_anti")
        return once.unionByName(batch.filter(~told))

    def batch_folder(self, run: str, batch_id: int) -> str:
        return f"{self.folder}/run={run}/batch_id={batch_id}"

    def zones_of(self, rows: DataFrame, time: str) -> DataFrame:
        *others, last = self.keys
        return rows.groupBy(*others).agg(F.min(last).alias("low"), F.max(last).alias("high"), F.min(time).alias("from"), F.max(time).alias("upto")).filter("upto IS NOT NULL")

    def met(self, once: DataFrame, run: str, batch_id: int) -> list[str]:
        """Key folders of the batches, other than this one, that a message of ``once`` may be a copy of."""
        spark, others = once.sparkSession, self.keys[:-1]
        own = written(self.zones_of(once, self.time), "zones")  # one row per value of the other keys
        first, last = own.agg(F.to_date(F.min("from") - self.delay), F.to_date(F.max("upto") + self.delay)).first()
        paths = [] if first is None else [p for p in subfolders(spark, self.zones) if str(first) <= p.rsplit("day=", 1)[-1] <= str(last)]
        if not paths:
            return []
        names = T.StructType([T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
        known = spark.read.schema(T.StructType([*own.schema, *names])).option("basePath", self.zones).parquet(*paths)
        known = known.filter((F.col("run") != run) | (F.col("batch_id") != batch_id)).select(*others, "run", "batch_id", *[F.col(c).alias(f"_{c}") for c in ("low", "high", "from", "upto")])
        overlap = (F.col("_low") <= F.col("high")) & (F.col("low") <= F.col("_high")) & (F.col("_from") - self.delay <= F.col("upto")) & (F.col("from") <= F.col("_upto") + self.delay)
        pairs = own.join(known, others) if others else own.crossJoin(known)  # without other keys, one row on the left
        folders = [self.batch_folder(r["run"], r["batch_id"]) for r in pairs.filter(overlap).select("run", "batch_id").distinct().collect()]
        return sorted(f for f in folders if folder_exists(spark, f))  # zones are written first
