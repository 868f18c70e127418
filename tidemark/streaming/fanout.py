"""Many routes from one scan of their source."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import remove_folder
from tidemark.streaming.lake import Lake, Route, run_of
from tidemark.streaming.sink import RouteSink

# Routes of a micro-batch that land at the same time.
AT_ONCE = 4


class FanOut:
    """Function for ``foreachBatch`` that lands each message of a stream in every route it belongs to.

    The micro-batch is read once and written to a staging folder by route, so each route reads its own share however many there are; the
    folder is removed when the batch is done. ``belongs`` says which messages are a route's; a message of none is dropped, one of several
    lands in each. Routes land side by side, each in a scheduler pool named after its mapping, which counts if the session's scheduler mode is FAIR.

    A route that fails does not keep the others from landing; then the batch fails with its error, and Spark replays it. Routes that have
    entered the batch in their manifest leave it out of the replay, so only the failed ones land again.
    """

    def __init__(
        self,
        routes: Iterable[Route],
        lake: Lake,
        belongs: Callable[[Route], Column],
        checkpoint: str,
        make_sink: Callable[..., RouteSink] = RouteSink,
        at_once: int = AT_ONCE,
    ):
        routes = list(routes)
        if len({route.mapping for route in routes}) < len(routes):
            raise ValueError("a mapping occurs twice")
        self.sinks = [make_sink(route, lake, checkpoint=checkpoint) for route in routes]
        self.lake, self.belongs, self.checkpoint, self.at_once = lake, belongs, checkpoint, at_once

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{self.lake.root}/staging/run={run_of(spark, self.checkpoint)}/batch_id={batch_id}"
        places = F.filter(F.array(*[F.when(self.belongs(s.route), F.lit(i)) for i, s in enumerate(self.sinks)]), lambda i: i.isNotNull())
        batch.select("*", F.explode(places).alias("_route")).write.mode("overwrite").partitionBy("_route").parquet(staged)
        shape = T.StructType([*batch.schema, T.StructField("_route", T.IntegerType())])
        # Only the partition column is read; there is one row per route.
        present = [r["_route"] for r in spark.read.schema(shape).parquet(staged).select("_route").distinct().collect()]

        def land(place: int) -> Exception | None:
            sink = self.sinks[place]
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", sink.route.mapping)
            try:
                sink(spark.read.schema(batch.schema).parquet(f"{staged}/_route={place}"), batch_id)
            except Exception as error:
                return error
            return None

        with ThreadPoolExecutor(self.at_once) as pool:
            failed = [(self.sinks[i].route.mapping, e) for i, e in zip(present, pool.map(land, present), strict=True) if e is not None]
        if failed:
            raise RuntimeError("not landed: " + "; ".join(f"{mapping}: {error}" for mapping, error in failed)) from failed[0][1]
        remove_folder(spark, staged)


def start_fan_out(stream: DataFrame, fan_out: FanOut, every: str | None = None) -> StreamingQuery:
    """Start the one query of many routes; ``every`` as in ``start_route``."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return stream.writeStream.foreachBatch(fan_out).option("checkpointLocation", fan_out.checkpoint).trigger(**trigger).start()
