"""Which stream goes to which table. Route tables are configuration: some hundreds of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import mapping_label
from tidemark.operators.joins import lookup_join

# Table that receives a stream whose target names none.
DEFAULT_TABLE = "events"

TARGET_SETTINGS = ["database", "schema_name", "table_name"]


def complete_targets(targets: DataFrame) -> DataFrame:
    """Targets with all their settings; the others are skipped."""
    kept = targets
    for name in TARGET_SETTINGS:
        kept = kept.filter(F.trim(name) != "")
    return kept


def incomplete_sources(sources: DataFrame) -> DataFrame:
    """Named sources without a consumer group: an error in the configuration."""
    group = F.trim(F.coalesce("consumer_group", F.lit("")))
    return sources.filter(F.col("name").isNotNull() & (group == ""))


def require_complete_sources(sources: DataFrame) -> DataFrame:
    """Raise, when read, at the first named source without a consumer group."""
    missing = F.raise_error(F.concat(F.lit("consumer group is required for "), F.col("source_key"))).cast("string")
    group = F.when(F.trim("consumer_group") != "", F.col("consumer_group"))
    return sources.filter(F.col("name").isNotNull()).withColumn("consumer_group", F.coalesce(group, missing))


def match_routes(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Sources joined to targets of the same number (J1, J8), with the mapping label."""
    return sources.join(complete_targets(targets), "route_no").withColumn(
        "mapping", mapping_label(F.col("source_key"), F.col("target_key"))
    )


def find_route(routes: DataFrame, source_key: str) -> DataFrame:
    """The route of one source, by its key."""
    return routes.filter(F.col("source_key") == source_key)


def unmatched(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Keys on either side without a partner."""
    complete = complete_targets(targets)
    lone_sources = sources.join(complete, "route_no", "left_anti")
    lone_targets = complete.join(sources, "route_no", "left_anti")
    return lone_sources.select(F.lit("source").alias("side"), F.col("source_key").alias("key")).unionByName(
        lone_targets.select(F.lit("target").alias("side"), F.col("target_key").alias("key"))
    )


def invalid_mappings(mappings: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Mappings that name a source or target that does not exist."""
    no_source = mappings.join(sources, "source_key", "left_anti").withColumn("missing", F.lit("source"))
    no_target = mappings.join(targets, "target_key", "left_anti").withColumn("missing", F.lit("target"))
    columns = ["source_key", "target_key", "missing"]
    return no_source.select(*columns).unionByName(no_target.select(*columns))


def configuration_counts(sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Numbers of sources, complete targets and mappings in one row."""
    kinds = [
        sources.select(F.lit("sources").alias("kind")),
        complete_targets(targets).select(F.lit("targets").alias("kind")),
        match_routes(sources, targets).select(F.lit("mappings").alias("kind")),
    ]
    rows = kinds[0].unionByName(kinds[1]).unionByName(kinds[2])
    return rows.agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in ("sources", "targets", "mappings")])


def route_messages(
    messages: DataFrame, routes: DataFrame, on: list[str], how: str = "inner", spread: str = "sequence_number"
) -> DataFrame:
    """Messages with the target of their stream."""
    table = F.coalesce(F.when(F.trim("table_name") != "", F.col("table_name")), F.lit(DEFAULT_TABLE))
    lookup = routes.withColumn("table_name", table)
    return lookup_join(messages, lookup, on, how, spread)


def unrouted_messages(messages: DataFrame, routes: DataFrame, on: list[str], spread: str = "sequence_number") -> DataFrame:
    """Messages of streams no route knows (P10, J3): to be checked before names are made of them."""
    return lookup_join(messages, routes.select(*on).distinct(), on, "left_anti", spread)


def write_routed(routed: DataFrame, path: str, by: list[str], mode: str = "append") -> None:
    """Write routed rows to one folder per target.

    Rebalancing lets the adaptive planner split a target that holds most of the rows over many
    writers and keep the small ones together.
    """
    routed.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def concat_streams(streams: dict[str, DataFrame], hub: str = "eventhub") -> DataFrame:
    """Several streams as one, each row marked with its stream."""
    frames = [df.withColumn(hub, F.lit(name)) for name, df in streams.items()]
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def key_of(column: Column) -> Column:
    """Route number at the end of a numbered key such as ``SOURCE_12``."""
    return F.regexp_extract(column, r"_(\d+)$", 1).try_cast("bigint")
