"""Batches of messages and the message that speaks for each partition in a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import parse_offset
from tidemark.operators.running import CELL_BITS, running_totals

# Default batch size, and default age in seconds.
BATCH_SIZE = 1000
BATCH_SECONDS = 300


def number_messages(df: DataFrame, keys: list[str], arrival: str = "arrival", cell_bits: int = CELL_BITS) -> DataFrame:
    """Add ``message_no``: 1, 2, 3, ... per key in arrival order."""
    return running_totals(df, keys, arrival, {"message_no": F.lit(1)}, cell_bits)


def batches_by_size(
    df: DataFrame,
    keys: list[str],
    arrival: str = "arrival",
    size: int | str = BATCH_SIZE,
    cell_bits: int = CELL_BITS,
) -> DataFrame:
    """Add ``batch_no``: every ``size`` arrivals close a batch.

    ``size`` is a number, or the name of a column that gives each key its own size.
    """
    numbered = number_messages(df, keys, arrival, cell_bits)
    return numbered.withColumn("batch_no", F.expr(f"(message_no - 1) div {size}"))


def highest_message(columns: list[str], arrival: str = "arrival") -> Column:
    """Aggregate: the message with the highest sequence number; the first arrival wins ties (A2)."""
    return F.max_by(F.struct(*columns), F.struct(F.col("sequence_number"), -F.col(arrival)))


def highest_messages(df: DataFrame, by: list[str], columns: list[str], arrival: str = "arrival") -> DataFrame:
    """Message with the highest sequence number per group (A2)."""
    return _chosen(df, by, highest_message(columns, arrival))


def last_arrivals(df: DataFrame, by: list[str], columns: list[str], arrival: str = "arrival") -> DataFrame:
    """Message that arrived last per group, whatever its sequence number (A3)."""
    return _chosen(df, by, F.max_by(F.struct(*columns), F.col(arrival)))


def first_arrivals(df: DataFrame, by: list[str], columns: list[str], arrival: str = "arrival") -> DataFrame:
    """Message that arrived first per group (A4)."""
    return _chosen(df, by, F.min_by(F.struct(*columns), F.col(arrival)))


def _chosen(df: DataFrame, by: list[str], choice: Column) -> DataFrame:
    return df.groupBy(*by).agg(choice.alias("_m")).select(*by, "_m.*")


def batch_waterlevels(df: DataFrame, by: list[str], arrival: str = "arrival") -> DataFrame:
    """Waterlevel each partition reaches in each batch: the offset of its highest message."""
    chosen = highest_messages(df, by, ["sequence_number", "offset"], arrival)
    return chosen.withColumn("waterlevel", parse_offset(F.col("offset"), F.col("sequence_number")))


def drop_redelivered(df: DataFrame, by: list[str], arrival: str = "arrival") -> DataFrame:
    """Keep the first arrival of every message delivered more than once.

    A group-by, so copies are merged before the shuffle and a message repeated any number of
    times costs one row per input partition.
    """
    rest = [c for c in df.columns if c not in by]
    chosen = _chosen(df, by, F.min_by(F.struct(*rest), F.col(arrival)))
    return chosen.select(*df.columns)
