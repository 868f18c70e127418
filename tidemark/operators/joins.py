"""Join of a large frame with a lookup frame, whatever the size of the lookup and however its keys are spread."""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage

# Lookup frames up to this many rows and bytes are broadcast; larger ones take the salted join.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
# A key is hot when it holds more than one row in HOT_SHARE, so there are fewer hot keys than that. Its rows are
# spread so that a task has about one row in HOT_SHARE.
HOT_SHARE = 10_000


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    spread: str | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join ``large`` with ``lookup``.

    Rows and bytes of the lookup are counted by the executors, up to ``broadcast_rows + 1`` rows. If it fits, its
    rows are broadcast and the large side is not shuffled; if not, see ``salted_join``.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``: row sets of the large side
    for which repeating lookup rows per salt changes nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    sizes = lookup.select(_row_bytes(lookup).alias("_bytes")).limit(broadcast_rows + 1)
    rows, size = sizes.agg(F.count("*"), F.coalesce(F.sum("_bytes"), F.lit(0))).first()
    if rows <= broadcast_rows and size <= BROADCAST_BYTES:
        # Fixed here, so that what is joined is what was measured; one row more shows that the lookup has grown since.
        head = lookup.limit(broadcast_rows + 1).toArrow()
        if head.num_rows <= broadcast_rows and head.nbytes <= 2 * BROADCAST_BYTES:
            local = lookup.sparkSession.createDataFrame(head, lookup.schema)
            return large.join(F.broadcast(local), on, how)
    return salted_join(large, lookup, on, how, spread)


def _row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: the length of text, binary and nested columns, and 16 for any other."""
    lengths = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            lengths.append(F.octet_length(column))
        elif isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
            lengths.append(F.octet_length(F.to_json(F.array(column))))
    lengths = [F.coalesce(length, F.lit(0)).cast("bigint") for length in lengths]
    return reduce(add, lengths, F.lit(16 * len(df.columns)).cast("bigint"))


def hot_keys(large: DataFrame, on: list[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than one in ``share`` of the rows, from counts aggregated before the shuffle, and their ``_salts``.

    All keys together have fewer than ``2 * share`` salts.
    """
    rows = large.count()
    counts = large.groupBy(*on).agg(F.count("*").alias("_rows")).filter(F.col("_rows") * share > rows)
    salts = F.ceil(F.col("_rows") * share / F.lit(rows)).cast("int")
    return cut_lineage(counts.select(*on, salts.alias("_salts")))


def salted_join(
    large: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    spread: str | None = None,
    share: int = HOT_SHARE,
) -> DataFrame:
    """Shuffled join in which the rows of each hot key are spread over as many salts as its share of the rows asks for.

    Only lookup rows of hot keys are repeated. Rows with a NULL key match nothing and are spread as
    well. ``spread`` is a column whose hash tells the rows of one key apart; all columns but the key
    by default.
    """
    hot = F.broadcast(hot_keys(large, on, share))
    rest = [spread] if spread else [c for c in large.columns if c not in on] or on
    unmatched = reduce(or_, [F.col(k).isNull() for k in on])
    salts = F.when(unmatched, F.lit(share)).otherwise(F.coalesce("_salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(*rest), salts).cast("int")
    repeats = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    salted = large.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    repeated = lookup.join(hot, on, "left").withColumn("_salt", repeats).drop("_salts")
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
