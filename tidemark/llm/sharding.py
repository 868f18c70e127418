"""Sharding by extendible hashing.

A row's hash decides its shard. The directory is indexed by the first bits of the hash; a bucket that is over the byte limit is split on one more bit, others
keep the bits they have. The sizes are summed per cell of a finer prefix, so the directory is made from a table whose length goes with the number of shards,
not with that of the rows; the texts themselves are not shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import BROADCAST_ROWS
from tidemark.operators.running import arrival_order, running_totals
from tidemark.session import written

HASH_BITS = 60
# Bits by which the cells are finer than the buckets would be, were all sizes alike.
FINER = 6
# Further bits that are looked at where the cells were not fine enough.
STEP = 12


def hash_of(key: Column, text: Column) -> Column:
    """60 bits of a digest of key and text."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _prefix(hashed: str, bits: Column | int) -> Column:
    return F.expr(f"shiftright({hashed}, cast({HASH_BITS} - ({bits}) as int))")


def _lookup(table: DataFrame) -> DataFrame:
    """The right side of a join with a written table: broadcast if it is short, by shuffle if not.

    Left to itself, Spark goes by the size of the compressed files, and takes rows that an explode repeats for one row each.
    """
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def _buckets(levels: DataFrame, limit: int) -> DataFrame:
    """Of the prefixes in ``levels(depth, prefix, bytes, n)``, those that fit the limit or have all bits, below one that does not fit."""
    right = F.col("prefix").bitwiseAND(1) == 1
    sums = [F.coalesce(F.sum(F.when(side, F.col(c))), F.lit(0)).alias(f"{c}_{i}") for i, side in enumerate((~right, right)) for c in ("bytes", "n")]
    # Both halves of a prefix meet in one row, so each is compared with their sum.
    pairs = levels.groupBy("depth", F.shiftright("prefix", 1).alias("up")).agg(*sums).where((F.col("depth") == 0) | (F.col("bytes_0") + F.col("bytes_1") > limit))
    halves = F.array(*[F.struct((F.col("up") * 2 + i).alias("prefix"), F.col(f"bytes_{i}").alias("shard_bytes"), F.col(f"n_{i}").alias("n")) for i in (0, 1)])
    fit = (F.col("shard_bytes") <= limit) | (F.col("depth") == HASH_BITS)
    return pairs.select("depth", F.explode(halves).alias("half")).select("depth", "half.*").where(fit & (F.col("n") > 0))


def directory(sizes: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """The directory over ``sizes(hash, bytes)``: for some numbers of bits, a table from cells of that many bits to their buckets.

    A bucket is the shortest prefix whose rows fit the limit: its ``depth`` in bits, its ``prefix`` as a number, its ``shard_bytes`` and ``n`` rows.
    A table has as many bits as the deepest of its buckets. Cells without a bucket are not in their table but, cut finer, in the next
    one. Rows of one hash cannot be split; their bucket has all bits, whatever its size.
    """
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    base, top = 0, min(HASH_BITS, max(1, -(-total // limit)).bit_length() + FINER)
    tables, rest = [], sizes
    while True:
        cells = written(rest.groupBy(_prefix("hash", top).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")), "cells")
        levels = cells.select("*", F.explode(F.sequence(F.lit(base), F.lit(top))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(cell, {top} - depth)"))
        buckets = written(_buckets(levels, limit), "buckets")
        least, most = buckets.agg(F.coalesce(F.min("depth"), F.lit(base)), F.coalesce(F.max("depth"), F.lit(base))).first()
        # Buckets do not overlap: a cell lies in one of them, or in none.
        coarse = cells.select(F.expr(f"shiftright(cell, {top - most})").alias("cell")).distinct()
        above = coarse.select("cell", F.explode(F.sequence(F.lit(least), F.lit(most))).alias("depth")).withColumn("prefix", F.expr(f"shiftright(cell, {most} - depth)"))
        found = above.join(_lookup(buckets), ["depth", "prefix"])
        tables.append((most, written(found.select("cell", "depth", "prefix", "shard_bytes", "n"), "directory")))
        over = written(cells.where(F.col("bytes") > limit).select("cell"), "over")
        if top == HASH_BITS or over.isEmpty():
            return tables
        rest = written(rest.withColumn("cell", _prefix("hash", top)).join(_lookup(over), "cell", "left_semi").drop("cell"), "rest")
        base, top = top, min(HASH_BITS, top + STEP)


def shard(docs: DataFrame, limit: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows and columns, with ``shard``, ``depth``, ``bytes`` and ``shard_bytes``; columns of these names are replaced.

    ``shard`` is the bucket's bits as text (empty while one bucket holds all), ``bytes`` the UTF-8 length of the text (NULL: 0),
    ``shard_bytes`` the sum over the shard. Every shard is at most ``limit`` bytes, unless it is one row that is longer. Rows
    equal in key and text have all bits in common; if they alone exceed the limit, they are dealt to parts ``.0``, ``.1`` and so on, each
    within the limit, or one row. An empty table has no shards.
    """
    added = ("shard", "depth", "bytes", "shard_bytes")
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    rows = docs.select(kept.alias("row"), hash_of(F.col(key), F.col(text)).alias("hash"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("bytes"))
    tables = directory(written(rows.select("hash", "bytes"), "sizes"), limit)
    fields = ("depth", "prefix", "shard_bytes", "n")
    for i, (top, table) in enumerate(tables):
        own = table.select(F.col("cell").alias(f"cell_{i}"), *[F.col(c).alias(f"{c}_{i}") for c in fields])
        rows = rows.withColumn(f"cell_{i}", _prefix("hash", top)).join(_lookup(own), f"cell_{i}", "left")
    placed = rows.select("row", "hash", "bytes", *[F.coalesce(*[f"{c}_{i}" for i in range(len(tables))]).alias(c) for c in fields])
    bits = F.when(F.col("depth") > 0, F.expr("lpad(conv(prefix, 10, 2), depth, '0')")).otherwise("")
    crowded = (F.col("depth") == HASH_BITS) & (F.col("shard_bytes") > limit) & (F.col("n") > 1)
    last = tables[-1][1]
    if last.where(crowded).isEmpty():
        return placed.select("row.*", bits.alias("shard"), "depth", "bytes", "shard_bytes")
    # Equal rows: whichever of them are put together, the parts are the same.
    numbered = running_totals(arrival_order(placed.where(crowded), ["hash"]), ["hash"], "arrival", {"nth": F.lit(1)})
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("bytes")))
    part = F.floor((F.col("nth") - 1) / each)
    dealt = numbered.select("row.*", F.concat(bits, F.lit("."), part.cast("string")).alias("shard"), "depth", "bytes", (F.least(each, F.col("n") - part * each) * F.col("bytes")).alias("shard_bytes"))
    return placed.where(~crowded).select("row.*", bits.alias("shard"), "depth", "bytes", "shard_bytes").unionByName(dealt)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, each written by the tasks that get its rows."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
