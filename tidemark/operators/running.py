"""Running totals in a total order, without a window over a whole key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, written

# A cell spans 2**CELL_BITS consecutive order values; order values are unique within a key,
# so that is also the most rows a cell can hold.
CELL_BITS = 16


def running_totals(
    df: DataFrame, keys: list[str], order: str, totals: dict[str, Column], cell_bits: int = CELL_BITS
) -> DataFrame:
    """Add inclusive running sums per key in the order of a bigint column unique within the key.

    The order axis is cut into equal cells and those into equal blocks. Sums per cell come from
    a partially aggregated group-by; windows then run over the cells of one block, the blocks of
    one key, and the rows of one cell. Each window partition is bounded by 2**cell_bits rows (the
    blocks by the span of the axis), so one key may hold any share of the data. Keys must not be
    NULL: such rows stay, with NULL totals. A NULL order value is an error, as it would shift all totals.
    """
    names = list(totals)
    given = F.coalesce(F.col(order), F.raise_error(F.lit(f"{order} is NULL")).cast("bigint"))
    df = df.withColumn(order, given)
    valued = df.select("*", *[totals[n].cast("bigint").alias(n) for n in names])
    cell = F.shiftright(F.col(order), cell_bits).alias("_cell")
    block = F.shiftright(F.col("_cell"), cell_bits).alias("_block")

    # Kept, so that the input is read once for the counts and once for the rows.
    cells = cut_lineage(valued.groupBy(*keys, cell).agg(*[F.sum(n).alias(n) for n in names]).withColumn("_block", block))
    blocks = cells.groupBy(*keys, "_block").agg(*[F.sum(n).alias(n) for n in names])

    by_block = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    by_cell = W.partitionBy(*keys, "_block").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    by_row = W.partitionBy(*keys, "_cell").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)

    def before(window, suffix):
        return [F.coalesce(F.sum(n).over(window), F.lit(0)).alias(n + suffix) for n in names]

    starts = (
        cells.select(*keys, "_block", "_cell", *before(by_cell, "_c"))
        .join(blocks.select(*keys, "_block", *before(by_block, "_b")), [*keys, "_block"])
        .select(*keys, "_cell", *[(F.col(n + "_c") + F.col(n + "_b")).alias(n + "_start") for n in names])
    )
    rows = valued.withColumn("_cell", cell).withColumns({n: F.sum(n).over(by_row) for n in names})
    return rows.join(starts, [*keys, "_cell"], "left").select(
        *df.columns, *[(F.col(n) + F.col(n + "_start")).alias(n) for n in names]
    )


def arrival_order(df: DataFrame, order: list[str], name: str = "arrival") -> DataFrame:
    """Give each row a bigint that follows a composite total order.

    For streams that carry no arrival number: range partitioning splits the rows evenly even
    where the leading order columns tie, and the row ids of the sorted partitions follow the
    order. The result is a table in the shared folder, because a second evaluation would draw
    other partition bounds. ``order`` must be unique per row.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.withColumn(name, F.monotonically_increasing_id()), "arrival")
