"""Exact percentiles per group without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.session import cut_lineage

CELLS = 4096
# A cell with more rows than this is cut again, unless all hold one value.
CELL_VALUES = 1 << 20


def exact_percentiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probabilities: dict[str, float],
    cells: int = CELLS,
    cell_values: int = CELL_VALUES,
) -> DataFrame:
    """Linearly interpolated percentiles of a numeric column, one named column each.

    The range of every group is cut into equal cells whose counts are partially aggregated, and
    only the cells that hold a wanted rank are looked at more closely: they are cut again while
    any with different values holds more than ``cell_values`` rows, and then ranked. The ends of an
    interval are cells of their own, so every round closes in on the ranks whatever the values
    are. Groups with NULL in ``by`` are groups like any other; NULL values are left out.
    """
    keys, by = by, ["_g"]
    x = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull()).select(F.struct(*keys).alias("_g"), x.alias("_v"))

    extent = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ranks = F.array(
        *[
            F.struct(F.lit(name).alias("_name"), F.lit(p).alias("_p"), side.alias("_rank"))
            for name, p in probabilities.items()
            for side in (F.floor(F.lit(p) * (F.col("_n") - 1)), F.ceil(F.lit(p) * (F.col("_n") - 1)))
        ]
    )
    # Two rows per group and percentile: the interval that holds it, and how many values lie below that.
    wanted = (
        extent.withColumn("_r", F.explode(ranks))
        .select(*by, "_n", "_lo", "_hi", "_r.*", F.lit(0).cast("bigint").alias("_below"))
        .distinct()
    )

    wanted = cut_lineage(wanted)
    while True:
        intervals = wanted.select(*by, "_lo", "_hi", "_below").distinct()
        held = lookup_join(rows, intervals, by, "inner", "_v").filter("_v >= _lo AND _v <= _hi")
        counted = held.groupBy(*by, "_lo", "_hi", "_below", _cell(cells).alias("_cell")).agg(
            F.count("*").alias("_count"), F.min("_v").alias("_cell_lo"), F.max("_v").alias("_cell_hi")
        )
        earlier = W.partitionBy(*by, "_lo", "_hi").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
        located = counted.withColumn(
            "_cell_below", F.col("_below") + F.coalesce(F.sum("_count").over(earlier), F.lit(0))
        ).drop("_below")
        inside = (F.col("_rank") >= F.col("_cell_below")) & (F.col("_rank") < F.col("_cell_below") + F.col("_count"))
        wanted = cut_lineage(
            wanted.join(located, [*by, "_lo", "_hi"])
            .filter(inside)
            .select(
                *by,
                "_n",
                F.col("_cell_lo").alias("_lo"),
                F.col("_cell_hi").alias("_hi"),
                "_name",
                "_p",
                "_rank",
                F.col("_cell_below").alias("_below"),
                F.col("_count").alias("_held"),
            )
        )
        widest = wanted.filter("_lo < _hi").agg(F.max("_held")).first()[0]
        wanted = wanted.drop("_held")
        if widest is None or widest <= cell_values:
            break

    intervals = wanted.select(*by, "_lo", "_hi", "_below").distinct()
    values = (
        lookup_join(rows, intervals, by, "inner", "_v")
        .filter("_v >= _lo AND _v <= _hi")
        .groupBy(*by, "_lo", "_hi", "_below", "_v")
        .agg(F.count("*").alias("_count"))
    )
    earlier = W.partitionBy(*by, "_lo", "_hi").orderBy("_v").rowsBetween(W.unboundedPreceding, -1)
    ranked = values.withColumn("_from", F.col("_below") + F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
    picked = wanted.drop("_below").join(ranked, [*by, "_lo", "_hi"]).filter(
        "_rank >= _from AND _rank < _from + _count"
    )
    position = F.col("_p") * (F.col("_n") - 1)
    aggregates = []
    for name in probabilities:
        mine = F.when(F.col("_name") == name, F.col("_v"))
        part = F.max(F.when(F.col("_name") == name, position - F.floor(position)))
        aggregates.append((F.min(mine) + (F.max(mine) - F.min(mine)) * part).alias(name))
    return picked.groupBy(*by).agg(*aggregates).select("_g.*", *probabilities)


def _cell(cells: int):
    """Number of the cell, not falling with the value: -1 and ``cells`` are the ends of the interval."""
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    # Halves, where the width is beyond the largest double.
    part = F.when(hi - lo == float("inf"), (v / 2 - lo / 2) / (hi / 2 - lo / 2)).otherwise((v - lo) / (hi - lo))
    inner = F.least(F.floor(part * cells), F.lit(cells - 1))
    return F.when(v == lo, F.lit(-1).cast("bigint")).when(v == hi, F.lit(cells).cast("bigint")).otherwise(inner)
