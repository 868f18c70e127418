"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Each source gets a budget of words. Whole epochs of the source are taken as often as they fit; what is left of the budget is filled with
documents in the order of exponential keys, divided by the documents' quality weights, whose sizes are summed up along
that order until the budget is spent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import arrival_order, running_totals

WORDS = r"[^\x20\x09-\x0D]+"
# Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def quality(text: Column, size: Column) -> Column:
    """A weight from 0.25 to 1: texts whose words are 3 to 10 characters long on average, and mostly not symbols, weigh most."""
    length = F.char_length(text) / F.greatest(size, F.lit(1))
    symbols = F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")) / F.greatest(size, F.lit(1))
    fit = F.when(length.between(4, 11), 0.5).otherwise(0.25)
    return F.coalesce(fit + F.when(symbols < 0.1, 0.5).otherwise(0.0), F.lit(0.25))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from ``sizes(source, source_size)``, one row per source.

    Sources weigh in the order of their code points, NULL last. A target is ``level * weight`` up to ``most`` times the source's size, with
    the one level at which the targets add up to ``share`` of all sizes: what resharing the excess by weight ends at. The sources
    reach their limit in the order of size per weight, so the level follows from sums along that order.
    """
    ranked = arrival_order(sizes.withColumn("missing", F.col("source").isNull()), ["missing", "source"])
    counted = running_totals(ranked.withColumn("one", F.lit(1)), ["one"], "arrival", {"place": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = counted.select("source", "source_size", "place", weight.cast("bigint").alias("weight"))
    by_limit = arrival_order(weighed.withColumn("limit", F.col("source_size") * most / F.col("weight")), ["limit", "place"])
    summed = running_totals(by_limit.withColumn("one", F.lit(1)), ["one"], "arrival", {"size_to": F.col("source_size"), "weight_to": F.col("weight")})
    whole = summed.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight")).withColumn("one", F.lit(1))
    # Were all sources before this one at their limit, the level would be:
    level = (F.col("all_size") * share - (F.col("size_to") - F.col("source_size")) * most) / (F.col("all_weight") - F.col("weight_to") + F.col("weight"))
    tried = summed.join(F.broadcast(whole), "one").withColumn("level", level)
    # The first source that does not reach its limit at that level sets it; with none, all are at their limits.
    free = tried.where("level < limit").agg(F.min(F.struct("arrival", "level")).alias("first")).withColumn("one", F.lit(1))
    target = F.when(F.col("first").isNull() | (F.col("arrival") < F.col("first.arrival")), F.col("source_size") * F.lit(float(most))).otherwise(F.col("first.level") * F.col("weight"))
    return tried.join(F.broadcast(free), "one").select("source", "source_size", target.cast("double").alias("target"))


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", seed: str = SEED) -> DataFrame:
    """``key``, ``source``, ``size``, ``source_size``, ``target``, ``taken``, ``weight`` and ``row_id`` of every row.

    ``taken`` is the number of words the mix takes from the row: its size times its whole epochs, and once more if the rest of the
    budget reaches it. The row at the edge of the budget is taken if that brings the source nearer to its target, so a source is
    off by at most half of one text. A NULL text has size 0 and takes nothing. Rows with NULL keys, and repeated rows, are rows
    like others; rows equal in key, text and source are interchangeable. ``row_id``
    is ``xxhash64(key, text, source)``. The same input gives the same mix.
    """
    at = F.col(text)
    plain = docs.select(F.col(key).alias("key"), F.col(source).alias("source"), F.xxhash64(F.col(key), at, F.col(source)).alias("row_id"), words_in(at).alias("size"), at.alias("text"))
    sized = plain.select("key", "source", "row_id", "size", quality(F.col("text"), F.col("size")).alias("weight"))
    # 52 bits of a digest, as a number above 0 and below 1.
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("key").cast("string"), F.lit(""))))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    keyed = sized.withColumn("es_key", -F.log(uniform) / F.col("weight"))
    ordered = arrival_order(keyed.withColumn("group", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))), ["group", "es_key", "key", "row_id"])
    totals = ordered.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(totals)
    summed = running_totals(ordered, ["group"], "arrival", {"size_to": F.col("size")})
    # One row per source; Spark broadcasts it if it is small and splits hot sources if not.
    joined = summed.join(wanted.withColumnRenamed("source", "its_source"), F.col("source").eqNullSafe(F.col("its_source")))
    epochs = F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1))), F.lit(MOST_EPOCHS))
    rest = F.col("target") - epochs * F.col("source_size")
    more = (F.col("size_to") - F.col("size") / 2 <= rest) & (epochs < MOST_EPOCHS) & (rest > 0)
    taken = F.col("size") * (epochs + more.cast("bigint"))
    return joined.select(F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target", taken.cast("bigint").alias("taken"), "weight", "row_id")
