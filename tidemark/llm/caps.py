"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it if it lies in the cap around it. Directions are drawn as products: the dimensions, randomly
rotated, are cut into blocks with a small code of random directions each, and every choice of one codeword per block is a filter. The score of a
filter is the sum of its codewords' scores, so a vector finds all filters it passes by list decoding, without trying each. Vectors that pass the
same filter are compared; vectors as close as the wanted cosine share several filters, unrelated ones hardly any.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import written

BLOCKS = 3
# Filters for each vector of the table; independent codes; and in each, the filters that a vector passes on average, and at least.
FILTERS_PER_VECTOR = 4
CODES = 3
PASSED = 24
AT_LEAST = 16
# Rows of one filter that are compared with each other at once; a filter of more rows is cut into squares of this side.
SIDE = 1024
SEED = 11


@cache
def _code(dims: int, words: int, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation, and per block the codewords, all of the same length, such that a filter has length 1."""
    draw = np.random.default_rng([SEED, dims, words, number])
    rotation = np.linalg.qr(draw.standard_normal((dims, dims)))[0]
    blocks = [draw.standard_normal((words, len(part))) for part in np.array_split(np.arange(dims), min(BLOCKS, dims))]
    return rotation, [b / np.linalg.norm(b, axis=1, keepdims=True) / np.sqrt(len(blocks)) for b in blocks]


def passed_filters(unit: np.ndarray, words: int) -> np.ndarray:
    """Numbers of the filters that a vector of length 1 passes, over all codes.

    A vector that lies far from the codewords passes few caps, and so does everything near to it; its caps are widened until it passes enough.
    """
    out = []
    for number in range(CODES):
        threshold = _threshold(len(unit), words)
        found = _decoded(unit, words, number, threshold)
        while len(found) < AT_LEAST and threshold > -np.inf:
            threshold = 0.93 * threshold if threshold > 1e-3 else -np.inf
            found = _decoded(unit, words, number, threshold)
        out.append(found * CODES + number)
    return np.concatenate(out)


def _decoded(unit: np.ndarray, words: int, number: int, threshold: float) -> np.ndarray:
    """Numbers of all filters whose direction has a product of ``threshold`` or more with the vector.

    Blocks are decoded one after the other. A choice for the first blocks is kept only if the best codewords of the others can
    still bring it over the threshold.
    """
    rotation, blocks = _code(len(unit), words, number)
    turned = rotation @ unit
    scores, at = [], 0
    for block in blocks:
        scores.append(block @ turned[at : at + block.shape[1]])
        at += block.shape[1]
    best_after = np.cumsum([0.0, *[s.max() for s in scores[:0:-1]]])[::-1]
    numbers, sums = np.zeros(1, np.int64), np.zeros(1)
    for score, after in zip(scores, best_after, strict=True):
        total = sums[:, None] + score[None]
        kept = np.nonzero(total >= threshold - after - 1e-12)
        numbers, sums = numbers[kept[0]] * words + kept[1], total[kept]
    return numbers


def _threshold(dims: int, words: int) -> float:
    """The product that ``PASSED`` of the filters exceed for a random vector, whose products are nearly normal."""
    filters = words ** min(BLOCKS, dims)
    return NormalDist().inv_cdf(max(0.0, 1 - PASSED / filters) or 1e-9) / np.sqrt(dims)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted rows, group by group, whatever batches they come in."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        columns = [np.asarray(batch.column(k)) for k in keys]
        changes = np.zeros(len(batch), bool)
        for column in columns:
            changes[1:] |= column[1:] != column[:-1]
        if held and len(batch):
            changes[0] = any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns, strict=True))
        begin = 0
        for end in np.flatnonzero(changes):
            if end:
                held.append(batch.slice(begin, end - begin))
            yield pa.Table.from_batches(held)
            held, begin = [], end
        if len(batch):
            held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def linked_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Two rows link when the cosine of their vectors, in double precision, is at least ``least``. A vector that is NULL, empty or zero, or
    holds a NULL or a value that is not finite, links with nothing; vectors of different lengths do not link. Equal vectors are one class
    that is compared once, and their rows link with each other. ``component_id`` is the smallest key reachable over links, its own included; a NULL key is
    never the smallest. ``kept`` says whether a row's key is that of its component. The links found are verified, so none is below
    ``least``; one is missed if two vectors share no filter, see the README for the recall measured.
    """
    numbers = F.transform(vector, lambda x: x.cast("double"))
    # Single-precision values are sent as such: they lose nothing and take half the room.
    kind = np.float32 if vectors.schema[vector].dataType.simpleString() == "array<float>" else np.float64
    usable = F.coalesce(F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(numbers, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), numbers.alias("vector"), usable.alias("usable")).withColumn("class", F.when(F.col("usable"), F.xxhash64("vector")))
    named = written(rows.select("key", "class"), "vector-classes")
    classes = written(rows.where("usable").groupBy("class", "vector").agg(F.count("*").alias("n"), F.min("key").alias("low")), "vectors")
    count = classes.count()
    words = max(8, int(np.ceil((FILTERS_PER_VECTOR * count) ** (1 / BLOCKS))))

    def filters(batches):
        for batch in batches:
            for piece in (batch.slice(i, 256) for i in range(0, len(batch), 256)):
                out: list[list] = [[], [], []]
                for node, values in zip(piece.column("class").to_pylist(), piece.column("vector"), strict=True):
                    raw = np.asarray(values.values, np.float64)
                    unit = raw / np.abs(raw).max()
                    unit /= np.linalg.norm(unit)
                    found = passed_filters(unit, words)
                    out[0].append(found * 4096 + len(unit) % 4096)  # lengths do not meet
                    out[1].append(np.full(len(found), node, np.int64))
                    out[2] += [raw.astype(kind).tobytes()] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[0])), pa.array(np.concatenate(out[1])), pa.array(out[2], pa.binary())], ["filter", "class", "vector"])

    passed = written(classes.select("class", "vector").mapInArrow(filters, "filter bigint, class bigint, vector binary"), "passed-filters")
    sides = passed.groupBy("filter").agg(F.count("*").alias("n")).where("n > 1").select("filter", F.ceil(F.col("n") / SIDE).cast("int").alias("sides"))
    # Rows of a filter with several sides go to each square that their side is part of.
    dealt = passed.join(sides, "filter").withColumn("own", F.pmod(F.xxhash64("class"), F.col("sides")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    squares = dealt.select("filter", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class", "vector", "own")

    def verify(batches):
        for group in _groups(batches, ["filter", "i", "j"]):
            nodes = np.asarray(group.column("class"))
            raw = group.column("vector").to_pylist()
            matrix = np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1)
            unit = matrix / np.abs(matrix).max(1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            own = np.asarray(group.column("own"))
            left, right = (np.arange(len(nodes)),) * 2 if i == j else (np.flatnonzero(own == i), np.flatnonzero(own == j))
            for begin in range(0, len(left), SIDE):
                part = left[begin : begin + SIDE]
                x, y = np.nonzero(unit[part] @ unit[right].T >= least)
                a, b = nodes[part][x], nodes[right][y]
                once = a < b if i == j else a != b
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[once]), pa.array(np.maximum(a, b)[once])], ["a", "b"])

    ordered = squares.repartition("filter", "i", "j").sortWithinPartitions("filter", "i", "j")
    links = written(ordered.mapInArrow(verify, "a bigint, b bigint").distinct(), "vector-links")

    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = classes.select(F.col("class").alias("b"), "n")
    degrees = both.join(weights, "b").groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "class")
    roots = components(links).withColumnRenamed("node", "class")
    of_class = classes.select("class", "n", "low").join(degrees, "class", "left").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    lows = of_class.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = of_class.join(lows, "root").select("class", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = named.where("class is not null").join(labels, "class").select("key", "n_links", "component_id")
    alone = named.where("class is null").select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    return linked.unionByName(alone).select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
