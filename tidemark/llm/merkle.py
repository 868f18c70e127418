"""A Merkle manifest of a dataset: digest-to-children records, and proofs read from them by descending from the root.

The leaves of a group, in the order of their keys, are merged ``fanout`` at a time until one digest is left, the group's subroot; the
subroots, in the order of the groups, are merged likewise into the root. Every inner digest has one record that names its children. Records
are stored in blocks: that of a digest holds the records of the next ``LEVELS`` levels below it, so a lookup by digest
serves that many levels. A proof is found from the root down: the digits of the leaf's rank choose a child at each level, and the
children that were not chosen are collected, block by block; each segment is reversed and put before those from above.

All steps are joins and aggregates on blocks of at most ``fanout ** LEVELS`` rows, whatever share of the rows a group holds. Requests
that share the upper part of their descent make it once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import lookup_join
from tidemark.operators.running import arrival_order
from tidemark.session import written

# Levels of the tree in one digit of a rank, and so in one block of records.
LEVELS = 6
NO_PATH = "array<struct<left:string,right:string>>"
# Row number within a partition in the ids that arrival_order gives.
PLACE_BITS = 33


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the columns asked for, ``leaf``, ``tree``, ``height`` and ``rank`` (from 0). ``records``: ``digest``, ``children``
    (map of each digest in the block to its children). ``trees``: ``tree``, its ``group``, ``n`` leaves, ``height``,
    ``subroot``, ``tree_rank``, and for all trees together ``top``, the levels above the subroots, and ``root``.
    """

    leaves: DataFrame
    records: DataFrame
    trees: DataFrame
    fanout: int


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if NULL and else its length in UTF-8 bytes, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _power(fanout: int, exponent: Column) -> Column:
    return F.element_at(F.array(*[F.lit(fanout**k).cast("bigint") for k in range(LEVELS + 1)]), exponent.cast("int") + 1)


def _height(n: Column, fanout: int) -> Column:
    """Levels above ``n`` leaves: the least ``h`` for which ``fanout ** h >= n``."""
    height, size = F.lit(0), 1
    while size < 1 << 60:
        height, size = height + (n > F.lit(size)).cast("int"), size * fanout
    return height


def _steps(digit: int) -> Column:
    """Levels of the tree that belong to a digit, counted from the leaves."""
    return F.least(F.greatest(F.col("height") - digit * LEVELS, F.lit(0)), F.lit(LEVELS))


def _digits(trees: DataFrame) -> int:
    """Digits that the ranks of the highest tree have."""
    return -(-(trees.agg(F.max("height")).first()[0] or 0) // LEVELS)


def _each(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with their place, from 0 without gaps, in an order that is total but for equal rows."""
    ordered = arrival_order(rows, order, "arrival")
    part = F.shiftright("arrival", PLACE_BITS)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    # One row per partition of the sort: its number is a setting, not the data's.
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = written(sizes.select(F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).alias("_start")), "starts")
    placed = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return placed.withColumn(name, F.col("_start") + F.col("arrival").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).drop("_part", "_start", "arrival")


def _grown(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of records, digit by digit, and ``tree``, ``digest`` of the roots, from ``nodes(tree, height, rank, digest)``."""
    blocks, roots = [], nodes.where("height = 0").select("tree", "digest")
    for digit in range(_digits(nodes)):
        group = F.floor(F.col("rank") / F.lit(fanout**LEVELS)).cast("bigint").alias("rank")
        rows = nodes.where(F.col("height") > digit * LEVELS).groupBy("tree", "height", group)
        level = rows.agg(F.array_sort(F.collect_list(F.struct("rank", "digest")))["digest"].alias("level"))

        def merged(state: Column, _: Column) -> Column:
            below = state["level"]
            places = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / fanout).cast("int"))
            runs = F.transform(places, lambda i: F.slice(below, i * fanout + 1, F.lit(fanout)))
            records = F.transform(runs, lambda run: F.struct(F.sha2(F.array_join(run, ""), 256).alias("digest"), run.alias("children")))
            return F.struct(records["digest"].alias("level"), F.concat(state["records"], records).alias("records"))

        nothing = F.array().cast("array<struct<digest:string,children:array<string>>>")
        grown = F.aggregate(_each(_steps(digit)), F.struct(F.col("level"), nothing.alias("records")), merged)
        made = written(level.select("tree", "height", "rank", grown.alias("grown")).select("tree", "height", "rank", F.col("grown.level")[0].alias("digest"), "grown.records"), "merkle-blocks")
        # The same digest has the same children wherever it stands.
        blocks.append(made.groupBy("digest").agg(F.first("records").alias("records")))
        nodes = made.select("tree", "height", "rank", "digest")
        roots = roots.unionByName(nodes.where(F.col("height") <= (digit + 1) * LEVELS).select("tree", "digest"))
    return blocks, roots


def build(docs: DataFrame, fields: list[str], group: str, key: str, carried: dict[str, Column] | None = None, fanout: int = 2) -> Manifest:
    """The manifest of ``docs``. Leaves are the digests of ``fields``, trees the values of ``group`` in UTF-8 order, NULL first.

    Leaves of a tree ascend by ``key``, NULL first; rows with the same key ascend by digest, so repeated rows are leaves next to each other.
    The leaves keep ``key``, ``group`` and the columns ``carried``, whatever other columns ``docs`` has. An empty table has no records and no trees.
    """
    kept = {key: F.col(f"`{key}`"), **(carried or {})}
    plain = docs.select(F.struct(*[c.alias(name) for name, c in kept.items()]).alias("row"), F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("k"), leaf_digest([F.col(f"`{f}`") for f in fields]).alias("leaf"))
    placed = ranked(plain, ["grp", "k", "leaf"], "place").drop("k")
    groups = placed.groupBy("grp").agg(F.min("place").alias("tree"), F.count("*").alias("n"))
    trees = written(ranked(groups.withColumn("height", _height(F.col("n"), fanout)), ["tree"], "tree_rank").withColumn("name", _name(F.col("grp"))), "merkle-trees")
    leaves = lookup_join(placed.withColumn("name", _name(F.col("grp"))), trees.select("name", "tree", "height"), ["name"], "inner", spread="place")
    leaves = written(leaves.select("row.*", F.col("grp").alias("group"), "tree", "height", (F.col("place") - F.col("tree")).alias("rank"), "leaf"), "merkle-leaves")

    low, subroots = _grown(leaves.select("tree", "height", "rank", F.col("leaf").alias("digest")), fanout)
    n_trees = trees.count()
    trees = written(trees.join(subroots, "tree").select("tree", F.col("grp").alias("group"), "n", "height", F.col("digest").alias("subroot"), "tree_rank"), "merkle-subroots")
    top = next(h for h in range(64) if fanout**h >= n_trees)
    high, roots = _grown(trees.select(F.lit(0).cast("bigint").alias("tree"), F.lit(top).alias("height"), F.col("tree_rank").alias("rank"), F.col("subroot").alias("digest")), fanout)
    root = roots.first()
    trees = trees.withColumns({"top": F.lit(top), "root": F.lit(root["digest"] if root else None).cast("string")})
    records = None
    for block in low + high:
        records = block if records is None else records.unionByName(block)
    if records is None:
        records = trees.sparkSession.createDataFrame([], "digest string, records array<struct<digest:string,children:array<string>>>")
    children = F.map_from_entries(F.array_distinct("records"))
    return Manifest(leaves, written(records.groupBy("digest").agg(F.first("records").alias("records")).select("digest", children.alias("children")), "merkle-records"), trees, fanout)


def _name(group: Column) -> Column:
    """A group as a key of an equality join: NULL has a name of its own."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def _descended(manifest: Manifest, starts: DataFrame, requests: DataFrame) -> DataFrame:
    """``requests(tree, rank, ...)`` with ``digest`` and ``path``, from ``starts(tree, height, digest, path)``, the digests to descend from.

    ``path`` has one ``left``, ``right`` for each level, from the request upwards: the siblings before and after, their digests joined.
    """
    fanout, current = manifest.fanout, None
    payload = [c for c in requests.columns if c not in ("tree", "rank")]
    rows = requests.select("tree", "rank", F.struct(F.lit(0).alias("_"), *payload).alias("payload"))
    for digit in reversed(range(_digits(starts))):
        begun = starts.where(F.col("height").between(digit * LEVELS + 1, (digit + 1) * LEVELS)).select("tree", "height", F.lit(0).cast("bigint").alias("above"), "digest", "path")
        current = begun if current is None else begun.unionByName(current.select("tree", "height", F.col("rank").alias("above"), "digest", "path"))
        held = current.join(manifest.records, "digest")
        low = fanout ** (digit * LEVELS)
        asked = rows if digit == 0 else rows.select("tree", F.floor(F.col("rank") / low).cast("bigint").alias("rank")).distinct()
        met = asked.withColumn("above", F.floor(F.col("rank") / fanout**LEVELS).cast("bigint")).join(held, ["tree", "above"]).withColumn("steps", _steps(digit))

        def chosen(state: Column, step: Column) -> Column:
            children = F.element_at(F.col("children"), state["digest"])
            place = F.pmod(F.floor(F.col("rank") / _power(fanout, F.col("steps") - step)), F.lit(fanout)).cast("int") + 1
            others = F.struct(F.array_join(F.slice(children, F.lit(1), place - 1), "").alias("left"), F.array_join(F.slice(children, place + 1, F.lit(fanout)), "").alias("right"))
            return F.struct(F.element_at(children, place).alias("digest"), F.concat(state["segment"], F.array(others)).alias("segment"))

        walked = F.aggregate(_each(F.col("steps")), F.struct(F.col("digest"), F.array().cast(NO_PATH).alias("segment")), chosen)
        found = met.withColumn("walked", walked).withColumn("path", F.concat(F.reverse("walked.segment"), "path"))
        current = found.select("tree", "height", "rank", F.col("walked.digest").alias("digest"), "path", *(["payload"] if digit == 0 else []))
    alone = rows.join(starts.where("height = 0").select("tree", "height", "digest", "path"), "tree").select("tree", "height", "rank", "digest", "path", "payload")
    every = alone if current is None else alone.unionByName(current)
    return every.select("tree", "rank", "digest", "path", *[F.col(f"payload.{c}").alias(c) for c in payload])


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests(tree, rank, ...)`` with ``digest``, the leaf found there, ``path``, ``subroot`` and ``root``.

    Each request descends on its own, so any number of leaves may be asked for, and a leaf may be asked for repeatedly. A request beyond a
    tree's leaves is an error; one for a tree that does not exist gives no row.
    """
    trees = manifest.trees
    whole = trees.select(F.lit(0).cast("bigint").alias("tree"), F.col("top").alias("height"), F.col("root").alias("digest"), F.array().cast(NO_PATH).alias("path")).distinct()
    tops = _descended(manifest, whole, trees.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree_rank").alias("rank"), F.col("tree").alias("of_tree"), "n", "height", "subroot", "root"))
    starts = written(tops.select(F.col("of_tree").alias("tree"), "n", "height", "digest", "path", "subroot", "root"), "merkle-tops")
    sized = lookup_join(requests, starts.select("tree", "n", "subroot", "root"), ["tree"], "inner", spread="rank")
    beyond = F.raise_error(F.concat(F.lit("no leaf of rank "), F.col("rank").cast("string"))).cast("bigint")
    checked = sized.withColumn("rank", F.when(F.col("rank").between(0, F.col("n") - 1), F.col("rank")).otherwise(beyond)).drop("n")
    return _descended(manifest, starts.select("tree", "height", "digest", "path"), checked)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings of a path, from the leaf upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
