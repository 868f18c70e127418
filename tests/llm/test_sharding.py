"""Joins of the sharding directory: what is broadcast does not grow with the input."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import sharding


def hashed(key, text):
    inner = hashlib.md5((text or "").encode()).hexdigest()
    return int(hashlib.md5(f"{'' if key is None else key}:{inner}".encode()).hexdigest()[:15], 16)


def plain(rows, limit):
    """``(doc_id, shard, depth, bytes, shard_bytes)`` of each row, from the sums of all its prefixes; equal rows of a full hash share one."""
    each = [(key, hashed(key, text), len((text or "").encode())) for key, text in rows]
    sums = {}
    for _, h, size in each:
        for depth in range(sharding.HASH_BITS + 1):
            at = depth, h >> (sharding.HASH_BITS - depth)
            sums[at] = sums.get(at, 0) + size
    out = []
    for key, h, size in each:
        depth = next(d for d in range(sharding.HASH_BITS + 1) if sums[d, h >> (sharding.HASH_BITS - d)] <= limit or d == sharding.HASH_BITS)
        out.append((key, f"{h:060b}"[:depth], depth, size, sums[depth, h >> (sharding.HASH_BITS - depth)]))
    return out


def below_broadcasts(plan):
    """Lines of a plan that stand below a broadcast."""
    inside, lines = None, []
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if inside is not None and depth <= inside:
            inside = None
        if inside is not None:
            lines.append(line)
        elif "BroadcastExchange" in line:
            inside = depth
    return lines


@pytest.fixture
def plans(monkeypatch):
    """Plans of all tables that the directory writes."""
    seen, write = [], sharding.written

    def noted(df, label):
        seen.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, label)

    monkeypatch.setattr(sharding, "written", noted)
    return seen


def odd_rows():
    draw = random.Random(5)
    rows = [(i, "é" * draw.choice((0, 1, 5, 40, 300))) for i in range(400)]
    # Longer than the limits, alike, without text, without a key.
    return rows + [(1000, "x" * 9000), (1001, "y" * 2500), *[(1002, "same" * 5)] * 30, (1003, None), (None, "no key"), (None, None)]


def test_repeated_rows_of_the_directory_are_not_broadcast(spark, plans):
    sizes = spark.range(3000).select(sharding.hash_of(F.col("id"), F.lit("")).alias("hash"), F.lit(100).cast("bigint").alias("bytes"))
    tables = sharding.directory(sizes, 1000)
    assert sum(t.select("prefix", "depth", "n").distinct().agg(F.sum("n")).first()[0] or 0 for _, t in tables) == 3000
    assert plans and not [line for _, plan in plans for line in below_broadcasts(plan) if "Generate" in line]


@pytest.mark.parametrize("longest", [100_000, -1])
def test_shards_are_the_same_however_they_are_joined(spark, plans, monkeypatch, longest):
    monkeypatch.setattr(sharding, "BROADCAST_ROWS", longest)
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for limit in (500, 5000):
        sharded, wanted = sharding.shard(docs, limit), plain(rows, limit)
        found = [tuple(r) for r in sharded.select("doc_id", F.substring_index("shard", ".", 1), "depth", "bytes", "shard_bytes").collect()]
        assert sorted((r[:4] for r in found), key=str) == sorted((r[:4] for r in wanted), key=str)
        # Equal rows that exceed the limit by themselves are in parts, each with bytes of its own.
        parts = {r[0] for r in wanted if r[0] == 1002 and r[4] > limit}
        assert sorted((r for r in found if r[0] not in parts), key=str) == sorted((r for r in wanted if r[0] not in parts), key=str)
        assert {r[4] for r in found if r[0] in parts} == ({500, 100} if limit == 500 else set())
        assert ("BroadcastHashJoin [cell_" in sharded._jdf.queryExecution().executedPlan().toString()) == (longest > 0)
    assert any("BroadcastHashJoin" in plan for _, plan in plans) == (longest > 0)
