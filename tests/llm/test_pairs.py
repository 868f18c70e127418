"""Pairs of the similarity join that meet in many long lists."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import jaccard

NODES, TOKENS = 60, 40


def _lists(spark, held):
    """Open lists of nodes that are no two connected, and their signatures, which refute nothing."""
    postings = [(token, node, 100, level, l, node, 0) for node, (l, tokens) in held.items() for token, level in tokens.items()]
    lists = spark.createDataFrame(postings, "token bigint, node bigint, n int, level tinyint, l tinyint, root bigint, main bigint")
    signature = np.full(jaccard.BUCKETS, 3, np.uint16).tobytes()
    return lists, spark.createDataFrame([(node, 100, signature) for node in held], "node bigint, n int, signature binary")


def _pairs(held):
    """The pairs that share as many tokens as the smaller level of the two asks for."""
    out = set()
    for a, (l_a, left) in held.items():
        for b, (l_b, right) in held.items():
            asked = min(l_a, l_b)
            if a < b and sum(left[t] <= asked and right[t] <= asked for t in left.keys() & right.keys()) >= asked:
                out.add((a, b))
    return out


def _compared(lists, nodes):
    size = lists.groupBy("token").agg(F.sum((F.col("root") != F.col("main")).cast("int")).alias("others"), F.count("*").alias("all"))
    return jaccard._compared(lists.join(size, "token"), nodes, 80)


def test_a_pair_becomes_one_row_however_many_lists_it_shares(spark):
    held = {node: (1 + node % 3, dict.fromkeys(range(-20, 20), 1)) for node in range(1, NODES + 1)}
    rows = _compared(*_lists(spark, held)).collect()
    assert {(r["a"], r["b"]) for r in rows} == _pairs(held)
    assert len(rows) == NODES * (NODES - 1) // 2
    assert all(r["met"] >= r["asked"] for r in rows)


def test_pairs_are_those_that_share_enough_tokens(spark):
    random = np.random.default_rng(5)
    held = {}
    for node in range(1, NODES + 1):
        tokens = random.choice(TOKENS, int(random.integers(1, 30)), replace=False) - TOKENS // 2
        l = int(random.integers(1, 4))
        held[node] = (l, {int(t): int(random.integers(1, l + 1)) if random.random() < 0.3 else 1 for t in tokens})
    lists, nodes = _lists(spark, held)
    assert {(r["a"], r["b"]) for r in jaccard._open_pairs(lists, nodes, 80).collect()} == _pairs(held)
    assert _compared(lists, nodes).count() < 2 * NODES * (NODES - 1) // 2
