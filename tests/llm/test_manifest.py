"""The Merkle manifest against its plain version."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute_force as plain  # noqa: E402
from tidemark.llm import merkle, queries  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, tree string, rank string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def rows(n, lang=lambda i: ["en", None, "é", "Z", "b"][i % 5]):
    return [(i, [f"text {i}", None, "", "ß\n"][i % 4], lang(i), ["s", None][i % 2], i * 3 if i % 6 else None) for i in range(n)]


def asked(spark, tmp_path, given):
    """The registered query over a table of the given rows, which has columns with clashing names as well."""
    spark.createDataFrame([(*r, "l", "t", "r") for r in given], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted([tuple(r) for r in queries.op12_manifest(spark, str(tmp_path)).select(*COLUMNS).collect()], key=str)


def hot(i):
    return "en" if i % 7 else f"l{i}"


@pytest.mark.parametrize(
    "given",
    [
        rows(300, hot),  # three digits' worth of levels would need 4097: two here, and one of languages
        rows(9) + rows(5) + [(None, "x", None, None, None), (None, "x", None, None, None), (None, None, "en", None, 7)],
        rows(1),
        [],
    ],
    ids=["hot", "odd", "one", "empty"],
)
def test_query_equals_plain_version(spark, tmp_path, given):
    assert asked(spark, tmp_path, given) == plain.merkle(given)


def test_fanouts_and_single_requests(spark):
    docs = spark.createDataFrame([(i, f"t{i}", None) for i in range(120)], "k bigint, v string, g string")
    made = merkle.build(docs, ["k", "v"], "g", "k", fanout=3)
    some = spark.createDataFrame([(0, 0), (0, 119), (0, 64), (0, 64)], "tree bigint, rank bigint")
    got = merkle.prove(made, some).withColumn("to", merkle.folded(F.col("digest"), F.col("path"))).collect()
    leaves = {r["rank"]: r["leaf"] for r in made.leaves.collect()}
    assert sorted(r["rank"] for r in got) == [0, 64, 64, 119]
    assert all(r["to"] == r["root"] and r["digest"] == leaves[r["rank"]] and len(r["path"]) == 5 for r in got)


def test_records_are_content_addressed(spark):
    docs = spark.createDataFrame([(None, "same", g) for g in "ab" for _ in range(8)], "k bigint, v string, g string")
    made = merkle.build(docs, ["v"], "g", "k")
    # Both trees have the same digests: one block of records serves both, and one the languages.
    assert made.records.count() == 2
    assert made.trees.select("subroot").distinct().count() == 1


def test_rank_beyond_the_tree_is_an_error(spark):
    made = merkle.build(spark.createDataFrame([(1, "a")], "k bigint, g string"), ["k"], "g", "k")
    with pytest.raises(Exception, match="no leaf of rank 1"):
        merkle.prove(made, spark.createDataFrame([(0, 1)], "tree bigint, rank bigint")).collect()
