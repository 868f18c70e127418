"""From raw documents to token ids: language, near duplicates, secrets, mixing, encoding.

Each stage takes the documents that its predecessor kept, read from Parquet, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, jaccard, language, mixing, secrets
from tidemark.llm.queries import VOCABULARY
from tidemark.session import configure, written

# Words in a shingle, and per cent of similarity from which documents are near duplicates.
SHINGLE, SIMILAR = 5, 80


def _packed(docs: DataFrame, *used: str) -> DataFrame:
    """The whole row as one struct column beside the columns an operator uses, so that no other column can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *used)


def _picked(docs: DataFrame, name: Column, picks: DataFrame) -> DataFrame:
    """Rows by name, as often as ``picks(row_id, n, copies)`` says: of the ``n`` rows of a name, ``copies`` in all.

    Every row of a name comes equally often; what is left over are copies of the one whose digest over all columns is the smallest, so
    rows that share a name but differ elsewhere have the same result in every run.
    """
    wanted = written(picks.where("copies > 0"), "picks")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name.alias("row_id")).join(wanted, "row_id")
    rows = marked.where("copies >= n").select("row", F.expr("copies div n").alias("times"))
    uneven = wanted.where("copies % n > 0")
    if not uneven.isEmpty():
        first = F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row")
        rows = rows.unionByName(marked.where("copies % n > 0").groupBy("row_id").agg(first, F.max(F.expr("copies % n")).alias("times")).select("row", "times"))
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times").cast("bigint")))).select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those with a letter in their text."""
    configure(spark)
    model = language.learn(docs, ~language.held_out(F.col("doc_id")))
    if model is None:  # no row has a language to learn from
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language.identify(_packed(docs, "text"), model)
    return found.where(F.col("lang_pred") != language.UNDETERMINED).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; documents without words all stay."""
    configure(spark)
    groups = jaccard.similar_groups(docs.select("doc_id", "text"), size=SHINGLE, percent=SIMILAR).where("kept")
    picks = groups.groupBy("row_id").agg(F.count("*").alias("n"), F.max("n_shingles").alias("size")).withColumn("copies", F.when(F.col("size") > 0, F.lit(1)).otherwise(F.col("n")))
    return _picked(docs, jaccard.row_id("doc_id", "text"), picks.select("row_id", "n", F.col("copies").cast("int").alias("copies")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark and ``n_chars`` as it then is."""
    configure(spark)
    found = secrets.find_secrets(_packed(docs, "doc_id", "text"))
    clean = found.withColumn("clean", secrets.redacted(F.col("text"), F.col("secrets")))
    changed = F.size("secrets") > 0
    new = {"text": F.col("clean"), "n_chars": F.when(changed, F.char_length("clean").cast("bigint")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return clean.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    configure(spark)
    mixed = mixing.mix(docs.select("doc_id", "text", "source")).where("size > 0")
    picks = mixed.groupBy("row_id").agg(F.count("*").alias("n"), F.sum(F.col("taken") / F.col("size")).cast("int").alias("copies"))
    return _picked(docs, F.xxhash64("doc_id", "text", "source"), picks)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their number, and the digests of the ids and of the bytes they decode to."""
    configure(spark)
    vocabulary = public_tokenizers.path(VOCABULARY)
    plain = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, decoded=True, keep=["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return plain.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixture", mixture),
    ("tokens", tokens),
]
# Classifiers and merges are beyond SQL: tests compare the stages with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
