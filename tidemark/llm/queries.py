"""The registered query of each operator, over its whole table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, bpe, caps, classifier, jaccard, language, licenses, merkle, mixing, quality, secrets, sharding, substrings
from tidemark.session import configure, written


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


BASE_KINDS = ("assign", "access", "hex")


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [F.size(F.filter("secrets", _is_kind(k))).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir).select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"))
    model = language.learn(docs, ~out)
    return language.identify(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(_table(spark, sf_dir).select("doc_id", "text"), size=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir).select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
keyed AS (
  SELECT doc_id, source, size,
    -ln((CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
    / CASE WHEN text IS NULL THEN 0.25::DOUBLE ELSE
        CASE WHEN length(text)::DOUBLE / greatest(size, 1) BETWEEN 4 AND 11 THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END
        + CASE WHEN length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::DOUBLE / greatest(size, 1) < 0.1 THEN 0.5::DOUBLE ELSE 0::DOUBLE END
      END AS es_key
  FROM sized),
sources AS (SELECT source, sum(size) AS source_size FROM keyed GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sources),
placed AS (
  SELECT *, row_number() OVER w AS place, source_size * 2 / weight::DOUBLE AS most,
    (sum(source_size) OVER () * 1.5::DOUBLE - (sum(source_size) OVER w - source_size) * 2)
    / (sum(weight) OVER () - sum(weight) OVER w + weight)::DOUBLE AS level
  FROM weighed
  WINDOW w AS (ORDER BY source_size * 2 / weight::DOUBLE, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
first AS (SELECT min(place) AS place, arg_min(level, place) AS level FROM placed WHERE level < most),
targets AS (
  SELECT p.source, p.source_size,
    CASE WHEN f.place IS NULL OR p.place < f.place THEN p.source_size * 2::DOUBLE ELSE f.level * p.weight END AS target
  FROM placed p, first f),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY es_key, doc_id ROWS UNBOUNDED PRECEDING) AS size_to FROM keyed),
epochs AS (
  SELECT k.*, t.source_size, t.target, least(floor(t.target / greatest(t.source_size, 1)), 2) AS epochs
  FROM summed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (epochs + CASE WHEN size_to - size / 2::DOUBLE <= target - epochs * source_size AND epochs < 2
    AND target - epochs * source_size > 0 THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM epochs
"""


VOCABULARY = "byte_bpe_50k.tiktoken"


def coded(docs: DataFrame) -> DataFrame:
    """``doc_id`` and digests of the ids of each text and of the bytes they decode to."""
    vocabulary = public_tokenizers.path(VOCABULARY)
    plain = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, decoded=True, keep=["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return plain.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(_table(spark, sf_dir).select("doc_id", "text"))


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.linked_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# Bytes of text in a shard at most.
SHARD_BYTES = 1 << 20


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir).select("doc_id", "text"), SHARD_BYTES).drop("text")


# Deep enough for 2**24 shards' worth of bytes; a row that needs more bits gets a NULL depth, and the comparison fails.
_DEPTHS = range(25)
OP8_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
summed AS (
  SELECT *, {", ".join(f"sum(bytes) OVER (PARTITION BY h >> {60 - k}) AS s{k}" for k in _DEPTHS)} FROM hashed),
placed AS (
  SELECT *, CASE {" ".join(f"WHEN s{k} <= {SHARD_BYTES} THEN {k}" for k in _DEPTHS)} END AS depth,
    CASE {" ".join(f"WHEN s{k} <= {SHARD_BYTES} THEN s{k}" for k in _DEPTHS)} END AS shard_bytes
  FROM summed)
SELECT doc_id, substr(to_base(h, 2, 60), 1, depth) AS shard, CAST(depth AS INTEGER) AS depth, CAST(bytes AS BIGINT) AS bytes,
  CAST(shard_bytes AS BIGINT) AS shard_bytes
FROM placed
"""


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeated_spans(_table(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.coalesce(F.sha2("kept", 256), "content").alias("kept_sha256"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir).select("doc_id", "text"))
    base, method = F.transform("base", lambda p: p["label"]), F.transform("licenses", lambda p: p["label"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min(F.transform("base", lambda p: p["start"])).alias("first_word"),
        F.array_max(F.transform("base", lambda p: p["start"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, method))), ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform("licenses", lambda p: p["confidence"])), F.lit(0.0)), F.when(F.size("base") > 0, 0.75).otherwise(0.0)).alias("score"),
    )

def op11_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(classifier.statistics(_table(spark, sf_dir).select("doc_id", "text")), "statistics")
    out = classifier.held_out(F.col("doc_id"))
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = classifier.learn(stats.where(~out).join(labels, "doc_id"))
    return classifier.score(stats, model).select("doc_id", out.alias("held_out"), "score", "predicted")


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir).select(*LEAF_FIELDS)
    # The tampered leaf, where there is one.
    more = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in LEAF_FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf_digest(more))
    made = merkle.build(docs, LEAF_FIELDS, "lang", "doc_id", {"tampered": tampered})
    proofs = merkle.prove(made, made.leaves.select("tree", "rank", "doc_id", "leaf", "tampered"))
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    told = proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


# CRC-32 of the decimal key: each byte (>= 0) is XORed in, each -1 shifts by one bit.
_CRC_STEPS = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: list_concat([ord(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))"
_CRC = f"""xor(list_reduce(list_concat([4294967295::BIGINT], {_CRC_STEPS}), lambda c, x:
  CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)"""
OP12_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, sha256({" || ".join(_sql_field(c) for c in LEAF_FIELDS)}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN sha256({" || ".join(_sql_field("(n_chars + 1)" if c == "n_chars" else c) for c in LEAF_FIELDS)}) END AS tampered
  FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
grown AS (
  SELECT lang, 0 AS lvl, r, n, leaf AS d FROM placed
  UNION ALL
  SELECT lang, lvl + 1, r // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY r)) FROM grown WHERE n > 1 GROUP BY lang, lvl, r // 2, n),
nodes AS MATERIALIZED (SELECT * FROM grown),
subroots AS MATERIALIZED (
  SELECT lang, lvl AS height, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1),
crown AS (
  SELECT 0 AS lvl, r, n, d FROM subroots
  UNION ALL
  SELECT lvl + 1, r // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY r)) FROM crown WHERE n > 1 GROUP BY lvl, r // 2, n),
tops AS MATERIALIZED (SELECT * FROM crown),
root AS (SELECT d, lvl AS height FROM tops WHERE n = 1),
requests AS MATERIALIZED (
  SELECT p.*, row_number() OVER () AS request, s.height, s.r AS tree_rank, s.d AS subroot, root.d AS root, s.height + root.height AS steps
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang, root),
siblings AS MATERIALIZED (
  SELECT q.request, n.lvl AS step, n.d, n.r < q.r >> n.lvl AS before
  FROM requests q JOIN nodes n ON q.lang IS NOT DISTINCT FROM n.lang AND n.r = xor(q.r >> n.lvl, 1)
  UNION ALL
  SELECT q.request, q.height + t.lvl, t.d, t.r < q.tree_rank >> t.lvl
  FROM requests q JOIN tops t ON t.r = xor(q.tree_rank >> t.lvl, 1)),
proofs AS (SELECT request, sha256(string_agg(d, '' ORDER BY step)) AS proof_sha256 FROM siblings GROUP BY request),
folded AS (
  SELECT request, steps, 0 AS step, coalesce(tampered, leaf) AS d FROM requests
  UNION ALL
  SELECT f.request, f.steps, f.step + 1, sha256(CASE WHEN s.before THEN s.d ELSE '' END || f.d || CASE WHEN s.before THEN '' ELSE coalesce(s.d, '') END)
  FROM folded f LEFT JOIN siblings s ON f.request = s.request AND f.step = s.step WHERE f.step < f.steps)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.d AS folded_root, f.d = root AS verified
FROM requests q JOIN folded f ON q.request = f.request AND f.step = q.steps LEFT JOIN proofs p ON q.request = p.request
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir).select("doc_id", "text")
    found = alignment.alignments(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    scored = alignment.with_scores(found.withColumn("groups_sha256", digest).drop("groups"))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


CATALOG = {
    "op1_secrets": (op1_secrets, None),
    "op2_vectors": (op2_vectors, None),
    "op3_quality": (op3_quality, None),
    "op4_language": (op4_language, None),
    "op5_jaccard": (op5_jaccard, None),
    "op6_mixing": (op6_mixing, OP6_SQL),
    "op7_bpe": (op7_bpe, None),
    "op8_sharding": (op8_sharding, OP8_SQL),
    "op9_substrings": (op9_substrings, None),
    "op10_licenses": (op10_licenses, None),
    "op11_quality_score": (op11_quality_score, None),
    "op12_manifest": (op12_manifest, OP12_SQL),
    "op13_alignment": (op13_alignment, None),
}
