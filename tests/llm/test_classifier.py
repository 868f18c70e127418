"""The quality classifier: its parts against plain versions, and its accuracy on rows it has not learned from."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import classifier, queries

WORDS = "river stone of the and cloud paper lamp wind to in green seven walk tall quiet orange table moon".split()


def prose(draw, n):
    words = [draw.choice(WORDS) + draw.choice(["", "", "ing", "ed", ","]) for _ in range(n)]
    return " ".join(words).capitalize() + ".\n"


def texts(n):
    """Texts and their labels: prose is good, noise of three kinds is bad."""
    draw = random.Random(4)
    out = []
    for i in range(n):
        if i % 4:
            out.append((prose(draw, draw.randrange(20, 200)), 1))
        else:
            words = [draw.choice(WORDS) for _ in range(60)]
            out.append(([" ".join(w + "###" for w in words), words[0] * 3 + " " + " ".join(words[:2] * 40), " ".join(w.upper() + "!!" for w in words)][i // 4 % 3], 0))
    return out


def test_statistics_of_each_text_do_not_depend_on_its_neighbours():
    many = ["", "one", "one one one", "A b.\nA b.\n", "x" * 5000, " \n\t ", "é中\U0001f600 ß", *[t for t, _ in texts(20)]]
    raw = [t.encode() for t in many]
    offsets = np.cumsum([0, *map(len, raw)])
    together = classifier.text_statistics(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert np.isfinite(together).all() and together.shape == (len(many), len(classifier.STATISTICS))
    for i, r in enumerate(raw):
        alone = classifier.text_statistics(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        assert np.allclose(alone[0], together[i]), many[i]
    by = dict(zip(classifier.STATISTICS, together[3], strict=True))
    assert by["repeated_lines"] == 0.5 and by["distinct_words"] == 0.5 and by["capital_words"] == 0.5 and by["log_words"] == np.log1p(4)
    assert dict(zip(classifier.STATISTICS, together[2], strict=True))["twin_words"] == pytest.approx(2 / 3)
    assert not together[0].any()


def test_isotonic_equals_a_plain_search():
    draw = np.random.default_rng(3)
    for _ in range(50):
        values, weights = draw.random(7), draw.integers(1, 5, 7).astype(float)
        found = classifier.isotonic(values, weights)
        # Largest of the smallest weighted means over all stretches around a place.
        mean = lambda a, b: np.average(values[a:b], weights=weights[a:b])
        plain = [max(min(mean(a, b) for b in range(i + 1, 8)) for a in range(i + 1)) for i in range(7)]
        assert np.allclose(found, plain)


def test_features_approximate_a_gaussian_kernel(monkeypatch):
    monkeypatch.setattr(classifier, "FEATURES", 20_000)
    draw = np.random.default_rng(5)
    x = draw.normal(size=(6, 10))
    z = classifier.features(x, np.zeros(10), np.ones(10))[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(2)
    assert np.allclose(z @ z.T, np.exp(-apart / (2 * (classifier.WIDTH**2) * 10)), atol=0.05)


def test_query_is_right_on_held_out_rows(spark, tmp_path):
    rows = [(i, t) for i, (t, _) in enumerate(texts(900))]
    labels = [(i, q, 0) for i, (_, q) in enumerate(texts(900))]
    odd = [(10_000, None), (10_001, ""), (None, "some words"), (3, "a row with a key that comes twice"), (10_002, " ".join(WORDS * 2000))]
    spark.createDataFrame(rows + odd, "doc_id bigint, text string").withColumn("stats", F.lit("clash")).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*labels, (5, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op11_quality_score(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    wanted = {i: q for i, q, _ in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in wanted]
    assert len(held) > 100
    assert sum(r["predicted"] == wanted[r["doc_id"]] for r in held) >= 0.97 * len(held)
    again = {(r["doc_id"], round(r["score"], 9)) for r in queries.op11_quality_score(spark, str(tmp_path)).collect()}
    assert again == {(r["doc_id"], round(r["score"], 9)) for r in got}


def test_learning_leaves_held_out_labels_alone(spark):
    """Wrong labels on held-out rows change nothing."""
    rows = spark.createDataFrame([(i, t, q) for i, (t, q) in enumerate(texts(300))], "doc_id bigint, text string, quality int")
    stats = classifier.statistics(rows)
    out = classifier.held_out(F.col("doc_id"))
    flipped = stats.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (classifier.learn(s.where(~out)) for s in (stats, flipped))
    assert np.allclose(one.weights, two.weights) and np.allclose(one.calibrated, two.calibrated)


def test_without_labels_or_rows(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, quality int, score string")
    stats = classifier.statistics(empty)
    assert classifier.learn(stats) is None
    some = classifier.statistics(spark.createDataFrame([(1, "a b", None, "x")], "doc_id bigint, text string, quality int, score string"))
    assert [(r["score"], r["predicted"]) for r in classifier.score(some, classifier.learn(some)).collect()] == [(0.5, 1)]
    assert classifier.score(stats, None).count() == 0


def test_one_class_of_labels(spark):
    rows = spark.createDataFrame([(i, t, 1) for i, (t, _) in enumerate(texts(40))], "doc_id bigint, text string, quality int")
    stats = classifier.statistics(rows)
    assert all(r["score"] > 0.9 for r in classifier.score(stats, classifier.learn(stats)).collect())
