"""Cross-tokenizer alignment against whole-text encoding and a plain merge."""

import random
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute_force as plain  # noqa: E402
from tidemark.llm import alignment, queries  # noqa: E402

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    return plain.Tokenizers(A, B)


def texts():
    draw = random.Random(6)
    pools = ["ab ", " \n\t", "aA1'st.!? ", "éß中́‍\U0001f600 x", "=-_#* ", "\r\n };", "　\xa0\x85\x1c a", "᠎​﻿ b", "<s>/unk| "]
    out = ["".join(draw.choices(pool, k=draw.randrange(50))) for pool in pools for _ in range(25)]
    words = "the river runs over old stones Ungewöhnlich größer déjà été niño 12345 3.14 don't it's".split()
    out += [" ".join(draw.choices(words, k=draw.randrange(1, 120))) for _ in range(40)]
    out += ["<|endoftext|> a <|endoftext|>", "<s>x</s><unk>", "a▁b", "▁", " ", "  ", "   a  b  ", "\x00a", "x" * 3000, "word " * 4000, "\n\n a\n  b", "a b c", "<0x41>"]
    return out


def test_query_equals_plain_version(spark, tmp_path, tokenizers):
    rows = [(i, t, "p") for i, t in enumerate(texts())] + [(9000, None, "p"), (9001, "", "p"), (None, "the river", "p"), (7, texts()[7], "p"), (7, texts()[7], "p")]
    spark.createDataFrame(rows, "doc_id bigint, text string, pairs string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_alignment(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert Counter(map(tuple, got)) == Counter(plain.alignment([r[:2] for r in rows], tokenizers))


def test_rare_pairs_are_joined_by_shuffle(spark, tokenizers, monkeypatch):
    """With a bound of one hot pair in two links, nearly every pair takes the other way; the rows are the same."""
    monkeypatch.setattr(alignment, "HOT_PAIRS", 2)
    rows = list(enumerate(texts()[:80]))
    found = alignment.alignments(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), A, B)
    got = {r["doc_id"]: (r["n_best"], r["count_sum"]) for r in alignment.with_scores(found).collect()}
    assert got == {r[0]: (r[5], r[6]) for r in plain.alignment(rows, tokenizers)}


def test_empty_table_and_clashing_columns(spark):
    shape = "doc_id bigint, text string, row string, used string, n_a string, groups string"
    found = alignment.alignments(spark.createDataFrame([], shape), A, B)
    assert alignment.with_scores(found).count() == 0
    some = alignment.with_scores(alignment.alignments(spark.createDataFrame([(1, "a b", "r", "u", "n", "g")], shape), A, B)).first()
    assert (some["row"], some["used"], some["n_a"], some["groups"]) == ("r", "u", 2, "257|264;275|287")


def test_forgetting_stretches_changes_nothing(monkeypatch):
    own = alignment.Aligner(Path(A).read_bytes(), Path(B).read_bytes())
    once = [x[:5] for x in own.aligned(texts())]
    monkeypatch.setattr(alignment, "REMEMBERED", 100)
    own.forget()
    assert [x[:5] for t in texts() for x in own.aligned([t])] == once


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=80))
def test_diagonal_runs_equal_a_plain_merge(cuts):
    """Any two lists of ends of the same bytes."""
    n = len(cuts) + 1
    a = [i + 1 for i, (x, _) in enumerate(cuts) if x] + [n]
    b = [i + 1 for i, (_, y) in enumerate(cuts) if y] + [n]
    cuts_a, cuts_b, links_a, links_b = alignment.align(a, b)
    groups, links = plain.merged(a, b)
    assert list(zip(cuts_a, cuts_b, strict=True)) == [(x, y) for _, x, _, y in groups]
    assert list(zip(links_a, links_b, strict=True)) == links


def test_runs_are_measured_by_probing():
    same = list(range(1, 1001))
    assert alignment.run_length(same, same, 0, 0) == 1000
    assert alignment.run_length(same, [*same[:700], 5000], 3, 3) == 697
    assert alignment.run_length([5], [4, 5], 0, 0) == 0
