"""Alignment of the tokens that two tokenizers make of the same text, and how often their ids meet.

Tokenizer A is a byte-level BPE file of the tokenizers library, B a sentencepiece model whose pieces start at spaces; A reads a space and
the text, B adds that space itself. Both texts are cut before each run of spaces that follows a character that is not white space: no
token of either crosses such a place, so both have a token end there. Every distinct stretch between two such places is encoded and aligned
once per worker and remembered, many new ones behind each other as one text; a text's alignment is that of its stretches.

Tokens are compared by the bytes at which they end. While the ends at the current index shift agree, tokens are one to one: the
stretch is measured by exponential probing and jumped. Where they do not, the group is resolved by merging the two lists of ends up to
the next common one, and the shift changes by the difference in tokens.
"""

from __future__ import annotations

import os
import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrow import text_pieces
from tidemark.llm.bpe import byte_characters
from tidemark.session import written

# White space other than U+0020 in any reading of it, before which and after which nothing is cut.
OTHER_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 ᠎ -​    ⁠　﻿"
STRETCH = re.compile(f" *(?:[^ ]+(?:(?<=[{OTHER_SPACE}]) +)?)+| +")
# Characters of stretches that a worker remembers the tokens of.
REMEMBERED = 4 << 20
SPACE = "▁"
# Stretches that are encoded as one text.
TOGETHER = 500
# A pair of ids met more than once in so many links is broadcast; there can be no more such pairs than this.
HOT_PAIRS = 1 << 16


class Aligner:
    """Both tokenizers and what is known of the stretches met so far, made once per worker."""

    def __init__(self, json_a: bytes, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(json_a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        back = {c: i for i, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.sizes_a, self.sizes_b = (np.fromiter(map(len, t), np.int64, len(t)) for t in (self.bytes_a, self.bytes_b))
        self.names_a, self.names_b = (list(map(str, range(len(t)))) for t in (self.bytes_a, self.bytes_b))
        self.space_b = pieces.index(SPACE)
        self.forget()

    def forget(self):
        self.known: dict[str, int] = {}
        self.held = 0
        self.groups: list[str] = []  # of each stretch, as text
        self.codes = np.zeros(0, np.int64)  # of the stretches' links, end to end
        # Per stretch: tokens of A, tokens of B, groups, links, and whether both sides give its bytes back.
        self.counts = np.zeros((0, 5), np.int64)
        self.begins = np.zeros(0, np.int64)

    def ids(self, stretches: list[str]) -> tuple[list[int], list[int]]:
        """Ids of A and of B for stretches that follow one another in a text."""
        text = "".join(stretches)
        b = [self.space_b] if text == " " else self.b.encode(text[1:], num_threads=1)  # B adds the first space
        return self.a.encode(text, add_special_tokens=False).ids, b

    def same(self, ids_a: list[int], ids_b: list[int], text: str) -> bool:
        raw = text.encode()
        return b"".join(map(self.bytes_a.__getitem__, ids_a)) == raw == b"".join(map(self.bytes_b.__getitem__, ids_b))

    def learn(self, stretches: list[str]):
        """Encode and align stretches not met before. Many of them make one text, as no token crosses from one to the next."""
        done: list[str] = []
        all_a: list[int] = []
        all_b: list[int] = []
        whole: list[bool] = []
        # A stretch that ends in white space is the last of its text, and runs into any that is put behind it.
        alone = [s for s in stretches if s[-1] in OTHER_SPACE or s[-1] == " " or SPACE in s]
        rest = list(set(stretches).difference(alone))
        runs = [[s] for s in alone] + [rest[i : i + TOGETHER] for i in range(0, len(rest), TOGETHER)]
        while runs:
            run = runs.pop()
            a, b = self.ids(run)
            same = self.same(a, b, "".join(run))
            if not same and len(run) > 1:  # find out which
                runs += [[s] for s in run]
                continue
            done += run
            whole += [same] * len(run)
            if same:
                all_a += a
                all_b += b
        ids_a, ids_b = np.array(all_a, np.int64), np.array(all_b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        cuts_a, cuts_b, links_a, links_b = align(ends_a.tolist(), ends_b.tolist())
        shown = group_texts([self.names_a[i] for i in all_a], [self.names_b[i] for i in all_b], cuts_a, cuts_b)
        group_ends = ends_a[np.array(cuts_a, np.int64) - 1]
        links_a, links_b = np.array(links_a, np.int64), np.array(links_b, np.int64)
        link_ends = np.minimum(ends_a[links_a], ends_b[links_b])
        # What belongs to each stretch, by the byte at which it ends.
        kept = np.array(whole, bool)
        upto = np.cumsum(np.where(kept, np.fromiter((len(s.encode()) for s in done), np.int64, len(done)), 0))
        places = np.column_stack([np.searchsorted(ends, upto, "right") for ends in (ends_a, ends_b, group_ends, link_ends)])
        counts = np.diff(places, axis=0, prepend=np.zeros((1, 4), np.int64))
        last = places[:, 2].tolist()
        self.groups += [";".join(shown[i:j]) for i, j in zip([0, *last], last, strict=False)]
        self.begins = np.concatenate([self.begins, len(self.codes) + places[:, 3] - counts[:, 3]])
        self.codes = np.concatenate([self.codes, ids_a[links_a] << 32 | ids_b[links_b]])
        self.counts = np.concatenate([self.counts, np.column_stack([counts, kept])])
        self.known.update(zip(done, range(len(self.known), len(self.known) + len(done)), strict=True))
        self.held += sum(map(len, done))

    def aligned(self, texts: list[str]):
        """For each text, the values of ``ADDED``."""
        if self.held > REMEMBERED:
            self.forget()
        cut = [STRETCH.findall(" " + t) if t else [] for t in texts]
        fresh = list({s for found in cut for s in found} - self.known.keys())
        if fresh:
            self.learn(fresh)
        nothing = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32))
        for found in cut:
            at = [self.known[s] for s in found]
            places = np.array(at, np.int64)
            counts = self.counts[places]
            if not at or not counts[:, 4].all():
                yield nothing
                continue
            links = counts[:, 3]
            ends = np.cumsum(links)
            codes = self.codes[np.arange(ends[-1]) + np.repeat(self.begins[places] - (ends - links), links)]
            codes.sort()
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            times = np.diff(np.append(first, len(codes))).astype(np.int32)
            yield (*counts[:, :4].sum(0).tolist(), ";".join([self.groups[i] for i in at]), codes[first], times)


def run_length(a: list[int], b: list[int], i: int, j: int) -> int:
    """How many ends from ``a[i]`` and ``b[j]`` on agree one by one."""
    run, step = 0, 1
    while a[i + run : i + run + step] == b[j + run : j + run + step]:
        if i + run + step >= len(a):
            return len(a) - i
        run += step
        step *= 2
    while step > 1:  # the first difference lies within the last step
        step //= 2
        if a[i + run : i + run + step] == b[j + run : j + run + step]:
            run += step
    return run


def align(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """``cuts_a, cuts_b, links_a, links_b`` from the ends of two lists of tokens of the same bytes.

    The cuts are the numbers of tokens up to each common end; the links are the indices of each two tokens whose bytes overlap.
    """
    cuts_a: list[int] = []
    cuts_b: list[int] = []
    links_a: list[int] = []
    links_b: list[int] = []
    i, shift = 0, 0
    while i < len(a):
        run = run_length(a, b, i, i + shift)
        if run:
            cuts_a += range(i + 1, i + run + 1)
            cuts_b += range(i + shift + 1, i + shift + run + 1)
            links_a += range(i, i + run)
            links_b += range(i + shift, i + shift + run)
            i += run
        else:
            j = i + shift
            while True:
                links_a.append(i)
                links_b.append(j)
                end = a[i] - b[j]
                i += end <= 0
                j += end >= 0
                if end == 0:
                    break
            cuts_a.append(i)
            cuts_b.append(j)
            shift = j - i
    return cuts_a, cuts_b, links_a, links_b


def group_texts(ids_a: list[str], ids_b: list[str], cuts_a: list[int], cuts_b: list[int]) -> list[str]:
    """Each group as ``a1,a2|b1``."""
    out, p, q = [], 0, 0
    for x, y in zip(cuts_a, cuts_b, strict=True):
        out.append(",".join(ids_a[p:x]) + "|" + ",".join(ids_b[q:y]))
        p, q = x, y
    return out


@cache
def aligner(json_a: bytes, model_b: bytes) -> Aligner:
    return Aligner(json_a, model_b)


ADDED = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(), "groups": T.StringType(), "pairs": T.ArrayType(T.LongType()), "times": T.ArrayType(T.IntegerType())}


def alignments(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """All columns but the text, with the alignment of each whole text; columns of the added names are replaced.

    ``n_a``, ``n_b``, ``n_groups`` and ``n_links`` count tokens, groups and links; ``groups`` has the ids of each group, as ``a1,a2|b1;a3|b2,b3``;
    ``pairs`` has the distinct linked ids, ``a << 32 | b``, and ``times`` how many links each has. A text that is NULL or empty, or whose
    tokens do not give back its bytes (one with U+2581, which B reads as a space), has no tokens: zeros and empty values.
    Repeated rows have the same result. A text is never cut for its length; memory grows with the longest.
    """
    blobs = []
    for path in (path_a, path_b):
        with open(path, "rb") as file:
            blobs.append(file.read())
    shared = docs.sparkSession.sparkContext.broadcast(tuple(blobs))
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ADDED and c != text])
    rows = docs.select(row.alias("row"), F.col(f"`{text}`").alias("used"))
    shape = T.StructType([rows.schema["row"], *[T.StructField(name, kind) for name, kind in ADDED.items()]])

    def run(batches):
        own = aligner(*shared.value)
        for batch in batches:
            for piece, _, _ in text_pieces(batch, "used"):
                out = dict(zip(ADDED, zip(*own.aligned(piece.column("used").fill_null("").to_pylist()), strict=True), strict=True))
                columns = [_lists(out[n], kind) if isinstance(kind, T.ArrayType) else pa.array(out[n], pa.string() if n == "groups" else pa.int64()) for n, kind in ADDED.items()]
                yield pa.RecordBatch.from_arrays([piece.column("row"), *columns], ["row", *ADDED])

    made = rows.mapInArrow(run, shape)
    return made.select(*[F.col(f"row.`{c}`") for c in rows.schema["row"].dataType.names if c != "_"], *ADDED)


def _lists(arrays: list[np.ndarray], kind: T.ArrayType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    plain = np.int64 if isinstance(kind.elementType, T.LongType) else np.int32
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, plain), type=pa.int64() if plain is np.int64 else pa.int32()))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``count`` (its links in all rows) and ``best`` (whether no pair of its B id has more) from ``pairs`` and ``times``."""
    each = aligned.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    counts = written(each.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pair-counts")
    tops = counts.groupBy("b").agg(F.max("count").alias("top"))
    return written(counts.join(tops, "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best")), "pair-ranks")


def with_scores(aligned: DataFrame) -> DataFrame:
    """The rows of a written ``aligned``, without ``pairs`` and ``times``, with ``n_best`` and ``count_sum``.

    ``n_best`` counts the links whose pair is the most frequent of its B id in all rows, ties included; ``count_sum`` adds up the pairs' counts over the
    links. Pairs that hold more than one in ``HOT_PAIRS`` links are looked up in a broadcast table, of fewer than that many rows
    by this definition; all others are joined by shuffle, and none of these holds a larger share.
    """
    named = written(aligned.withColumn("row_name", F.monotonically_increasing_id()), "alignments")
    ranks = pair_counts(named)
    links = ranks.agg(F.sum("count")).first()[0] or 0
    hot = F.broadcast(ranks.where(F.col("count") * HOT_PAIRS > links))
    each = named.select("row_name", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair").join(hot, "pair", "left")
    known = each.where("count is not null")
    rare = each.where("count is null").select("row_name", "pair", "times").join(ranks, "pair")
    sums = [F.sum(F.when(F.col("best"), F.col("times").cast("bigint")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    scores = known.unionByName(rare.select(*known.columns)).groupBy("row_name").agg(*sums)
    rest = [c for c in aligned.columns if c not in ("pairs", "times", "n_best", "count_sum")]
    joined = named.select("row_name", *[F.col(f"`{c}`") for c in rest]).join(scores, "row_name", "left")
    return joined.select(*[F.col(f"`{c}`") for c in rest], *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")])
