"""Substring deduplication with suffix automata of reference shards.

A run of words counts as repeated if it also starts in a text with a smaller key. The reference is what texts own: the runs of which they
have the smallest key. It is cut into shards of bounded size; each task holds the automaton of one shard and streams through
it the stretches of other texts that may match there. Matching statistics of the wanted length, with the smallest owner of each matched
run, give the spans to remove.

Sending every text through every shard would cost texts times shards. Which stretches may match where is found by fingerprints: the
smallest hash of the short word runs in a window is the same wherever the window stands, so only texts that share such an
anchor with another one are looked at, and only windows that meet in their whole hash are sent on. The automata decide by the words.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import text_pieces
from tidemark.llm.automaton import SuffixAutomaton
from tidemark.llm.shingles import shingles_of, word_hashes
from tidemark.session import written

# Words in the short runs from which a window's anchor is drawn, as a share of the window.
ANCHOR_SHARE = 0.4
# Words of reference in one automaton, and words streamed through one copy of it, about.
SHARD_WORDS = 100_000
STREAM_WORDS = 1_000_000


def _anchor_size(size: int) -> int:
    return max(1, int(size * ANCHOR_SHARE))


def _anchors(words: np.ndarray, size: int) -> np.ndarray:
    """For each window of ``size`` words the smallest hash of the shorter runs in it."""
    short = _anchor_size(size)
    if len(words) < size:
        return words[:0]
    low, span, wanted = shingles_of(words, short), 1, size - short + 1
    while 2 * span <= wanted:  # minima over twice as many runs each time
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    rest = wanted - span
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def _members(rows: DataFrame, size: int) -> DataFrame:
    """Per row the number of words, the digest of its words joined by one space, and its distinct anchors."""

    def run(batches):
        for batch in batches:
            for piece, data, offsets in text_pieces(batch, "text"):
                words, _, _, cuts = word_hashes(data, offsets)
                raw = data.tobytes()
                found = [np.unique(_anchors(words[cuts[i] : cuts[i + 1]], size)).view(np.int64) for i in range(len(piece))]
                digests = [hashlib.sha256(b" ".join(raw[offsets[i] : offsets[i + 1]].split())).hexdigest() for i in range(len(piece))]
                anchors = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32)), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("row_id"), pa.array(np.diff(cuts)), pa.array(digests), anchors], ["key", "row_id", "n_words", "content", "anchors"])

    return written(rows.mapInArrow(run, "key bigint, row_id bigint, n_words bigint, content string, anchors array<bigint>"), "substring-members")


def _windows(candidates: DataFrame, size: int) -> DataFrame:
    """Place and hash of each window of ``candidates(row_id, key, text, anchors)`` whose anchor is among the given ones."""

    def run(batches):
        for batch in batches:
            for piece, data, offsets in text_pieces(batch, "text", 1 << 18):
                words, _, _, cuts = word_hashes(data, offsets)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for i, (row, key, wanted) in enumerate(zip(piece.column("row_id").to_pylist(), piece.column("key").to_pylist(), piece.column("anchors"), strict=True)):
                    own = words[cuts[i] : cuts[i + 1]]
                    places = np.flatnonzero(np.isin(_anchors(own, size), np.asarray(wanted.values).view(np.uint64)))
                    out[0].append(np.full(len(places), row, np.int64))
                    out[1].append(np.full(len(places), key, np.int64))
                    out[2].append(places.astype(np.int32))
                    out[3].append(shingles_of(own, size)[places].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["row_id", "key", "place", "window"])

    return candidates.mapInArrow(run, "row_id bigint, key bigint, place int, window bigint")


def _stretches(met: DataFrame, size: int) -> DataFrame:
    """The runs of words to add to the reference (``kind`` 0) and to stream (1), each with the owner whose shard it goes to."""

    def run(batches):
        for batch in batches:
            for piece in (batch.slice(i, 64) for i in range(0, len(batch), 64)):
                out: list[list] = [[], [], [], [], [], []]
                for row, key, text, found in zip(*(piece.column(c).to_pylist() for c in ("row_id", "key", "text", "met")), strict=True):
                    words = text.encode().split()
                    found.sort(key=lambda m: (m["owner"], m["place"]))
                    for owner, places in groupby(found, key=lambda m: m["owner"]):
                        begin = last = None
                        for place in [*(m["place"] for m in places), None]:
                            if begin is not None and (place is None or place > last + 1):
                                values = (0 if owner == key else 1, owner, row, key, begin, b" ".join(words[begin : last + size]))
                                for column, value in zip(out, values, strict=True):
                                    column.append(value)
                                begin = None
                            if begin is None:
                                begin = place
                            last = place
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["kind", "owner", "row_id", "key", "place", "words"])

    return met.mapInArrow(run, "kind int, owner bigint, row_id bigint, key bigint, place int, words binary")


def _matched(stretches: DataFrame, size: int) -> DataFrame:
    """Spans of streamed rows that the automaton of their shard has of a smaller owner."""
    counted = F.size(F.split(F.col("words").cast("string"), " ")).cast("bigint")
    stretches = stretches.withColumn("n", counted)
    total = stretches.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = stretches.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards)))
    # A shard that much is streamed through is held by several tasks.
    copies = dealt.where("kind = 1").groupBy("shard").agg(F.ceil(F.sum("n") / STREAM_WORDS).cast("int").alias("copies"))
    spread = dealt.join(copies, "shard").withColumn(
        "copy", F.explode(F.when(F.col("kind") == 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array(F.pmod(F.xxhash64("row_id", "place"), F.col("copies")).cast("int"))))
    )

    def run(batches):
        at, automaton, closed = None, None, False
        for batch in batches:
            rows, starts, ends = [], [], []
            for shard, copy, kind, owner, row, key, place, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "copy", "kind", "owner", "row_id", "key", "place", "words")), strict=True):
                if at != (shard, copy):
                    at, automaton, closed = (shard, copy), SuffixAutomaton(), False
                if kind == 0:
                    automaton.add(words.split(), owner)
                    continue
                if not closed:
                    automaton.close()
                    closed = True
                for begin, end in automaton.spans(words.split(), size, key):
                    rows.append(row)
                    starts.append(place + begin)
                    ends.append(place + end)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["row_id", "start", "end"])

    in_order = spread.repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    return in_order.select("shard", "copy", "kind", "owner", "row_id", "key", "place", "words").mapInArrow(run, "row_id bigint, start int, end int")


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 50) -> DataFrame:
    """Per row ``key``, ``n_words``, ``n_removed``, ``spans``, ``kept`` and ``content``.

    ``spans`` are the maximal stretches of words (start, end exclusive) covered by windows of ``size`` words that also start in a row with
    a smaller key; windows are judged on the input. ``kept`` is what is left, words joined by one space, and NULL where nothing is
    removed. ``content`` is the SHA-256 digest of all words joined by one space.

    Words are runs other than white space; a NULL text has none. The key is a bigint. Rows with a NULL key neither lose words nor make others
    lose any; rows with equal keys do not affect each other. An empty table gives an empty result.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(F.col(key), F.col(text)).alias("row_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    members = _members(rows, size)
    firsts = members.groupBy("content").agg(F.min("key").alias("first"))
    classed = members.join(firsts, "content")
    # Of rows with the same words, those with the smallest key stand for all; the others repeat them throughout.
    copies = classed.where("key > first").select("key", "row_id", "n_words", "content")
    own = written(classed.where("key = first").select("key", "row_id", "anchors").dropDuplicates(["row_id"]), "substring-own")

    spread = own.select("key", "row_id", F.explode("anchors").alias("anchor"))
    met = spread.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("anchor")
    wanted = spread.join(met, "anchor").groupBy("row_id", "key").agg(F.collect_list("anchor").alias("anchors"))  # at most one per word of a text
    candidates = written(rows.select("row_id", "text").join(wanted, "row_id").dropDuplicates(["row_id"]), "substring-candidates")

    windows = written(_windows(candidates.select("row_id", "key", "text", "anchors"), size), "windows")
    owners = windows.groupBy("window").agg(F.min("key").alias("owner"), F.max("key").alias("high")).where("owner < high").select("window", "owner")
    places = windows.join(owners, "window").groupBy("row_id").agg(F.collect_list(F.struct("place", "owner")).alias("met"))
    stretches = written(_stretches(candidates.join(places, "row_id").select("row_id", "key", "text", "met"), size), "stretches")
    spans = _matched(stretches, size).groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    cut = _cut(candidates.select("row_id", "text").join(spans, "row_id"))

    everything = F.when(F.col("n_words") >= size, F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))))
    gone = copies.select("row_id", everything.alias("spans"), F.when(F.col("n_words") >= size, F.lit("")).alias("kept")).where("spans is not null").distinct()
    left = members.select("key", "row_id", "n_words", "content").join(cut.unionByName(gone), "row_id", "left")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["end"] - s["start"]))
    return left.select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce(removed, F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)")).alias("spans"),
        "kept",
        "content",
    )


def _cut(found: DataFrame) -> DataFrame:
    """Merge the spans of each row, and join the words outside of them."""

    def run(batches):
        for batch in batches:
            for piece in (batch.slice(i, 256) for i in range(0, len(batch), 256)):
                merged, kept = [], []
                for text, spans in zip(piece.column("text").to_pylist(), piece.column("spans").to_pylist(), strict=True):
                    words, whole = text.encode().split(), []
                    for span in spans:
                        if whole and span["start"] <= whole[-1]["end"]:
                            whole[-1]["end"] = max(whole[-1]["end"], span["end"])
                        else:
                            whole.append(dict(span))
                    edges = [0, *(x for s in whole for x in (s["start"], s["end"])), len(words)]
                    kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2], strict=True) for w in words[a:b]).decode())
                    merged.append(whole)
                yield pa.RecordBatch.from_arrays([piece.column("row_id"), pa.array(merged, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string())], ["row_id", "spans", "kept"])

    return found.select("row_id", "text", "spans").mapInArrow(run, "row_id bigint, spans array<struct<start:int,end:int>>, kept string")
