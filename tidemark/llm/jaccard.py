"""Similarity join of texts on word shingles, with adaptive multi-match prefixes.

The shingles of all texts are put in one global order, rare ones first. Two sets of at least the wanted similarity, cut to the first
``n - needed(n) + l`` shingles, have at least ``l`` of these in common. A longer prefix (a higher ``l``) meets more partners
once but few of them ``l`` times. So each text takes the ``l`` that is cheapest for it, as estimated from how frequent the shingles of its prefixes are;
a pair has to agree on the smaller ``l`` of the two.

Equal sets are one node. To keep large groups of near copies from producing all their pairs, the texts of each shared shingle are
first verified against one of them, the pivot, until few pairs are left whose ends are not yet connected; all of those are
then formed, counted and verified. Nothing is capped, and a link is left out only between texts already connected by
other verified links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import text_pieces
from tidemark.llm.caps import _groups
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_set, shingles_of, word_hashes
from tidemark.session import written

LEVELS = 3
# Counters that estimate how many texts hold a shingle. Their size is fixed: 8 MB of codes are broadcast whatever the input is.
SKETCH_BITS = 23
MOST = np.iinfo(np.uint32).max
# Texts that a task counts in 16 bits before it hands its counters on and begins anew.
COUNTED = np.iinfo(np.uint16).max
# Bytes of text hashed at a time: a worker keeps what its arrays took, and each of them is many times the text.
HASHED_BYTES = 1 << 18
# Steps that codes of counters have in an octave.
STEPS = 8
SKETCH_PARTS = 64
# Cost of verifying a candidate, in units of reading one entry of a posting list.
VERIFY_COST = 50.0
# Pairs are formed once there are at most this many for each posting that is left.
PAIRS_PER_POSTING = 16


def needed(n, percent: int):
    """Fewest shingles that a set of ``n`` shares with any set of the wanted similarity."""
    return (percent * n + 99) // 100


def row_id(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text))


def _documents(docs: DataFrame, text: str, key: str) -> DataFrame:
    """A name for each row, equal only for rows equal in key and text, and its text; NULL text is empty."""
    return docs.select(F.col(key).alias("key"), row_id(key, text).alias("row_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(piece: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    words, _, _, cuts = word_hashes(data, offsets, fold=True)
    return [shingle_set(words[cuts[i] : cuts[i + 1]], size) for i in range(len(piece))]


# How many shingles fall into each of some buckets: no two sets have more in common than their signatures have.
BUCKETS = 256
FULL = np.iinfo(np.uint16).max


def _signature(shingles: np.ndarray) -> bytes:
    counts = np.bincount((shingles & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
    return np.minimum(counts, FULL).astype(np.uint16).tobytes()


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _members(docs: DataFrame, size: int) -> DataFrame:
    """Per row its node, set size and signature, and per task the counters of its shingles in parts, as one written table.

    ``counters`` has the signature in the rows of texts and the part's counters in those of parts. A task has a further row for each part
    after every ``COUNTED`` texts.
    """
    names = ["key", "row_id", "node", "n", "part", "counters"]

    def parts(counters: np.ndarray):
        for part, cells in enumerate(counters.reshape(SKETCH_PARTS, -1)):
            if cells.any():
                empty = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64())]
                blob = pa.compress(cells.astype(np.uint32).tobytes(), "zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays([*empty, pa.array([part], pa.int32()), pa.array([blob], pa.binary())], names)

    def run(batches):
        counters, texts = np.zeros(1 << SKETCH_BITS, np.uint16), 0
        for batch in batches:
            for piece, data, offsets in text_pieces(batch, "text", HASHED_BYTES):
                sets = _sets(piece, data, offsets, size)
                for s in sets:
                    if texts == COUNTED:
                        yield from parts(counters)
                        counters[:], texts = 0, 0
                    counters[_cells(s)] += 1  # two shingles of a text in one cell count once
                    texts += 1
                nodes = pa.array([_node_of(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), piece.column("row_id"), nodes, pa.array([len(s) for s in sets], pa.int64()), pa.nulls(len(piece), pa.int32()), pa.array([_signature(s) for s in sets], pa.binary())],
                    names,
                )
        yield from parts(counters)

    wanted = docs.select(F.col("key").cast("bigint").alias("key"), "row_id", "text")
    return written(wanted.mapInArrow(run, "key bigint, row_id bigint, node bigint, n bigint, part int, counters binary"), "shingle-members")


def _sketch(members: DataFrame) -> np.ndarray:
    """The counters of all tasks, added up part by part, in groups of bounded size."""
    parts = members.where("part is not null").select("part", "counters")
    tasks = parts.groupBy("part").count().agg(F.max("count")).first()[0] or 0

    def add(frame):
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint32)
        for blob in frame["counters"]:
            more = np.frombuffer(pa.decompress(blob, total.nbytes, "zstd", asbytes=True), np.uint32)
            total += np.minimum(more, MOST - total)
        return frame.iloc[:1][["part"]].assign(counters=[pa.compress(total.tobytes(), "zstd", asbytes=True)])

    while tasks > 64:
        tasks = -(-tasks // 64)
        parts = parts.withColumn("deal", F.pmod(F.xxhash64("counters"), F.lit(tasks))).groupBy("part", "deal").applyInPandas(add, "part int, counters binary")
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint32)
    for row in parts.groupBy("part").applyInPandas(add, "part int, counters binary").collect():  # 32 MB at most
        out[row["part"]] = np.frombuffer(pa.decompress(row["counters"], out[0].nbytes, "zstd", asbytes=True), np.uint32)
    return out.reshape(-1)


def _noise(sketch: np.ndarray) -> tuple[float, float]:
    """What a counter may hold of shingles that nobody asks for, and the least difference that tells.

    However many shingles share a counter, a frequent one stands out of the spread of the others: counters are wide enough not to fill up, and the
    limit is four times that spread above the middle.
    """
    middle, high = np.quantile(sketch, [0.5, 0.84])
    spread = max(float(high - middle), float(np.sqrt(middle)))
    return max(2.0, float(middle) + 4 * spread), max(2.0, 4 * spread)


def _codes(sketch: np.ndarray, noise: float, unit: float) -> np.ndarray:
    """What each counter holds above the noise, in steps of ``STEPS`` an octave of ``unit``, rounded up. They fit in a byte, as ``unit`` is 2 at least."""
    codes = np.zeros(len(sketch), np.uint8)
    for begin in range(0, len(sketch), 1 << 18):
        above = np.maximum(0, sketch[begin : begin + (1 << 18)] - noise)
        codes[begin : begin + (1 << 18)] = np.ceil(STEPS * np.log2(1 + above / unit))
    return codes


def _postings(docs: DataFrame, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """``token``, ``node``, set size ``n``, the ``level`` from which the token is in the prefix, and the chosen level ``l`` of the node."""
    noise, unit = _noise(sketch)
    shared = docs.sparkSession.sparkContext.broadcast(_codes(sketch, noise, unit))

    def run(batches):
        codes = shared.value
        for batch in batches:
            for piece, data, offsets in text_pieces(batch, "text", HASHED_BYTES):
                columns: list[list[np.ndarray]] = [[], [], [], [], []]
                for s in _sets(piece, data, offsets, size):
                    n = len(s)
                    if n == 0:
                        continue
                    first = n - needed(n, percent) + 1
                    top = min(LEVELS, needed(n, percent))
                    rarity = codes[_cells(s)]
                    # Rarity in octaves above the noise: smaller differences mean nothing.
                    order = np.lexsort((s, -(-rarity.astype(np.int16) // STEPS)))[: first + top - 1]
                    reading = np.cumsum(unit * (np.exp2(rarity[order] / STEPS) - 1))[first - 1 :]
                    # Each further match asked for leaves about a quarter of the candidates.
                    cost = reading * (1 + VERIFY_COST * 0.25 ** np.arange(top))
                    level = int(np.argmin(cost)) + 1
                    count = first + level - 1
                    columns[0].append(s[order[:count]].view(np.int64))
                    columns[1].append(np.full(count, _node_of(s), np.int64))
                    columns[2].append(np.full(count, n, np.int32))
                    columns[3].append(np.maximum(1, np.arange(count) - first + 2).astype(np.int8))
                    columns[4].append(np.full(count, level, np.int8))
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["token", "node", "n", "level", "l"])

    return docs.select("text").mapInArrow(run, "token bigint, node bigint, n int, level byte, l byte")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` of ``pairs`` that may be similar enough by what their signatures have in common."""

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("signature_a", "signature_b"))
            total = np.asarray(batch.column("n_a")) + np.asarray(batch.column("n_b"))
            yield batch.select(["a", "b"]).filter(pa.array(_may_link(x, y, total, percent)))

    left, right = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("signature").alias(f"signature_{c}")) for c in "ab")
    return pairs.select("a", "b").join(right, "b").join(left, "a").mapInArrow(run, "a bigint, b bigint")


# Bits of the filter that keeps texts nobody asked for out of a shuffle: 2 MB whatever the input is. It only ever lets more texts through.
FILTER_BITS = 24


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``text`` for ``wanted(row_id, node)``."""
    cell = F.pmod(F.xxhash64("row_id"), F.lit(1 << FILTER_BITS))
    maps = wanted.select((cell + 1).alias("cell")).groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect()
    bits = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for m in maps:
        part = np.frombuffer(m["bits"], np.uint8)
        begin = (m["bucket"] - 1) * len(part)  # buckets and their bits count from 1
        bits[begin : begin + len(part)] |= part[: len(bits) - begin]
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            cells = np.asarray(batch.column("cell"))
            asked = (shared.value[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1
            yield batch.select(["row_id", "text"]).filter(pa.array(asked.astype(bool)))

    passed = rows.select("row_id", "text", cell.alias("cell")).mapInArrow(run, "row_id bigint, text string")
    return written(passed.join(wanted, "row_id").select("node", "text").distinct(), "texts")


def _verified(pairs: DataFrame, rows: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes, from a written table, whose texts are similar enough, by their whole shingle sets."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts(rows, nodes.select("row_id", "node").join(ends, "node"))

    def run(batches):
        held: dict[int, np.ndarray] = {}

        def set_of(node: int, text: str) -> np.ndarray:
            if node not in held:
                raw = text.encode()
                if len(held) >= 64:
                    held.clear()
                words = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), fold=True)[0]
                held[node] = shingle_set(words, size)
            return held[node]

        for batch in batches:
            links = []
            for a, b, text_a, text_b in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b")), strict=True):
                x, y = set_of(a.as_py(), text_a.as_py()), set_of(b.as_py(), text_b.as_py())
                both = len(np.intersect1d(x, y, assume_unique=True))
                links.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    left, right = texts.toDF("a", "text_a"), texts.toDF("b", "text_b")
    return written(pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint"), "links")


def _near_in_size(n_a: str, n_b: str, percent: int) -> Column:
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def similar_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """``key``, ``row_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    ``component_id`` is the smallest key reachable over links, the row's own included. ``row_id`` is ``xxhash64(key, text)``; ``kept`` marks the
    row that stands for its component, the first by key, and every row equal to it in key and text.

    Two rows link when their sets of ``size``-word shingles, of words after lower-casing A-Z, have a Jaccard similarity of at least
    ``percent`` per cent. A text of fewer words is one shingle. Rows without words (NULL, empty or blank text) link with
    nothing and are their own component. Equal texts are always linked. Rows with a NULL key have one row each as others do, but a NULL key is no
    smallest key: only if all keys of a component are NULL, its id is NULL. An empty table gives an empty result.

    Shingles and nodes are 64-bit hashes. The chance that any two of N different sets share a node is N * N / 2**65.
    """
    rows = _documents(docs, text, key)
    members = _members(rows, size)
    people = members.where("part is null").select("key", "row_id", "node", "n", F.col("counters").alias("signature"))
    postings = _postings(rows, size, percent, _sketch(members))
    raw = written(postings, "prefixes")
    met = raw.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    lists = written(raw.join(met.select("token"), "token").distinct(), "posting-lists")  # equal texts have equal postings

    # One row to stand for each node that meets another.
    speakers = people.where("node is not null").groupBy("node").agg(F.min("row_id").alias("row_id")).join(lists.select("node").distinct(), "node")
    nodes = written(people.select("row_id", "n", "signature").join(speakers, "row_id").distinct(), "nodes")

    links, open_lists = _pivot_links(lists, rows, nodes, size, percent)
    pairs = written(_open_pairs(open_lists, nodes, percent), "pairs")
    late = _verified(written(_likely(pairs, nodes, percent), "likely-pairs"), rows, nodes, size, percent)
    groups = components(links.unionByName(late) if links is not None else late)

    speaks = F.struct(F.col("key").isNull(), "key", "row_id")
    of_node = people.where("node is not null").groupBy("node").agg(F.min("key").alias("low"), F.min(speaks).alias("first")).join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = of_node.groupBy("root").agg(F.min("low").alias("component_id"), F.min("first").alias("first"))
    labels = of_node.select("node", "root").join(lows, "root").select("node", "component_id", F.col("first.row_id").alias("speaker"))
    linked = people.join(labels, "node").select("key", "row_id", F.col("n").alias("n_shingles"), "component_id", (F.col("row_id") == F.col("speaker")).alias("kept"))
    alone = people.where("node is null").select("key", "row_id", F.col("n").alias("n_shingles"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(alone).withColumnRenamed("key", key)


def _pivot_links(lists: DataFrame, rows: DataFrame, nodes: DataFrame, size: int, percent: int) -> tuple[DataFrame | None, DataFrame]:
    """Links found by comparing each list with one node after the other, and the lists that are still open.

    A list is open while it holds more than one component. ``main`` is the component of its pivot. The rounds stop when the pairs that
    are left are few for the postings left, or when a round does not halve them: their number bounds that of the rounds.
    """
    links = groups = None
    tried, pairs_left = None, float("inf")
    open_lists = lists.withColumns({"root": F.col("node"), "main": F.lit(None).cast("bigint")})
    while True:
        pivots = open_lists.where("main is null or root <> main").groupBy("token").agg(F.min(F.struct("node", "n")).alias("p")).select("token", F.col("p.node").alias("a"), F.col("p.n").alias("n_a"))
        pairs = open_lists.join(pivots, "token").where((F.col("node") != F.col("a")) & _near_in_size("n", "n_a", percent))
        pairs = pairs.where("root <> a") if links is None else pairs.join(groups.toDF("a", "root_a"), "a", "left").where(F.col("root") != F.coalesce("root_a", "a"))
        pairs = pairs.select("a", F.col("node").alias("b")).distinct()
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pivot-pairs")
        found = _verified(written(_likely(pairs, nodes, percent), "likely-pairs"), rows, nodes, size, percent)
        fresh = not found.isEmpty()
        if fresh:
            links = found if links is None else links.unionByName(found)
            groups = components(links)
        tried = pairs if tried is None else tried.unionByName(pairs)
        rooted = lists if groups is None else lists.join(groups, "node", "left")
        rooted = written(rooted.withColumn("root", F.coalesce("root", "node") if groups is not None else F.col("node")), "rooted")
        # The pivot's component is taken for the main one of its list.
        mains = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("node", "root")).alias("p")).where("low < high").select("token", F.col("p.root").alias("main"))
        open_lists = written(rooted.join(mains, "token"), "open-lists")
        size_of = open_lists.groupBy("token").agg(F.count("*").alias("all"), F.sum((F.col("root") != F.col("main")).cast("bigint")).alias("others"))
        left = size_of.agg(F.sum(F.col("all") * F.col("others")).alias("pairs"), F.sum("all").alias("postings")).first()
        pairs_left, before = left["pairs"] or 0, pairs_left
        if not fresh or pairs_left <= PAIRS_PER_POSTING * (left["postings"] or 0) or 2 * pairs_left > before:
            return links, open_lists


# Postings on one side of a rectangle that one task compares at a time.
SIDE = 512
# A list with at most this many nodes outside its main component is joined as it is: its pairs are so many times its postings at most.
FEW = 16
# What a signature is cut to for the rectangles: four bits a bucket.
NIBBLE = 15
# Tokens of a node, the smallest of those in long lists, by which a pair that meets in many rectangles becomes a row in one of them.
FIRST = 16


def _brief(nodes: DataFrame) -> DataFrame:
    """``node`` and its signature, each bucket in four bits."""

    def run(batches):
        for batch in batches:
            counts = np.minimum(np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint16).reshape(-1, BUCKETS), NIBBLE).astype(np.uint8)
            packed = counts[:, 0::2] | counts[:, 1::2] << 4
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([p.tobytes() for p in packed], pa.binary())], ["node", "brief"])

    return nodes.select("node", "signature").mapInArrow(run, "node bigint, brief binary")


def _open_pairs(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes in different components that share enough of their prefixes and may be similar enough, each once.

    Lists with few nodes outside the main component are joined as they are. A longer one is cut into rectangles of bounded side, of these nodes
    against all, and its pairs are compared there: only those that the signatures cannot refute become rows, most of them once however many lists
    they share.
    """
    others = F.sum((F.col("root") != F.col("main")).cast("int"))
    sized = lists.join(lists.groupBy("token").agg(others.alias("others"), F.count("*").alias("all")), "token")
    met = _joined(sized.where(F.col("others") <= FEW), percent).unionByName(_compared(sized.where(F.col("others") > FEW), nodes, percent))
    return met.groupBy("a", "b").agg(F.sum("met").alias("shared"), F.first("asked").alias("asked")).where("shared >= asked").select("a", "b")


def _joined(lists: DataFrame, percent: int) -> DataFrame:
    others = lists.where("root <> main").select("token", *[F.col(c).alias(f"{c}_a") for c in ("node", "n", "level", "l", "root")])
    every = lists.select("token", "main", *[F.col(c).alias(f"{c}_b") for c in ("node", "n", "level", "l", "root")])
    asked = F.least("l_a", "l_b")
    met = others.join(every, "token").where(
        (F.col("root_a") != F.col("root_b"))
        & ((F.col("root_b") == F.col("main")) | (F.col("node_a") < F.col("node_b")))
        & _near_in_size("n_a", "n_b", percent)
        & (F.col("level_a") <= asked)
        & (F.col("level_b") <= asked)
    )
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"), asked.alias("asked"), F.lit(1).alias("met"))


def _firsts(lists: DataFrame) -> DataFrame:
    """``node`` and its ``FIRST`` smallest tokens that count whatever level a partner asks for, as 64-bit numbers behind each other."""

    def run(batches):
        for batch in batches:
            firsts = [np.array(tokens, np.int64).tobytes() for tokens in batch.column("firsts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(firsts, pa.binary())], ["node", "firsts"])

    # No more than a text's own prefix is collected.
    own = lists.where("level = 1").groupBy("node").agg(F.slice(F.array_sort(F.collect_list("token")), 1, FIRST).alias("firsts"))
    return own.mapInArrow(run, "node bigint, firsts binary")


def _compared(lists: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` and how many shared tokens a row stands for, ``met``, of the ``asked`` ones.

    Two nodes that have at least as many of their first tokens in common as they are asked for become a row in the list of the smallest of
    these only, which stands for all of them. Others become a row in every list they share.
    """
    rows = lists.join(_brief(nodes), "node").join(_firsts(lists), "node", "left").withColumn("hash", F.xxhash64("node", "token"))
    rows = rows.withColumns({"ups": F.ceil(F.col("others") / SIDE).cast("int"), "downs": F.ceil(F.col("all") / SIDE).cast("int")})

    def dealt(of: DataFrame, own: str, other: str, first: bool) -> DataFrame:
        place = F.pmod("hash", F.col(f"{own}s")).cast("int").alias(own)
        return of.select("token", place, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other), F.lit(first).alias("first"), "node", "n", "level", "l", "root", "main", "brief", "firsts")

    both = dealt(rows.where("root <> main"), "up", "down", True).unionByName(dealt(rows, "down", "up", False))

    def compare(batches):
        for group in _groups(batches, ["token", "up", "down"]):
            token, first = group.column("token")[0].as_py(), np.asarray(group.column("first"))
            left, right = (_side(group.filter(pa.array(side))) for side in (first, ~first))
            for begin in range(0, len(left["node"]), 64):
                some = {name: column[begin : begin + 64, None] for name, column in left.items() if column.ndim == 1}
                asked = np.minimum(some["l"], right["l"])
                apart = (some["root"] != right["root"]) & ((right["root"] == right["main"]) | (some["node"] < right["node"]))
                apart &= (some["level"] <= asked) & (right["level"] <= asked)
                apart &= np.minimum(some["n"], right["n"]) * 100 >= np.maximum(some["n"], right["n"]) * percent
                x, y = np.nonzero(apart)
                for at in range(0, len(x), 1 << 14):  # 8 MB of buckets at a time
                    i, j = x[at : at + (1 << 14)] + begin, y[at : at + (1 << 14)]
                    gone = left["brief"][i] - right["brief"][j]  # counts of one that the other lacks, at least
                    most = np.minimum(left["n"][i] - np.maximum(gone, 0).sum(1, dtype=np.int64), right["n"][j] + np.minimum(gone, 0).sum(1, dtype=np.int64))
                    kept = 100 * most >= percent * (left["n"][i] + right["n"][j] - most)
                    i, j = i[kept], j[kept]
                    least = np.minimum(left["l"][i], right["l"][j])
                    own = left["firsts"][i]
                    common = ((own[:, :, None] == right["firsts"][j][:, None, :]) & left["known"][i][:, :, None] & right["known"][j][:, None, :]).any(2)
                    met = common.sum(1)
                    here = np.where(common, own, np.iinfo(np.int64).max).min(1) == token
                    met = np.where(met < least, 1, np.where(here, met, 0))
                    i, j, least, met = i[met > 0], j[met > 0], least[met > 0], met[met > 0]
                    a, b = left["node"][i], right["node"][j]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(least, pa.int8()), pa.array(met, pa.int32())], ["a", "b", "asked", "met"])

    return both.repartition("token", "up", "down").sortWithinPartitions("token", "up", "down").mapInArrow(compare, "a bigint, b bigint, asked byte, met int")


def _side(rows: pa.Table) -> dict[str, np.ndarray]:
    out = {name: np.asarray(rows.column(name)).astype(np.int64) for name in ("node", "n", "level", "l", "root", "main")}
    packed = np.frombuffer(b"".join(rows.column("brief").to_pylist()), np.uint8).reshape(-1, BUCKETS // 2)
    out["brief"] = np.stack([packed & NIBBLE, packed >> 4], 2).reshape(-1, BUCKETS).astype(np.int8)
    firsts = [np.frombuffer(f or b"", np.int64) for f in rows.column("firsts").to_pylist()]
    out["known"] = np.arange(FIRST) < np.array([len(f) for f in firsts], np.int64)[:, None]
    out["firsts"] = np.zeros((len(firsts), FIRST), np.int64)
    out["firsts"][out["known"]] = np.concatenate([np.zeros(0, np.int64), *firsts])
    return out


def _may_link(x: np.ndarray, y: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with these signatures, of ``total`` shingles together, may be similar enough. A full bucket says nothing."""
    most = np.minimum(x, y).sum(1, dtype=np.int64)
    return (100 * most >= percent * (total - most)) | (x == FULL).any(1) | (y == FULL).any(1)
