"""A quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Each text becomes a short vector of statistics. Cosines of random projections of the standardised vectors approximate a Gaussian kernel; a
ridge regression on them is fitted from its normal equations, which tasks sum up over their rows. The equations are kept apart by fold,
so the scores that the calibration is fitted on come from models that have not seen the row: leaving a fold out is a subtraction.

All labelled rows count. What reaches the driver are sums of fixed size: the moments, the equations and a histogram of scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tidemark.llm.arrow import text_pieces
from tidemark.llm.shingles import mixed, word_hashes
from tidemark.session import written

FEATURES = 256
FOLDS = 4
# Width of the Gaussian kernel in units of the square root of the number of statistics.
WIDTH = 0.7
RIDGE = 1e-3
# Scores are counted in this many bins from LOW to HIGH; a score beyond them counts in the last one.
BINS, LOW, HIGH = 4096, -0.5, 1.5
# Standardised statistics are cut to this many deviations.
FARTHEST = 6.0
# Labelled rows in a task, so that the number of partial sums grows with the rows alone.
TASK_ROWS = 50_000
SCORE, THRESHOLD = 0.5, 0.3

# Bytes of text worked on at a time; the arrays beside them take some sixty times as much.
PIECE_BYTES = 1 << 18

# Classes of bytes whose shares are statistics.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:",
    "call": b"!?",
    "quote": b"'\"()-",
    "symbol": b"#*$%&@^~=+_\\/`",
    "bracket": b"|<>[]{}",
    "space": b" \t\x0b\x0c",
    "line": b"\n\r",
}
STATISTICS = [
    *CLASSES, "wide", "log_words", "word_bytes", "word_spread", "short_words", "long_words", "distinct_words", "top_word", "twin_words", "repeated_runs",
    "capital_words", "shouted_words", "marked_words", "log_line_words", "repeated_lines",
]


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.int32)  # all else: bytes of longer characters and control bytes
    for k, members in enumerate(CLASSES.values()):
        table[list(members)] = k
    return table


CLASS_OF = _class_table()
LETTER_CLASSES = (0, 1, len(CLASSES))


def _repeated(owner: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per owner: distinct values, how often the most frequent one comes, and how many values come more than once, all their places counted."""
    if not len(values):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    first = np.ones(len(o), bool)
    first[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    begins = np.flatnonzero(first)
    counts = np.diff(np.append(begins, len(o)))
    who = o[begins]
    most = np.zeros(n)
    np.maximum.at(most, who, counts)
    return np.bincount(who, minlength=n), most, np.bincount(who, counts * (counts > 1), n)


def text_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x statistics, from texts that lie end to end. All are finite; a text without words has zeros where words are asked for."""
    n, k = len(offsets) - 1, len(CLASSES) + 1
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    kinds = CLASS_OF[data]
    shares = np.bincount(owner * k + kinds, minlength=n * k).reshape(n, k) / np.maximum(sizes, 1)[:, None]
    hashes, starts, ends, cuts = word_hashes(data, offsets)
    words = np.diff(cuts)
    of_word = np.repeat(np.arange(n), words)
    per_word = 1 / np.maximum(words, 1)
    lengths = (ends - starts).astype(float)

    def share(flags: np.ndarray, who: np.ndarray = of_word) -> np.ndarray:
        return np.bincount(who, flags, n)[:n] * per_word

    mean = share(lengths)
    spread = np.sqrt(np.maximum(share(lengths**2) - mean**2, 0))
    distinct, most, _ = _repeated(of_word, hashes, n)
    same_text = of_word[1:] == of_word[:-1]
    twins = np.zeros(len(hashes))
    twins[1:] = same_text & (hashes[1:] == hashes[:-1])
    runs = len(hashes) - 2
    inside = of_word[2:] == of_word[:-2] if runs > 0 else np.zeros(0, bool)
    triples = mixed(mixed(hashes[:-2] ^ np.uint64(3)) * np.uint64(5) + hashes[1:-1] * np.uint64(7) + hashes[2:])[inside] if runs > 0 else hashes[:0]
    _, _, repeated = _repeated(of_word[2:][inside] if runs > 0 else of_word[:0], triples, n)
    first, last = (kinds[starts], kinds[ends - 1]) if len(starts) else (kinds[:0], kinds[:0])
    second = kinds[np.minimum(starts + 1, np.maximum(ends - 1, 0))] if len(starts) else kinds[:0]
    capital, shouted = first == 1, (first == 1) & (second == 1) & (lengths > 1)
    marked = ~np.isin(last, [*LETTER_CLASSES, 2, 3])
    # Lines by the hash of their words, numbered over all texts; those without words do not count.
    line_of = np.cumsum(data == 10)[starts] if len(starts) else np.zeros(0, np.int64)
    new_line = np.ones(len(starts), bool)
    new_line[1:] = (line_of[1:] != line_of[:-1]) | ~same_text
    line_starts = np.flatnonzero(new_line)
    line_hash = np.add.reduceat(mixed(hashes + (np.arange(len(hashes), dtype=np.uint64) - np.repeat(line_starts, np.diff(np.append(line_starts, len(hashes)))).astype(np.uint64)) * np.uint64(11)), line_starts) if len(line_starts) else hashes[:0]
    line_owner = of_word[line_starts]
    lines = np.bincount(line_owner, minlength=n)
    fresh, _, _ = _repeated(line_owner, line_hash, n)
    columns = [
        *shares.T, np.log1p(words), mean, spread, share(lengths <= 2), share(lengths >= 12), distinct * per_word, most * per_word, share(twins), repeated * per_word,
        share(capital), share(shouted), share(marked), np.log1p(words / np.maximum(lines, 1)), (lines - fresh) / np.maximum(lines, 1),
    ]
    return np.column_stack(columns)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, with ``stats``, the statistics of each whole text in the order of ``STATISTICS``; a column of that name is replaced.

    A NULL text counts as empty. Equal texts have equal statistics.
    """
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("stats", text)])
    rows = docs.select(row.alias("row"), F.col(f"`{text}`").alias("used"))
    shape = rows.select("row").schema.add("stats", ArrayType(DoubleType()))

    def run(batches):
        for batch in batches:
            for piece, data, offsets in text_pieces(batch, "used", PIECE_BYTES):
                found = text_statistics(data, offsets)
                places = pa.array(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.ListArray.from_arrays(places, pa.array(found.ravel()))], ["row", "stats"])

    made = rows.mapInArrow(run, shape)
    return made.select(*[F.col(f"row.`{c}`") for c in rows.schema["row"].dataType.names if c != "_"], "stats")


@dataclass(frozen=True)
class QualityModel:
    """Standardisation, random projection, ridge weights, and the calibration as points of a rising line."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray


def _projection(width: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11)
    return draw.normal(size=(width, FEATURES)) / (WIDTH * np.sqrt(width)), draw.uniform(0, 2 * np.pi, FEATURES)


def features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of statistics, and a constant."""
    directions, phases = _projection(stats.shape[1])
    x = np.clip((stats - mean) / scale, -FARTHEST, FARTHEST)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ directions + phases), np.ones((len(x), 1))])


def _vectors(batch: pa.RecordBatch, most: int = 4096):
    """Slices of a batch with their statistics as a matrix."""
    for begin in range(0, len(batch), most):
        part = batch.slice(begin, most)
        stats = part.column("stats")
        yield part, stats.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _summed(rows: DataFrame, of) -> np.ndarray:
    """Sum over all rows of what ``of(stats, label, fold)`` gives for a slice of them: a vector of fixed length. Zeros are not sent."""

    def partial(batches):
        total = None
        for batch in batches:
            for part, stats in _vectors(batch):
                more = of(stats, np.asarray(part.column("label")).astype(float), np.asarray(part.column("fold")))
                total = more if total is None else total + more
        if total is not None:
            places = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(total[places])], ["place", "amount"])

    sums = rows.mapInArrow(partial, "place int, amount double").groupBy("place").agg(F.sum("amount").alias("amount")).toPandas()
    out = np.zeros(int(sums["place"].max()) + 1 if len(sums) else 0)
    out[sums["place"]] = sums["amount"]
    return out


def _padded(total: np.ndarray, *shape: int) -> np.ndarray:
    return np.pad(total, (0, int(np.prod(shape)) - len(total))).reshape(shape)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``values`` by weighted squares: neighbours that fall are pooled."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, k = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + v * w) / (last[1] + w)
            last[1] += w
            last[2] += k
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def learn(labelled: DataFrame, label: str = "quality", stats: str = "stats") -> QualityModel | None:
    """Fit on all rows of ``labelled`` whose label is not NULL (1 good, any other number bad); None if there are none.

    Three passes over the narrow rows sum the moments, the equations per fold, and the histogram of left-out scores. Rows with equal
    statistics share a fold. Repeated rows count as often as they come.
    """
    given = labelled.where(F.col(label).isNotNull()).select(F.col(stats).alias("stats"), (F.col(label) == 1).cast("int").alias("label"))
    rows = written(given.withColumn("fold", F.pmod(F.xxhash64("stats"), F.lit(FOLDS)).cast("int")), "labelled")
    n = rows.count()
    if n == 0:
        return None
    rows = rows.repartition(1 + n // TASK_ROWS)
    width = len(STATISTICS)
    moments = _padded(_summed(rows, lambda x, y, _: np.concatenate([x.sum(0), (x**2).sum(0)])), 2, width)
    mean = moments[0] / n
    scale = np.sqrt(np.maximum(moments[1] / n - mean**2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)

    size = FEATURES + 1
    upper = np.triu_indices(size)

    def equations(x, y, fold):
        z = features(x, mean, scale)
        out = []
        for f in range(FOLDS):
            own = fold == f
            out += [(z[own].T @ z[own])[upper], z[own].T @ y[own]]
        return np.concatenate(out)

    sums = _padded(_summed(rows, equations), FOLDS, len(upper[0]) + size)

    def solved(total: np.ndarray) -> np.ndarray:
        gram = np.zeros((size, size))
        gram[upper] = total[: len(upper[0])]
        gram = gram + np.triu(gram, 1).T
        ridge = np.full(size, RIDGE * max(gram[-1, -1], 1.0))
        ridge[-1] = 1e-9  # the constant is free
        return np.linalg.solve(gram + np.diag(ridge), total[len(upper[0]) :])

    whole = sums.sum(0)
    left_out = np.array([solved(whole - sums[f]) for f in range(FOLDS)])

    def histogram(x, y, fold):
        raw = (features(x, mean, scale) * left_out[fold]).sum(1)
        bins = np.clip(((raw - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(bins, minlength=BINS), np.bincount(bins, y, BINS)])

    counts, good = _padded(_summed(rows, histogram), 2, BINS)
    held = np.flatnonzero(counts)
    pooled = isotonic(good[held] / counts[held], counts[held])
    # Half a row more in each pool, good by the share of all, keeps small pools from being certain.
    _, pool = np.unique(pooled, return_inverse=True)
    size_of = np.bincount(pool, counts[held])[pool]
    prior = good.sum() / counts.sum()
    level = isotonic((pooled * size_of + prior * 0.5) / (size_of + 0.5), counts[held])
    centres = LOW + (held + 0.5) * (HIGH - LOW) / BINS
    return QualityModel(mean, scale, solved(whole), centres, np.clip(level, 0, 1))


def score(rows: DataFrame, model: QualityModel | None, stats: str = "stats") -> DataFrame:
    """All columns but the statistics, with ``score`` (0 to 1, higher: good likelier) and ``predicted``; columns of these names are replaced.

    Without a model every score is 0.5.
    """
    kept = [c for c in rows.columns if c not in ("score", "predicted", stats)]
    packed = rows.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(stats).alias("stats"))

    def run(batches):
        for batch in batches:
            for part, x in _vectors(batch):
                found = np.full(len(part), SCORE) if model is None else np.interp(features(x, model.mean, model.scale) @ model.weights, model.raw, model.calibrated)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found)], ["row", "score"])

    scored = packed.mapInArrow(run, packed.select("row").schema.add("score", "double"))
    return scored.select(*[F.col(f"row.`{c}`") for c in kept], "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: by the CRC-32 of its key as text. NULL keys are held out as well."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(True))
