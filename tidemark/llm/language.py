"""Language identification with error-correcting output codes.

Every language has a codeword. For every bit of the codewords, a binary classifier over hashed byte n-grams predicts that bit from a
text; the language whose codeword is nearest to the predictions, under a loss weighted by how reliable each bit is for each
language, is chosen. The classifiers are naive Bayes: the log-odds of an n-gram are taken from its counts in the texts of
the languages whose bit is 1 and of those whose bit is 0. The counts cover all learning rows and are summed by Spark; only
one histogram per language, of fixed size, reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import text_pieces

# Hash buckets of n-grams of 1, 2 and 3 bytes.
BUCKETS = 1 << 13
# A model with more languages than this is refused, not cut.
MOST_LANGUAGES = 256
UNDETERMINED = "und"
# A text whose best language leads the second by less than this share of the probability is flagged.
CLEAR_LEAD = 0.2


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # buckets x bits
    reliability: np.ndarray  # languages x bits, rows sum to 1


def _letters() -> np.ndarray:
    """What a byte counts as: a letter in lower case, a byte of a longer character as it is, anything else a space."""
    table = np.full(256, 32, np.uint8)
    table[128:] = np.arange(128, 256)
    table[97:123] = table[65:91] = np.arange(97, 123)
    return table


LETTERS = _letters()


def ngram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Histogram of the n-grams of each text, texts x buckets."""
    n_texts = len(offsets) - 1
    out = np.zeros((n_texts, BUCKETS), np.float32)
    kept = LETTERS[data]
    lone = np.ones(len(kept), bool)
    lone[1:] = (kept[1:] != 32) | (kept[:-1] != 32)
    x = kept.astype(np.uint32)
    two = x * np.uint32(0x01000193)
    two[1:] ^= x[:-1] * np.uint32(0x9E3779B1)
    three = two * np.uint32(0x85EBCA6B)
    three[2:] ^= x[:-2] * np.uint32(0xC2B2AE35)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    grams = [(x * np.uint32(0x27D4EB2F) ^ np.uint32(0x5BD1E995)) >> shift, (two * np.uint32(0x165667B1)) >> shift, (three * np.uint32(0x9E3779B1)) >> shift]
    for i in range(n_texts):
        a, b = offsets[i], offsets[i + 1]
        if b == a:
            continue
        wanted = lone[a:b]
        for size, gram in enumerate(grams, 1):  # n-grams lie wholly in their text
            inside = gram[a + size - 1 : b][wanted[size - 1 :]]
            out[i] += np.bincount(inside, minlength=BUCKETS)
    return out


def codewords(n: int) -> np.ndarray:
    """A codeword of -1 and 1 per language: the exhaustive code up to six languages, beyond that random words chosen for their distance."""
    if n <= 6:
        columns = [[1 if i == 0 or i in chosen else -1 for i in range(n)] for size in range(n - 1) for chosen in combinations(range(1, n), size)]
        return np.array(columns, np.int8).T.reshape(n, -1)
    draw = np.random.default_rng(7)
    bits = 10 * int(np.ceil(np.log2(n))) + 5
    best, distance = None, -1
    for _ in range(200):
        code = draw.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code.shape[1] - code.astype(int) @ code.T) // 2 + np.eye(n, dtype=int) * bits
        if apart.min() > distance:
            best, distance = code, apart.min()
    return best


def margins(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean log-odds of each bit over the n-grams of each text; a text is as sure as its n-grams, however long it is."""
    total = np.maximum(counts.sum(1, keepdims=True), 1)
    return np.tanh(4 * (counts @ weights) / total)


def decode(found: np.ndarray, model: LanguageModel) -> np.ndarray:
    """Probability of each language: a softmin of the weighted exponential losses to the codewords."""
    loss = (model.reliability[None] * np.exp(-found[:, None, :] * model.code[None])).sum(2)
    odds = np.exp(-8 * (loss - loss.min(1, keepdims=True)))
    return odds / odds.sum(1, keepdims=True)


def learn(docs: DataFrame, learns: Column, text: str = "text", lang: str = "lang") -> LanguageModel | None:
    """Fit on the rows for which ``learns`` holds and text and language are not NULL; None if there are none.

    Two passes: one sums the histograms per language, the other counts per language how often each bit is predicted right,
    which gives the weights of the decoding. No row is left out and none reaches the driver.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where(learns & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sums = _sums(rows, lambda counts: counts, BUCKETS)
    if not sums:
        return None
    languages = tuple(sorted(sums))
    counts = np.array([sums[name] for name in languages])
    code = codewords(len(languages)) if len(languages) > 1 else np.ones((1, 1), np.int8)
    shares = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)  # each language counts alike, whatever its share of the rows
    on, off = (code == 1).astype(float), (code == -1).astype(float)
    weights = np.log((shares.T @ on) / on.sum(0)) - np.log((shares.T @ off + 1e-12) / np.maximum(off.sum(0), 1) + 1e-12 * (off.sum(0) == 0))
    weights = weights.astype(np.float32)

    def right(found_counts: np.ndarray) -> np.ndarray:
        positive = margins(found_counts, weights) > 0
        return np.hstack([positive, np.ones((len(positive), 1))])

    hits = _sums(rows, right, code.shape[1] + 1)
    tally = np.array([hits[name] for name in languages])
    ones = tally[:, :-1] / tally[:, -1:]
    accuracy = np.where(code == 1, ones, 1 - ones) + 1e-3
    return LanguageModel(languages, code.astype(np.float32), weights, (accuracy / accuracy.sum(1, keepdims=True)).astype(np.float32))


def _sums(rows: DataFrame, of, width: int) -> dict[str, np.ndarray]:
    """Per language, the sum over its texts of a vector of fixed width. Tasks add up their own rows; languages are few."""

    def partial(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece, data, offsets in text_pieces(batch, "text"):
                names = np.array(piece.column("lang").to_pylist(), object)
                for begin in range(0, len(names), 256):
                    some = slice(begin, begin + 256)
                    vectors = of(ngram_counts(data, offsets[some.start : some.stop + 1]))
                    for name in set(names[some]):
                        totals[name] = totals.get(name, 0) + vectors[names[some] == name].sum(0, dtype=np.float64)
            if len(totals) > MOST_LANGUAGES:
                raise ValueError(f"more than {MOST_LANGUAGES} languages")
        for name, vector in totals.items():
            places = np.flatnonzero(vector)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(places), pa.string()), pa.array(places, pa.int32()), pa.array(vector[places])], ["lang", "place", "amount"])

    summed = rows.mapInArrow(partial, "lang string, place int, amount double").groupBy("lang", "place").agg(F.sum("amount").alias("amount"))
    # At most MOST_LANGUAGES * width rows: one more shows that there are too many languages.
    found = summed.limit(MOST_LANGUAGES * width + 1).toPandas()
    out = {}
    for name, part in found.groupby("lang"):
        out[name] = np.zeros(width)
        out[name][part["place"]] = part["amount"]
    if len(out) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return out


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """All rows and columns, with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``; columns of these names are replaced.

    A text that is NULL or has no letter is ``und`` with score 0, and so is every text if the model is None. Repeated rows have the
    same result. The whole text counts.
    """
    added = {"lang_pred": "string", "score": "double", "ambiguous": "boolean"}
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("row"), F.col(text).alias("text"))
    shape = rows.select("row").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def predict(batches):
        for batch in batches:
            for piece, data, offsets in text_pieces(batch, "text"):
                names, scores, doubt = [], [], []
                for begin in range(0, len(piece), 256):
                    part = piece.column("text").slice(begin, 256).to_pylist()
                    lettered = [model is not None and t is not None and any(map(str.isalpha, t)) for t in part]
                    names += [UNDETERMINED] * len(part)
                    scores += [0.0] * len(part)
                    doubt += [True] * len(part)
                    if any(lettered):
                        odds = decode(margins(ngram_counts(data, offsets[begin : begin + len(part) + 1]), model.weights), model).astype(np.float64)
                        best = odds.argmax(1)
                        ordered = np.sort(odds, 1)
                        lead = ordered[:, -1] - (ordered[:, -2] if odds.shape[1] > 1 else 0)
                        for i in np.flatnonzero(lettered):
                            names[begin + i], scores[begin + i], doubt[begin + i] = model.languages[best[i]], float(ordered[i, -1]), bool(lead[i] < CLEAR_LEAD)
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubt, pa.bool_())], ["row", *added])

    return rows.mapInArrow(predict, shape).select("row.*", *added)


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether a row is kept from learning: by the CRC-32 of its key as text. NULL keys are held out as well."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(True))
