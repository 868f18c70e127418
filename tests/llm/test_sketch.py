"""What the similarity join counts shingles with, and what its tasks hold while they do."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard, shingles


class _Frame:
    """Stands in for a frame and keeps the function of its tasks."""

    def __init__(self, session):
        self.sparkSession = session

    def select(self, *columns):
        return self

    def mapInArrow(self, of, shape):
        self.of = of
        return self


def _batch(texts):
    keys = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_arrays([keys, keys, pa.array(texts)], ["key", "row_id", "text"])


def _texts(n, words, seed):
    random = np.random.default_rng(seed)
    return [" ".join(f"w{x:06d}" for x in random.integers(0, 10**6, words)) for _ in range(n)]


@pytest.fixture
def members(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "written", lambda df, label: df)
    return jaccard._members(_Frame(spark), 3).of


def _peak(of, batch):
    """Most megabytes that a task held at once."""
    shingles._kept_powers.cache_clear()
    tracemalloc.start()
    try:
        for _ in of([batch]):
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_tasks_hold_little_besides_the_counters(spark, members):
    batch = _batch(_texts(2000, 256, 1))
    assert _peak(members, batch) < 48
    sketch = np.random.default_rng(2).poisson(3, 1 << jaccard.SKETCH_BITS).astype(np.uint32)
    assert _peak(jaccard._postings(_Frame(spark), 3, 90, sketch).of, batch) < 32


def test_counters_handed_on_early_add_up(members, monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTED", 3)
    texts = [*_texts(4, 20, 3), *_texts(4, 20, 3), "", None]
    rows = pa.Table.from_batches(list(members([_batch(texts)]))).to_pylist()
    total = np.zeros((jaccard.SKETCH_PARTS, (1 << jaccard.SKETCH_BITS) // jaccard.SKETCH_PARTS), np.int64)
    for r in rows:
        if r["part"] is not None:
            total[r["part"]] += np.frombuffer(pa.decompress(r["counters"], total[0].size * 4, "zstd", asbytes=True), np.uint32)
    plain = np.zeros(total.size, np.int64)
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        words = shingles.word_hashes(raw, np.array([0, len(raw)]), fold=True)[0]
        plain[np.unique(jaccard._cells(shingles.shingle_set(words, 3)))] += 1
    assert sum(r["part"] is None for r in rows) == len(texts) and (total.reshape(-1) == plain).all()


def test_codes_keep_the_order_of_the_octaves():
    counters = np.concatenate([np.arange(5000), np.random.default_rng(4).integers(0, jaccard.MOST, 5000), [jaccard.MOST]]).astype(np.uint32)
    for noise, unit in ((2.0, 2.0), (37.5, 6.4), (900.0, 120.0)):
        codes, above = jaccard._codes(counters, noise, unit), np.maximum(0, counters - noise)
        assert codes.dtype == np.uint8
        assert (-(-codes.astype(int) // jaccard.STEPS) == np.ceil(np.log2(1 + above / unit))).all()
        assert np.allclose(unit * (np.exp2(codes / jaccard.STEPS) - 1) + unit, above + unit, rtol=0.1)
