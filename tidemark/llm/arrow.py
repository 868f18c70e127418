"""Reading Arrow batches inside tasks, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that numpy works on at a time. One text is never cut, so a longer one makes a longer piece.
PIECE_BYTES = 1 << 20


def text_pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with the UTF-8 bytes of their texts, end to end, and the offsets of the texts. NULL counts as empty."""
    texts = batch.column(column).fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
        yield batch.slice(first, last - first), data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last
