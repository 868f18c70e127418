"""Byte-level BPE with the tokenizers library over Arrow batches, from a file of ranks.

A text is split by a pattern; the bytes of each piece are written as one printable character each, and merged by rank. The library wants
merges, so every way to split a token into two tokens becomes a merge of that token's rank: this makes the result the same as merging
whichever neighbours have the lowest rank together.
"""

from __future__ import annotations

import base64
import os
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from tidemark.llm.arrow import text_pieces

# Characters of distinct pieces that a worker remembers the ids of.
REMEMBERED = 2 << 20


def byte_characters() -> list[str]:
    """The printable character for each byte: its own where it has one, else the next free one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in own else free))
        free += b not in own
    return out


def read_ranks(blob: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, blob.splitlines())}


class ByteTable:
    """The bytes of each id of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of a run of ids, and where in them each token ends."""
        begin = self.starts[ids]
        lengths = self.starts[ids + 1] - begin
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - lengths), lengths)
        return self.bytes[places], ends


class Encoder:
    """The tokenizer of one vocabulary, and the ids of the pieces met so far, end to end."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        chars = byte_characters()

        def shown(token: bytes) -> str:
            return "".join(chars[b] for b in token)

        by_rank = sorted(ranks.items(), key=lambda item: item[1])
        merges = [(shown(t[:i]), shown(t[i:])) for t, _ in by_rank for i in range(len(t) - 1, 0, -1) if t[:i] in ranks and t[i:] in ranks]
        self.tokenizer = Tokenizer(models.BPE(vocab={shown(t): r for t, r in by_rank}, merges=merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        self.forget()

    def forget(self):
        self.known: dict[str, int] = {}
        self.held = 0
        self.ids, self.begins, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text. Each distinct piece is encoded once and remembered."""
        if self.held > REMEMBERED:
            self.forget()
        pieces = [self.pattern.findall(t) for t in texts]
        fresh = list({p for found in pieces for p in found} - self.known.keys())
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.held += sum(map(len, fresh))
            new = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
            counts = np.fromiter(map(len, new), np.int64, len(new))
            self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, np.fromiter((i for ids in new for i in ids), np.int32, int(counts.sum()))])
        out = []
        for found in pieces:
            places = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
            counts = self.counts[places]
            ends = np.cumsum(counts)
            out.append(self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begins[places] - (ends - counts), counts)])
        return out


@cache
def byte_table(blob: bytes) -> ByteTable:
    return ByteTable(read_ranks(blob))


@cache
def codec(blob: bytes, pattern: str) -> Encoder:
    return Encoder(read_ranks(blob), pattern)


def _shared(docs: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", offsets: bool = False, decoded: bool = False, keep: list[str] | None = None) -> DataFrame:
    """All rows with ``ids``, the token ids of the whole text, beside the columns ``keep``, by default all; columns of the added names are replaced.

    ``vocabulary`` is the path of the file of ranks; its size is that of the vocabulary. With ``offsets``, ``starts`` and ``ends`` are added: the code points of the text that
    each token lies in, where a token that holds a part of a character covers that character. With ``decoded``, the bytes that the
    ids decode to are added, as ``decode`` would in a pass of its own. A NULL or empty text has no ids. No
    special token is ever made, whatever the text holds. The text is sent to the workers once, and back only if it is kept.
    """
    shared = _shared(docs, vocabulary)
    added: dict[str, DataType] = {name: ArrayType(IntegerType()) for name in (("ids", "starts", "ends") if offsets else ("ids",))}
    if decoded:
        added["decoded"] = BinaryType()
    wanted = [c for c in (docs.columns if keep is None else keep) if c not in added]
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in wanted if c != text])
    rows = docs.select(row.alias("row"), F.col(f"`{text}`").alias("used"))
    sent_back = ["used"] if text in wanted else []
    shape = StructType([rows.schema["row"], *[rows.schema[c] for c in sent_back], *[StructField(name, kind) for name, kind in added.items()]])

    def run(batches):
        own = codec(shared.value, pattern)
        back = byte_table(shared.value) if offsets or decoded else None
        for batch in batches:
            for piece, _, _ in text_pieces(batch, "used"):
                texts = piece.column("used").fill_null("").to_pylist()
                ids = own.encode(texts)
                out = [piece.column("row"), *[piece.column(c) for c in sent_back], _lists(ids)]
                found = [back.decode(i) for i in ids] if back else []
                if offsets:
                    spans = [_spans(t, ends) for t, (_, ends) in zip(texts, found, strict=True)]
                    out += [_lists([s for s, _ in spans]), _lists([e for _, e in spans])]
                if decoded:
                    out.append(pa.array([raw.tobytes() for raw, _ in found], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, ["row", *sent_back, *added])

    made = rows.mapInArrow(run, shape)
    return made.select(*[F.col("used").alias(c) if c == text else F.col(f"row.`{c}`") for c in wanted], *added)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)))


def _spans(text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points that each token covers, from the bytes at which the tokens end."""
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character that each byte belongs to
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    return character[starts], character[ends - 1] + 1


def decode(tokens: DataFrame, vocabulary: str, pattern: str | None = None, ids: str = "ids") -> DataFrame:
    """All rows and columns with ``decoded``, the bytes of the ids.

    Bytes rather than text, since a run of ids may begin or end inside a character; ids of a whole text give its UTF-8 bytes. NULL ids give no
    bytes. An id that the vocabulary does not have raises an error. The pattern is taken
    so that both directions have the same arguments; decoding needs the byte table alone.
    """
    shared = _shared(tokens, vocabulary)
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in tokens.columns if c != "decoded"])
    rows = tokens.select(row.alias("row"), F.col(f"`{ids}`").alias("used"))
    shape = StructType([rows.schema["row"], StructField("decoded", BinaryType())])

    def run(batches):
        own = byte_table(shared.value)
        for batch in batches:
            for begin in range(0, len(batch), 256):
                part = batch.slice(begin, 256)
                found = [own.decode(np.asarray(i.values if i.is_valid else [], np.int64))[0].tobytes() for i in part.column("used")]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found, pa.binary())], ["row", "decoded"])

    made = rows.mapInArrow(run, shape)
    return made.select(*[F.col(f"row.`{c}`") for c in tokens.columns if c != "decoded"], "decoded")
