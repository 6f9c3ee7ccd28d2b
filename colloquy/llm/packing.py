"""Operator 10: sum-of-squares packing of tokenized documents into sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import stored

CONTEXT = 4096
END_ID = 1
SHARD_PIECES = 32_768  # pieces packed together in one task

# Fixed value: the pre-tokenizer pattern of the vocabulary file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of a few whole texts at a time, as little-endian unsigned 32-bit bytes.

    Equal to ``tokenizers`` on the text. White space always parts words, so every
    chunk between spaces is encoded once and then taken from a cache of at most
    ``cached`` chunks (or those of one call). Chunks are merged with the vocabulary's own ranks; the mark
    for a word's end becomes one more byte, so that the two libraries agree. Texts in
    which chunks don't stand alone (special tokens, a capital sigma, control
    characters that count as spaces or as the mark, not NFC) and chunks beyond the
    Latin letters go to ``tokenizers`` as they are.
    """

    END = "\x01"
    APART = ("<|", "Σ", "\x01", "\x1c", "\x1d", "\x1e", "\x1f")

    def __init__(self, path: str, cached: int = 400_000):
        import json
        import unicodedata

        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        byte_of = {letter: b for b, letter in _byte_letters().items()}
        mark = self.END.encode()
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        ranks = {}
        for token, rank in vocabulary.items():
            bare = token.removesuffix("</w>")
            ranks[bytes(byte_of[c] for c in bare) + (mark if bare != token else b"")] = rank
        merger = tiktoken.Encoding(
            "words", pat_str=r" |[^ \x01]*\x01", mergeable_ranks=ranks, special_tokens={}
        )
        self.merge, self.space = merger.encode_ordinary, ranks[b" "]
        self.words = regex.compile(WORDS)
        self.composed = unicodedata.is_normalized
        self.cached, self.cache = cached, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        chunked = [None if self._apart(text) else text.lower().split() for text in texts]
        fresh = set().union(*(c for c in chunked if c)).difference(self.cache)
        if len(self.cache) + len(fresh) > self.cached:
            self.cache.clear()
            fresh = set().union(*(c for c in chunked if c))
        self._learn(list(fresh))
        ids_of = self.cache.__getitem__
        return [
            self._whole(text) if chunks is None else b"".join(map(ids_of, chunks))
            for text, chunks in zip(texts, chunked)
        ]

    def _apart(self, text: str) -> bool:
        return any(mark in text for mark in self.APART) or not self.composed("NFC", text)

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, chunks: list[str]) -> None:
        latin = [c for c in chunks if c.isascii() or max(c) < "\u0250"]
        self.cache.update((c, self._whole(c)) for c in set(chunks).difference(latin))
        marked = self.words.sub(r"\g<0>\x01", " ".join(latin))
        ids = np.array(self.merge(marked), dtype="<u4")
        ends = [*(4 * np.flatnonzero(ids == self.space)).tolist(), 4 * len(ids)]
        packed = ids.tobytes()
        starts = [0, *(e + 4 for e in ends)]
        self.cache.update((c, packed[s:e]) for c, s, e in zip(latin, starts, ends))


PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("deal", pa.int64()),
    ]
)


def tokenized_pieces(docs: DataFrame, vocabulary: str, context: int = CONTEXT, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, deal``.

    A document is the ids of its text and one end id; a null text is empty.
    Only documents over ``context`` tokens are cut. ``deal`` is a number by
    which pieces are dealt to packing tasks evenly, also where ids repeat.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder(vocabulary)
        end = np.array([end_id], dtype="<u4").tobytes()
        deal = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 64):
                few = batch.slice(at, 64)
                texts = [text or "" for text in few.column(1).to_pylist()]
                for doc, ids in zip(few.column(0).to_pylist(), encoder(texts)):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * context)):
                        part = ids[start : start + 4 * context]
                        rows.append((doc, piece, start // 4, len(part) // 4, zlib.crc32(part), deal))
                        deal += 1
            columns = list(zip(*rows)) or [()] * len(PIECES)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, deal bigint"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(encode, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item, items taken from the longest to the shortest.

    An item goes where the sum over gaps of the squared number of open bins with
    that gap becomes smallest; full bins and the empty new bin do not count. Ties
    go to the smallest gap, so to an open bin rather than a new one.
    """
    open_bins = np.zeros(capacity + 1, dtype=np.int64)
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        # Change of the sum when a bin of gap g moves to gap g - size.
        gaps = np.flatnonzero(open_bins[size:capacity]) + size
        best = capacity
        if len(gaps):
            change = 2 * (open_bins[gaps - size] - open_bins[gaps]) + 2
            change[gaps == size] -= 1
            at = int(np.argmin(change))
            new = (2 * open_bins[capacity - size] + 1) if size < capacity else 0
            if change[at] <= new:
                best = int(gaps[at])
        if best == capacity:
            chosen, made = made, made + 1
        else:
            chosen = by_gap[best].pop()
            open_bins[best] -= 1
        bins[i], offsets[i] = chosen, capacity - best
        if best > size:
            by_gap[best - size].append(chosen)
            open_bins[best - size] += 1
    return bins, offsets


def pack(docs: DataFrame, vocabulary: str, context: int = CONTEXT, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pack every document into sequences of at most ``context`` tokens.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. Only lengths are shuffled. The number of packing tasks follows the
    number of pieces, so a task holds about ``shard_pieces`` narrow rows however
    large the corpus; each leaves a few sequences unfilled.

    Null text: one end token. Null ids and repeated rows: packed like any other.
    No rows: no rows. Other columns are ignored.
    """
    pieces = stored(tokenized_pieces(docs, vocabulary, context), "pieces")
    shards = max(1, -(-pieces.count() // shard_pieces))

    def place(shard: pd.DataFrame) -> pd.DataFrame:
        # Rows come in any order after a shuffle; a fixed one makes retries equal.
        shard = shard.sort_values("deal", ignore_index=True)
        bins, offsets = sum_of_squares(shard["length"].to_numpy(), context)
        first = int(shard["shard"].iloc[0]) << 32
        out = shard.drop(columns=["deal", "shard"])
        return out.assign(sequence_id=bins + first, offset=offsets)

    schema = (
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("deal"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(place, schema)
