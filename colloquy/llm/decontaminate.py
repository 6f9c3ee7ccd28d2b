"""Operator 2: benchmark decontamination by counted seeds and local alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 3  # shorter items are not searched
SEED_GAP = 2  # a pair of neighbouring item words is a seed up to this distance in the text
BLOCK_WORDS = 1_000_000  # benchmark words sent to the workers at a time
MATCH, MISMATCH, GAP = 2, -1, -1
LEAK = 0.5  # share of the best possible score from which an item counts as leaked

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local score and the (item, text) positions where it ends.

    One row of the matrix per item word. Gaps cost the same per word, so a gap
    along the text is a running maximum over the row.
    """
    slope = -GAP * np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, dtype=np.int64)
    best, at_item, at_text = 0, -1, -1
    for i, word in enumerate(item):
        step = np.where(text == word, MATCH, MISMATCH)
        new = np.maximum(row + GAP, 0)
        np.maximum(new[1:], row[:-1] + step, out=new[1:])
        row = np.maximum.accumulate(new + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, at_item, at_text = int(row[top]), i, top - 1
    return best, at_item, at_text


@dataclass
class Items:
    """A bounded block of benchmark items as numbers, with their seeds."""

    ids: list
    words: list[np.ndarray]
    sizes: np.ndarray
    vocabulary: dict[str, int]
    grams: np.ndarray  # sorted codes of the word pairs
    first: np.ndarray  # where the items of each pair begin in ``owner``
    owner: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]]) -> Items:
        """Items of fewer than ``MIN_WORDS`` words are left out."""
        vocabulary: dict[str, int] = {}
        ids, words = [], []
        for item, text in rows:
            found = words_of(text)
            if len(found) >= MIN_WORDS:
                ids.append(item)
                words.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in found], dtype=np.int64))
        base, pairs = len(vocabulary) + 1, [np.empty((2, 0), dtype=np.int64)]
        for number, own in enumerate(words):
            codes = [own[:-1] * base + own[1:]]
            if len(own) == MIN_WORDS:  # its middle word may be the one that is edited
                codes.append(own[:1] * base + own[2:])
            codes = np.unique(np.concatenate(codes))
            pairs.append(np.stack([codes, np.full(len(codes), number)]))
        code, owner = np.concatenate(pairs, axis=1)
        order = np.argsort(code, kind="stable")
        grams, first = np.unique(code[order], return_index=True)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        return cls(ids, words, sizes, vocabulary, grams, np.append(first, len(code)), owner[order])

    def hits(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A text as word numbers (0: in no item), and position and item of every seed in it, without repeats."""
        get = self.vocabulary.get
        ids = np.array([get(w, 0) for w in words_of(text)], dtype=np.int64)
        ats, grams = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for gap in range(1, SEED_GAP + 1):
            at = np.flatnonzero((ids[:-gap] > 0) & (ids[gap:] > 0)) if len(self.grams) else ats[0]
            codes = ids[at] * (len(self.vocabulary) + 1) + ids[at + gap]
            gram = np.searchsorted(self.grams, codes)
            same = self.grams[np.minimum(gram, len(self.grams) - 1)] == codes if len(at) else np.empty(0, bool)
            ats.append(at[same])
            grams.append(gram[same])
        at, gram = np.concatenate(ats), np.concatenate(grams)
        times = self.first[gram + 1] - self.first[gram]
        skipped = np.repeat(self.first[gram] - np.cumsum(times) + times, times)
        number = self.owner[skipped + np.arange(times.sum())]
        number, at = np.divmod(np.unique(number * (len(ids) + 1) + np.repeat(at, times)), len(ids) + 1)
        return ids, at, number

    def leaks(self, text: str | None, least: float) -> list[tuple[int, float, int, int]]:
        """Item number, score, first and last word of the best passage of every leaked item.

        Only stretches with enough seeds for the score are aligned; none else can
        reach it. Of L item words an alignment of score S = 2 L ``least`` or more
        matches M and edits X, with 2 M - X >= S. Of the M - 1 steps between matches
        those that are no seed (no neighbours in the item, or over ``SEED_GAP`` apart)
        leave out an item word, of which there are L - M, or cost two edits; so at
        least (2 S - L) / 3 - 1 steps are seeds, and the passage is no longer than
        M + X <= 3 L - S words.
        """
        ids, at, number = self.hits(text)
        needed = least * MATCH * self.sizes
        seeds = np.maximum(np.ceil((2 * needed - self.sizes) / 3 - 1 - 1e-9), 1).astype(np.int64)[number]
        reach = np.ceil(3 * self.sizes - needed + 1e-9).astype(np.int64)[number]
        last = np.arange(len(at)) + seeds - 1
        inside = last < len(at)
        last = np.where(inside, last, 0)
        start = np.flatnonzero(inside & (number[last] == number) & (at[last] - at <= reach)) if len(at) else at
        windows: dict[int, list[tuple[int, int]]] = {}
        for k in start.tolist():
            low, high = max(0, int(at[last[k]] - reach[k])), min(len(ids), int(at[k] + reach[k]) + 1)
            windows.setdefault(int(number[k]), []).append((low, high))
        found = []
        for i_item, spans in windows.items():
            item, enough = self.words[i_item], needed[i_item] - 1e-9
            best = (0, 0, 0)
            for begin, end in _merged(spans):
                window = ids[begin:end]
                # No alignment can match more words than the two have in common.
                if MATCH * min(np.isin(window, item).sum(), np.isin(item, window).sum()) < enough:
                    continue
                score, i, j = smith_waterman(item, window)
                if score >= enough and score > best[0]:
                    back, _, k = smith_waterman(item[i::-1], window[j::-1])
                    best = (score, begin + j - k, begin + j)
            if best[0]:
                found.append((i_item, best[0] / (MATCH * len(item)), best[1], best[2]))
        return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The benchmark in blocks of about ``block_words`` words, each with its seeds."""
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        block_items = Items.of([tuple(r) for r in items.filter(block == number).orderBy("item_id", "text").collect()])
        if block_items.ids:
            yield block_items


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAK, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(doc_id, item_id, score, first_word, last_word)`` for every leaked item of every document.

    Seeds are the pairs of neighbouring words of an item, side by side in the text
    or one word apart. Where there are enough of them for the score (see
    ``Items.leaks``), the text is aligned with the item (Smith-Waterman over words;
    match 2, mismatch and gap -1). With ``least`` at 0.5 or more no alignment of that
    score has fewer, so none is missed. The score is the share of the item's best
    possible score, the words are those of the best passage. The texts are read once
    per block of the benchmark and never shuffled; what is sent to the workers is
    one block.

    Null texts leak nothing; items of fewer than three words are not searched. Null
    ids and repeated rows or items are returned like others. Empty tables: no rows.
    Other columns are ignored.
    """
    schema = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark, block_words):

        def align(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "item_id", "score", "first_word", "last_word"]
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            for batch in batches:
                rows = [
                    (doc, items.ids[number], *rest)
                    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))
                    for number, *rest in items.leaks(text.as_py(), least)
                ]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
        out = out.union(texts.mapInArrow(align, schema))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAK) -> DataFrame:
    """``docs`` without the documents that hold an item; every column is kept.

    The decision is made where a text is read, so nothing is joined or shuffled.
    """
    for items in item_blocks(benchmark):

        def keep(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text"))
                yield batch.filter(pa.array([not items.leaks(t.as_py(), least) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
