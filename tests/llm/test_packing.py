import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from colloquy.llm import packing as p
from colloquy.llm.common import table
from colloquy.llm.queries import word_vocabulary
from tests.conftest import SF_DIR

TEXTS = [
    "I'm <|endoftext|> don't 123 ÀÉ", "ΑΣ Σ x\x1cy É é 日本語 don'tx ''s 'S", "½ ²³ ß ǅ İ İx ſ K", "", " \n", "a" * 3000, "x\x01y <|", "e\u0301 E\u0301",
    "ᾳ ŉ ɐ ʼn ﬁ A\u00a0B\u2003C\u0085D", "emoji 👩‍👩‍👧 x", "'s's''re 1'll", "\ufeffx \u200bx",
]


def ids(texts):
    whole = Tokenizer.from_file(word_vocabulary())
    return [np.array(e.ids, dtype="<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_tokenizer(documents):
    texts = TEXTS + [d["text"] or "" for d in documents]
    for cached in (100, 400_000):
        encoder = p.Encoder(word_vocabulary(), cached)
        assert encoder(texts) == ids(texts)
        assert encoder(texts[::-1]) == ids(texts)[::-1]


def slow_squares(lengths, capacity):
    """Sum-of-squares packing, trying every bin."""
    gaps, bins = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        def total(changed):
            counts = {}
            for g in changed:
                if 0 < g < capacity:
                    counts[g] = counts.get(g, 0) + 1
            return sum(n * n for n in counts.values())

        options = [(total(gaps[:b] + [g - lengths[i]] + gaps[b + 1 :]), g, b) for b, g in enumerate(gaps) if g >= lengths[i]]
        options.append((total(gaps + [capacity - lengths[i]]), capacity, len(gaps)))
        _, gap, b = min(options, key=lambda o: (o[0], o[1], -o[2]))
        if b == len(gaps):
            gaps.append(capacity)
        bins[i] = (gaps[b], b)
        gaps[b] -= lengths[i]
    return gaps


@pytest.mark.parametrize("seed", range(5))
def test_placement_equals_brute_force(seed):
    lengths = np.random.default_rng(seed).integers(1, 31, 60)
    bins, offsets = p.sum_of_squares(lengths, 30)
    used = np.bincount(bins, weights=lengths)
    assert sorted(used.astype(int)) == sorted(30 - g for g in slow_squares(lengths.tolist(), 30))
    for b in range(len(used)):
        own = sorted((offsets[i], lengths[i]) for i in np.flatnonzero(bins == b))
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]


def test_query(spark, documents):
    rows = p.pack(table(spark, SF_DIR, "documents"), word_vocabulary()).collect()
    check(rows, {d["doc_id"]: d["text"] or "" for d in documents}, 4096)
    tokens = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-tokens // 4096) * 1.02 + 1


def check(rows, texts, context):
    whole = dict(zip(texts, ids(list(texts.values()))))
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        data = whole[doc] + np.array([1], dtype="<u4").tobytes()
        own.sort(key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(data) // 4, context))
        for r in own:
            part = data[4 * r["start"] : 4 * (r["start"] + r["length"])]
            assert len(part) == 4 * r["length"] and r["ids_crc32"] == zlib.crc32(part)
        assert sum(r["length"] for r in own) == len(data) // 4
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= context


def test_many_shards(spark):
    texts = {i: f"word{i} " * (i % 50) for i in range(300)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    check(p.pack(df, word_vocabulary(), context=64, shard_pieces=50).collect(), texts, 64)


def test_odd_rows(odd, no_rows):
    rows = p.pack(odd, word_vocabulary()).collect()
    assert len({r["doc_id"] for r in rows}) == 7 and sum(r["piece"] == 0 for r in rows) == 9
    assert p.pack(no_rows, word_vocabulary()).count() == 0
