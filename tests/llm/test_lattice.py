import math
import re
import time
import zlib
from collections import Counter

import pytest

from colloquy.llm import lattice
from colloquy.llm.common import table
from colloquy.llm.queries import piece_model
from tests.conftest import SF_DIR


def all_segmentations(text, log_p):
    if not text:
        return [0.0]
    return [
        log_p[text[:n]] + rest
        for n in range(1, len(text) + 1)
        if text[:n] in log_p
        for rest in all_segmentations(text[n:], log_p)
    ]


def toy():
    weight = {"▁": 2.0, "a": 3.0, "b": 1.0, "ab": 2.0, "▁a": 1.0, "ba": 0.5, "aba": 0.7, lattice.END: 1.0}
    weight |= {f"<0x{b:02X}>": 0.01 for b in range(256)}
    return lattice.Pieces.normalized(weight)


@pytest.mark.parametrize("word", ["a", "abab", "ababaab", "bbba", "a" * 9])
def test_forward_sums_all_segmentations(word):
    pieces = toy()
    paths = all_segmentations("▁" + word, pieces.log_p)
    assert pieces.log_probability(word) == pytest.approx(math.log(sum(map(math.exp, paths))))
    used = {}
    pieces.expected(word, 1.0, used)
    assert sum(n * len(p) for p, n in used.items()) == pytest.approx(len(word) + 1)


def test_unknown_letters_are_spelled_in_bytes():
    pieces = toy()
    assert pieces.log_probability("é") == pytest.approx(
        pieces.log_p["▁"] + pieces.log_p["<0xC3>"] + pieces.log_p["<0xA9>"]
    )
    assert math.isfinite(lattice.Pieces.from_model(piece_model()).log_probability("日x\x00" * 5000))


@pytest.mark.parametrize("word", ["\U0001f600" * 30, "\ud7a3" * 5000, "ab" * 400, "a\u9fa5" * 60])
def test_long_words_and_unknown_letters_are_learned_from(word):
    pieces, used = toy(), {}
    pieces.expected(word, 3.0, used)
    spelled = sum(n for p, n in used.items() if p.startswith("<0x"))
    letters = sum(n * len(p) for p, n in used.items() if not p.startswith("<0x"))
    assert all(map(math.isfinite, used.values()))
    assert spelled == pytest.approx(3 * sum(len(c.encode()) for c in word if c not in "ab"))
    assert letters == pytest.approx(3 * (1 + sum(c in "ab" for c in word)))  # one word start


def test_plain_and_log_sums_agree():
    for word in ("abab", "b\u00e9a" * 5, "ab" * 30):
        plain, logs = {}, {}
        assert toy()._expected(word, 2.0, plain)
        toy()._expected_in_logs(word, 2.0, logs)
        assert logs == pytest.approx(plain)


def test_texts_of_emoji_are_scored(spark):
    rows = [(i, "\U0001f600" * 40 + " plain words") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(math.isfinite(r["score"]) for r in lattice.score_documents(df, piece_model()).collect())


def words(text):
    return [w for w in re.split(r"[ \t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]


def test_query_equals_brute_force(spark, documents):
    held = {d["doc_id"]: zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in documents}
    counts = Counter()
    for d in documents:
        if not held[d["doc_id"]]:
            counts.update([*words(d["text"]), None])
    n, v = sum(counts.values()), len(counts)
    pieces = lattice.Pieces.from_model(piece_model())
    ends = counts[None]
    for _ in range(lattice.ROUNDS):
        used = {}
        for w, c in counts.items():
            if w is not None:
                pieces.expected(w, c, used)
        used[lattice.END] = ends
        pieces = lattice.Pieces.normalized({p: used.get(p, 0) + lattice.SMOOTH for p in pieces.log_p})
    for frequent in (lattice.FREQUENT, 50):
        rows = {r["doc_id"]: r for r in lattice.score_documents(table(spark, SF_DIR, "documents"), piece_model(), frequent=frequent).collect()}
        assert len(rows) == len(documents)
        for d in documents:
            r, own = rows[d["doc_id"]], [*words(d["text"]), None]
            assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[d["doc_id"]], len(own), n)
            assert r["n_known"] == sum(counts[w] > 0 for w in own)
            assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
            score = sum(pieces.log_probability(w) for w in own[:-1]) + pieces.log_p[lattice.END]
            assert r["score"] == pytest.approx(score / math.log(10), abs=1e-6)
    # Learning from the corpus helps on texts that were not learned from.
    plain = lattice.Pieces.from_model(piece_model())
    for d in documents:
        if held[d["doc_id"]] and len(words(d["text"])) > 50:
            untrained = sum(map(plain.log_probability, words(d["text"]))) + plain.log_p[lattice.END]
            assert rows[d["doc_id"]]["score"] > untrained / math.log(10)


def test_odd_rows(odd, no_rows):
    rows = lattice.score_documents(odd, piece_model()).collect()
    assert len(rows) == 9 and sorted(r["n_tokens"] for r in rows)[:3] == [1, 1, 1]
    assert len({r["score"] for r in rows if r["n_tokens"] == 1}) == 1
    assert lattice.score_documents(no_rows, piece_model()).count() == 0


def test_words_beyond_the_table_make_no_row_each(spark, monkeypatch):
    written = {}

    def stored(df, name):
        df = store(df, name)
        written[name] = df.count()
        return df

    store = lattice.stored
    monkeypatch.setattr(lattice, "stored", stored)
    docs = [(i, " ".join(f"word{i}x{k}" for k in range(50))) for i in range(8)] + [(None, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    rows = lattice.score_documents(df, piece_model(), frequent=0).collect()
    assert len(rows) == written["scored-parts"] == 9
    assert sorted(r["n_tokens"] for r in rows) == [1, *[51] * 8] and all(math.isfinite(r["score"]) for r in rows)


def test_a_long_piece_does_not_make_every_word_slow():
    pieces = lattice.Pieces.normalized({lattice.END: 1.0, lattice.WORD_START: 1e9, "b": 1e12, "a" * 3000: 1.0})
    began, used = time.process_time(), {}
    pieces.expected("b" * 6000, 2.0, used)
    assert used["b"] == pytest.approx(12_000) and math.isfinite(pieces.log_probability("b" * 6000))
    assert time.process_time() - began < 1
