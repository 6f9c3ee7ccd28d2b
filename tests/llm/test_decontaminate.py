import random

import numpy as np

from colloquy.llm import decontaminate as dc


def slow_alignment(a, b):
    """Textbook Smith-Waterman."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i][j] = max(
                0, table[i - 1][j - 1] + (dc.MATCH if x == y else dc.MISMATCH), table[i - 1][j] + dc.GAP,
                table[i][j - 1] + dc.GAP,
            )
    return max(map(max, table))


def test_alignment_equals_the_textbook():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 20))
        assert dc.smith_waterman(a, b)[0] == slow_alignment(a.tolist(), b.tolist())


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    items = [rng.choices(words, k=rng.randint(12, 50)) for _ in range(12)]
    docs, leaked = [], set()
    for doc in range(60):
        text = rng.choices(words, k=rng.randint(0, 300))
        if doc % 3 == 0:
            item = rng.randrange(len(items))
            copy = list(items[item])
            for _ in range(len(copy) // 8):  # edited words, one lost and one added
                copy[rng.randrange(len(copy))] = rng.choice(words)
            copy.insert(3, "new")
            at = rng.randint(0, len(text))
            text[at:at] = copy
            leaked.add((doc, item))
        docs.append((doc, " ".join(text)))
    return docs, [(i, " ".join(w).capitalize() + ".") for i, w in enumerate(items)], leaked


def test_finds_edited_copies_and_nothing_else(spark):
    docs, items, leaked = corpus()
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block_words in (1_000_000, 60):
        rows = dc.leaks(df, benchmark, block_words=block_words).collect()
        assert {(r["doc_id"], r["item_id"]) for r in rows} == leaked and len(rows) == len(leaked)
    texts, wanted = dict(docs), dict(items)
    for r in rows:
        item = dc.words_of(wanted[r["item_id"]])
        assert abs(r["score"] - slow_alignment(item, dc.words_of(texts[r["doc_id"]])) / (dc.MATCH * len(item))) < 1e-9
        passage = dc.words_of(texts[r["doc_id"]])[r["first_word"] : r["last_word"] + 1]
        assert abs(r["score"] - slow_alignment(item, passage) / (dc.MATCH * len(item))) < 1e-9
    kept = {r["doc_id"] for r in dc.without_leaks(df, benchmark).collect()}
    assert kept == set(texts) - {d for d, _ in leaked}


def edited(rng, item, every, kind):
    """Every so many words one is replaced, lost or followed by a new one."""
    out = []
    for i, word in enumerate(item):
        if i % every != every - 1:
            out.append(word)
        elif kind == "insert":
            out += [word, f"n{rng.randrange(10**9)}"]
        elif kind == "replace":
            out.append(f"n{rng.randrange(10**9)}")
    return out


def test_finds_strongly_edited_copies(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    items = [rng.choices(words, k=40) for _ in range(30)]
    cases = [(n, k) for k in ("replace", "lose", "insert") for n in (3, 4, 5, 6)] + [(2, "insert"), (1, "insert")]
    docs = [(i, edited(rng, items[i], *case), i) for i, case in enumerate(cases)]
    docs += [(100 + i, docs[2][1], 2) for i in range(20)]  # one edited copy in many documents
    texts = [(i, " ".join(rng.choices(words, k=100) + t + rng.choices(words, k=100))) for i, t, _ in docs]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in dc.leaks(df, benchmark).collect()} == {(i, n) for i, _, n in docs}


def test_finds_whatever_aligns():
    rng = random.Random(3)
    for _ in range(1500):
        words = [f"w{i}" for i in range(rng.choice((6, 12, 40)))]
        item = rng.choices(words, k=rng.randint(3, 14))
        text = [w for word in item for w in rng.choice(([word], [word], [], ["x"], [word, "y"], [word, "y", "z"]))]
        text = rng.choices(words, k=rng.randint(0, 9)) + text + rng.choices(words, k=rng.randint(0, 9))
        score = slow_alignment(item, text) / (dc.MATCH * len(item))
        found = dc.Items.of([(1, " ".join(item))]).leaks(" ".join(text), dc.LEAK)
        assert [f[1] for f in found] == ([score] if score >= dc.LEAK else [])


def test_odd_rows(spark, odd, no_rows):
    items = [(1, "same words here again and"), (1, "same words here again and"), (None, None), (2, ""), (3, "a b"), (None, "a text without an id")]
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, doc_id string")
    found = sorted(((r["doc_id"] or 0), r["item_id"] or 0) for r in dc.leaks(odd, benchmark).collect())
    assert found == [(0, 0), (1, 1), (1, 1), (1, 1), (1, 1), (2, 1), (2, 1)]
    kept = dc.without_leaks(odd, benchmark)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 6]
    assert dc.leaks(no_rows, benchmark).count() == 0 and dc.without_leaks(no_rows, benchmark).count() == 0
    assert dc.leaks(odd, benchmark.limit(0)).count() == 0 and dc.without_leaks(odd, benchmark.limit(0)).count() == 9
