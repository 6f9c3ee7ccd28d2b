import bisect
import hashlib
import time

import numpy as np
import public_tokenizers
import pytest
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from colloquy.llm import alignment as al
from tests.conftest import SF_DIR

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_force(rows):
    """Align each text by plain string offsets and count pairs with dicts."""
    a, b, a_vocab, b_vocab = al.tokenizers_of(A, B)
    a_bytes = [a_vocab.buffer[s : s + n].tobytes() for s, n in zip(a_vocab.starts, a_vocab.lengths)]
    b_bytes = [b_vocab.buffer[s : s + n].tobytes() for s, n in zip(b_vocab.starts, b_vocab.lengths)]
    done = []
    for doc_id, text in rows:
        if not text:
            done.append((doc_id, None))
            continue
        whole = (" " + text).encode()
        ea = a.encode(" " + text, add_special_tokens=False).ids
        eb = b.encode(text)
        if b"".join(a_bytes[i] for i in ea) != whole or b"".join(b_bytes[i] for i in eb) != whole:
            done.append((doc_id, None))
            continue
        spans_a, spans_b, at = [], [], 0
        for i in ea:
            spans_a.append((at, at + len(a_bytes[i]), i))
            at += len(a_bytes[i])
        at = 0
        for i in eb:
            spans_b.append((at, at + len(b_bytes[i]), i))
            at += len(b_bytes[i])
        starts_b = [s for s, _, _ in spans_b]
        links = []
        for s1, e1, x in spans_a:  # every B span that starts before e1 and ends after s1
            first = max(bisect.bisect_right(starts_b, s1) - 1, 0)
            links += [(x, y) for s2, e2, y in spans_b[first : bisect.bisect_left(starts_b, e1)] if s1 < e2 and s2 < e1]
        cuts = sorted({e for _, e, _ in spans_a} & {e for _, e, _ in spans_b})
        groups = [([], []) for _ in cuts]
        for spans, side in ((spans_a, 0), (spans_b, 1)):
            for s, e, x in spans:
                groups[bisect.bisect_left(cuts, e)][side].append(x)
        done.append((doc_id, (len(ea), len(eb), groups, links)))
    count = {}
    for _, d in done:
        if d:
            for pair in set(d[3]):
                count[pair] = count.get(pair, 0) + 1
    top = {}
    for (x, _), c in count.items():
        top[x] = max(top.get(x, 0), c)
    out = []
    for doc_id, d in done:
        if d is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, n_a, n_b, len(groups), len(links), sum(count[p] == top[p[0]] for p in links),
            sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_alignment_equals_brute_force(spark, ranks):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()]
    got = al.alignment(spark.read.parquet(f"{SF_DIR}/documents.parquet"), A, B, a_ranks=ranks).select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r)) == brute_force(rows)


def test_nulls_repeats_long_special_and_empty(spark, odd, no_rows):
    extra = spark.createDataFrame(
        [(7, "a<|endoftext|>b  two  spaces", "x"), (8, "tab\tand\nnew line", "y"), (9, "ｆｕｌｌ width", "z")],
        "doc_id bigint, text string, n_a string",
    )
    docs = odd.select("doc_id", "text").unionByName(extra.select("doc_id", "text"))
    got = al.alignment(docs.withColumn("n_a", F.lit("clash")), A, B, a_ranks=RANKS).select(*COLUMNS).collect()
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r)) == want
    assert al.alignment(no_rows, A, B).count() == 0


def test_perfect_hash_is_one_to_one(spark):
    keys = spark.range(0, 5000).select(F.shiftleft(F.col("id") * 7919, 20).alias("key"))
    buckets, n_buckets, n_keys = al.perfect_hash(keys)
    slots = [r["slot"] for r in al.with_slot(keys, buckets, n_buckets, n_keys).collect()]
    assert sorted(slots) == list(range(5000))


def test_alignment_of_a_long_text_costs_little_more_than_its_numerals():
    rng = np.random.default_rng(4)
    vocab = al.Vocabulary([b"x" * n for n in (1, 2, 3, 4)] * 10_000)
    a, b = (rng.integers(0, 40_000, 400_000) for _ in range(2))
    total = min(int(vocab.lengths[i].sum()) for i in (a, b))
    a, b = (np.append(i[: np.searchsorted(np.cumsum(vocab.lengths[i]), total)], 0) for i in (a, b))
    short = [total - int(vocab.lengths[i].sum()) for i in (a, b)]
    a, b = (np.append(i, [0] * n) if n > 0 else i for i, n in zip((a, b), short))
    whole = b"x" * max(int(vocab.lengths[i].sum()) for i in (a, b))
    a, b = (np.append(i, [0] * (len(whole) - int(vocab.lengths[i].sum()))).astype(np.int64) for i in (a, b))
    al.align(a[:0], b[:0], vocab, vocab, b"")  # builds the numerals
    times = {}
    for name, call in (("numerals", lambda: ",".join(map(str, [*a.tolist(), *b.tolist()]))), ("align", lambda: al.align(a, b, vocab, vocab, whole))):
        best = []
        for _ in range(5):
            began = time.process_time()
            done = call()
            best.append(time.process_time() - began)
        times[name] = min(best)
    n_groups, text, (la, lb) = done
    ends = [set(np.cumsum(vocab.lengths[i]).tolist()) for i in (a, b)]
    assert n_groups == len(ends[0] & ends[1]) and len(la) == len(lb) == len(ends[0] | ends[1])
    assert [int(i) for g in text.decode().split(";") for i in g.split("|")[0].split(",")] == a.tolist()
    assert [int(i) for g in text.decode().split(";") for i in g.split("|")[1].split(",")] == b.tolist()
    print(times)
    assert times["align"] < 2 * times["numerals"]
