import math
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from colloquy.llm import lexical
from tests.conftest import SF_DIR

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    if text is None:
        return []
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def brute_force(docs, queries, k=10):
    """The scoring contract over every document and query, in plain Python."""
    terms = {d: split(t) for d, t in docs}
    has = {d: t for d, t in terms.items() if t}
    n_docs, n_all = len(has), sum(len(t) for t in has.values())
    df = {}
    for t in has.values():
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for qid, text in queries:
        scores = {}
        for term in set(split(text)):
            if term not in df:
                continue
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
            for d, t in has.items():
                tf = t.count(term)
                if tf:
                    m = 10 + (90 * len(t) * n_docs) // n_all
                    scores[d] = scores.get(d, 0) + w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        best = sorted(((-s, d) for d, s in scores.items() if s > 0))[:k]
        out += [(qid, r + 1, d, -s) for r, (s, d) in enumerate(best)]
    return sorted(out)


def test_search_equals_brute_force(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    items = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()
    got = lexical.search(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    want = brute_force([(d["doc_id"], d["text"]) for d in docs], [(q["item_id"], q["text"]) for q in items])
    assert sorted(tuple(r) for r in got.collect()) == want and want


def test_ties_nulls_repeats_and_empty_tables(spark, odd, no_rows):
    docs = odd.withColumn("qid", F.lit(9))  # an extra column named like the output
    queries = spark.createDataFrame(
        [(1, "same words"), (2, None), (3, ""), (4, "WORD5 end unknownterm"), (4, "again"), (5, "!!!")],
        "item_id bigint, text string",
    )
    got = sorted(tuple(r) for r in lexical.search(docs, queries).collect())
    pooled = {}
    for r in odd.collect():  # rows that repeat an id are one document
        pooled.setdefault(r["doc_id"], []).append(r["text"] or "")
    ids = sorted(pooled, key=lambda d: -1 if d is None else d)
    texts = [(i, " ".join(pooled[d])) for i, d in enumerate(ids)]
    want = brute_force(texts, [(1, "same words"), (4, "word5 end unknownterm again")])
    key = lambda x: (x[0], x[1], -1 if x[2] is None else x[2], x[3])
    rank_ok = [(q, r, ids[d], s) for q, r, d, s in want]
    assert sorted(got, key=key) == sorted(rank_ok, key=key) and rank_ok
    assert lexical.search(no_rows, queries).count() == 0
    assert lexical.search(odd, queries.limit(0)).count() == 0


def test_maxscore_skips_documents(spark):
    """A frequent term whose bound stays below the threshold is not essential: its documents are never scored."""
    docs = spark.createDataFrame(
        [(i, "the " * 5 + ("rare" if i < 12 else "common") + " words") for i in range(200)], "doc_id bigint, text string"
    )
    queries = spark.createDataFrame([(1, "the rare")], "item_id bigint, text string")
    rows = lexical.search(docs, queries).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(10))
    words = lexical.query_terms(queries)
    vocabulary = lexical.term_ids(words)
    qterms = words.join(vocabulary, "term").select("qid", F.col("tid").alias("term"))
    postings = lexical.impacts(docs, vocabulary)
    bounds = postings.groupBy("term").agg(F.max("impact").alias("ub"))
    prefixed = lexical.pair_bounds(qterms, lexical.forward(postings), bounds).collect()
    theta = sorted((r["score"] for r in rows), reverse=True)[9]
    names = {r["tid"]: r["term"] for r in vocabulary.collect()}
    essential = [names[r["term"]] for r in prefixed if r["prefix_bound"] >= theta]
    assert essential == ["rare"]


def test_terms_are_the_matches_of_the_pattern(apply):
    texts = ["".join(map(chr, range(256))), "aB\x00cÉ\x7fd e\U0001F600f", "", "...", None, " a  b ", "x\\y'z\"0"]
    upper, lower = lexical.UPPER, lexical.LOWER
    want = [re.findall(lexical.TERM_PATTERN, (t or "").translate(str.maketrans(upper, lower))) for t in texts]
    assert apply(lexical.terms, texts) == want


def test_a_score_is_computed_once(spark):
    index = spark.createDataFrame([(1, {1: 5, 2: 7}), (2, {3: 1})], "doc_id bigint, impacts map<int, bigint>")
    qterms = spark.createDataFrame([(9, 1), (9, 2), (9, 4)], "qid bigint, term int")
    pairs = spark.createDataFrame([(9, 1), (9, 2)], "qid bigint, doc_id bigint")
    got = lexical.top_k(lexical.full_scores(pairs, qterms, index))
    assert [(r["doc_id"], r["score"], r["rank"]) for r in got.collect()] == [(1, 12, 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
