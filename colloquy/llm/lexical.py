"""Ranked lexical search by MaxScore with pair bounds.

Documents are scored for every query (a ``benchmark`` item) with an integer
BM25 (see ``impacts``); the ``k`` best per query are returned exactly.

Method (all Spark joins and aggregates, no Python on the main path):

1. Index. Postings ``(term, doc_id, impact)`` are built only for the terms of
   the queries (a query-term set bounded by the query table; its join is a
   broadcast behind a size check). ``ub(t)`` is a term's largest impact.
2. Pair lists. Each query's terms are sorted by ``ub`` and paired in that order
   (1st with 2nd, 3rd with 4th, ...). For every pair the intersection of the two
   posting lists (read inside each document's row of a forward index, so no
   posting list is shuffled) gives the joint maximum impact, so the pair bound
   is ``max(joint, ub1, ub2) <= ub1 + ub2``.
3. Threshold. The 10 highest-impact postings of every query term (a top-k per
   term, which Spark limits inside each task before the shuffle, so a frequent
   term is no hot key) are scored in full; the k-th of these exact scores per
   query is ``theta`` (0 with fewer than k).
4. MaxScore. The longest ub-ordered prefix of a query's terms whose pair-bound sum
   stays below ``theta`` is non-essential: a document that holds only those
   terms scores below ``theta`` and cannot enter the result. Only documents that
   hold an essential term are candidates; each is scored in full by look-ups on
   ``(term, doc_id)``.

Ties (equal scores) go to the smaller doc_id; a document whose score equals
``theta`` is always a candidate, since the prefix bound is strictly smaller.

Edge cases: a null or empty text has no terms and no score; a query without
terms, or whose terms occur in no document, returns no rows; rows that repeat
a ``doc_id`` are one document holding all their terms (a null id is one such
document too); a repeated query id pools its terms; extra columns of
the inputs are ignored. The postings are written to the shared scratch folder
once, so later joins neither recompute the terms nor depend on lost executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import stored

# Fixed values of the scoring contract.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())  # what TERM_PATTERN leaves out
K1_MILLI, B_PERCENT = 1000, 90  # k1 = 1.0 and b = 0.9 in integer units
TOP = 10

# The query-term table is broadcast below this many rows, else shuffled.
MAX_BROADCAST_TERMS = 2_000_000


def terms(text: Column) -> Column:
    """All terms of a text with repeats; a null text has none."""
    spaced = F.translate(text, UPPER + SEPARATORS, LOWER + " " * len(SEPARATORS))
    return F.coalesce(F.array_remove(F.split(spaced, " "), ""), F.array())


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_TERMS else df


def query_terms(queries: DataFrame, qid: str = "item_id", text: str = "text") -> DataFrame:
    """``(qid, term)``, once each."""
    return queries.select(F.col(qid).alias("qid"), F.explode(terms(F.col(text))).alias("term")).distinct()


def term_ids(qterms: DataFrame) -> DataFrame:
    """``(term, tid)``: the query terms numbered from 1 (one small window over the query vocabulary)."""
    return qterms.select("term").distinct().withColumn("tid", F.dense_rank().over(W.orderBy("term")).cast("int"))


def impacts(docs: DataFrame, vocabulary: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings ``(term, doc_id, impact)`` for the terms of ``vocabulary`` ``(term, tid)``; ``term`` is the tid.

    N: documents with a term; L: their terms with repeats; n: a document's terms;
    df, tf as usual. ``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` in doubles,
    ``m = 10 + (90 n N) div L`` and impact ``= w * ((10**9 tf) div (1000 tf + 8 m))``
    in 64-bit integers. Rows that repeat a ``doc_id`` are one document that holds
    all their terms (a hot id is pre-aggregated, never collected).

    The texts are split once: every document adds one row without a term that
    carries its length, so term counts and lengths come from one aggregate,
    written to the scratch folder.
    """
    some = docs.filter(F.col(text).rlike(TERM_PATTERN))  # a filter on the terms would split every text a second time
    split = some.select(F.col(doc_id).alias("doc_id"), terms(F.col(text)).alias("__terms"))
    split = split.withColumn("__n", F.size("__terms").cast("long"))
    occurrences = split.select(
        "doc_id", "__n", F.explode(F.concat("__terms", F.array(F.lit(None).cast("string")))).alias("term")
    )
    n_terms = vocabulary.count()
    known = occurrences.join(_small(vocabulary.select("term", "tid"), n_terms), "term", "left")
    known = known.filter(F.col("tid").isNotNull() | F.col("term").isNull())
    counts = stored(
        known.groupBy("tid", "doc_id").agg(
            F.count(F.lit(1)).alias("tf"), F.sum(F.when(F.col("term").isNull(), F.col("__n"))).alias("__n")
        ),
        "counts",
    )
    lengths = counts.filter(F.col("tid").isNull()).select("doc_id", "__n")
    n_docs, n_all = lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0)).cast("long")).first()
    tf = counts.filter(F.col("tid").isNotNull()).select(F.col("tid").alias("term"), "doc_id", "tf").join(lengths, "doc_id")
    frequencies = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    weights = frequencies.select("term", w.alias("w"))
    m = F.lit(100 - B_PERCENT) + F.expr(f"({B_PERCENT} * __n * {n_docs}L) div {max(n_all, 1)}L")
    part = F.expr(f"(1000000000L * tf) div ({K1_MILLI} * tf + 8 * __m)")
    joined = tf.join(_small(weights, n_terms), "term").withColumn("__m", m)
    return joined.select("term", "doc_id", (F.col("w") * part).alias("impact"))


def pair_bounds(qterms: DataFrame, index: DataFrame, bounds: DataFrame) -> DataFrame:
    """``(qid, term, rank, ub, prefix_bound)``: the pair-bound sum of a query's terms up to each, in ub order.

    ``index`` is the forward index (``forward``). ``prefix_bound`` does not decrease
    along ``rank``: a pair's bound is at least the ``ub`` of its first term.
    """
    order = W.partitionBy("qid").orderBy("ub", "term")
    ranked = qterms.join(bounds, "term", "left").fillna(0, ["ub"]).withColumn("rank", F.row_number().over(order))
    ranked = ranked.withColumn("pair", F.floor((F.col("rank") - 1) / 2))
    firsts = ranked.filter(F.col("rank") % 2 == 1).select("qid", "pair", F.col("term").alias("t1"), F.col("ub").alias("ub1"))
    seconds = ranked.filter(F.col("rank") % 2 == 0).select("qid", "pair", F.col("term").alias("t2"), F.col("ub").alias("ub2"))
    pairs = firsts.join(seconds, ["qid", "pair"])
    # Intersections, each pair once, inside each document's row of the forward index:
    # every posting of t1 looks up t2 in the same map. Only the maxima are shuffled.
    distinct_pairs = pairs.select("t1", "t2").distinct()
    entries = index.select("impacts", F.explode("impacts").alias("t1", "i1"))
    both = entries.join(_small(distinct_pairs, MAX_BROADCAST_TERMS), "t1").withColumn("i2", F.element_at("impacts", F.col("t2")))
    joint = both.filter(F.col("i2").isNotNull()).groupBy("t1", "t2").agg(F.max(F.col("i1") + F.col("i2")).alias("joint"))
    bound = F.greatest(F.coalesce("joint", F.lit(0)), "ub1", "ub2")
    pair_bound = pairs.join(joint, ["t1", "t2"], "left").select("qid", "pair", bound.alias("pb"))
    upto = W.partitionBy("qid").orderBy("pair").rowsBetween(W.unboundedPreceding, -1)
    done = pair_bound.withColumn("before", F.coalesce(F.sum("pb").over(upto), F.lit(0)))
    # Sums of the complete pairs before each pair; a last, unpaired term has no pair row.
    before_all = W.partitionBy("qid").orderBy("pair").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    totals = done.select("qid", F.sum("pb").over(before_all).alias("all_pairs")).distinct()
    with_pairs = ranked.join(done, ["qid", "pair"], "left").join(totals, "qid", "left")
    prefix = (
        F.when(F.col("pb").isNotNull() & (F.col("rank") % 2 == 0), F.col("before") + F.col("pb"))
        .when(F.col("pb").isNotNull(), F.col("before") + F.col("ub"))
        .otherwise(F.coalesce("all_pairs", F.lit(0)) + F.col("ub"))
    )
    return with_pairs.select("qid", "term", "rank", "ub", prefix.alias("prefix_bound"))


def forward(postings: DataFrame) -> DataFrame:
    """``(doc_id, impacts)``: a document's query-term impacts as a map; bounded by the query vocabulary."""
    entries = F.map_from_entries(F.collect_list(F.struct("term", "impact")))
    return postings.groupBy("doc_id").agg(entries.alias("impacts"))


def full_scores(candidates: DataFrame, qterms: DataFrame, index: DataFrame) -> DataFrame:
    """``(qid, doc_id, score)`` for candidate ``(qid, doc_id)`` pairs: the query's terms looked up in the document's map."""
    wanted = qterms.groupBy("qid").agg(F.collect_set("term").alias("__terms"))  # one small row per query
    scored = candidates.join(F.broadcast(wanted), "qid").join(index, "doc_id")
    # A look-up reads a map from its start, so only the terms that the document holds are looked up.
    found = F.transform(F.array_intersect(F.map_keys("impacts"), F.col("__terms")), lambda t: F.element_at("impacts", t))
    return scored.select("qid", "doc_id", F.aggregate(found, F.lit(0).cast("long"), lambda a, b: a + b).alias("score"))


def top_k(scores: DataFrame, k: int = TOP) -> DataFrame:
    order = W.partitionBy("qid").orderBy(F.desc("score"), "doc_id")
    # Scores of 0 come last; a filter on the score before the window would compute every score twice.
    ranked = scores.withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("rank") <= k) & (F.col("score") > 0))


def search(
    docs: DataFrame, queries: DataFrame, k: int = TOP, doc_id: str = "doc_id", text: str = "text",
    qid: str = "item_id", qtext: str = "text",
) -> DataFrame:
    """The ``k`` best documents of every query: ``(qid, rank, doc_id, score)``, rank from 1.

    Only scores above 0 count; equal scores go to the smaller doc_id. See the module
    for the method and the edge cases.
    """
    words = query_terms(queries, qid, qtext)
    vocabulary = stored(term_ids(words), "terms")
    qterms = words.join(_small(vocabulary, MAX_BROADCAST_TERMS), "term").select("qid", F.col("tid").alias("term"))
    postings = stored(impacts(docs, vocabulary, doc_id, text), "postings")
    index = stored(forward(postings), "forward")
    bounds = postings.groupBy("term").agg(F.max("impact").alias("ub"))
    # Threshold: the best postings of each term, scored in full.
    best = postings.withColumn("__r", F.row_number().over(W.partitionBy("term").orderBy(F.desc("impact"), "doc_id")))
    seeds = qterms.join(best.filter(F.col("__r") <= k).select("term", "doc_id"), "term").select("qid", "doc_id").distinct()
    seeded = top_k(full_scores(seeds, qterms, index), k)
    theta = seeded.filter(F.col("rank") == k).select("qid", F.col("score").alias("theta"))
    # MaxScore: terms beyond the prefix whose pair-bound sum is below theta are essential.
    prefixed = pair_bounds(qterms, index, bounds).join(theta, "qid", "left").fillna(0, ["theta"])
    essential = prefixed.filter(F.col("prefix_bound") >= F.col("theta")).select("qid", "term")
    candidates = essential.join(postings.select("term", "doc_id"), "term").select("qid", "doc_id").distinct()
    ranked = top_k(full_scores(candidates, qterms, index), k)
    return ranked.select(F.col("qid"), F.col("rank").cast("int"), F.col("doc_id").cast("long"), F.col("score").cast("long"))
