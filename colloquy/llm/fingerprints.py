"""Operator 6: homomorphic multiset hash of documents. DataFrame functions only.

A fingerprint is a sum of wide vectors, one per paragraph, lane by lane modulo
2**32. So the order of paragraphs does not matter, and inserting or deleting one
adds or subtracts its vector (``combined``). A paragraph's vector has two parts:

* ``EXACT`` lanes hashed from the SHA-512 of the paragraph. Sums of them are equal for
  equal multisets of paragraphs and differ for others (but for 2**-512 chances).
* ``LIKE`` lanes of +1 or -1 per pair of neighbouring words, from the bits of the
  pair's hash, begin and end of the paragraph included. The cosine of two such sums
  estimates the cosine of the two multisets of pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import bit_count, bit_sums, stored

EXACT = 16
LIKE = 64
MODULUS = 1 << 32


def _paragraphs(text: Column) -> Column:
    return F.split(text, "\n", -1)


def exact_lanes(text: Column) -> Column:
    """The exact part of a text's fingerprint: ``EXACT`` numbers below 2**32."""

    def vector(paragraph: Column) -> Column:
        digest = F.sha2(paragraph, 512)
        return F.array(*(F.xxhash64(digest, F.lit(i)).bitwiseAND(F.lit(MODULUS - 1)) for i in range(EXACT)))

    def add(total: Column, own: Column) -> Column:
        return F.zip_with(total, own, lambda a, b: (a + b).bitwiseAND(F.lit(MODULUS - 1)))

    zero = F.array_repeat(F.lit(0).cast("bigint"), EXACT)
    return F.aggregate(F.transform(_paragraphs(text), vector), zero, add)


def pair_hashes(text: Column) -> Column:
    """Hashes of all pairs of neighbouring words of each paragraph, its two ends included."""

    def pairs(paragraph: Column) -> Column:
        words = F.split(paragraph, " ", -1)
        return F.zip_with(
            F.concat(F.array(F.lit("\n")), words), F.concat(words, F.array(F.lit("\n"))), lambda a, b: F.xxhash64(a, b)
        )

    return F.flatten(F.transform(_paragraphs(text), pairs))


def hex_lanes(lanes: Column) -> Column:
    """Lanes as 8 hex digits each."""
    return F.array_join(F.transform(lanes, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def number_lanes(digits: Column) -> Column:
    """The lanes of ``hex_lanes`` as numbers."""
    each = F.regexp_extract_all(digits, F.lit("[0-9a-f]{8}"), F.lit(0))
    return F.transform(each, lambda d: F.conv(d, 16, 10).cast("bigint"))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of two texts' paragraphs together (``sign`` -1: of the first without the second's)."""
    lanes = F.zip_with(number_lanes(a), number_lanes(b), lambda x, y: F.pmod(x + sign * y, F.lit(MODULUS)))
    return hex_lanes(lanes)


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the like parts of two fingerprints, 0 at least; 1 for equal fingerprints, null beside a null."""

    def signed(digits: Column) -> Column:
        lanes = number_lanes(F.substring(digits, 8 * EXACT + 1, 8 * LIKE))
        return F.transform(lanes, lambda x: F.when(x >= MODULUS // 2, x - MODULUS).otherwise(x).cast("double"))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)

    x, y = signed(a), signed(b)
    dot = total(F.zip_with(x, y, lambda p, q: p * q))
    norms = F.sqrt(total(F.transform(x, lambda p: p * p)) * total(F.transform(y, lambda p: p * p)))
    cosine = F.when(norms > 0, F.round(dot / norms, 12)).otherwise(0.0)
    some = F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine))
    return F.when(a == b, F.lit(1.0)).when(a.isNotNull() & b.isNotNull(), some)


def fingerprints(rows: DataFrame, texts: dict[str, str], keep: list[str]) -> DataFrame:
    """``keep`` and one fingerprint per entry (output name → text column) for every row.

    The words are exploded and summed where the row stands: the grouping keys
    start with ``keep``, so rows already dealt by its first column stay there.
    Equal rows are summed together once and told apart by their count.
    """
    outs = list(texts)
    sides = F.array(*(F.struct(F.lit(i).alias("side"), F.col(t).alias("__text")) for i, t in enumerate(texts.values())))
    each = rows.select(*keep, F.inline(sides))
    pairs = each.select(
        *keep, "side", hex_lanes(exact_lanes(F.col("__text"))).alias("__exact"), pair_hashes(F.col("__text")).alias("__pairs")
    )
    pairs = pairs.withColumn("__size", F.size("__pairs").cast("bigint"))
    keys = [*keep, "side", "__exact", "__size"]
    hashes = pairs.select(*keys, F.explode("__pairs").alias("h"))
    counted = hashes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *bit_sums(F.col("h")))
    counted = counted.withColumn("__times", F.expr("__n div __size"))
    counted = counted.withColumn("__bits", F.array(*(bit_count(j) for j in range(LIKE))))
    like = F.transform("__bits", lambda c: F.pmod(2 * F.floor(c / F.col("__times")) - F.col("__size"), F.lit(MODULUS)))
    prints = counted.select(*keep, "side", "__times", F.concat("__exact", hex_lanes(like)).alias("print"))
    wide = prints.groupBy(*keep).agg(
        F.max("__times").alias("__times"),
        *(F.max(F.when(F.col("side") == i, F.col("print"))).alias(name) for i, name in enumerate(outs)),
    )
    repeated = F.sequence(F.lit(1).cast("bigint"), F.col("__times"))
    return wide.select(*keep, *outs, F.explode(repeated).alias("__i")).drop("__i")


def neighbours(ids: DataFrame) -> DataFrame:
    """``(doc_id, next_id, previous_id, previous_n)`` in falling order of ids, a ring.

    ``ids`` has distinct ``doc_id`` and ``n``. Ranges of ids are sorted side by
    side; only the first and last row of each range meet in one place.
    """
    ranged = ids.repartitionByRange(F.desc("doc_id")).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    inside = W.partitionBy("part").orderBy(F.desc("doc_id"))
    ends = ranged.groupBy("part").agg(
        F.max("doc_id").alias("first"), F.min(F.struct("doc_id", "n")).alias("last")
    )
    across, ring = W.orderBy("part"), W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("first").over(across), F.first("first").over(ring)).alias("after"),
        F.coalesce(F.lag("last").over(across), F.last("last").over(ring)).alias("before"),
    )
    here = ranged.select(
        "doc_id", "part", F.lead("doc_id").over(inside).alias("lead"),
        F.lag(F.struct("doc_id", "n")).over(inside).alias("lag"),
    )
    before = F.coalesce("lag", "before")
    # One row per task of the sort above.
    return here.join(F.broadcast(ends), "part").select(
        "doc_id", F.coalesce("lead", "after").alias("next_id"), before["doc_id"].alias("previous_id"),
        before["n"].alias("previous_n"),
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, in which the last third is
    replaced by as much from the start of the next document in falling order of ids.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` per row. Texts are shuffled once whole, by id, and a
    third of them once more to the document they are put into.

    Null text: empty. Of rows that repeat an id the one with the smallest text is
    the "next" one; each keeps a row. Rows without an id have no next document:
    their edited text is only shortened and ``near_next`` is null. No rows: no
    rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    named = rows.filter(F.col("doc_id").isNotNull())
    ids = named.groupBy("doc_id").agg(F.max(F.length("text")).cast("bigint").alias("n"))
    ring = stored(neighbours(ids), "ring")
    # Both joins deal the same columns by id, so the texts are shuffled once for them.
    third = F.floor(F.col("previous_n") / 3).cast("int")
    heads = named.join(ring, "doc_id").select(
        F.col("previous_id").alias("doc_id"), F.substring(F.col("text"), F.lit(1), third).alias("head")
    )
    heads = heads.groupBy("doc_id").agg(F.min("head").alias("head"))
    joined = named.join(heads, "doc_id").select("doc_id", "text", "head")
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("head"), F.lit(1), cut))

    def printed(both: DataFrame) -> DataFrame:
        both = both.select("doc_id", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
        both = both.withColumn("edited_sha256", F.sha2("edited", 256))
        texts = {"fingerprint": "text", "edited_fingerprint": "edited"}
        return fingerprints(both, texts, ["doc_id", "n_chars", "edited_sha256"])

    unnamed = rows.filter(F.col("doc_id").isNull()).withColumn("head", F.lit(""))
    # Written apart: inside one union the planner would not share the shuffle.
    prints = stored(printed(joined), "prints").union(stored(printed(unnamed), "unnamed"))
    following = prints.groupBy("doc_id").agg(F.min("fingerprint").alias("next_fingerprint"))
    following = ring.select("doc_id", "next_id").join(following.withColumnRenamed("doc_id", "next_id"), "next_id")
    joined = prints.join(following.select("doc_id", "next_fingerprint"), "doc_id", "left")
    return joined.select(
        *prints.columns, likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
