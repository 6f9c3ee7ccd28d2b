"""Exact ranks and order statistics without a single-task window.

Two orders are served. *Hash order* is a seeded permutation: rows sort by
``md5(salt:key)``, so the first hex digits of the hash cut every group, however
large, into even buckets. *Ordinal order* follows an integer column such as a
turn or step number; ranges of that column with even numbers of rows are the buckets.

In both, counts per bucket are pre-aggregated, a running sum over the small
bucket table gives each bucket's offset, and only the rows inside one bucket are
ever sorted together. ``key`` must be unique within its group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Cut = Callable[[Column], Column]

MAX_BROADCAST_EDGES = 20_000


def order_hash(salt: str | int, key: Column) -> Column:
    """Seeded hash of a key; the same text in any engine that has md5. A null key is an error."""
    text = F.coalesce(key.cast("string"), F.raise_error(F.lit("a null key has no place in a random order")).cast("string"))
    return F.md5(F.concat(F.lit(f"{salt}:"), text))


def _before(order: str, by: Sequence[str]):
    return W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join where null keys meet; ``right`` loses its key columns."""
    renamed = right.withColumnsRenamed({c: f"{c}__r" for c in on})
    matches = [left[c].eqNullSafe(renamed[f"{c}__r"]) for c in on]
    return left.join(renamed, matches, "inner").drop(*(f"{c}__r" for c in on))


def bucket_offsets(df: DataFrame, by: Sequence[str], bucket: str) -> DataFrame:
    """Rows per group that lie in earlier buckets: ``(by, bucket, __offset)``."""
    counts = df.groupBy(*by, bucket).agg(F.count(F.lit(1)).alias("__n"))
    earlier = F.coalesce(F.sum("__n").over(_before(bucket, by)), F.lit(0))
    return counts.select(*by, bucket, earlier.alias("__offset"))


def _rank_in_buckets(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    keys = [*by, "__bucket"]
    offsets = bucket_offsets(df.select(*keys), by, "__bucket")
    inside = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return join_null_safe(df, offsets, keys).withColumn(out, F.col("__offset") + inside).drop("__bucket", "__offset")


def hash_rank(
    df: DataFrame, key: str, salt: str | int, by: Sequence[str] = (), out: str = "rank", digits: int = 4
) -> DataFrame:
    """Add the 1-based rank of every row in seeded random order, per group."""
    hashed = df.withColumn("__h", order_hash(salt, F.col(key)))
    bucketed = hashed.withColumn("__bucket", F.substring("__h", 1, digits))
    return _rank_in_buckets(bucketed, by, ["__h", key], out).drop("__h")


def ordinal_rank(
    df: DataFrame, order: str, by: Sequence[str] = (), out: str = "rank", ranges: int = 256
) -> DataFrame:
    """Add the 1-based rank along a numeric column, per group.

    ``order`` is unique within a group. The buckets are ``ranges`` ranges of it that hold
    about as many rows each, whatever its values: their bounds are approximate
    quantiles, computed once per query. So a group that holds most of the table is
    sorted in as many parts, time stamps and dense counters alike.
    """
    shares = [i / ranges for i in range(1, ranges)]
    bounds = df.agg(F.percentile_approx(order, shares, 100 * ranges)).scalar()
    known = F.coalesce("__bounds", F.array().cast("array<double>"))
    bucketed = df.withColumn("__bounds", bounds).withColumn("__bucket", F.size(F.filter(known, lambda b: b < F.col(order))))
    return _rank_in_buckets(bucketed.drop("__bounds"), by, [order], out)


def hash_cutoffs(
    df: DataFrame, key: str, salt: str | int, cuts: Mapping[str, Cut], by: str | None = None,
    max_groups: int | None = None, digits: int = 4,
) -> DataFrame:
    """The row that stands at a given rank in hash order, per group.

    ``cuts`` maps a name to a function from the group's row count to the wanted
    rank (it may also use the ``by`` column). The result has one row per group
    and one ``struct(h, k)`` column per cut: a row is within the first ``rank``
    rows exactly when its own ``(hash, key)`` does not exceed that struct. A cut
    beyond the group's size is null.

    Ranks are found by selection, not by sorting: a histogram over hash prefixes
    names the one bucket that holds the wanted rank, and only that bucket
    (a 16**-digits share of the group) is ordered. There is one such bucket per
    group and cut; when ``max_groups`` shows that these are few, they are
    broadcast and the rows are only scanned.
    """
    groups = [by] if by else []
    hashed = df.select(
        *groups, F.col(key).alias("__k"), order_hash(salt, F.col(key)).alias("__h")
    ).withColumn("__bucket", F.substring("__h", 1, digits))

    counts = hashed.groupBy(*groups, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    whole = W.partitionBy(*groups)
    upto = whole.orderBy("__bucket").rowsBetween(W.unboundedPreceding, 0)
    running = counts.withColumns({"__upto": F.sum("__n").over(upto), "__total": F.sum("__n").over(whole)})
    wanted = F.array(
        *(
            F.struct(F.lit(name).alias("__cut"), rank(F.col("__total")).cast("bigint").alias("__rank"))
            for name, rank in cuts.items()
        )
    )
    edges = (
        running.select(*groups, "__bucket", "__upto", "__n", F.inline(wanted))
        .filter((F.col("__rank") <= F.col("__upto")) & (F.col("__rank") > F.col("__upto") - F.col("__n")))
        .select(
            *groups, "__bucket", "__cut", (F.col("__rank") - F.col("__upto") + F.col("__n")).alias("__need")
        )
    )
    groups_bound = max_groups if by else 1
    if groups_bound is not None and groups_bound * len(cuts) <= MAX_BROADCAST_EDGES:
        edges = F.broadcast(edges)
    keys = [*groups, "__bucket"]
    inside = W.partitionBy(*keys, "__cut").orderBy("__h", "__k")
    found = (
        join_null_safe(hashed, edges, keys)
        .withColumn("__rn", F.row_number().over(inside))
        .filter(F.col("__rn") == F.col("__need"))
    )
    place = F.struct(F.col("__h").alias("h"), F.col("__k").alias("k"))
    return found.groupBy(*groups).agg(
        *(F.max(F.when(F.col("__cut") == name, place)).alias(name) for name in cuts)
    )


def place_of(key: str, salt: str | int) -> Column:
    """A row's own place in hash order, comparable with the cut structs."""
    return F.struct(order_hash(salt, F.col(key)).alias("h"), F.col(key).alias("k"))
