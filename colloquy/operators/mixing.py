"""Sampling, mixing, shuffling and splitting, exact and repeatable.

The permutation depends only on the seed and the row keys: not on partitioning,
file order or the number of executors. Sampling and splitting compare each row
with a cut-off (see ``ranking``), so the rows themselves are never shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.constants import SEED
from colloquy.operators.ranking import hash_cutoffs, order_hash, place_of
from colloquy.operators.rows import add_source

# Cut-off tables have one row per target; beyond this many the join is left to
# the planner instead of being broadcast.
MAX_BROADCAST_TARGETS = 10_000


def take_n(df: DataFrame, n: int, key: str, seed: int = SEED) -> DataFrame:
    """A random ``min(n, rows)`` rows."""
    if n <= 0:
        return df.filter(F.lit(False))
    cut = hash_cutoffs(df, key, seed, {"cut": lambda total: F.least(F.lit(n), total)})
    return df.filter(place_of(key, seed) <= cut.select("cut").scalar())


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Concatenation by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, dfs)


def shuffle(df: DataFrame, key: str, seed: int = SEED, partitions: int | None = None) -> DataFrame:
    """Rows in seeded random order: partition by partition, row by row.

    The order is ``(md5(seed:key), key)``. The hash is uniform, so its first eight
    hex digits name the row's partition directly: partition ``p`` of ``n`` holds the
    hashes in ``[p, p + 1) * 2**32 / n``. One hash exchange and a sort inside each
    partition give the global order, with no sampling pass over the child (which an
    ``orderBy`` would run a second time to find range bounds). Written files keep
    the order in their part numbers. ``partitions`` defaults to
    ``spark.sql.shuffle.partitions``. Rows with equal keys stay together, in no
    particular order among themselves; a null key is an error.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    h = order_hash(seed, F.col(key))
    prefix = F.conv(F.substring("__order", 1, 8), 16, 10).cast("long")
    part = F.shiftright(prefix * F.lit(n), 32).cast("int")
    return df.withColumn("__order", h).repartitionById(n, part).sortWithinPartitions("__order", key).drop("__order")


def source_cutoffs(
    df: DataFrame, targets: Mapping[str, int], key: str, seed: int = SEED, source: str = "source"
) -> DataFrame:
    """The last row to keep of every source above its target: ``(source, cap)``.

    Only the ``source`` and ``key`` columns are read.
    """
    limits = {name: max(n, 0) for name, n in targets.items()}
    limit_of = F.create_map(*(F.lit(x) for pair in limits.items() for x in pair))
    capped = df.select(source, key).filter(F.col(source).isin(list(limits)))
    return hash_cutoffs(
        capped, key, seed, {"cap": lambda _: limit_of[F.col(source)]}, by=source, max_groups=len(limits)
    )


def apply_cutoffs(
    df: DataFrame, cutoffs: DataFrame, targets: Mapping[str, int], key: str, seed: int = SEED, source: str = "source"
) -> DataFrame:
    """Keep the rows up to their source's cut-off; sources without one stay whole."""
    nothing = [name for name, n in targets.items() if n <= 0]
    if nothing:
        df = df.filter(~F.coalesce(F.col(source).isin(nothing), F.lit(False)))
    ends = cutoffs.select(F.col(source).alias("__source"), F.col("cap").alias("__cap"))
    if len(targets) <= MAX_BROADCAST_TARGETS:
        ends = F.broadcast(ends)
    joined = df.join(ends, F.col(source) == F.col("__source"), "left")
    return joined.filter(F.col("__cap").isNull() | (place_of(key, seed) <= F.col("__cap"))).drop("__source", "__cap")


def cap_one_source(
    df: DataFrame, name: str, cutoffs: DataFrame, targets: Mapping[str, int], key: str, seed: int = SEED
) -> DataFrame:
    """``apply_cutoffs`` for rows of a single source that need no ``source`` column.

    The cut-off is one value, so rows are dropped right above the scan, before
    any work is done on them.
    """
    if targets.get(name, 1) <= 0:
        return df.filter(F.lit(False))
    cap = cutoffs.filter(F.col("source") == name).select("cap").scalar()
    return df.filter(F.coalesce(place_of(key, seed) <= cap, F.lit(True)))


def cap_sources(
    df: DataFrame, targets: Mapping[str, int], key: str, seed: int = SEED, source: str = "source"
) -> DataFrame:
    """Keep a random ``targets[source]`` rows of each source.

    A source below its target, or without one, is kept whole; nothing is
    upsampled.
    """
    if not targets:
        return df
    return apply_cutoffs(df, source_cutoffs(df, targets, key, seed, source), targets, key, seed, source)


def balance_by_targets(
    dsets: Mapping[str, DataFrame], targets: Mapping[str, int], key: str, seed: int = SEED, shuffled: bool = True
) -> DataFrame:
    """Label every corpus with its name, cap each at its target, and mix.

    The result is in random order, which costs a sort of all rows; ``shuffled=False``
    leaves it out.
    """
    mixed = union_all([add_source(df, name) for name, df in dsets.items()])
    capped = cap_sources(mixed, targets, key, seed)
    return shuffle(capped, key, f"{seed}:mix") if shuffled else capped


def split_limits(df: DataFrame, held_out: float, test_share: float, key: str, seed: int = SEED) -> DataFrame:
    """One row: the last row of the test split and the last of all held-out rows.

    Only the ``key`` column is read.
    """

    def n_held_out(total: Column) -> Column:
        return F.ceil(F.lit(held_out) * total)

    def n_test(total: Column) -> Column:
        return F.ceil(F.lit(test_share) * n_held_out(total))

    cuts = hash_cutoffs(df.select(key), key, _split_salt(seed), {"test": n_test, "held_out": n_held_out})
    return cuts.select(F.struct("test", "held_out").alias("limits"))


def apply_split(df: DataFrame, limits: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Add ``split`` by comparing each row with the one row of ``limits``."""
    place, last = place_of(key, _split_salt(seed)), limits.scalar()
    return df.withColumn(
        "split", F.when(place <= last["test"], "test").when(place <= last["held_out"], "val").otherwise("train")
    )


def _split_salt(seed: int) -> str:
    # Not the salt of the caps: a row kept by its cap has a low place there.
    return f"{seed}:split"


def held_out_shares(val: float, test: float) -> tuple[float, float]:
    """Share of rows held out, and the test split's share of those."""
    return val + test, test / (val + test)


def split_keep_ratios(
    df: DataFrame, val: float = 0.02, test: float = 0.02, key: str = "id", seed: int = SEED
) -> DataFrame:
    """Add ``split``: train, val or test, with exact sizes.

    ``ceil((val + test) * n)`` rows are held out and ``ceil(test / (val + test))``
    of those are the test split. Not stratified.
    """
    return apply_split(df, split_limits(df, *held_out_shares(val, test), key, seed), key, seed)


def split_dataset(
    df: DataFrame, val_size: float = 0.025, test_size: float = 0.025, key: str = "id", seed: int = SEED
) -> DataFrame:
    """The same split with the test share written as ``1 - val / (val + test)``."""
    held_out = val_size + test_size
    return apply_split(df, split_limits(df, held_out, 1 - val_size / held_out, key, seed), key, seed)


def mix_and_split(
    dfs: Sequence[DataFrame], raw_path: str, val_size: float = 0.025, test_size: float = 0.025, key: str = "id",
    seed: int = SEED, force_ascii: bool = False,
) -> DataFrame:
    """Concatenate, write a shuffled raw copy as JSON lines, and split the rest."""
    from colloquy.sources.writers import write_jsonl

    mixed = union_all(dfs)
    write_jsonl(shuffle(mixed, key, seed), raw_path, force_ascii=force_ascii)
    return split_dataset(mixed, val_size, test_size, key, seed)
