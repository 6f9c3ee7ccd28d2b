"""Training batches of similar length, and padding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.constants import LABEL_IGNORE, SEED
from colloquy.functions.tokens import pad_right
from colloquy.operators.ranking import hash_rank, join_null_safe


def length_grouped_batches(
    df: DataFrame, key: str, size: str, batch_size: int, seed: int = SEED, mega: int = 50, by: Sequence[str] = ()
) -> DataFrame:
    """Add ``batch_id``, ``batch_pos`` and ``batch_size_max``: random batches of rows of similar size.

    Rows in random order are cut into mega-batches of ``mega`` batches, each
    sorted by falling size and cut into batches. A table too small for four
    mega-batches of that size uses smaller ones, as length-grouped samplers do.
    ``by`` keeps groups, such as splits, apart: each is batched for itself, with its own
    numbers. ``batch_size_max`` is the largest size in the batch.

    Only ``by``, ``key`` and ``size`` are ranked; the rows, however wide, are moved
    once, to be joined with their places. Keys are unique.
    """
    narrow = df.select(*by, key, size)
    totals = narrow.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    fitting = F.floor(F.col("__n") / (batch_size * 4))
    per_mega = F.greatest(F.least(fitting, F.lit(mega)), F.lit(1)).cast("bigint").alias("__per_mega")
    ranked = hash_rank(narrow, key, f"{seed}:batch", by=by, out="__rank")
    sizes = totals.select(*by, per_mega)
    ranked = join_null_safe(ranked, sizes, by) if by else ranked.withColumn("__per_mega", sizes.scalar())
    ranked = ranked.withColumn("__mega", F.floor((F.col("__rank") - 1) / (F.col("__per_mega") * batch_size)))
    # A mega-batch holds at most mega * batch_size rows.
    inside = F.row_number().over(W.partitionBy(*by, "__mega").orderBy(F.desc(size), key)) - 1
    placed = ranked.withColumn("__at", inside).select(
        F.col(key).alias("__key"),
        (F.col("__mega") * F.col("__per_mega") + F.floor(F.col("__at") / batch_size)).alias("batch_id"),
        (F.col("__at") % batch_size).cast("int").alias("batch_pos"),
        # Rows fall in size, so the first of a batch is its largest.
        F.max(size).over(
            W.partitionBy(*by, "__mega", F.floor(F.col("__at") / batch_size))
        ).alias("batch_size_max"),
    )
    return df.join(placed, F.col(key) == F.col("__key")).drop("__key")


def collate(
    df: DataFrame, pad_id: int, batch: str = "batch_id", ids: str = "input_ids", longest: str | None = None
) -> DataFrame:
    """Pad every row to the longest of its batch and add ``labels``.

    Padding has mask 0 and label -100. So has every real token equal to the
    padding token: with padding = end of text, end tokens carry no loss. Where the
    column ``longest`` already has the batch's length, rows are padded where they are.
    """
    width = F.max(F.size(ids)).over(W.partitionBy(batch)) if longest is None else F.col(longest)
    padded = df.withColumn("__len", width).withColumns(
        {
            "attention_mask": pad_right(F.col("attention_mask"), F.col("__len"), 0),
            ids: pad_right(F.col(ids), F.col("__len"), pad_id),
        }
    )
    labels = F.transform(ids, lambda x: F.when(x == pad_id, LABEL_IGNORE).otherwise(x))
    return padded.withColumn("labels", labels).drop("__len")
