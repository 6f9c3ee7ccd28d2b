"""Summaries of metric logs: ``(run_id, step, metric, value)`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def perplexity_of(loss: str, weight: str | None = None) -> Column:
    """The aggregate behind ``perplexity``, to be combined with others in one pass."""
    if weight is None:
        mean = F.avg(loss)
    else:
        counted = F.when(F.col(loss).isNotNull(), F.col(weight))
        mean = F.sum(F.col(loss) * counted) / F.nullif(F.sum(counted), F.lit(0))
    return F.coalesce(F.exp(mean), F.lit(float("nan")))


def perplexity(
    df: DataFrame, by: Sequence[str] = (), loss: str = "loss", weight: str | None = None
) -> DataFrame:
    """``exp`` of the mean loss, weighted by tokens when ``weight`` is given.

    NaN where a group has no loss.
    """
    return df.groupBy(*by).agg(perplexity_of(loss, weight).alias("perplexity"))


def _of_metric(df: DataFrame, metric: str | None, greater_is_better: bool, value: str) -> DataFrame:
    """The rows of one metric with ``__v``, of which less is better."""
    rows = df if metric is None else df.filter(F.col("metric") == metric)
    return rows.withColumn("__v", -F.col(value) if greater_is_better else F.col(value))


def best_checkpoint(
    df: DataFrame, run: str = "run_id", step: str = "step", value: str = "value", metric: str | None = "eval_loss",
    greater_is_better: bool = False,
) -> DataFrame:
    """The step with the best value of each run, the earliest on ties.

    ``metric`` names the rows that count (None: all, for logs of one metric).
    """
    rows = _of_metric(df, metric, greater_is_better, value).filter(F.col("__v").isNotNull())
    best = F.min(F.struct(F.col("__v").alias("o"), F.col(step).alias("s"), F.col(value).alias("v")))
    return rows.groupBy(run).agg(best.alias("__best")).select(
        run, F.col("__best.s").alias("best_step"), F.col("__best.v").alias("best_value")
    )


def early_stop_step(
    df: DataFrame, run: str = "run_id", step: str = "step", value: str = "value", patience: int = 3,
    width: int = 1 << 20, metric: str | None = "eval_loss", greater_is_better: bool = False,
) -> DataFrame:
    """The first step of each run at which ``patience`` evaluations of ``metric`` in a row
    did not beat the best value before them; runs that never stop have no row.

    Long runs are cut into ranges of ``width`` steps. The best value, the row
    count and the last improvement before a range are carried into it from
    per-range aggregates, so a run is never one task. Steps are unique in a run.
    """
    keys = [run, "__range"]
    rows = _of_metric(df, metric, greater_is_better, value).withColumn(value, F.col("__v"))
    rows = rows.select(run, step, value, F.floor(F.col(step) / width).alias("__range"))
    earlier = W.partitionBy(run).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(*keys).orderBy(step)

    ranges = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(value).alias("__low"))
    carried = ranges.select(
        *keys,
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.min("__low").over(earlier).alias("__best_before"),
    )
    best_so_far = F.least(
        F.col("__best_before"), F.min(value).over(inside.rowsBetween(W.unboundedPreceding, -1))
    )
    judged = (
        rows.join(carried, keys)
        .withColumn("__pos", F.col("__before") + F.row_number().over(inside))
        .withColumn("__best", best_so_far)
        .withColumn(
            "__improved", F.when(F.col("__best").isNull() | (F.col(value) < F.col("__best")), F.col("__pos"))
        )
        .select(*keys, step, "__pos", "__improved")
    )
    improvements = judged.groupBy(*keys).agg(F.max("__improved").alias("__last"))
    carried_improvement = improvements.select(*keys, F.max("__last").over(earlier).alias("__last_before"))
    last = F.greatest(
        F.col("__last_before"), F.max("__improved").over(inside.rowsBetween(W.unboundedPreceding, 0))
    )
    waited = judged.join(carried_improvement, keys).withColumn("__wait", F.col("__pos") - last)
    return waited.filter(F.col("__wait") >= patience).groupBy(run).agg(F.min(step).alias("stop_step"))
