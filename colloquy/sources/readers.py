"""Reading corpora."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colloquy.operators.mixing import union_all


def read_source(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet",
    sample_len: int | None = None, row_id: str | None = None,
) -> DataFrame:
    """One named corpus from a local or shared path, or its first rows in file order.

    ``row_id`` adds a stable unique key (file path and row position in it) to
    corpora that carry none; ``sample_len`` keeps the first rows, files in path
    order. Both work for Parquet (by row index) and for JSON lines and other file
    formats (by ``file_positions``), whatever the split size.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    df = reader.load(path)
    columns = [F.col(c) for c in df.columns]
    if fmt != "parquet" and (row_id is not None or sample_len is not None):
        placed = file_positions(df)
        if row_id is not None:
            columns.append(F.concat_ws("#", "__file", "__row").alias(row_id))
        if sample_len is not None:
            placed = placed.filter(F.col("__position") <= sample_len)
        return placed.select(*columns)
    if row_id is not None:
        columns.append(F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias(row_id))
    if sample_len is None:
        return df.select(*columns)
    return _first_in_file_order(df, sample_len).select(*columns)


def file_positions(df: DataFrame) -> DataFrame:
    """Rows of a file scan with their place: ``__file``, ``__row`` and ``__position``.

    ``__row`` counts lines (records) inside the file from 0; ``__position`` counts
    all rows from 1, files taken in path order. Works for any file format,
    JSON lines included, and for any split size: a task reads whole splits
    (``_metadata.file_block_start``) in order, so the ids that Spark counts up
    inside a task are consecutive within a split. One small row per split
    (its size and first id) is put in order and broadcast; its size grows with
    the number of splits, not with the rows. The scan runs twice, once for these
    counts, with the same splits both times. Empty input gives no rows.
    """
    tagged = df.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"),
    )
    blocks = tagged.groupBy("__file", "__start").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    in_file = W.partitionBy("__file").orderBy("__start").rowsBetween(W.unboundedPreceding, -1)
    overall = W.orderBy("__file", "__start").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        "__file", "__start", "__first",
        F.coalesce(F.sum("__n").over(in_file), F.lit(0)).alias("__in_file"),
        F.coalesce(F.sum("__n").over(overall), F.lit(0)).alias("__before"),
    )
    inside = F.col("__id") - F.col("__first")
    return tagged.join(F.broadcast(offsets), ["__file", "__start"]).select(
        *(F.col(c) for c in df.columns), "__file", (F.col("__in_file") + inside).alias("__row"),
        (F.col("__before") + inside + 1).alias("__position"),
    )


def _first_in_file_order(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of Parquet files taken in path order.

    Row counts per file name the file and position where row ``n`` stands; the
    scan then compares positions. Nothing is sorted, however large ``n`` is.
    """
    here = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, 0))
    end = (
        files.withColumn("upto", upto)
        .filter((F.col("upto") >= n) & (F.col("upto") - F.col("rows") < n))
        .select(F.struct("file", (F.lit(n) - F.col("upto") + F.col("rows")).alias("row")))
    )
    return df.filter(F.coalesce(here < end.scalar(), F.lit(True))) if n > 0 else df.filter(F.lit(False))


def head_slice(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first ``n`` rows in key order, for sources whose order is a column."""
    return df.orderBy(key).limit(n)


def read_jsonl_splits(spark: SparkSession, paths: Mapping[str, str], schema: StructType | str) -> DataFrame:
    """JSON lines files by split name, as one table with a ``split`` column.

    A line that is not valid JSON fails the read.
    """
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    return union_all([reader.json(path).withColumn("split", F.lit(name)) for name, path in paths.items()])
