"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.session import scratch_path

FILTER_BITS = 1 << 24  # fixed size of the filter that is sent to the tasks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it from there.

    Later jobs read the files, so a lost executor costs no recomputation of what
    stands before, and the planner knows the true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read._stored_at = path
    return read


def discard(df: DataFrame) -> None:
    """Delete the files of a result of ``stored`` that nothing reads any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def id_filter(ids: DataFrame, bits: int) -> np.ndarray:
    """A filter of fixed size that passes every document of ``ids`` (one column) and some others."""
    hashed_id = F.xxhash64(ids.columns[0])
    bit = F.pmod(hashed_id, F.lit(bits))
    place = F.pmod(hashed_id, F.lit(32)).cast("int")
    words = ids.select(F.floor(bit / 32).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), place).alias("bit"))
    filled = np.zeros(bits // 32, dtype=np.int64)
    for word, value in words.groupBy("word").agg(F.bit_or("bit")).collect():  # bits / 32 rows at most
        filled[word] = value
    return filled.astype(np.uint32)


def numbered(docs: DataFrame, bits: int) -> DataFrame:
    """``(doc_id, text, bit)`` of the documents that have an id; the bit is their place in a filter."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.filter("doc_id IS NOT NULL").withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(bits)))


def in_filter(filled: np.ndarray, bit: pa.Array) -> np.ndarray:
    at = np.asarray(bit.to_pylist(), dtype=np.int64)
    return ((filled[at // 32] >> (at % 32).astype(np.uint32)) & np.uint32(1)).astype(bool)


def bit_sums(h: Column) -> list[Column]:
    """32 sums over a group of 64-bit hashes: bit ``i`` is counted in the lower
    half of sum ``i % 32`` when ``i < 32`` and in its upper half otherwise.

    A half holds counts up to 2**32, so no carry reaches the other.
    """
    lanes = F.lit((1 << 32) | 1)
    return [F.sum(F.shiftrightunsigned(h, i).bitwiseAND(lanes)).alias(f"__s{i}") for i in range(32)]


def bit_count(i: int) -> Column:
    """How often bit ``i`` was set, from ``bit_sums``."""
    low = F.col(f"__s{i % 32}")
    return low.bitwiseAND(F.lit((1 << 32) - 1)) if i < 32 else F.shiftrightunsigned(low, 32)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node reachable from every node that has an edge.

    ``edges`` has two columns of one orderable type. Each round hooks every node
    to its smallest neighbour if that is smaller, follows the hooks to their end,
    and replaces the edges by those between the ends; at least half of the nodes
    that still have edges go in a round. Rounds are written to the scratch folder,
    nothing is collected. An edge from a node to itself makes it its own root;
    edges with a null end are left out.
    """
    a, b = edges.columns
    known = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    left = stored(known.select(*_ordered(a, b)).distinct(), "edges")
    roots = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("root", F.col("node"))
    left = left.filter(F.col("a") < F.col("b"))
    while left.head(1):
        both = left.union(left.select("b", "a"))
        hooks = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("up")), "hooks")
        while True:
            further = hooks.select(F.col("a").alias("up"), F.col("up").alias("next"))
            jumped = stored(hooks.join(further, "up").select("a", "up", "next"), "hooks")
            hooks = jumped.select("a", F.col("next").alias("up"))
            if not jumped.filter(F.col("up") != F.col("next")).head(1):
                break
        roots = roots.join(hooks.withColumnRenamed("a", "root"), "root", "left").select(
            "node", F.coalesce("up", "root").alias("root")
        )
        roots = stored(roots, "roots")
        moved = left.join(hooks.select("a", F.col("up").alias("x")), "a").join(
            hooks.select(F.col("a").alias("b"), F.col("up").alias("y")), "b"
        )
        left = stored(
            moved.filter(F.col("x") != F.col("y")).select(*_ordered("x", "y")).distinct(), "edges"
        )
    return roots


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]
