"""Approximate nearest neighbours: stable projections indexed by a kd-tree.

Every valid vector ``v`` is projected to ``DIMS`` dimensions by a fixed Gaussian
matrix ``A`` (a 2-stable projection): for any two vectors the ratio
``|A(v - w)|**2 / |v - w|**2`` follows a chi-square law with ``DIMS`` degrees of
freedom. The projected points are indexed by a kd-tree whose splits (medians
along the widest side) are fitted on a bounded sample of ``SAMPLE_ROWS``
projected points; every row is then placed in its leaf ("cell").

Search, for every query (the caller's query set, against all rows):

1. Round 1 verifies the query's own cell: the true distances of all its points
   give a k-th nearest distance ``d_k`` (infinite with fewer than k).
2. Stopping test: a point at true distance ``d <= d_k`` lies beyond projected
   radius ``R`` with probability ``1 - F(R**2 / d**2) <= 1 - F(R**2 / d_k**2)``, F
   the chi-square distribution function. With ``R = d_k * sqrt(F^-1(P_TAU))`` the
   test holds once every point within projected distance ``R`` has been verified.
   Round 2 visits the cells whose kd-tree region meets that ball, keeps the
   points within ``R`` in projection and verifies them by their true distance.
   Since ``d_k`` can only fall, the test then holds and the search stops. An
   infinite ``d_k`` visits every cell (exact).

All work is Spark joins over blocks: a cell's points are dealt into blocks of at
most ``BLOCK_ROWS`` rows (salted by id, so one hot cell, a repeated vector for
instance, becomes many blocks) and its queries into chunks of at most
``QUERY_BLOCK``; each (block, chunk) pair is one ``cogroup`` task that computes
exact distances with numpy and returns at most k rows per query; a last window
keeps the k best per query. The tree (``2**depth`` leaves, ``depth`` from the
row count and ``LEAF_ROWS``) is the only broadcast, checked against
``MAX_LEAVES``.

Edge cases: null vectors, vectors with a null or non-finite component, all-zero
vectors and vectors whose length differs from the most common length take no
part (neither as query nor as candidate); a query never meets a row with its own
id; equal distances go to the smaller vec_id; repeated vectors (distance 0) are
found like any other; empty input gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import stored

DIMS = 8  # projected dimensions (even, see chi2_quantile)
P_TAU = 0.99  # probability of the stopping test
LEAF_ROWS = 2_000  # points per kd-tree leaf, on average
SAMPLE_ROWS = 100_000  # the kd-tree's splits are fitted on at most this many rows
BLOCK_ROWS = 4_096  # points in one verification task
QUERY_BLOCK = 512  # queries in one verification task
MAX_LEAVES = 1 << 20
TOP = 10
SEED = 42

_OUT = "query_id long, vec_id long, score double"


def chi2_cdf(m: int, x: float) -> float:
    """Chi-square distribution function for an even number ``m`` of degrees of freedom."""
    if x <= 0:
        return 0.0
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, m // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def chi2_quantile(m: int, p: float) -> float:
    lo, hi = 0.0, 1.0
    while chi2_cdf(m, hi) < p:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(m, mid) < p else (lo, mid)
    return hi


def valid_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, vec)`` of the rows that take part, ``vec`` as doubles."""
    v = F.col(vector)
    ok = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    ok = ok & F.exists(v, lambda x: x != 0)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.cast("array<double>").alias("vec")).filter(ok)
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").head(1)
    if not sizes:
        return rows
    return rows.filter(F.size("vec") == sizes[0]["n"])


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((DIMS, dim))


def fit_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Split dimension and threshold of every inner node, heap order (children of i: 2i+1, 2i+2)."""
    inner = (1 << depth) - 1
    dims, cuts = np.zeros(inner, dtype=np.int64), np.zeros(inner)
    parts = [sample]
    for node in range(inner):
        points = parts[node]
        if len(points):
            dims[node] = int(np.argmax(points.max(0) - points.min(0)))
            cuts[node] = float(np.median(points[:, dims[node]]))
        side = points[:, dims[node]] <= cuts[node] if len(points) else np.zeros(0, bool)
        parts += [points[side], points[~side]]
    return dims, cuts


def leaf_of(proj: np.ndarray, dims: np.ndarray, cuts: np.ndarray, depth: int) -> np.ndarray:
    node = np.zeros(len(proj), dtype=np.int64)
    for _ in range(depth):
        right = proj[np.arange(len(proj)), dims[node]] > cuts[node]
        node = 2 * node + 1 + right
    return node - ((1 << depth) - 1)


def leaves_in_ball(q: np.ndarray, radius: float, dims: np.ndarray, cuts: np.ndarray, depth: int) -> list[int]:
    """Leaves whose tree region meets the ball; the regions are exact, so none is missed."""
    found, stack = [], [(0, np.full(DIMS, -np.inf), np.full(DIMS, np.inf))]
    first_leaf = (1 << depth) - 1
    while stack:
        node, lo, hi = stack.pop()
        gap = np.maximum(np.maximum(lo - q, q - hi), 0.0)
        if math.sqrt(float((gap * gap).sum())) > radius:
            continue
        if node >= first_leaf:
            found.append(node - first_leaf)
            continue
        d, c = dims[node], cuts[node]
        left_hi, right_lo = hi.copy(), lo.copy()
        left_hi[d], right_lo[d] = min(hi[d], c), max(lo[d], c)
        stack += [(2 * node + 1, lo, left_hi), (2 * node + 2, right_lo, hi)]
    return found


def _nearest(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> pd.DataFrame:
    """Exact distances of a block's queries to its points; the k best per query within each radius."""
    if queries.empty or points.empty:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    pv, pp, pid = np.stack(points["vec"].to_numpy()), np.stack(points["proj"].to_numpy()), points["vec_id"].to_numpy()
    out = []
    for start in range(0, len(queries), 32):
        chunk = queries.iloc[start : start + 32]
        qv, qp = np.stack(chunk["vec"].to_numpy()), np.stack(chunk["proj"].to_numpy())
        dist = np.sqrt(((qv[:, None, :] - pv[None, :, :]) ** 2).sum(-1))
        near = np.sqrt(((qp[:, None, :] - pp[None, :, :]) ** 2).sum(-1)) <= chunk["radius"].to_numpy()[:, None]
        for row, qid in enumerate(chunk["query_id"].to_numpy()):
            keep = near[row] & (pid != qid)
            ids, d = pid[keep], dist[row][keep]
            order = np.lexsort((ids, d))[:k]
            out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[order], "score": d[order]}))
    return pd.concat(out, ignore_index=True)


def _blocks(points: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    """Verify ``requests`` (query_id, vec, proj, radius, cell) against the points of their cells."""
    per_cell = points.groupBy("cell").agg(F.count(F.lit(1)).alias("n_points"))
    asked = requests.groupBy("cell").agg(F.count(F.lit(1)).alias("n_queries"))
    # Block keys are ints on both sides: the two sides of the cogroup must hash them alike.
    sizes = per_cell.join(asked, "cell").select(
        "cell", F.ceil(F.col("n_points") / BLOCK_ROWS).cast("int").alias("parts"),
        F.ceil(F.col("n_queries") / QUERY_BLOCK).cast("int").alias("chunks"),
    )
    sizes = F.broadcast(sizes)  # one row per cell, at most MAX_LEAVES
    salt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    p = points.join(sizes, "cell").select(
        "cell", salt("vec_id", "parts").alias("part"), F.explode(F.sequence(F.lit(0), F.col("chunks").cast("int") - 1)).alias("chunk"),
        "vec_id", "vec", "proj",
    )
    q = requests.join(sizes, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part"), salt("query_id", "chunks").alias("chunk"),
        "query_id", "vec", "proj", "radius",
    )
    keys = ["cell", "part", "chunk"]
    return q.groupBy(*keys).cogroup(p.groupBy(*keys)).applyInPandas(lambda a, b: _nearest(a, b, k), _OUT)


def search(df: DataFrame, is_query, k: int = TOP, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows (Euclidean, doubles) of every query row: ``(query_id, rank, vec_id, score)``.

    ``is_query`` is a Column over ``vec_id`` naming the query rows. See the module
    for the method, its stopping test and the edge cases.
    """
    spark = df.sparkSession
    rows = valid_vectors(df, vec_id, vector)
    first = rows.head(1)
    if not first:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    a = projection(len(first[0]["vec"]))

    def project(batches):
        for b in batches:
            v = np.stack(b["vec"].to_numpy()) if len(b) else np.zeros((0, a.shape[1]))
            yield b.assign(proj=list(v @ a.T))

    projected = stored(rows.mapInPandas(project, "vec_id long, vec array<double>, proj array<double>"), "projected")
    n = projected.count()
    depth = max(0, math.ceil(math.log2(max(n / LEAF_ROWS, 1))))
    if (1 << depth) > MAX_LEAVES:
        raise ValueError(f"{n} rows need more than {MAX_LEAVES} leaves; raise LEAF_ROWS")
    fraction = min(1.0, SAMPLE_ROWS / n)
    sample = np.array([r["proj"] for r in projected.sample(fraction=fraction, seed=SEED).select("proj").collect()])
    dims, cuts = fit_tree(sample.reshape(-1, DIMS), depth)

    def place(batches):
        for b in batches:
            p = np.stack(b["proj"].to_numpy()) if len(b) else np.zeros((0, DIMS))
            yield b.assign(cell=leaf_of(p, dims, cuts, depth).astype("int32"))

    points = stored(projected.mapInPandas(place, "vec_id long, vec array<double>, proj array<double>, cell int"), "cells")
    queries = stored(points.filter(is_query(F.col("vec_id"))).withColumnRenamed("vec_id", "query_id"), "queries")
    own = _blocks(points, queries.withColumn("radius", F.lit(float("inf"))), k)
    own = stored(own, "own_cell")
    kth = own.withColumn("__r", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")))
    d_k = kth.filter(F.col("__r") == k).select("query_id", F.col("score").alias("d_k"))
    scale = math.sqrt(chi2_quantile(DIMS, P_TAU))
    with_r = queries.join(d_k, "query_id", "left").select(
        "query_id", "proj", "cell", (F.coalesce("d_k", F.lit(float("inf"))) * scale).alias("radius")
    )

    def reach(batches):
        for b in batches:
            cells, ids, radii = [], [], []
            for qid, proj, own_cell, r in zip(b["query_id"], b["proj"], b["cell"], b["radius"]):
                for leaf in leaves_in_ball(np.asarray(proj), r, dims, cuts, depth):
                    if leaf != own_cell:
                        cells.append(leaf), ids.append(qid), radii.append(r)
            yield pd.DataFrame({"query_id": ids, "cell": cells, "radius": radii}).astype(
                {"query_id": "int64", "cell": "int32", "radius": "float64"}
            )

    reached = with_r.mapInPandas(reach, "query_id long, cell int, radius double")
    further = _blocks(points, reached.join(queries.select("query_id", "vec", "proj"), "query_id"), k)
    found = own.unionByName(further)
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
