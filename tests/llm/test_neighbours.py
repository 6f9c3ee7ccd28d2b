import numpy as np
import pyarrow.parquet as pq
import pytest

from colloquy.llm import neighbours as nn


def brute_force(rows, is_query, k=10):
    ok = [(i, np.array(v, float)) for i, v in rows
          if v is not None and all(x is not None for x in v) and np.all(np.isfinite(np.array(v, float))) and np.any(np.array(v, float) != 0)]
    out = {}
    for q, qv in ok:
        if not is_query(q):
            continue
        d = sorted((float(np.sqrt(((qv - v) ** 2).sum())), i) for i, v in ok if i != q)[:k]
        out[q] = d
    return out


@pytest.fixture
def small_tree(monkeypatch):
    """Many cells, blocks and query chunks on a small table."""
    monkeypatch.setattr(nn, "LEAF_ROWS", 60)
    monkeypatch.setattr(nn, "BLOCK_ROWS", 25)
    monkeypatch.setattr(nn, "QUERY_BLOCK", 3)


def clustered(n, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 4, (12, dim))
    return [(i, [float(x) for x in centres[i % 12] + rng.normal(0, 1, dim)]) for i in range(n)]


def test_recall_against_brute_force(spark, small_tree):
    rows = clustered(1500)
    rows += [(1500 + i, rows[7][1]) for i in range(300)]  # a hot, repeated vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nn.search(df, lambda v: v % 20 == 0).collect()
    want = brute_force(rows, lambda v: v % 20 == 0)
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = sum(len({v for _, v, _ in found.get(q, [])} & {i for _, i in w}) for q, w in want.items())
    assert hits / sum(len(w) for w in want.values()) >= 0.95
    for q, rs in found.items():
        rs.sort()
        assert [r[0] for r in rs] == list(range(1, len(rs) + 1)) and len(rs) == 10
        exact = dict((i, d) for d, i in brute_force([(q, dict(rows)[q])] + [x for x in rows if x[0] != q], lambda v: v == q, 10**6)[q])
        assert all(abs(exact[v] - s) <= 1e-12 * max(1, s) for _, v, s in rs)
        assert [s for _, _, s in rs] == sorted(s for _, _, s in rs)


@pytest.mark.parametrize("blocks", [(4096, 512), (40, 2)])
def test_exact_on_the_given_table(spark, monkeypatch, blocks):
    """One leaf holds all rows, so the search is exact; small blocks deal it into many block pairs.

    Partitions are not coalesced here, so the two sides of a block must hash their keys alike.
    """
    from tests.conftest import SF_DIR

    monkeypatch.setattr(nn, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(nn, "QUERY_BLOCK", blocks[1])
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = nn.search(spark.read.parquet(f"{SF_DIR}/embeddings.parquet"), lambda v: v % 100 == 0).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute_force(rows, lambda v: v % 100 == 0)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == sorted(
        (q, k + 1, i) for q, w in want.items() for k, (_, i) in enumerate(w)
    )


def test_invalid_vectors_ties_and_empty(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
        (6, [None, 1.0]), (7, [float("inf"), 1.0]), (8, [1.0, 0.0, 3.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("query_id", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(5))
    got = sorted(tuple(r) for r in nn.search(df, lambda v: v % 10 == 0).collect())
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 1), (0, 2, 10), (0, 3, 2), (0, 4, 9), (10, 1, 0), (10, 2, 1), (10, 3, 2), (10, 4, 9)]
    assert nn.search(df.limit(0), lambda v: v % 10 == 0).count() == 0
    assert abs(nn.chi2_quantile(8, 0.99) - 20.0902) < 1e-3
