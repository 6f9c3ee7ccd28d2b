import math
import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import batching, mixing, ranking, runlog


def ids(df, column="id"):
    return sorted(r[column] for r in df.select(column).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """A group with a third of all rows, and small ones."""
    return spark.range(0, 3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 40).alias("g")).cache()


@pytest.mark.parametrize("digits", [1, 4])
def test_hash_rank(skewed, digits):
    got = ranking.hash_rank(skewed, "id", 7, ["g"], digits=digits).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in groups.values()) and len(got) == 3000


@pytest.mark.parametrize("ranges", [2, 16, 300])
def test_ordinal_rank(skewed, ranges):
    got = ranking.ordinal_rank(skewed, "id", ["g"], ranges=ranges).orderBy("g", "id").collect()
    seen = {}
    for r in got:
        seen[r["g"]] = seen.get(r["g"], 0) + 1
        assert r["rank"] == seen[r["g"]]


def test_ranks_keep_null_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id bigint, g string")
    assert ids(ranking.hash_rank(df, "id", 1, ["g"]), "rank") == [1, 1, 2]


@pytest.mark.parametrize("n", [0, 1, 137, 3000, 5000])
def test_take_n(skewed, n):
    first = ids(mixing.take_n(skewed, n, "id"))
    assert len(first) == min(n, 3000)
    assert first == ids(mixing.take_n(skewed.repartition(13), n, "id"))
    if n == 137:
        assert first != ids(mixing.take_n(skewed, n, "id", seed=43))


@pytest.mark.parametrize("n, test, val", [(0, 0, 0), (1, 1, 0), (10, 1, 0), (25, 1, 0), (50, 1, 1), (81_690, 1634, 1634)])
def test_split_sizes(spark, n, test, val):
    split = mixing.split_keep_ratios(spark.range(n))
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    held = math.ceil((0.02 + 0.02) * n)
    assert held == test + val
    assert sizes == {k: v for k, v in (("test", test), ("val", val), ("train", n - held)) if v}


def test_split_is_complete_and_independent_of_partitions(skewed):
    a = {r["id"]: r["split"] for r in mixing.split_dataset(skewed).collect()}
    b = {r["id"]: r["split"] for r in mixing.split_dataset(skewed.repartition(5)).collect()}
    assert a == b and len(a) == 3000


def test_caps_and_split_are_unrelated(spark):
    """Rows that a cap kept are not more likely to be held out."""
    df = spark.range(0, 20_000).withColumn("source", F.when(F.col("id") < 10_000, "a").otherwise("b"))
    kept = mixing.cap_sources(df, {"a": 1000}, "id")
    split = mixing.split_dataset(kept, 0.25, 0.25)
    held = split.filter((F.col("source") == "a") & (F.col("split") != "train")).count()
    assert 430 < held < 570


def test_balance_by_targets(spark):
    sizes = {"above": 500, "exact": 200, "below": 50, "free": 90, "none": 30}
    sets, start = {}, 0
    for name, n in sizes.items():
        sets[name] = spark.range(start, start + n)
        start += n
    targets = {"above": 120, "exact": 200, "below": 1000, "none": 0}
    got = mixing.balance_by_targets(sets, targets, "id", shuffled=True).collect()
    counts = {}
    for r in got:
        counts[r["source"]] = counts.get(r["source"], 0) + 1
    assert counts == {"above": 120, "exact": 200, "below": 50, "free": 90}
    again = ids(mixing.balance_by_targets({k: v.repartition(3) for k, v in sets.items()}, targets, "id"))
    assert sorted(r["id"] for r in got) == again


def test_selection_does_not_shuffle_rows(spark, tmp_path):
    spark.range(0, 1000).withColumn("payload", F.repeat(F.lit("x"), 100)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = mixing.split_keep_ratios(df)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchanges and not any("payload" in line for line in plan.split("Subquery")[0].splitlines() if "Exchange" in line)


@pytest.mark.parametrize("n", [5, 40, 1000])
def test_length_grouped_batches(spark, n):
    df = spark.range(n).withColumn("size", (F.col("id") * 37) % 101)
    got = batching.length_grouped_batches(df, "id", "size", 4).collect()
    batches = {}
    for r in got:
        batches.setdefault(r["batch_id"], []).append((r["batch_pos"], r["size"]))
    assert sorted(batches) == list(range(math.ceil(n / 4)))
    for batch_id, rows in batches.items():
        rows.sort()
        assert [p for p, _ in rows] == list(range(len(rows)))
        assert [s for _, s in rows] == sorted((s for _, s in rows), reverse=True)
        assert len(rows) == 4 or batch_id == max(batches)


def test_collate(spark):
    df = spark.createDataFrame([(1, 0, [5, 9], [1, 1]), (2, 0, [7, 8, 9], [1, 1, 1]), (3, 1, [9], [1])],
                               "id int, batch_id int, input_ids array<int>, attention_mask array<int>")
    got = {r["id"]: (r["input_ids"], r["attention_mask"], r["labels"]) for r in batching.collate(df, 9).collect()}
    assert got == {
        1: ([5, 9, 9], [1, 1, 0], [5, -100, -100]),
        2: ([7, 8, 9], [1, 1, 1], [7, 8, -100]),
        3: ([9], [1], [-100]),
    }


def stops(values, patience):
    best, waited = None, 0
    for step, value in values:
        if best is None or value < best:
            best, waited = value, 0
        else:
            waited += 1
        if waited >= patience:
            return step
    return None


@pytest.mark.parametrize("width", [1, 7, 1 << 20])
def test_early_stop_step(spark, width):
    rng = random.Random(3)
    runs = {r: [(s * 5, rng.randrange(max(1, 60 - s))) for s in range(60)] for r in range(12)}
    runs[12] = [(s, 100 - s) for s in range(200)]  # never stops
    runs[13] = [(s, 1) for s in range(2)]
    rows = [(r, s, float(v)) for r, log in runs.items() for s, v in log]
    df = spark.createDataFrame(rows, "run_id int, step int, value double")
    got = {r["run_id"]: r["stop_step"] for r in runlog.early_stop_step(df, width=width, metric=None).collect()}
    want = {r: stops(log, 3) for r, log in runs.items()}
    assert got == {r: s for r, s in want.items() if s is not None}


def test_run_summaries(spark):
    df = spark.createDataFrame([(1, 10, 2.0), (1, 20, 1.0), (1, 30, 1.0), (2, 5, None)], "run_id int, step int, value double")
    assert [tuple(r) for r in runlog.best_checkpoint(df, metric=None).collect()] == [(1, 20, 1.0)]
    both = df.withColumn("metric", F.lit("eval_loss")).union(df.select("run_id", "step", -F.col("value"), F.lit("lr")))
    assert [tuple(r) for r in runlog.best_checkpoint(both).collect()] == [(1, 20, 1.0)]
    assert [tuple(r) for r in runlog.best_checkpoint(both, metric="lr", greater_is_better=True).collect()] == [(1, 20, -1.0)]
    loss = spark.createDataFrame([(1, 1.0, 3), (1, 2.0, 1), (2, None, 4)], "run_id int, loss double, n int")
    got = {r["run_id"]: r["perplexity"] for r in runlog.perplexity(loss, ["run_id"], weight="n").collect()}
    assert got[1] == pytest.approx(math.exp(1.25)) and math.isnan(got[2])
    plain = {r["run_id"]: r["perplexity"] for r in runlog.perplexity(loss, ["run_id"]).collect()}
    assert plain[1] == pytest.approx(math.exp(1.5)) and math.isnan(plain[2])


def test_sparse_orders_are_cut_evenly(spark):
    """Time stamps of one hot group: no window holds more than a few ranges' share."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("g"),
        (F.lit(1_700_000_000_000) + F.col("id") * F.col("id") * 1000).alias("at"),
    )
    ranked = ranking.ordinal_rank(df, "at", ["g"], ranges=64).orderBy("g", "at").collect()
    for group in ("hot", "cold"):
        own = [r["rank"] for r in ranked if r["g"] == group]
        assert own == list(range(1, len(own) + 1))
    shares = [i / 64 for i in range(1, 64)]
    bounds = df.agg(F.percentile_approx("at", shares, 6400)).first()[0]
    largest = df.groupBy(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("at")))).count()
    assert max(r["count"] for r in largest.collect()) < 2 * 20_000 / 64


def test_null_keys_are_an_error(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    with pytest.raises(Exception, match="null key"):
        mixing.take_n(df, 1, "id").collect()


def test_positions_come_from_counts_of_files(spark, tmp_path):
    from colloquy.catalog.queries import read_with_position

    path = str(tmp_path / "rows")
    spark.range(0, 5000, 1, 7).write.parquet(path)
    got = read_with_position(spark, path, "id")
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(i, i + 1) for i in range(5000)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "__n" in plan.split("Window", 1)[1].splitlines()[0]
