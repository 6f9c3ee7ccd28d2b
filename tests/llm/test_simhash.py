import random

import pytest
import xxhash
from pyspark.sql import functions as F

from colloquy.llm import simhash
from colloquy.llm.common import components, table
from tests.conftest import SF_DIR


def print_of(text, n=3):
    words = [w for w in __import__("re").split(r"[ \t-\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(nodes, linked):
    """Smallest reachable node of every node, by repeated search."""
    root = {}
    for start in sorted(nodes):
        todo = [start]
        while todo:
            node = todo.pop()
            if node not in root:
                root[node] = start
                todo += [o for o in nodes if o not in root and linked(node, o)]
    return root


def test_query_equals_brute_force(spark, documents):
    prints = {d["doc_id"]: print_of(d["text"]) for d in documents}
    want = grouped(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = simhash.near_components(table(spark, SF_DIR, "documents")).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {
        (i, f"{p:016x}", want[i]) for i, p in prints.items()
    }
    assert len(got) == len(documents)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_of_crowded_blocks(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 150:
        prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    prints |= {rng.getrandbits(64) for _ in range(50)}
    rows = [(signed(p), i) for i, p in enumerate(sorted(prints))]
    ids = dict((i, p) for p, i in rows)
    mask = (1 << 64) - 1
    want = grouped(ids, lambda a, b: ((ids[a] ^ ids[b]) & mask).bit_count() <= 2)
    df = spark.createDataFrame(rows, "fp bigint, id bigint")
    for shard_rows in (5, 1000):
        roots = dict(components(simhash.link_fingerprints(df, 2, shard_rows)).collect())
        assert {i: roots.get(i, i) for i in ids} == want


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(i, i + 1) for i in range(2000, 2100)]
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    df = spark.createDataFrame([*pairs, (7, None), (None, 7)], "a bigint, b bigint")
    assert dict(components(df).collect()) == grouped(near, lambda a, b: b in near[a])
    assert components(df.limit(0)).count() == 0


def test_odd_rows(odd, no_rows):
    got = [tuple(r) for r in simhash.near_components(odd).collect()]
    assert len(got) == 9
    assert sorted(c for i, _, c in got if i in (1, 2)) == [1, 1, 1]
    assert {c for i, f, c in got if i in (3, 4)} == {3}
    assert [c for i, _, c in got if i is None] == [None, None]
    assert simhash.near_components(no_rows).count() == 0


def test_one_of_each_keeps_what_is_no_copy(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = [rng.choices(vocabulary, k=200) for _ in range(30)]
    texts = [" ".join(w) for w in base]
    near = []
    for words in base[:10]:
        for _ in range(4):
            changed = list(words)
            for at in rng.sample(range(200), 2):
                changed[at] = "changed"
            near.append(" ".join(changed))
    rows = list(enumerate([*texts, *near, *texts[:5]]))
    df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id bigint, text string, id int")
    kept = simhash.one_of_each(df)
    assert kept.columns == ["doc_id", "text", "id"]
    assert {r["doc_id"] for r in kept.collect()} == set(range(30))


def test_crowded_trees_stay_connected(spark):
    rng = random.Random(2)
    words = rng.choices([f"w{i}" for i in range(3000)], k=300)
    rows = []
    for i in range(300):
        changed = list(words)
        changed[rng.randrange(300)] = f"c{i}"
        rows.append((i, " ".join(changed)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["component_id"] for r in simhash.near_copies(df, shard_rows=100).collect()} == {0}


@pytest.mark.parametrize("shard_rows", [40, 2000])
def test_copies_of_one_original_that_are_no_copies_of_each_other(spark, shard_rows):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    words = rng.choices(vocabulary, k=500)
    rows = [(0, " ".join(words))]
    for i in range(1, 200):
        changed = list(words)
        for k, at in enumerate(rng.sample(range(0, 500, 6), 10)):
            changed[at] = f"c{i}x{k}"
        rows.append((i, " ".join(changed)))
    rng.shuffle(rows)
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(496)} for i, t in rows}
    likeness = [len(sets[0] & sets[i]) / len(sets[0] | sets[i]) for i in range(1, 200)]
    assert min(likeness) >= 0.8 > len(sets[1] & sets[2]) / len(sets[1] | sets[2])
    df = spark.createDataFrame([(1000 - i, t) for i, t in rows], "doc_id bigint, text string")  # the original comes last
    got = simhash.near_copies(df, shard_rows=shard_rows).collect()
    assert len(got) == 200 and {r["component_id"] for r in got} == {801}


def test_one_of_each_finds_what_simhash_links(spark):
    """Texts within two bits of each other go, as in ``near_components``, also below the similarity."""
    rng = random.Random(4)
    rows = []
    for i in range(20):
        line = " ".join(f"w{rng.randrange(10**6)}" for _ in range(9))
        rows += [(2 * i + k, " ".join([line] * 60 + [f"x{rng.randrange(10**6)}" for _ in range(12)])) for k in range(2)]
    near = {(2 * i, 2 * i + 1) for i in range(20) if (print_of(rows[2 * i][1]) ^ print_of(rows[2 * i + 1][1])).bit_count() <= 2}
    assert len(near) > 10
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    linked = {r["doc_id"]: r["component_id"] for r in simhash.near_components(df).collect()}
    kept = {r["doc_id"] for r in simhash.one_of_each(df).collect()}
    assert kept == {i for i, c in linked.items() if i == c} and not kept & {b for _, b in near}


def test_copies_whose_lines_repeat_differently(spark):
    """The same distinct shingles but for the seams, in other numbers: fingerprints of all shingles are far apart."""
    rng = random.Random(6)
    rows, far = [], 0
    for i in range(10):
        one, two = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(2))
        texts = [" ".join([one] * 12 + [two] * 2), " ".join([one] * 2 + [two] * 12)]
        far += (print_of(texts[0]) ^ print_of(texts[1])).bit_count() > 22
        rows += [(2 * i + k, t) for k, t in enumerate(texts)]
    assert far
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"] for r in simhash.one_of_each(df).collect()} == set(range(0, 20, 2))


def test_every_text_of_a_repeated_id_is_searched(spark):
    rng = random.Random(7)
    rows = []
    for i in range(12):
        texts = [rng.choices([f"w{k}" for k in range(3000)], k=200) for _ in range(3)]
        rows += [(i, " ".join(words)) for words in texts]
        rows += [(100 + 3 * i + k, " ".join([*words[:-1], "other"])) for k, words in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_copies(df).collect()}
    assert got == {(i, i) for i in range(12)} | {(100 + 3 * i + k, i) for i in range(12) for k in range(3)}


def test_of_a_repeated_id_a_text_stays_that_no_other_has(spark):
    rng = random.Random(8)
    rows, want = [], set()
    for i in range(0, 36, 3):
        one, two = (" ".join(rng.choices([f"w{k}" for k in range(3000)], k=60)) for _ in range(2))
        rows += [(i, two), (i + 1, one), (i + 1, two), (i + 2, one)]
        want |= {(i, two), (i + 1, one)}
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in simhash.one_of_each(df).collect()} == want


@pytest.mark.parametrize("size", [100, 400])
def test_rows_dealt_of_a_crowd_grow_with_it_and_no_faster(spark, size):
    rng = random.Random(size)
    sketches = [rng.randbytes(simhash.SKETCH) for _ in range(size)]
    sketches[1] = sketches[0]
    rows = [(i, 0, bytearray(x)) for i, x in enumerate(sketches)]
    prints = spark.createDataFrame(rows, "id bigint, fp bigint, sketch binary")
    crowded = prints.selectExpr("id", "1L AS shard")
    roots = spark.createDataFrame([], "id bigint, root bigint")
    dealt = [tuple(r) for r in simhash._across(crowded, prints, roots, 10).collect()]
    assert len(dealt) <= 2 * simhash.BANDS * size
    shards = {}
    for shard, turn, i in dealt:
        shards.setdefault(shard, set()).add(i)
    assert sum({0, 1} <= members for members in shards.values()) >= simhash.BANDS


def test_one_of_each_odd_rows(odd, no_rows):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    # 2 copies 1, 4 copies 3 (both empty), 6 is near to 5
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect() if r["doc_id"]) == [(False, i) for i in (1, 3, 5)]
    assert kept.filter(F.col("doc_id").isNull()).count() == 2
    assert simhash.one_of_each(no_rows).count() == 0
