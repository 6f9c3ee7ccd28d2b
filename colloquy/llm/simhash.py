"""Operator 7: SimHash near-duplicates, found with BK-trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from colloquy.llm.common import FILTER_BITS, components, id_filter, in_filter, numbered, stored

SEED = 42
BITS = 64
SHARD = 20_000  # fingerprints in one exact tree
DENSE_SHARD = 2_000  # the same for a large radius, where a search visits most of a tree
LEADERS = 64  # documents that every part of an oversized shard has in common
SKETCH = 128
BITS_APART, MARGIN = 28, 0.2  # what near copies are looked up by, see ``near_copies``
TABLES = 8
BANDS, BAND = 16, 2  # pieces of a sketch by which an oversized shard is split, and their bytes


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 of every run of ``n`` words (of all words if there are fewer)."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    runs = zip(*(words[i:] for i in range(n))) if len(words) >= n else [words]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(run), SEED) for run in runs), dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(hashes: np.ndarray) -> int:
    """Signed 64-bit number whose bits are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


class BKTree:
    """Fingerprints, each under a parent by its Hamming distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, new = 0, len(self.values)
        self.values.append(value)
        self.children.append({})
        while new:
            distance = (self.values[at] ^ value).bit_count()
            further = self.children[at].setdefault(distance, new)
            if further == new:
                return
            at = further

    def within(self, value: int, radius: int) -> list[int]:
        """Positions, in order of adding, of the values at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            # Whatever lies under an edge is exactly that far from this value.
            todo += [c for edge, c in self.children[at].items() if abs(edge - distance) <= radius]
        return found


class _Forest:
    def __init__(self):
        self.up: list[int] = []

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def joins(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _tree_links(radius: int):
    """For rows sorted by shard: a spanning forest of the links in every shard.

    A shard of n fingerprints gives at most n - 1 links.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, forest, ids = None, BKTree(), _Forest(), []
        for batch in batches:
            a, b = [], []
            for key, value, doc in zip(*(c.to_pylist() for c in batch.columns)):
                if key != shard:
                    shard, tree, forest, ids = key, BKTree(), _Forest(), []
                value &= (1 << BITS) - 1
                near = tree.within(value, radius)
                here = len(ids)
                forest.up.append(here)
                for other in near:
                    if forest.joins(here, other):
                        a.append(ids[other])
                        b.append(doc)
                tree.add(value)
                ids.append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return search


def _links(rows: DataFrame, radius: int) -> DataFrame:
    dealt = rows.select("shard", "fp", "id").repartition("shard").sortWithinPartitions("shard", "id")
    return dealt.mapInArrow(_tree_links(radius), "a bigint, b bigint").distinct()


def _copy_search(radius: int, similar: float, similarity: float | None = None):
    """For rows sorted by shard and turn ``(shard, turn, id, fp, sketch, root)``: what may be copies, or is.

    A row of turn 0 is only put into the tree, of turn 1 only looked up, of turn 2 both.
    Candidates lie within ``radius`` bits, share ``similar`` of their sketch bytes (corrected for
    chance) and have different roots. Without ``similarity`` the rows ``(shard, turn, id)`` that have or are a candidate
    come back. With it, rows also hold their distinct shingles, sorted; candidates are compared on these, and
    the links ``(a, b)`` that connect whatever is connected come back.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        rows: list = []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:6]]
            own = batch.columns[6] if similarity is not None else None
            for i, row in enumerate(zip(*columns)):
                if rows and row[0] != rows[0][0]:
                    yield rows
                    rows = []
                elif rows and row[:3] == rows[-1][:3]:  # a row of the table that comes twice
                    continue
                rows.append((*row, own[i].values.to_numpy() if own is not None else None))
        if rows:
            yield rows

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in shards(batches):
            tree, forest, first = BKTree(), _Forest(), {}
            roots = np.array([row[5] for row in rows], dtype=np.int64)
            sketches = np.stack([np.frombuffer(row[4], dtype=np.uint8) for row in rows])
            named = np.zeros(len(rows), dtype=bool)
            links = []
            for here, (_, turn, doc, value, _, root, own) in enumerate(rows):
                value &= (1 << BITS) - 1
                forest.up.append(here)
                forest.joins(first.setdefault(root, here), here)
                near = np.array(tree.within(value, radius) if turn else [], dtype=np.int64)
                near = near[roots[near] != root]
                if len(near):
                    same = (sketches[near] == sketches[here]).mean(axis=1)
                    likeness = (same - 1 / 256) / (1 - 1 / 256)
                    near = near[likeness >= similar]
                if len(near) and similarity is None:
                    named[near] = named[here] = True
                elif len(near):
                    apart = [i for i in near.tolist() if forest.top(i) != forest.top(here) and len(rows[i][6])]
                    for other in _alike(own, apart, rows, similarity) if apart and len(own) else []:
                        if forest.joins(here, other):
                            links.append((min(rows[other][2], doc), max(rows[other][2], doc)))
                if turn != 1:  # rows of turn 1 come last, so places in the tree and among the rows agree
                    tree.add(value)
            if similarity is None:
                found = [rows[i][:3] for i in np.flatnonzero(named).tolist()]
                names, types = ["shard", "turn", "id"], [pa.int64(), pa.int32(), pa.int64()]
            else:
                found, names, types = links, ["a", "b"], [pa.int64()] * 2
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names=names)

    return search


def _alike(own: np.ndarray, others: list[int], rows: list, similarity: float) -> list[int]:
    """Those of ``others`` (places in ``rows``) that share ``similarity`` of their distinct shingles with ``own``."""
    sets = [rows[i][6] for i in others]
    sizes = np.array([len(x) for x in sets])
    each = np.concatenate(sets)
    hits = own[np.minimum(np.searchsorted(own, each), len(own) - 1)] == each
    shared = np.add.reduceat(hits.astype(np.int64), np.r_[0, np.cumsum(sizes)[:-1]])
    return np.array(others)[shared >= similarity * (len(own) + sizes - shared)].tolist()


def _sub_shards(rows: DataFrame, width: int, parts: int, level: int) -> tuple[DataFrame, int]:
    """Deal every row to ``parts`` shards, one per block of its remaining bits.

    Fingerprints of one shard that differ in fewer bits than there are blocks
    agree in a whole block, so they meet again in at least one of the new shards.
    """
    size = -(-width // parts)

    def ones(n: int) -> Column:
        return F.lit((1 << n) - 1)

    dealt, left = [], 0
    for part in range(parts):
        start = part * size
        length = min(size, width - start)
        left = max(left, width - length)
        block = F.shiftrightunsigned("rest", start).bitwiseAND(ones(length))
        above = F.shiftrightunsigned("rest", start + length) if start + length < BITS else F.lit(0).cast("bigint")
        rest = F.shiftleft(above, start).bitwiseOR(F.col("rest").bitwiseAND(ones(start)))
        dealt.append(F.struct(F.xxhash64("shard", F.lit(level * 64 + part), block).alias("shard"), rest.alias("rest")))
    exploded = rows.select("fp", "id", F.inline(F.array(*dealt)))
    return exploded, left


def link_fingerprints(prints: DataFrame, radius: int, shard_rows: int = SHARD) -> DataFrame:
    """Links between distinct fingerprints at most ``radius`` bits apart: ``(a, b)``.

    ``prints`` has one row per distinct ``fp`` and an ``id`` for it. Only as many
    links are returned as connect whatever is connected. A tree holds the
    fingerprints that agree in one of ``radius + 1`` blocks, and each fingerprint
    is looked up only in the trees of its own blocks: no link can be elsewhere. A
    block value shared by over ``shard_rows`` fingerprints is dealt out again by
    blocks of the bits that are left, so no tree grows with a hot group.
    """
    parts = radius + 1
    start = prints.select("fp", "id", F.col("fp").alias("rest"), F.lit(0).alias("shard"))
    rows, width = _sub_shards(start, BITS, parts, 0)
    found, level = [], 1
    while True:
        rows = stored(rows, "shards")
        crowded = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard_rows)
        crowded = stored(crowded.select("shard"), "crowded")
        if width < 2 * parts or not crowded.head(1):
            found.append(_links(rows, radius))
            break
        found.append(_links(rows.join(crowded, "shard", "left_anti"), radius))
        rows, width = _sub_shards(rows.join(crowded, "shard", "left_semi"), width, parts, level)
        level += 1
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def simhash(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``: SimHash of the word shingles, repeats included."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(words_of(t.as_py()), shingle)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])

    columns = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return columns.mapInArrow(compute, "doc_id bigint, fp bigint")


def near_components(docs: DataFrame, radius: int = 2, shingle: int = 3, shard_rows: int = SHARD) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Documents are linked when their fingerprints differ in at most ``radius``
    bits; ``component_id`` is the smallest id reachable over links.

    Null or empty text: fingerprint zero, linked like any other. A null id cannot
    name a component: such a row keeps its fingerprint, has a null component and
    links nothing. Rows with one id count as one document of several texts.
    Repeated rows: each returned. No rows: no rows. Other columns are ignored.
    """
    prints = stored(simhash(docs, shingle), "prints")
    named = prints.filter(F.col("doc_id").isNotNull())
    distinct = stored(named.groupBy("fp").agg(F.min("doc_id").alias("id")), "distinct")
    first = named.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).filter("x <> y")
    many = named.join(first.select("doc_id"), "doc_id", "left_semi").join(distinct, "fp").select("doc_id", "id")
    links = link_fingerprints(distinct, radius, shard_rows).union(many)
    roots = components(links).withColumnRenamed("node", "id")
    placed = stored(
        distinct.join(roots, "id", "left").select("fp", F.coalesce("root", "id").alias("component_id")), "placed"
    )
    joined = prints.join(placed, "fp", "left")
    return joined.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def signatures(docs: DataFrame, shingle: int = 3, wide_shingle: int = 5, tables: int = TABLES) -> DataFrame:
    """``(doc_id, copy, fp, wide, mins, sketch)`` per row.

    ``copy`` is a 128-bit hash of the text, ``fp`` its SimHash. ``wide`` is that of the distinct
    ``wide_shingle``-word shingles, ``mins`` are ``tables`` min-hashes of these and ``sketch`` the low
    bytes of ``SKETCH``.
    """
    rng = np.random.default_rng(SEED)
    factors = rng.integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, prints, wides, mins, sketches = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                copies.append(_digest(words))
                prints.append(fingerprint(shingle_hashes(words, shingle)))
                wide = np.unique(shingle_hashes(words, wide_shingle))
                wides.append(fingerprint(wide))
                least = np.full(SKETCH, np.iinfo(np.uint64).max, dtype=np.uint64)
                for at in range(0, len(wide), 2048):
                    mixed = wide[at : at + 2048, None] * factors
                    np.minimum(least, (mixed ^ (mixed >> np.uint64(31))).min(axis=0), out=least)
                mins.append(least[:tables].view(np.int64).tolist())
                sketches.append((least >> np.uint64(20)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(copies, pa.binary()), pa.array(prints, pa.int64()),
                    pa.array(wides, pa.int64()), pa.array(mins, pa.list_(pa.int64())), pa.array(sketches, pa.binary()),
                ],
                names=["doc_id", "copy", "fp", "wide", "mins", "sketch"],
            )

    schema = "doc_id bigint, copy binary, fp bigint, wide bigint, mins array<bigint>, sketch binary"
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(compute, schema)


def _shingle_sets(docs: DataFrame, texts: DataFrame, wide_shingle: int) -> DataFrame:
    """``(id, own)``: distinct shingles, sorted, of ``texts`` (id, copy, doc_id).

    Documents are chosen by a filter of fixed size that passes few others, so their texts are not shuffled.
    """
    passing = docs.sparkSession.sparkContext.broadcast(id_filter(texts.select("doc_id"), FILTER_BITS))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(in_filter(passing.value, batch.column(2))))
            words = [words_of(t.as_py()) for t in some.column(1)]
            own = [np.unique(shingle_hashes(w, wide_shingle).view(np.int64)) for w in words]
            copies = [_digest(w) for w in words]
            columns = [some.column(0), pa.array(copies, pa.binary()), pa.array(own, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "own"])

    each = numbered(docs, FILTER_BITS).mapInArrow(sets, "doc_id bigint, copy binary, own array<bigint>")
    return each.join(texts, ["doc_id", "copy"]).select("id", "own")


def _settled(
    dealt: DataFrame, prints: DataFrame, texts: DataFrame, docs: DataFrame, roots: DataFrame, similarity: float,
    radius: int, margin: float, wide_shingle: int,
) -> DataFrame:
    """``roots`` (id, root) joined by all true links inside the shards of ``dealt``.

    ``dealt`` has keys only (shard, turn, id); ``prints`` (id, fp, sketch) are joined to them. What has a candidate
    in its shard gets the shingles of its text (``texts``: id, copy, doc_id) and is searched again, candidates being
    compared on them at once: a forest of true links hides none.
    """

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.join(roots, "id", "left").join(prints, "id").select(
            "shard", "turn", "id", "fp", "sketch", F.coalesce("root", "id").alias("root")
        )

    def in_order(rows: DataFrame) -> DataFrame:
        return rows.repartition("shard").sortWithinPartitions("shard", "turn", "id")

    search = _copy_search(radius, similarity - margin)
    named = stored(in_order(keyed(dealt)).mapInArrow(search, "shard bigint, turn int, id bigint"), "named")
    if not named.head(1):
        return roots
    wanted = stored(texts.join(named.select("id").distinct(), "id"), "wanted")
    sets = stored(_shingle_sets(docs, wanted, wide_shingle), "shingles")
    search = _copy_search(radius, similarity - margin, similarity)
    full = keyed(named).join(sets, "id").select("shard", "turn", "id", "fp", "sketch", "root", "own")
    links = stored(in_order(full).mapInArrow(search, "a bigint, b bigint"), "links")
    known = roots.select(F.col("id").alias("a"), F.col("root").alias("b"))
    return components(known.union(links)).withColumnRenamed("node", "id")


def _apart(members: DataFrame) -> DataFrame:
    """Shards of ``members`` (id, root, shard) with several roots: ``(shard, n, widest, rest)``, ``rest`` outside the widest."""
    sizes = members.groupBy("shard", "root").agg(F.count(F.lit(1)).alias("n"))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("widest"))
    shards = shards.withColumn("rest", F.col("n") - F.col("widest.n")).filter("rest > 0")
    return shards.select("shard", "n", F.col("widest.root").alias("widest"), "rest")


def _across(crowded: DataFrame, prints: DataFrame, roots: DataFrame, part_rows: int) -> DataFrame:
    """Shards ``(shard, turn, id)`` in which what crowded shards ``(id, shard)`` leave apart meets.

    Members meet where ``BAND`` bytes of their sketches agree at one of ``BANDS`` places, so crowds
    are split by content and not by size. Of such a smaller shard only the members outside
    its widest root are looked up; if it is crowded itself, part by part in trees of all parts of it.
    """
    members = crowded.join(roots, "id", "left").select("id", "shard", F.coalesce("root", "id").alias("root"))
    members = stored(members.join(_apart(members).select("shard"), "shard").select("id", "root").distinct(), "crowds")
    bands = [F.xxhash64(F.lit(band), F.substring("sketch", TABLES + band * BAND + 1, BAND)) for band in range(BANDS)]
    members = members.join(prints.select("id", "sketch"), "id").select("id", "root", F.explode(F.array(*bands)).alias("shard"))
    members = stored(members, "members")
    shards = _apart(members).select(
        "shard", "widest", F.ceil(F.col("n") / part_rows).cast("int").alias("parts"),
        F.ceil(F.col("rest") / part_rows).cast("int").alias("seekers"),
    )
    members = stored(members.join(shards, "shard"), "members")

    def deal(rows: DataFrame, turn: int, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64("id", F.lit(3 + turn)), F.col(own)).cast("int")
        rows = rows.withColumn("own", place).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        pair = ("other", "own") if turn else ("own", "other")
        return rows.select(F.xxhash64("shard", *pair).alias("shard"), F.lit(turn).alias("turn"), "id")

    alone = members.filter("parts = 1").select("shard", F.when(F.col("root") == F.col("widest"), 0).otherwise(2).alias("turn"), "id")
    members = members.filter("parts > 1")
    seeking = deal(members.filter("root != widest"), 1, "seekers", "parts")
    return alone.union(deal(members, 0, "parts", "seekers")).union(seeking)


def _simhash_links(firsts: DataFrame, radius: int) -> DataFrame:
    """Links ``(a, b)`` that connect the ids of ``firsts`` (id, fp) whose fingerprints differ in at most ``radius`` bits."""
    distinct = stored(firsts.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    equal = firsts.select("fp", F.col("id").alias("b")).join(distinct, "fp").select(F.col("first").alias("a"), "b")
    return link_fingerprints(distinct.withColumnRenamed("first", "id"), radius).union(equal.filter("a <> b"))


def near_copies(
    docs: DataFrame, similarity: float = 0.8, radius: int = BITS_APART, margin: float = MARGIN, wide_shingle: int = 5,
    shard_rows: int = DENSE_SHARD, simhash_radius: int = 2,
) -> DataFrame:
    """``(doc_id, component_id)`` of every named row, for texts whose SimHash differs in at most
    ``simhash_radius`` bits (as in ``near_components``) and copies of a Jaccard similarity of at
    least ``similarity`` on ``wide_shingle``-word shingles.

    At this similarity fingerprints differ in too many bits for blocks, so the
    trees hold the documents that share one of ``TABLES`` min-hashes; a pair at
    0.8 misses all of them once in 400,000. Candidates within ``radius`` bits, counted on the distinct
    shingles, whose sketches come within ``margin`` of the similarity (at 0.8, six and more
    standard deviations for the bits of all but the shortest texts, five for the sketches) are checked on
    the shingles themselves (see ``_settled``). Equal word sequences are one document throughout;
    of an id with several texts all are searched.
    Of over ``shard_rows`` documents that share a min-hash, first parts are searched that have ``LEADERS``
    documents in common; what is still apart after that meets by ``BANDS`` pieces of the sketches (see ``_across``),
    which a pair at 0.8 misses once in ten million.
    """
    placed = _placed(docs, similarity, radius, margin, wide_shingle, shard_rows, simhash_radius)
    return placed.select("doc_id", "component_id")


def _placed(
    docs: DataFrame, similarity: float, radius: int, margin: float, wide_shingle: int, shard_rows: int, simhash_radius: int
) -> DataFrame:
    """``near_copies`` with the hash of the text: ``(doc_id, copy, component_id)``."""
    signed = stored(signatures(docs, wide_shingle=wide_shingle).filter(F.col("doc_id").isNotNull()), "signatures")
    copies = signed.groupBy("copy").agg(F.min("doc_id").alias("doc_id"))
    copies = stored(copies.withColumn("id", F.monotonically_increasing_id()), "copies")  # a text's number
    firsts = stored(signed.join(copies, ["copy", "doc_id"]).dropDuplicates(["id"]), "firsts")
    prints, texts = firsts.select("id", F.col("wide").alias("fp"), "sketch"), copies.select("id", "copy", "doc_id")
    rows = firsts.select("id", F.posexplode("mins").alias("table", "least"))
    rows = stored(rows.select("id", F.xxhash64("table", "least").alias("shard")), "shards")
    counts = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    counts = counts.withColumn("parts", F.ceil(F.col("n") / shard_rows).cast("int"))
    shared = stored(rows.join(counts, "shard"), "shared")
    place = F.pmod(F.xxhash64("id", F.lit(1)), F.col("n"))
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    own = F.array(F.pmod(F.xxhash64("id", F.lit(2)), F.col("parts")).cast("int"))
    parts = F.when((F.col("parts") == 1) | (place >= LEADERS), own).otherwise(everywhere)
    dealt = shared.select("id", F.col("shard").alias("__shard"), F.explode(parts).alias("part")).select(
        F.xxhash64("__shard", "part").alias("shard"), F.lit(2).alias("turn"), "id"
    )
    roots = components(_simhash_links(firsts, simhash_radius)).withColumnRenamed("node", "id")
    options = (similarity, radius, margin, wide_shingle)
    roots = _settled(dealt, prints, texts, docs, roots, *options)
    crowded = shared.filter("parts > 1").select("id", "shard")
    if crowded.head(1):
        across = stored(_across(crowded, prints, roots, -(-shard_rows // 2)), "across")
        roots = _settled(across, prints, texts, docs, roots, *options)
    joined = copies.join(roots, "id")
    heads = joined.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = copies.join(joined.join(heads, "root").select("id", "component_id"), "id", "left")
    placed = stored(placed.select("copy", F.coalesce("component_id", "doc_id").alias("component_id")), "placed")
    return signed.select("doc_id", "copy").join(placed, "copy").select("doc_id", "copy", "component_id")


def one_of_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``docs`` with only the document of the smallest id of each group of near copies (see ``near_copies``).

    Of rows that repeat an id one stays, and one whose text is no copy of a smaller id's if there is one. Rows
    without an id cannot be compared by it and stay. Columns and their order are kept.
    """
    placed = stored(_placed(docs, similarity, BITS_APART, MARGIN, 5, DENSE_SHARD, 2), "placed")
    # A text is placed at its own or a smaller id.
    ids = placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("component_id").alias("last"))
    gone = stored(ids.filter(F.col("last") < F.col("doc_id")).select("doc_id"), "gone")
    again = stored(ids.filter((F.col("n") > 1) & (F.col("last") == F.col("doc_id"))).select("doc_id"), "repeated")
    kept = docs.join(gone, "doc_id", "left_anti")
    if again.head(1):
        first = placed.filter(F.col("doc_id") == F.col("component_id")).join(again, "doc_id").select("doc_id", "copy")
        first = first.distinct().withColumnsRenamed({"doc_id": "__id", "copy": "__copy"})
        once = kept.join(again, "doc_id", "left_semi").withColumn("__copy", _copy_hash(F.col("text").cast("string")))
        once = once.join(first, (F.col("doc_id") == F.col("__id")) & (once["__copy"] == first["__copy"]), "left_semi")
        once = once.dropDuplicates(["doc_id"]).drop("__copy")
        kept = kept.join(again, "doc_id", "left_anti").unionByName(once)
    return kept.select(*docs.columns)


@F.arrow_udf(BinaryType())
def _copy_hash(texts: pa.Array) -> pa.Array:
    return pa.array([_digest(words_of(t.as_py())) for t in texts], pa.binary())
