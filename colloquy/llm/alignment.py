"""Cross-tokenizer alignment counted through a minimal perfect hash of distinct pairs.

Tokenizer A is a byte-level BPE applied to ``" " + text``; tokenizer B is a
sentencepiece BPE (it adds the leading space itself). Each token covers a byte
range of ``" " + text`` (A: its vocabulary entry byte-level decoded; B: its piece
in UTF-8 with U+2581 as a space and ``<0xHH>`` as byte HH). Byte offsets where
an A token and a B token both end cut the tokens into groups; every A and B
token occurrence whose byte ranges overlap form a link. An id pair's count is
the number of documents (rows) in which it is linked.

Method:

1. Pass 1 (``mapInPandas``, both tokenizers batched per Arrow batch) aligns
   every document: token counts, groups and the distinct ``(a, b)`` link keys
   with their multiplicity. Written to the scratch folder.
2. A minimal perfect hash (MPH) over the distinct keys: keys are dealt into
   buckets of about ``BUCKET_KEYS`` by ``xxhash64(key)``; for each bucket a
   ``cogroup``-free ``applyInPandas`` searches the first seed under which
   ``pmod(xxhash64(key, seed), size)`` is one-to-one; a running sum of bucket
   sizes gives offsets. ``slot = offset + pmod(xxhash64(key, seed), size)`` is then
   a Spark expression, the same in every task.
3. Counts: every partition fills a dense vector indexed by slot (one count per
   document and distinct key) and sends only the slices it touched; slices are
   summed in a tree (by slice and partition group, then by slice). The key of
   every slot is stored beside its count, so a look-up is verified.
4. Pass 2 looks up each document's keys by slot, checks the stored key, and
   adds ``count`` and whether it is its A id's corpus-wide highest.

The MPH tables (one row per bucket, about a quarter of the distinct pairs) and
the slot table are joined by broadcast below ``MAX_BROADCAST_KEYS`` rows, else by
a shuffle salted over ``SALT`` copies, so a hot pair (one pair linked in a third
of all documents) is spread.

Edge cases: a null or empty text, or one whose joined A or B bytes differ from
``" " + text`` (sentencepiece normalisation, dropped white space), has no tokens:
all counts 0 and ``groups_sha256`` ``''``; its pairs are not counted. Rows that
repeat a ``doc_id`` are separate documents. Special-token strings inside a text
are plain text. Very long texts are aligned whole. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import stored

BUCKET_KEYS = 4  # keys per MPH bucket, on average
SLICE = 1 << 16  # slots per slice of the dense count vector
FAN = 16  # partition groups in the first level of the tree sum
MAX_BROADCAST_KEYS = 4_000_000
SALT = 32
PIECE_SPACE = "▁"

_ALIGNED = (
    "__row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "keys array<long>, mults array<long>"
)


def byte_decoder() -> dict[str, int]:
    """The byte-level BPE alphabet: printable Latin-1 bytes stand for themselves, the others for 256 + n."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, extra = list(keep), 0
    for b in range(256):
        if b not in keep:
            keep.append(b)
            chars.append(256 + extra)
            extra += 1
    return {chr(c): b for b, c in zip(keep, chars)}


class Vocabulary:
    """The bytes of every id of one tokenizer, as one buffer with offsets, for gathers without Python loops."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.buffer = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        sizes = self.lengths[ids]
        total = int(sizes.sum())
        first = np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes)
        return self.buffer[first + np.arange(total)].tobytes()


@lru_cache(maxsize=4)
def ranked_encoder(ranks_path: str, pattern: str):
    """A's vocabulary as merge ranks: the same ids as the tokenizer file, several times faster."""
    import base64

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def tokenizers_of(a_path: str, b_path: str):
    """Both tokenizers and the bytes of every id, once per worker process."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    decode = byte_decoder()
    a_bytes = []
    for i in range(a.get_vocab_size()):
        token = a.id_to_token(i) or ""
        a_bytes.append(bytes(decode[c] for c in token) if all(c in decode for c in token) else token.encode())
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            b_bytes.append(bytes([int(piece[3:5], 16)]))
        else:
            b_bytes.append(piece.replace(PIECE_SPACE, " ").encode())
    return a, b, Vocabulary(a_bytes), Vocabulary(b_bytes)


@lru_cache(maxsize=4)
def _numerals(n: int) -> Vocabulary:
    """The decimal numerals of the ids below ``n``, each with a comma behind it."""
    return Vocabulary([b"%d," % i for i in range(n)])


def align(a_ids: np.ndarray, b_ids: np.ndarray, a_vocab: Vocabulary, b_vocab: Vocabulary, whole: bytes):
    """``(n_groups, groups text, (a ids, b ids) of the links)`` of one text, or ``None``.

    ``None`` when a side's joined bytes differ from ``whole``. Groups lie between
    consecutive common token ends; the text is ``a1,a2|b1;a3|b2,b3``. Two tilings of
    the same bytes overlap once per segment between consecutive ends of either side,
    so the links are read off the union of the end offsets.
    """
    if a_vocab.joined(a_ids) != whole or b_vocab.joined(b_ids) != whole:
        return None
    a_end, b_end = np.cumsum(a_vocab.lengths[a_ids]), np.cumsum(b_vocab.lengths[b_ids])
    mark = np.zeros(len(whole) + 1, dtype=np.uint8)
    mark[a_end] = 1
    mark[b_end] |= 2
    ends, cuts = np.flatnonzero(mark), np.flatnonzero(mark == 3)
    links = (a_ids[np.searchsorted(a_end, ends)], b_ids[np.searchsorted(b_end, ends)])
    # Tokens in text order: each group's A ids, then its B ids.
    a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    a_at = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group)
    b_at = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, side="right")
    ids = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
    side = np.zeros(len(ids), dtype=bool)
    ids[a_at], ids[b_at], side[b_at] = a_ids, b_ids, True
    numerals = _numerals(max(len(a_vocab.lengths), len(b_vocab.lengths)))
    text = np.frombuffer(numerals.joined(ids), dtype=np.uint8)[:-1].copy()
    commas = np.cumsum(numerals.lengths[ids])[:-1] - 1
    text[commas[~side[:-1] & side[1:]]] = ord("|")
    text[commas[side[:-1] & ~side[1:]]] = ord(";")
    return len(cuts), text.tobytes(), links


SUB_BATCH = 128  # texts encoded at a time: an encoding holds several objects per token


def aligned_rows(batch: pd.DataFrame, a_path: str, b_path: str, a_ranks: tuple[str, str] | None = None) -> pd.DataFrame:
    a, b, a_vocab, b_vocab = tokenizers_of(a_path, b_path)
    ranked = ranked_encoder(*a_ranks) if a_ranks else None
    texts = [t if isinstance(t, str) else "" for t in batch["text"]]
    out = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "mults")}
    for start in range(0, len(texts), SUB_BATCH):
        part = texts[start : start + SUB_BATCH]
        if ranked is not None:
            a_enc = [np.asarray(e, dtype=np.int64) for e in ranked.encode_ordinary_batch([" " + t for t in part], num_threads=1)]
        else:
            a_enc = [np.asarray(e.ids, dtype=np.int64) for e in a.encode_batch([" " + t for t in part], add_special_tokens=False)]
        b_enc = [np.asarray(e, dtype=np.int64) for e in b.encode(part, num_threads=1)]
        for text, ea, eb in zip(part, a_enc, b_enc):
            done = align(ea, eb, a_vocab, b_vocab, (" " + text).encode()) if text else None
            if done is None:
                for c, v in (("n_a", 0), ("n_b", 0), ("n_groups", 0), ("n_links", 0), ("groups_sha256", ""), ("keys", []), ("mults", [])):
                    out[c].append(v)
                continue
            n_groups, groups, (la, lb) = done
            keys, mults = np.unique((la << 32) | lb, return_counts=True)
            out["n_a"].append(len(ea))
            out["n_b"].append(len(eb))
            out["n_groups"].append(n_groups)
            out["n_links"].append(len(la))
            out["groups_sha256"].append(hashlib.sha256(groups).hexdigest())
            out["keys"].append(keys)
            out["mults"].append(mults.astype(np.int64))
    return pd.DataFrame({"__row": batch["__row"].to_numpy(), "doc_id": batch["doc_id"].to_numpy(), **out})


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def spark_hash(key: int, seed: int) -> int:
    """``xxhash64(key, seed)`` of two long columns, as Spark computes it."""
    first = xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), seed=42)
    return _signed(xxhash.xxh64_intdigest(int(seed).to_bytes(8, "little", signed=True), seed=first))


def bucket_seed(keys: pd.DataFrame) -> pd.DataFrame:
    """The first seed that maps a bucket's keys one-to-one onto ``[0, size)``."""
    ks = keys["key"].to_numpy()
    size, seed = len(ks), 0
    while len({spark_hash(k, seed) % size for k in ks}) < size:
        seed += 1
    return pd.DataFrame({"bucket": [int(keys["bucket"].iloc[0])], "size": [size], "seed": [seed]})


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MAX_BROADCAST_KEYS else df


def perfect_hash(keys: DataFrame) -> tuple[DataFrame, int, int]:
    """``(buckets, n_buckets, n_keys)``: buckets ``(bucket, offset, size, seed)`` of an MPH over ``keys(key)``."""
    n_keys = keys.count()
    n_buckets = max(1, -(-n_keys // BUCKET_KEYS))
    dealt = keys.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n_buckets)))
    seeds = dealt.groupBy("bucket").applyInPandas(bucket_seed, "bucket long, size long, seed long")
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)  # one small row per bucket
    buckets = seeds.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long"))
    return stored(buckets, "buckets"), n_buckets, n_keys


def with_slot(df: DataFrame, buckets: DataFrame, n_buckets: int, n_keys: int) -> DataFrame:
    """Add ``slot`` of column ``key`` (which must be one of the hashed keys)."""
    placed = df.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(n_buckets)))
    placed = placed.join(_maybe_broadcast(buckets, n_keys // BUCKET_KEYS + 1), "bucket")
    slot = F.col("offset") + F.pmod(F.xxhash64(F.col("key"), F.col("seed")), F.col("size"))
    return placed.withColumn("slot", slot).drop("bucket", "offset", "size", "seed")


def _dense(batches):
    """Per partition: a dense count vector over the slots it touched, sent slice by slice."""
    counts: dict[int, np.ndarray] = {}
    part = None
    for b in batches:
        if b.empty:
            continue
        part = int(b["__part"].iloc[0])
        slots = b["slot"].to_numpy()
        for s in np.unique(slots // SLICE):
            inside = slots[slots // SLICE == s] % SLICE
            vec = counts.setdefault(int(s), np.zeros(SLICE, dtype=np.int64))
            vec += np.bincount(inside, minlength=SLICE)
    for s, vec in counts.items():
        yield pd.DataFrame({"slice": [s], "grp": [part % FAN], "counts": [vec]})


def _sum_slices(g: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"slice": [int(g["slice"].iloc[0])], "counts": [np.sum(np.stack(g["counts"].to_numpy()), axis=0)]})


def pair_counts(aligned: DataFrame) -> tuple[DataFrame, DataFrame, int, int]:
    """``(key, slot, count, best)`` (documents per linked pair, and whether it is its A id's highest), and the MPH."""
    pairs = aligned.select(F.explode("keys").alias("key"))
    keys = stored(pairs.distinct(), "keys")
    buckets, n_buckets, n_keys = perfect_hash(keys)
    slots = with_slot(pairs, buckets, n_buckets, n_keys).select("slot", F.spark_partition_id().alias("__part"))
    partial = slots.mapInPandas(_dense, "slice long, grp long, counts array<long>")
    level1 = partial.groupBy("slice", "grp").applyInPandas(_sum_slices, "slice long, counts array<long>")
    summed = level1.groupBy("slice").applyInPandas(_sum_slices, "slice long, counts array<long>")
    vector = summed.select(
        F.posexplode("counts").alias("pos", "count"), "slice"
    ).select((F.col("slice") * SLICE + F.col("pos")).alias("slot"), "count").filter(F.col("count") > 0)
    # Verified keys: the key stored at each slot.
    owners = with_slot(keys, buckets, n_buckets, n_keys)
    table = vector.join(owners, "slot").select("key", "slot", "count")
    best = W.partitionBy(F.shiftright("key", 32))
    table = table.withColumn("best", F.col("count") == F.max("count").over(best))
    return stored(table, "pair_counts"), buckets, n_buckets, n_keys


def alignment(
    docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
    a_ranks: tuple[str, str] | None = None,
) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``a_ranks`` (merge-ranks file of A's vocabulary, split pattern) encodes A with
    ``tiktoken`` instead of ``tokenizers``: the same ids (tests compare both with the
    tokenizer file), at a fifth of the CPU time. Token bytes always come from
    ``a_path``. See the module for the method and the edge cases.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    aligned = stored(rows.mapInPandas(lambda it: (aligned_rows(b, a_path, b_path, a_ranks) for b in it), _ALIGNED), "aligned")
    table, buckets, n_buckets, n_keys = pair_counts(aligned)
    held = aligned.select("__row", F.explode(F.arrays_zip("keys", "mults")).alias("p")).select(
        "__row", F.col("p.keys").alias("key"), F.col("p.mults").alias("mult")
    )
    looked = with_slot(held, buckets, n_buckets, n_keys)
    slots = table.select("slot", F.col("key").alias("stored_key"), "count", "best")
    if n_keys <= MAX_BROADCAST_KEYS:
        found = looked.join(F.broadcast(slots), "slot")
    else:
        copies = slots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        found = looked.withColumn("salt", F.pmod(F.xxhash64("__row"), F.lit(SALT)).cast("int")).join(copies, ["slot", "salt"])
    found = found.filter(F.col("stored_key") == F.col("key"))  # the verified look-up
    per_doc = found.groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("mult")).otherwise(0)).alias("n_best"),
        F.sum(F.col("mult") * F.col("count")).alias("count_sum"),
    )
    out = aligned.join(per_doc, "__row", "left")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256",
    )
