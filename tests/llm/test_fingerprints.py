import hashlib
import random
import struct

import numpy as np
import xxhash
from pyspark.sql import functions as F

from colloquy.llm import fingerprints as fp
from colloquy.llm.common import table
from tests.conftest import SF_DIR


def exact(text):
    total = [0] * fp.EXACT
    for p in text.split("\n"):
        seed = xxhash.xxh64_intdigest(hashlib.sha512(p.encode()).hexdigest(), 42)
        total = [(t + xxhash.xxh64_intdigest(struct.pack("<i", i), seed)) % fp.MODULUS for i, t in enumerate(total)]
    return "".join(f"{t:08x}" for t in total)


def test_query_equals_brute_force(spark, documents):
    docs = sorted(documents, key=lambda d: -d["doc_id"])
    rows = {r["doc_id"]: r for r in fp.edited_fingerprints(table(spark, SF_DIR, "documents")).collect()}
    assert len(rows) == len(docs)
    ahead, behind = [], []
    for at, doc in enumerate(docs):
        text, after = doc["text"] or "", docs[(at + 1) % len(docs)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + (after["text"] or "")[:cut]
        row = rows[doc["doc_id"]]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"][: 8 * fp.EXACT] == exact(text)
        assert row["edited_fingerprint"][: 8 * fp.EXACT] == exact(edited)
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        ahead.append(row["near_edited"])
        behind.append(row["near_next"])
    assert np.mean([a > b for a, b in zip(ahead, behind)]) > 0.95
    assert np.median(ahead) > 0.5 and np.median(behind) < 0.2


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = fp.fingerprints(df, {"print": "text"}, ["i"]).collect()
    return {r["i"]: r["print"] for r in rows}


def test_order_insertion_and_deletion(spark):
    rng = random.Random(1)
    paragraphs = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 9))) for _ in range(12)]
    mixed = rng.sample(paragraphs, len(paragraphs))
    texts = ["\n".join(paragraphs), "\n".join(mixed), "\n".join(paragraphs[:5]), "\n".join(paragraphs[5:]), "\n".join(paragraphs + ["x"])]
    got = prints(spark, texts)
    assert got[0] == got[1] != got[4]
    df = spark.createDataFrame([(got[0], got[2], got[3])], "whole string, a string, b string")
    row = df.select(
        fp.combined(F.col("a"), F.col("b")).alias("sum"), fp.combined(F.col("whole"), F.col("b"), -1).alias("rest")
    ).first()
    assert row["sum"] == got[0] and row["rest"] == got[2]


def test_odd_rows(odd, no_rows):
    rows = fp.edited_fingerprints(odd).collect()
    assert len(rows) == 9
    assert sorted(r["n_chars"] for r in rows if r["doc_id"] in (3, 4)) == [0, 0]
    assert all(r["near_next"] is None for r in rows if r["doc_id"] is None)
    assert len({r["fingerprint"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert fp.edited_fingerprints(no_rows).count() == 0
