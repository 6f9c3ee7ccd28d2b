import random

import pytest

from colloquy.llm import quality
from colloquy.llm.common import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Fitted on one half of the labels, right on the other."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    known = {r["doc_id"]: r["toxic"] == 1 or r["quality"] == 0 for r in labels.collect()}
    fitted = labels.filter("doc_id % 2 = 0")
    keep = {r["doc_id"]: r["__keep"] for r in quality.judged(docs, fitted).select("doc_id", "__keep").collect()}
    held = [i for i in known if i % 2]
    bad = [i for i in held if known[i]]
    good = [i for i in held if not known[i]]
    assert sum(not keep[i] for i in bad) / len(bad) > 0.85
    assert sum(keep[i] for i in good) / len(good) > 0.97


def site_rows():
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(1200):
        host = f"h{i % 40}"
        path = f"p{i % 3}"
        docs.append((i, "text", host, path))
        labels.append((i, 1, int(rng.random() < (0.9 if host == "h7" else 0.1))))
    docs += [(5000, "text", "h7", "new path"), (5001, "text", "new host", "p0")]
    return docs, labels


def test_sites_shrink_towards_their_parents(spark):
    docs, labels = site_rows()
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality.judged(df, known).collect()}
    overall = sum(x[2] for x in labels) / len(labels)
    own = [x for x in labels if x[0] % 40 == 7]
    rate = sum(x[2] for x in own) / len(own)
    assert overall < rows[7]["__prior_toxic"] <= rate + 0.01 and rows[7]["__prior_toxic"] > 0.6
    assert rows[5000]["__prior_toxic"] == pytest.approx(rows[5000]["__prior_toxic"]) and rows[5000]["__prior_toxic"] > 0.6
    assert rows[5001]["__prior_toxic"] == pytest.approx((sum(x[2] for x in labels) + 0.5) / (len(labels) + 1))
    assert not rows[7]["__keep"] and rows[8]["__keep"]


def test_odd_rows(spark, odd, no_rows):
    labels = spark.createDataFrame(
        [(1, 1, 0, "x"), (1, None, None, None), (3, 0, 1, "x"), (None, 0, 1, None), (99, 1, 1, "x")],
        "doc_id bigint, quality int, toxic int, text string",
    )
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns
    assert quality.judged(odd, labels).count() == 9
    assert quality.accepted(no_rows, labels).count() == 0
    assert quality.accepted(odd, labels.limit(0)).count() == 9
