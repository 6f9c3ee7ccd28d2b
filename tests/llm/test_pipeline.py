"""Every stage of the pipeline against plain Python on the small tables."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from colloquy.llm import decontaminate as dc
from colloquy.llm import secret_scan as ss
from colloquy.llm.common import stored, table
from colloquy.llm.queries import word_vocabulary
from tests.conftest import SF_DIR
from tests.llm.test_secret_scan import base_spans


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage."""
    docs, out = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SF_DIR), name)
        out[name] = ({r["doc_id"]: r for r in docs.collect()}, result.collect(), result.columns)
        docs = result
    return out


def shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_columns_and_order(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
    for name in names[:-1]:
        assert stages[name][2] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_clean_documents_pass_the_classifier(stages):
    before, after, _ = stages["quality_classifier"]
    kept = {r["doc_id"] for r in after}
    labels = pq.read_table(f"{SF_DIR}/labels.parquet").to_pylist()
    clean = [r["doc_id"] for r in labels if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(i in kept for i in clean) / len(clean) > 0.97 and len(kept) < len(before)


def test_one_of_each_group_of_copies(stages):
    before, after, _ = stages["simhash_near_dedup"]
    sets = {i: shingles(r["text"]) for i, r in before.items()}
    root = {}
    for start in sorted(sets):
        todo = [start]
        while todo:
            i = todo.pop()
            if i not in root:
                root[i] = start
                todo += [j for j in sets if j not in root and (sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))]
    assert {r["doc_id"] for r in after} == set(root.values())


def test_leaking_documents_go(stages):
    before, after, _ = stages["benchmark_decontamination"]
    items = [dc.words_of(r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    kept = {r["doc_id"] for r in after}
    for i, row in before.items():
        text = " ".join(dc.words_of(row["text"]))
        if any(f" {' '.join(item)} " in f" {text} " for item in items):
            assert i not in kept
        elif not any(" ".join(item[k : k + 4]) in text for item in items for k in range(len(item) - 3)):
            assert i in kept


def test_secrets_are_masked(stages):
    before, after, _ = stages["secret_scans"]
    assert {r["doc_id"] for r in after} == set(before)
    for row in after:
        old = before[row["doc_id"]]["text"]
        assert row["n_chars"] == len(row["text"])
        if not base_spans(old) and row["text"] != old:
            assert ss.MASK in row["text"]
        if base_spans(old):
            assert len(base_spans(row["text"])) < len(base_spans(old))


def test_packed_pieces_hold_every_token(stages):
    before, after, _ = stages["best_fit_packing"]
    whole = Tokenizer.from_file(word_vocabulary())
    for row in after:
        ids = [*whole.encode(before[row["doc_id"]]["text"], add_special_tokens=False).ids, 1]
        part = ids[row["start"] : row["start"] + row["length"]]
        assert row["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    assert {r["doc_id"] for r in after} == set(before)


def test_run_gives_the_last_stage(spark, stages):
    got = {tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id", "piece", "ids_crc32").collect()}
    assert got == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in stages["best_fit_packing"][1]}
