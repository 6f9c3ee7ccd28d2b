import json
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from colloquy.catalog import adapters as A
from colloquy.functions.dialogue import DIALOGUE_TYPE
from colloquy.operators import prompts
from colloquy.plans import corpus
from colloquy.sources import readers, writers
from colloquy.streaming import chat, clean
from tests.conftest import SF_DIR


def lines(path):
    return [line for f in sorted(Path(path).rglob("*.json")) for line in f.read_text("utf-8").splitlines()]


def test_jsonl_keeps_nulls_and_characters(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "é😀")], "id int, a string, b string")
    assert writers.write_jsonl(df, str(tmp_path / "x")) == str(tmp_path / "x")
    assert lines(tmp_path / "x") == ['{"id":1,"a":null,"b":"é😀"}']
    writers.write_jsonl(df, str(tmp_path / "y"), force_ascii=True)
    assert lines(tmp_path / "y")[0].isascii() and json.loads(lines(tmp_path / "y")[0])["b"] == "é😀"
    with pytest.raises(TypeError, match="DataFrame"):
        writers.write_jsonl(pd.DataFrame({"a": [1]}), str(tmp_path / "z"))


def test_read_jsonl_splits(spark, tmp_path):
    for name in ("train", "val"):
        (tmp_path / name).write_text(json.dumps({"text": name}) + "\n")
    got = readers.read_jsonl_splits(spark, {n: str(tmp_path / n) for n in ("train", "val")}, "text string")
    assert sorted(tuple(r) for r in got.collect()) == [("train", "train"), ("val", "val")]
    (tmp_path / "bad").write_text("{not json\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_jsonl_splits(spark, {"x": str(tmp_path / "bad")}, "text string").collect()


def test_write_samples_appends(spark, tmp_path):
    df = spark.createDataFrame([("p", "g", 1)], "prompt string, generation string, other int")
    for _ in range(2):
        writers.write_samples(df, str(tmp_path / "s"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [("p", "g")] * 2


@pytest.mark.parametrize("n", [0, 1, 40, 100, 101, 250, 300, 999])
def test_sample_in_file_order(spark, tmp_path, n):
    for part in range(3):  # three files of 100 rows
        spark.range(part * 100, part * 100 + 100, 1, 1).write.parquet(str(tmp_path / f"d/part={part}"))
    got = readers.read_source(spark, str(tmp_path / "d"), sample_len=n, row_id="row_id")
    rows = got.collect()
    assert sorted(r["id"] for r in rows) == list(range(min(n, 300)))
    assert len({r["row_id"] for r in rows}) == len(rows)


def test_write_corpus(spark, tmp_path):
    from colloquy.catalog.queries import corpus_sources, corpus_targets

    prepared = corpus.prepare_corpus(corpus_sources(spark, SF_DIR), corpus_targets(spark, SF_DIR))
    path, counts = corpus.write_corpus(prepared, str(tmp_path / "corpus"))
    assert {p.name for p in Path(path).iterdir() if p.is_dir()} == {"split=train", "split=val", "split=test"}
    records = [json.loads(x) for x in lines(path)]
    assert set(records[0]) == {"dialogue", "source", "text"}
    assert sum(r["rows"] for r in counts.collect()) == len(records)


def test_rejected_records_do_not_count_towards_a_cap(spark):
    from colloquy.catalog.queries import corpus_sources

    nq = {"natural-questions": corpus_sources(spark, SF_DIR)["natural-questions"]}
    accepted = corpus.two_message_dialogues(nq).count()
    assert 20 < accepted < nq["natural-questions"].count()
    for target in (0, 1, 20, accepted, accepted + 1):
        prepared = corpus.prepare_corpus(nq, {"nq": target}, val=0.1, test=0.1)
        assert prepared.count() == min(target, accepted)
    with pytest.raises(ValueError, match="unknown source"):
        corpus.prepare_corpus({"other": nq["natural-questions"]}, {})


def test_final_pass_of_prepare_corpus_only_sorts(spark):
    from colloquy.catalog.queries import corpus_sources, corpus_targets

    sources = corpus_sources(spark, SF_DIR)
    sources.pop("dolly")  # its test adapter joins
    for shuffled in (False, True):
        df = corpus.prepare_corpus(sources, corpus_targets(spark, SF_DIR), shuffled=shuffled)
        plan = df._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x]
        # The random order needs no range bounds, so nothing samples the texts first.
        assert len(moved) == shuffled and not any("rangepartitioning" in x.lower() for x in moved)


@pytest.mark.parametrize("split_bytes", [256, 4096, 1 << 27])
@pytest.mark.parametrize("n", [0, 1, 7, 40, 41, 119, 200])
def test_json_lines_in_file_order_for_any_split_size(spark, tmp_path, split_bytes, n):
    folder = tmp_path / "lines"
    folder.mkdir()
    sizes = [40, 0, 79]  # an empty file among them
    expected = []
    for f, size in enumerate(sizes):
        ids = [1000 * f + i for i in range(size)]
        (folder / f"part-{f}.json").write_text("".join(json.dumps({"id": i, "pad": "x" * (i % 37)}) + "\n" for i in ids))
        expected += [(f"part-{f}.json", k, i) for k, i in enumerate(ids)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        placed = readers.file_positions(spark.read.schema("id long, pad string").json(str(folder))).collect()
        got = readers.read_source(spark, str(folder), "id long", fmt="json", sample_len=n, row_id="row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r["__position"], r["id"]) for r in placed) == [(p + 1, e[2]) for p, e in enumerate(expected)]
    assert {(r["__file"].rsplit("/", 1)[1], r["__row"], r["id"]) for r in placed} == set(expected)
    assert sorted(r["id"] for r in got) == [e[2] for e in expected[:n]]
    assert {r["row_id"].rsplit("/", 1)[1] for r in got} == {f"{e[0]}#{e[1]}" for e in expected[:n]}


def test_shuffle_is_one_global_order(spark, tmp_path):
    from colloquy.operators import mixing, ranking

    df = spark.range(0, 3000, 1, 7).withColumnRenamed("id", "k")
    expected = [r["k"] for r in df.select("k", ranking.order_hash(42, F.col("k")).alias("h")).orderBy("h", "k").collect()]
    mixing.shuffle(df, "k", 42, partitions=5).write.parquet(str(tmp_path / "s"))
    files = sorted(p for p in (tmp_path / "s").iterdir() if p.name.startswith("part-"))
    got = [k for f in files for k in pd.read_parquet(f)["k"]]
    assert got == expected and len(files) == 5
    assert mixing.shuffle(df.filter(F.lit(False)), "k").count() == 0


def test_stream_clean_equals_batch(spark, tmp_path):
    docs = A.dirty_dialogues(spark, SF_DIR)
    writers.write_jsonl(docs.repartition(3), str(tmp_path / "in"))
    stream = clean.read_dialogue_stream(spark, str(tmp_path / "in"), f"doc_id bigint, {clean.SCHEMA}", files_per_batch=1)
    clean.start_clean(clean.clean_stream(stream, "doc_id"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    schema = f"doc_id bigint, dialogue {DIALOGUE_TYPE}, source string, text string"
    got = spark.read.schema(schema).json(str(tmp_path / "out")).select("doc_id", "text")
    want = clean.clean_stream(docs, "doc_id").select("doc_id", "text")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


SCHEMA = "conv_id long, turn long, role string, text string"


def run_chat(spark, tmp_path, batches, **options):
    source = tmp_path / "turns"
    source.mkdir()
    query = None
    for i, batch in enumerate(batches):
        names = ("conv_id", "turn", "role", "text")
        (source / f"{i}.json").write_text("".join(json.dumps(dict(zip(names, r))) + "\n" for r in batch))
        stream = spark.readStream.schema(SCHEMA).json(str(source))
        query = (
            chat.stream_prompts(stream, **options).writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return {(r["conv_id"], r["turn"]): (r["prompt"], r["late"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def test_stream_prompts_keeps_history_between_batches(spark, tmp_path):
    got = run_chat(spark, tmp_path, [
        [(1, 1, "assistant", "hello"), (1, 0, "user", " hi "), (2, 0, "user", "x")],
        [(1, 3, "assistant", "b"), (1, 2, "user", "a"), (2, 1, "user", "  "), (2, 2, "user", "SAIR"), (2, 3, "user", "new")],
        [(1, 4, "user", "c"), (1, 1, "user", "late one")],
    ])
    u, a = "<|user|> ", "<|assistant|> "
    assert got == {
        (1, 0): (f"{u}hi\n{a}", False),
        (2, 0): (f"{u}x\n{a}", False),
        (1, 2): (f"{u}hi\n{a}hello\n{u}a\n{a}", False),
        (2, 3): (f"{u}new\n{a}", False),
        (1, 1): (f"{u}hi\n{a}hello\n{u}a\n{a}b\n{u}late one\n{a}", True),
        (1, 4): (f"{u}hi\n{a}hello\n{u}a\n{a}b\n{u}late one\n{u}c\n{a}", False),
    }


def test_stream_prompts_equals_batch_prompts(spark, tmp_path):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    got = run_chat(spark, tmp_path, [[r for r in rows if r[1] < 3], [r for r in rows if r[1] >= 3]])
    want = {(r["conv_id"], r["turn"]): r["prompt"] for r in prompts.build_prompts(turns.withColumn("text", F.trim("text"))).collect()}
    assert {k: p for k, (p, _) in got.items()} == want


@pytest.mark.parametrize("parts", [1, 3])
def test_stream_prompts_equal_batch_prompts(spark, tmp_path, parts):
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t} is long") for t in range(300)]
    size = len(turns) // parts
    got = run_chat(spark, tmp_path, [turns[i : i + size] for i in range(0, len(turns), size)], max_len=50)
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    want = {(r["conv_id"], r["turn"]): r["prompt"] for r in prompts.context_prompts(df, 50).collect()}
    assert {k: v[0] for k, v in got.items()} == want
