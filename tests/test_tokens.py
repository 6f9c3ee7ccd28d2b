from pathlib import Path

import pytest
from pyspark.sql import functions as F

from colloquy.constants import SPECIALS
from colloquy.functions import tokens as T
from colloquy.operators import generation, prompts, rows, vocabulary
from colloquy.plans import encode
from colloquy.session import cut_lineage


@pytest.fixture(scope="module")
def texts(spark):
    data = ["the cat", " the  dog's cat<|endoftext|>", "  ", "zebra", None, "a<b <|user|> 12é x\n"]
    return spark.createDataFrame(list(enumerate(data)), "id bigint, text string")


@pytest.fixture(scope="module")
def vocab(spark, texts):
    return vocabulary.build_vocab(texts, 4).cache()


def test_pretokenize_is_lossless(apply):
    raw = ["I've  got\n\n2 <|user|>s <|assistant|>", " ünï x<y>", "", "<|other|>"]
    pieces = apply(T.pretokenize, raw)
    assert ["".join(p) for p in pieces] == raw
    assert pieces[0] == ["I", "'ve", "  ", "got", "\n\n", "2", " ", "<|user|>", "s", " ", "<|assistant|>"]
    assert pieces[3] == ["<", "|", "other", "|>"]


def test_special_tags_are_atomic(apply):
    assert apply(T.pretokenize, ["a<|user|>b<|endoftext|>"]) == [["a", "<|user|>", "b", "<|endoftext|>"]]


def test_build_vocab(vocab):
    got = [r["token"] for r in vocab.orderBy("id").collect()]
    assert len(got) == 7 and tuple(got[-3:]) == SPECIALS
    assert not set(got[:4]) & set(SPECIALS)


def test_vocab_check(spark, vocab):
    assert vocabulary.vocab_check(vocab, 7).first()["ok"]
    vocabulary.assert_vocab(vocab, 7)
    with pytest.raises(ValueError, match="base.*inconsistent"):
        vocabulary.assert_vocab(vocab, 8, "base")
    broken = spark.createDataFrame([("a", 0), ("a", 1)], "token string, id int")
    assert not vocabulary.vocab_check(broken).first()["ok"]


@pytest.mark.parametrize("block", [1, 3, 512])
def test_shipped_and_joined_vocabularies_agree(texts, vocab, block):
    pieces = texts.withColumn("tokens", T.truncate_head(T.pretokenize(F.coalesce("text", F.lit(""))), block))
    shipped = vocabulary.encode_tokens(pieces, vocab).select("id", "input_ids")
    joined = vocabulary.encode_tokens(pieces, vocab, max_shipped=2).select("id", "input_ids")
    as_rows = lambda df: sorted((r["id"], r["input_ids"]) for r in df.collect())
    assert as_rows(shipped) == as_rows(joined) and len(as_rows(shipped)) == 6


@pytest.mark.parametrize("max_shipped", [2, 1000])
def test_look_up_is_the_same_at_every_size(spark, vocab, max_shipped):
    rows = [(1, ["the", "zzz"]), (1, ["the"]), (None, []), (None, None), (2, ["<|endoftext|>", " cat"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    unknown = ids["<|endoftext|>"]
    got = vocabulary.encode_tokens(df, vocab, max_shipped=max_shipped).select("id", "input_ids").collect()
    want = [(i, [ids.get(t, unknown) for t in t_ or []]) for i, t_ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    lacking = vocab.filter(F.col("token") != "<|endoftext|>")
    with pytest.raises(ValueError, match="lacks its unknown token"):
        vocabulary.encode_tokens(df, lacking, max_shipped=max_shipped)
    some = vocab.filter(F.col("token") != "<|endoftext|>").first()["token"]
    repeated = vocab.unionByName(vocab.filter(F.col("token") == some).withColumn("id", F.lit(7)))
    with pytest.raises(ValueError, match="more than once"):
        vocabulary.encode_tokens(df, repeated, max_shipped=max_shipped)


def test_values_pass_through_generators_and_row_functions(spark):
    big = 2**53 + 1
    schema = "id bigint, prompt string, many array<bigint>, pair struct<a:bigint,b:string>, price decimal(20,2), at timestamp"
    import datetime
    import decimal

    at = datetime.datetime(2020, 1, 2, 3, 4, 5, 678901)
    data = [(big, "p", [big, None], (big, "x"), decimal.Decimal("1.10"), at), (None, "q", None, None, None, None)]
    df = spark.createDataFrame(data, schema).coalesce(1)
    asked = generation.batch_generate(df, echo).drop("full").orderBy("prompt").collect()
    def look(row):
        kinds = {k: type(v).__name__ for k, v in row.items()}
        return {"kinds": ",".join(kinds[c] for c in ("id", "many", "pair")), "next": None if row["id"] is None else row["id"] + 2}

    mapped = rows.map_rows(df, look, "kinds string, next bigint").orderBy("prompt").collect()
    for got in (asked, mapped):
        assert [r["id"] for r in got] == [big, None] and got[0]["many"] == [big, None] and got[0]["pair"]["a"] == big
        assert got[0]["price"] == decimal.Decimal("1.10") and got[0]["at"] == at and got[1]["pair"] is None
    assert [r["kinds"] for r in mapped] == ["int,list,dict", "NoneType,NoneType,NoneType"] and mapped[0]["next"] == big + 2


def test_batches_keep_splits_apart_and_move_the_arrays_once(spark, vocab):
    docs = spark.range(200).select(
        "id", F.repeat(F.lit("the cat "), (F.col("id") % 9 + 1).cast("int")).alias("text"),
        F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"),
    )
    got = encode.encode_corpus(docs, vocab, 4, "id", split="split")
    batches = {}
    for r in got.collect():
        batches.setdefault((r["split"], r["batch_id"]), []).append(len(r["input_ids"]))
    assert all(len(set(sizes)) == 1 and len(sizes) <= 4 for sizes in batches.values())
    assert sum(map(len, batches.values())) == 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    assert plan.count("Python") == 0 and len(moved) > 0


def test_tokenize(texts, vocab):
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    encoded = vocabulary.tokenize(texts, vocab, keep=["id"]).collect()
    assert sorted(r["id"] for r in encoded) == [0, 1, 3, 5]
    first = next(r for r in encoded if r["id"] == 0)
    unknown = ids["<|endoftext|>"]
    assert first["input_ids"] == [ids.get("the", unknown), ids.get(" cat", unknown)]
    assert first["attention_mask"] == [1, 1]
    assert vocabulary.tokenize(texts, vocab).columns == ["input_ids", "attention_mask"]
    assert vocabulary.tokenize_keep(texts, vocab, 2).columns == ["id", "text", "input_ids", "attention_mask"]


def test_counting_tokenized_rows_does_not_tokenize(texts, vocab):
    plan = vocabulary.tokenize(texts, vocab, keep=["id"]).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "regexp_extract_all" not in plan


@pytest.mark.parametrize("n, kept", [(3, "b c d"), (4, "a b c d"), (5, "a b c d")])
def test_truncate_tail(apply, n, kept):
    assert apply(lambda c: T.truncate_tail(c, n), [list("abcd")], "array<string>") == [kept.split()]


def test_truncate_to_context(spark):
    df = spark.createDataFrame([("a b c",)], "prompt string")
    assert prompts.truncate_to_context(df, "prompt", 2).first()["prompt"] == " b c"


def echo():
    return lambda batch: [f"{p}re: {p}<|endoftext|>" for p in batch]


def test_generation(spark):
    df = spark.range(20).select("id", F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))
    full = generation.batch_generate(df, echo)
    assert full.columns == ["id", "prompt", "full"] and df.columns == ["id", "prompt"]
    assert full.count() == 20
    few = generation.generate_answers(df, echo, n=3, key="id").orderBy("id").collect()
    assert [r["generation"] for r in few] == ["re: p0", "re: p1", "re: p2"]
    both = generation.compare_models(df, {"base": echo, "tuned": lambda: lambda b: [p + "!" for p in b]}).first()
    assert (both["base"], both["tuned"]) == ("re: " + both["prompt"], "!")


def test_generator_must_answer_every_prompt(spark):
    df = spark.createDataFrame([("x",)], "prompt string")
    with pytest.raises(Exception, match="0 texts for 1 prompts"):
        generation.batch_generate(df, lambda: lambda batch: []).collect()


def test_a_call_gets_a_bounded_number_of_prompts(spark):
    def loader():
        def generate(batch):
            assert len(batch) <= 100
            return [p + "!" for p in batch]

        return generate

    df = spark.range(0, 1050, 1, 2).select("id", F.col("id").cast("string").alias("prompt"))
    got = generation.batch_generate(df, loader, call_rows=100).collect()
    assert sorted((r["id"], r["full"]) for r in got) == [(i, f"{i}!") for i in range(1050)]
    assert generation.CALL_ROWS <= 1000


def test_look_up_makes_no_python_strings(vocab):
    import tracemalloc

    import pyarrow as pa

    table = vocab.toArrow()
    tokens = pa.array([["the", None, " cat", "zzz"] * 500] * 200 + [None, []], pa.list_(pa.string()))
    tracemalloc.start()
    ids = vocabulary._ids(tokens, table["token"], table["id"], 99)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000 and ids[-1].as_py() == ids[-2].as_py() == []
    known = {r["token"]: r["id"] for r in vocab.collect()}
    assert ids[7].as_py()[:4] == [known.get(t, 99) for t in ("the", None, " cat", "zzz")]


def test_joined_look_up_moves_tokens_once_a_block(spark, vocab):
    token, known = vocab.filter(F.col("id") == 1).select("token", "id").first()
    df = spark.range(0, 3000, 1, 2).select("id", F.array_repeat(F.lit(token), 200).alias("tokens"))
    encoded = vocabulary.encode_tokens(df, vocab, max_shipped=2)
    plan = encoded._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and "collect_list" not in plan
    rows = encoded.select("id", "input_ids").collect()
    assert sorted(r["id"] for r in rows) == list(range(3000)) and all(r["input_ids"] == [known] * 200 for r in rows)


def test_joined_look_up_writes_little(spark):
    """Half of the tokens are in the vocabulary; the rows that are written hold all of them."""
    vocab = spark.range(5000).select(F.concat(F.lit("token"), "id").alias("token"), F.col("id").cast("int"))
    vocab = vocab.unionByName(spark.createDataFrame([("<|endoftext|>", 5000)], "token string, id int"))
    tokens = F.transform(F.sequence(F.lit(1), F.lit(500)), lambda i: F.concat(F.lit("token"), F.pmod(F.xxhash64("id", i), F.lit(10_000))))
    df = spark.range(0, 1000, 1, 2).select("id", F.when(F.col("id") != 7, F.array_append(tokens, F.lit(None))).alias("tokens"))
    cut_lineage(df.limit(0))  # the scratch folder exists from here on
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())
    before = size()
    encoded = vocabulary.encode_tokens(df, vocab, max_shipped=100)
    got = {r["id"]: r["input_ids"] for r in encoded.collect()}
    assert size() - before < 1000 * 500 * 5
    shipped = {r["id"]: r["input_ids"] for r in vocabulary.encode_tokens(df, vocab).collect()}
    assert got == shipped and got[7] == [] and got[8][-1] == 5000 and len(got) == 1000


def test_joined_look_up_joins_what_a_block_may_know(spark, vocab, monkeypatch):
    monkeypatch.setattr(vocabulary, "_BLOCK_ROWS", 100)
    token = vocab.filter(F.col("id") == 1).first()["token"]
    df = spark.range(0, 1000, 1, 2).select("id", F.array(F.lit(token), F.concat(F.lit("w"), "id"), F.lit(token)).alias("tokens"))
    numbers = vocabulary._numbers(spark, "tokens", vocabulary._token_filter(vocab))
    rows = cut_lineage(df.select("id", numbers.alias("at"))).select("id", "at.*").collect()
    assert len({r["block"] for r in rows}) == 10
    words = [w for r in rows for w in r["words"]]
    assert sum(w["token"] == token for w in words) == 10 and len(words) < 30
    assert all(len(r["codes"]) == 3 and r["codes"][0] == r["codes"][2] >= 0 for r in rows)


def test_loader_runs_on_the_worker_once_per_task(spark, tmp_path):
    log = str(tmp_path / "loads")

    def loader():
        with open(log, "a") as f:
            f.write("load\n")
        return lambda batch: list(batch)

    df = spark.range(0, 1000, 1, 2).select(F.col("id").cast("string").alias("prompt"))
    assert generation.batch_generate(df, loader).count() == 1000
    assert len(open(log).readlines()) == 2


def test_score_prompts(spark, texts):
    got = encode.score_prompts(texts, echo, max_len=2).orderBy("id").collect()
    assert [(r["id"], r["prompt"]) for r in got] == [(0, "the cat"), (1, " the  "), (3, "zebra"), (5, "a<")]


@pytest.mark.parametrize(
    "args, want", [(None, "x0"), ({"suffix": "k", "times": 2}, "xkk"), (("t",), "xt"), ("s", "xs")]
)
def test_map_rows(spark, args, want):
    def add(row, suffix="0", times=1):
        return {"out": row["a"] + suffix * times, "b": 5}

    df = spark.createDataFrame([("x", 1)], "a string, b int")
    got = rows.map_rows(df, add, "out string, b int", args).first().asDict()
    assert got == {"a": "x", "out": want, "b": 5}
    assert rows.map_rows(df, add, "out string", remove_columns=["a"]).columns == ["b", "out"]
