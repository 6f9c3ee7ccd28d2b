import pytest
from pyspark.sql import functions as F

from colloquy.functions import answers
from colloquy.functions import dialogue as D
from colloquy.operators import dialogues, prompts, rows
from colloquy.sources import converters

DIALOGUE = D.DIALOGUE_TYPE


def test_clean_dialogue(apply):
    raw = [
        [("System ", "be <b>kind</b>"), (" ASSISTANT", "ok"), ("user", "  ")],
        [("user", None)],
        None,
    ]
    out = apply(D.clean_dialogue, raw, DIALOGUE)
    assert [[tuple(m) for m in d] for d in out] == [[("user", "be kind"), ("assistant", "ok")], [], []]


def test_dialogue_to_text(apply):
    raw = [[("user", "a"), ("Assistant", "b"), ("tool", "c")], []]
    assert apply(D.dialogue_to_text, raw, DIALOGUE) == [
        "<|user|> a\n<|assistant|> b\ntool: c<|endoftext|>", "<|endoftext|>",
    ]


def test_format_prompt(apply):
    assert apply(D.format_prompt, ["hi"]) == ["<|user|> hi\n<|assistant|> "]


def test_filters(spark):
    df = spark.createDataFrame([(1, [("user", "a"), ("assistant", "")]), (2, [("user", "")]), (3, [])], f"id int, dialogue {DIALOGUE}")
    ids = lambda d: [r["id"] for r in d.orderBy("id").collect()]
    assert ids(rows.filter_turn_count(df)) == [1]
    assert ids(rows.filter_has_content(df)) == [1]
    assert ids(rows.filter_nonempty(df, "dialogue")) == [1, 2]


def test_converters(spark):
    alpaca = spark.createDataFrame([("a", None, "x"), ("b", "", None), ("c", "d", "y")], "instruction string, input string, output string")
    pairs = [(d[0]["content"], d[1]["content"]) for (d,) in converters.convert(alpaca, "alpaca").collect()]
    assert pairs == [("a", "x"), ("b", ""), ("c d", "y")]
    sciq = spark.createDataFrame(
        [("q ", "Ion", "ion  trap"), ("q", "Ion", "A trap"), ("q", None, "s"), ("q", "a", None)],
        "question string, correct_answer string, support string",
    )
    assert [d[1]["content"] for (d,) in converters.convert(sciq, "sciq").collect()] == ["ion trap", "Ion. A trap", "s", "a"]
    with pytest.raises(ValueError, match="unknown source"):
        converters.convert(sciq, "other")


@pytest.mark.parametrize("listed", [False, True])
def test_nq_layouts(spark, listed):
    inner = "struct<short_answers:array<struct<text:array<string>>>>"
    dtype = f"array<{inner}>" if listed else inner
    answers_ = [[(["<b>yes</b>", "no"],)], [([],)], [], None, [([" "],)]]
    data = [("q", [(a,)] if listed else (a,)) for a in answers_] + [(" ", [([(["x"],)],)] if listed else ([(["x"],)],))]
    df = spark.createDataFrame(data, f"question string, annotations {dtype}")
    got = [[m["content"] for m in d] for (d,) in converters.convert(df, "natural-questions").collect()]
    assert got == [["q", "yes"], ["q", "[]"], [], [], [], []]
    kind = df.schema["annotations"].dataType
    strict = df.select(converters.nq_short_answer(F.col("annotations"), kind, True)).collect()
    assert [r[0] for r in strict] == ["yes", "", "", "", "", "x"]


def test_few_shot_prompt_of_one_record(spark):
    df = spark.createDataFrame([(0, [("user", "Hello"), ("assistant", "Hi")])], f"id bigint, dialogue {DIALOGUE}")
    assert prompts.few_shot_prompt(df, [], "id", None).first()["prompt"] == "\n<|user|>: Hello\n<|assistant|>: Hi\n<|assistant|>: "


def test_few_shot_blocks_use_every_record_once(spark):
    df = spark.range(0, 103).select(
        F.when(F.col("id") < 70, "hot").otherwise("cold").alias("g"), "id",
        D.exchange(F.concat(F.lit(" q"), F.col("id").cast("string")), F.lit("a ")).alias("dialogue"),
    )
    got = prompts.few_shot_prompt(df, ["g"], "id", shots=8).orderBy("g", "block").collect()
    asked = [line for r in got if r["g"] == "hot" for line in r["prompt"].split("\n") if line.startswith("<|user|>")]
    assert asked == [f"<|user|>: q{i}" for i in range(70)]
    assert [r["prompt"].count("<|user|>") for r in got if r["g"] == "cold"] == [8, 8, 8, 8, 1]
    assert "<|assistant|>: a \n" in got[0]["prompt"]


def test_build_dialogue_continues_long_conversations(spark):
    turns = spark.range(0, 25).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text")
    )
    parts = dialogues.build_dialogue(turns, segment_turns=10).withColumn("source", F.lit("s"))
    got = parts.orderBy("segment").collect()
    assert [[m["content"] for m in r["dialogue"]] for r in got] == [
        [str(i) for i in range(a, b)] for a, b in ((0, 10), (10, 20), (20, 25))
    ]
    assert [(r["n_turns"], r["is_last"]) for r in got] == [(25, False), (25, False), (25, True)]
    assert rows.filter_turn_count(parts, 25).count() == 3 and rows.filter_turn_count(parts, 5).count() == 0
    whole = dialogues.as_text(dialogues.build_dialogue(turns)).first()["text"]
    pieces = dialogues.as_text(parts, "segment").orderBy("segment").collect()
    assert "".join(r["text"] for r in pieces) == whole


def test_turn_numbers_do_not_cut_a_conversation(spark):
    for start in (4094, 1_700_000_000_000):
        turns = spark.range(start, start + 4).select(
            F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text")
        )
        got = dialogues.build_dialogue(turns)
        assert [len(r["dialogue"]) for r in got.collect()] == [4] and rows.filter_turn_count(got).count() == 0


def full_prompts(turns, keep=None):
    out, lines = {}, []
    for turn, role, text in sorted(turns):
        lines.append(f"<|user|> {text}" if role == "user" else f"<|assistant|> {text}")
        if role == "user":
            shown = lines if keep is None else lines[-(keep + 1):]
            out[turn] = "\n".join([*shown, "<|assistant|> "])
    return out


@pytest.mark.parametrize("history", [None, 0, 3, 20])
def test_build_prompts(spark, monkeypatch, history):
    monkeypatch.setattr(prompts, "_CHUNK", 8)
    turns = [(3 * i, "user" if i % 3 else "system", f"m{i}") for i in range(50)]
    df = spark.createDataFrame([(1, *t) for t in turns] + [(2, 5, "user", "x")], "conv_id int, turn int, role string, text string")
    got = {(r["conv_id"], r["turn"]): r["prompt"] for r in prompts.build_prompts(df, history=history).collect()}
    want = {(1, t): p for t, p in full_prompts(turns, history).items()}
    assert got == {**want, (2, 5): "<|user|> x\n<|assistant|> "}


def test_context_prompts_equal_cut_full_prompts(spark, monkeypatch):
    monkeypatch.setattr(prompts, "_CHUNK", 8)
    data = [(1, i, "user", f"word{i} and  more ") for i in range(60)]
    df = spark.createDataFrame(data, "conv_id int, turn int, role string, text string")
    cut = {r["turn"]: r["prompt"] for r in prompts.context_prompts(df, 17).collect()}
    full = {r["turn"]: r["prompt"] for r in prompts.truncate_to_context(prompts.build_prompts(df), "prompt", 17).collect()}
    assert cut == full and len(cut) == 60


def test_postprocess(spark):
    long = "a" * 299
    cases = [
        ("hello there<|endoftext|> more", "hello there"),
        ("<|assistant|> one\n<|user|> two", "one"),
        ("first\n\nsecond", "first"),
        (long + ".", long + "."),  # exactly 300: unchanged
        ("no end here\n" + "b" * 200 + ". " + "c" * 100, "b" * 200 + "."),
        ("x. " + "d" * 300, "x."),
        ("e" * 400, "e" * 400),
        ("", ""),
    ]
    df = spark.createDataFrame([(i, "P: ", "P: " + g) for i, (g, _) in enumerate(cases)], "i int, p string, f string")
    out = df.select("i", answers.postprocess_response(F.col("p"), F.col("f")).alias("a")).orderBy("i").collect()
    assert [r["a"] for r in out] == [w for _, w in cases]


def test_hits_stop(apply):
    texts = ["", "a<|endoftext|>", "<|endoftext|>" + "x" * 300, "<|endoftext|>" + "x" * 287, "q\n<|user|>", "<|user|>", None]
    assert apply(answers.hits_stop, texts) == [False, True, False, True, True, False, False]
