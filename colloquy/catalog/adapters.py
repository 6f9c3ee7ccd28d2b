"""The test tables in the shapes of the corpora the operators are made for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions.dialogue import exchange, format_prompt
from colloquy.operators.dialogues import build_dialogue

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alpaca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts: a third without input, a third with an empty one."""
    kind = F.col("p_size") % 3
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("instruction"),
        F.when(kind == 1, "").when(kind == 2, F.col("p_type")).alias("input"),
        F.col("p_brand").alias("output"),
    )


def dolly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns that an assistant turn answers directly."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    pairs = asked.join(answered, ["conv_id", "turn"])
    return pairs.select(F.concat_ws("-", "conv_id", "turn").alias("id"), "instruction", "response")


def sciq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: first line as question; some without answer or support."""
    doc_id, text = F.col("doc_id"), F.col("text")
    answer = F.when(doc_id % 2 == 0, F.substring_index(text, " ", 1)).otherwise(F.col("lang"))
    return table(spark, sf_dir, "documents").select(
        doc_id.alias("id"),
        F.substring_index(text, "\n", 1).alias("question"),
        F.when(doc_id % 7 != 0, answer).alias("correct_answer"),
        F.when(doc_id % 11 == 0, "").otherwise(text).alias("support"),
    )


def heading(tag: str) -> Column:
    return F.regexp_extract("html", f"(?s)<{tag}>(.*?)</{tag}>", 1)


def nq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages: title as question; h1 as short answer, some empty or missing."""
    page = F.col("page_id")
    texts = F.when(page % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(heading("h1")))
    answers = F.when(page % 7 != 0, F.array(F.struct(texts.alias("text")))).otherwise(
        F.array().cast("array<struct<text:array<string>>>")
    )
    return table(spark, sf_dir, "pages").select(
        page.alias("id"),
        F.struct(heading("title").alias("text")).alias("question"),
        F.struct(answers.alias("short_answers")).alias("annotations"),
    )


SOURCES = {"alpaca": alpaca, "dolly": dolly, "sciq": sciq, "natural-questions": nq}


# The text that stands for a record where records are only mixed and split.
TEXT_OF = {"alpaca": "instruction", "dolly": "response", "sciq": "question", "natural-questions": "question.text"}


def dirt(text: Column, key: Column) -> Column:
    """Markup, quotes, control characters, Unicode space and blanks, by key."""
    return (
        F.when(key % 4 == 0, text)
        .when(key % 4 == 1, F.concat(F.lit("<p>"), text, F.lit("</p><br/>“x” it’s &amp; y")))
        .when(key % 4 == 2, F.concat(F.lit("\x01"), text, F.lit("\t\u00a0  z")))
        .when(key % 8 == 3, F.lit(" \u2003\n"))
        .otherwise(F.concat(F.lit("<script>a</script>"), text))
    )


def dirty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "source", dirt(F.col("text"), F.col("doc_id")).alias("text")
    )


def dirty_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question and a dirty answer per document; the question repeats its language."""
    docs = dirty_documents(spark, sf_dir)
    asked = F.when(F.col("doc_id") % 16 == 3, " ").otherwise(F.concat(F.lit("about \t"), F.col("source")))
    return docs.select("doc_id", "source", exchange(asked, F.col("text")).alias("dialogue"))


def conversation_dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn numbers far apart, as time stamps are."""
    turns = table(spark, sf_dir, "conversations").withColumn("turn", F.col("turn").cast("bigint") * 10_000)
    return build_dialogue(turns)


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user with two metrics; a fifth of the runs improves at every step."""
    step = F.col("event_id")
    value = F.when(F.col("user_id") % 5 == 0, 500.0 / (step + 1)).otherwise(F.col("value"))
    metrics = F.array(
        F.struct(F.lit("eval_loss").alias("metric"), value.alias("value")),
        F.struct(F.lit("learning_rate").alias("metric"), (F.col("value") / (step % 13 + 1)).alias("value")),
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), step.alias("step"), F.inline(metrics)
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt and the full text of a model that goes on too long."""
    doc_id, text = F.col("doc_id"), F.col("text")
    gen = (
        F.when(doc_id % 4 == 0, text)
        .when(doc_id % 4 == 1, F.concat(text, F.lit("<|endoftext|> more")))
        .when(doc_id % 4 == 2, F.concat(F.lit("<|assistant|> "), text, F.lit("\n<|user|> next")))
        .otherwise(F.concat(F.lit("A first part.\n\n"), text))
    )
    prompt = format_prompt(F.col("lang"))
    return table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"), F.concat(prompt, gen).alias("full"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", format_prompt(F.col("text")).alias("prompt"))


def chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in which some users leave, or send nothing."""
    turn, conv = F.col("turn"), F.col("conv_id")
    text = (
        F.when((F.col("role") == "user") & (conv % 5 == 1) & (turn == 2), "exit")
        .when((F.col("role") == "user") & (conv % 5 == 2) & (turn == 2), " Sair ")
        .when((F.col("role") == "user") & (conv % 5 == 3) & (turn == 2), "  ")
        .otherwise(F.col("text"))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", text.alias("text"))
