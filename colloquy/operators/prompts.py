"""Prompts: few-shot blocks and chat history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.constants import ASSISTANT, CONTEXT_SIZE, USER
from colloquy.functions.text import strip_ws
from colloquy.functions.tokens import pretokenize, truncate_tail
from colloquy.operators.ranking import ordinal_rank

_CHUNK = 4096


def few_shot_prompt(
    df: DataFrame, by: Sequence[str], order: str, shots: int | None, dialogue: str = "dialogue"
) -> DataFrame:
    """Question/answer records in order, ready for one more answer.

    The first two messages of each dialogue are used; the question is stripped,
    the answer is not. With ``shots``, each group gives consecutive prompts
    (numbered by ``block``) of that many records: every record is used once and
    no prompt grows with the table. ``shots=None`` makes each group one prompt, for
    groups known to fit one. ``order`` is an integer, unique in its group.
    """
    first, second = F.get(F.col(dialogue), F.lit(0)), F.get(F.col(dialogue), F.lit(1))
    record = F.concat(
        F.lit(USER + ": "), strip_ws(first["content"]), F.lit("\n" + ASSISTANT + ": "), second["content"]
    )
    rows = df.select(*by, order, record.alias("__record"))
    if shots is None:
        rows = rows.withColumn("block", F.lit(0).cast("bigint"))
    else:
        rows = ordinal_rank(rows, order, by, out="__rank").withColumn("block", F.floor((F.col("__rank") - 1) / shots))
    records = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("__record").alias("r"))))
    grouped = rows.groupBy(*by, "block").agg(records.alias("__records"))
    body = F.array_join(F.transform("__records", lambda s: s["r"]), "\n")
    return grouped.select(*by, "block", F.concat(F.lit("\n"), body, F.lit("\n" + ASSISTANT + ": ")).alias("prompt"))


def build_prompts(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    history: int | None = None,
) -> DataFrame:
    """For each user turn, the whole conversation so far as a prompt.

    User lines carry the user tag, all others the assistant tag, and the prompt
    ends with an open assistant tag. ``history`` keeps that many earlier lines.
    Turn numbers are unique in a conversation.

    Long conversations are cut into chunks, so no task sorts more than a chunk.
    With ``history`` the chunks overlap by that many lines. Without it the text
    of all earlier chunks is put in front; each prompt then repeats the
    conversation, so the output is quadratic in its length by definition.
    """
    asks = F.col(role) == "user"
    tag = F.when(asks, USER).otherwise(ASSISTANT)
    lines = df.select(conv, turn, asks.alias("__asks"), F.concat(tag, F.lit(" "), F.col(text)).alias("__line"))
    seen = _within_chunks(lines, conv, turn) if history is None else _recent(lines, conv, turn, history)
    return seen.select(conv, turn, F.concat("__seen", F.lit("\n" + ASSISTANT + " ")).alias("prompt"))


def _recent(lines: DataFrame, conv: str, turn: str, history: int) -> DataFrame:
    """Each asking line with up to ``history`` lines before it."""
    size = max(_CHUNK, history)
    ranked = ordinal_rank(lines, turn, [conv], out="__pos")
    home = F.floor((F.col("__pos") - 1) / size)
    needed_next = (F.col("__pos") - 1) % size >= size - history
    chunks = F.when(needed_next, F.array(home, home + 1)).otherwise(F.array(home))
    spread = ranked.select("*", home.alias("__home"), F.explode(chunks).alias("__chunk"))
    frame = W.partitionBy(conv, "__chunk").orderBy("__pos").rowsBetween(-history, 0)
    seen = spread.withColumn("__seen", F.array_join(F.collect_list("__line").over(frame), "\n"))
    return seen.filter(F.col("__asks") & (F.col("__home") == F.col("__chunk")))


def _within_chunks(lines: DataFrame, conv: str, turn: str) -> DataFrame:
    """Each asking line with all lines before it."""
    chunked = lines.withColumn("__chunk", F.floor(F.col(turn) / _CHUNK))
    frame = W.partitionBy(conv, "__chunk").orderBy(turn).rowsBetween(W.unboundedPreceding, 0)
    seen = chunked.withColumn("__seen", F.array_join(F.collect_list("__line").over(frame), "\n")).filter("__asks")

    # Usually no conversation has a second chunk; this side is then empty.
    spans = chunked.groupBy(conv).agg(F.min("__chunk").alias("__lo"), F.max("__chunk").alias("__hi"))
    long = spans.filter(F.col("__lo") < F.col("__hi")).select(conv)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col("__line").alias("l"))))
    texts = chunked.join(long, conv, "left_semi").groupBy(conv, "__chunk").agg(ordered.alias("__lines"))
    before = W.partitionBy(conv).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    text = F.array_join(F.transform("__lines", lambda s: s["l"]), "\n")
    earlier = texts.withColumn("__text", text).select(
        conv, "__chunk", F.collect_list("__text").over(before).alias("__earlier")
    )
    joined = seen.join(earlier, [conv, "__chunk"], "left")
    parts = F.concat(F.coalesce("__earlier", F.array().cast("array<string>")), F.array("__seen"))
    return joined.withColumn("__seen", F.array_join(parts, "\n"))


def truncate_to_context(df: DataFrame, column: str = "prompt", max_len: int = CONTEXT_SIZE) -> DataFrame:
    """Keep the last ``max_len`` tokens of a text; adds ``tokens`` as well."""
    tail = truncate_tail(pretokenize(F.col(column)), max_len)
    return df.withColumn("tokens", tail).withColumn(column, F.array_join("tokens", ""))


def context_prompts(
    df: DataFrame, max_len: int = CONTEXT_SIZE, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``build_prompts`` cut to the model's context, for conversations of any length.

    Each line holds at least one token, its tag, so the last ``max_len`` lines
    contain the last ``max_len`` tokens and earlier lines cannot matter.
    """
    prompts = build_prompts(df, conv, turn, role, text, history=max_len)
    return truncate_to_context(prompts, "prompt", max_len)
