"""Building, cleaning and rendering dialogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.constants import EOS
from colloquy.functions.dialogue import clean_dialogue, dialogue_to_text, has_content, message
from colloquy.operators.ranking import ordinal_rank
from colloquy.operators.rows import compute_once


def build_dialogue(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    segment_turns: int | None = None,
) -> DataFrame:
    """One row per conversation with its turns as an ordered dialogue.

    Turn numbers are unique in a conversation. With ``segment_turns`` a longer
    conversation continues in further rows of that many messages, numbered by
    ``segment``. Each then carries ``n_turns``, the size of the whole conversation,
    and ``is_last``, so that size filters and rendering treat it as one.
    """
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn), F.col(role), F.col(text))))
    dialogue = F.transform("__turns", lambda t: message(t[role], t[text])).alias("dialogue")
    if segment_turns is None:
        return df.groupBy(conv).agg(turns.alias("__turns")).select(conv, dialogue)
    ranked = ordinal_rank(df.select(conv, turn, role, text), turn, [conv], out="__rank")
    segment = F.floor((F.col("__rank") - 1) / segment_turns).alias("segment")
    rows = ranked.groupBy(conv, segment).agg(turns.alias("__turns"))
    sizes = df.groupBy(conv).agg(F.count(F.lit(1)).alias("n_turns"))
    is_last = ((F.col("segment") + 1) * segment_turns >= F.col("n_turns")).alias("is_last")
    return rows.join(sizes, conv).select(conv, "segment", "n_turns", is_last, dialogue)


def clean_corpus(df: DataFrame) -> DataFrame:
    """Clean every dialogue, whatever its split, and drop those left empty.

    A dialogue may keep a single message: the two-message check comes earlier.
    """
    cleaned = compute_once(df, dialogue=clean_dialogue(F.col("dialogue")))
    return cleaned.filter(has_content(F.col("dialogue")))


def as_text(df: DataFrame, *keep: str) -> DataFrame:
    """Render the dialogue; keep ``dialogue``, ``source``, ``text`` and ``keep``.

    Of a dialogue that spans rows only the last row ends the text; the others end a line.
    """
    kept = [c for c in ("dialogue", "source", *keep) if c in df.columns]
    text = dialogue_to_text(F.col("dialogue"))
    if "is_last" in df.columns:
        open_end = F.concat(F.substring(text, F.lit(1), F.length(text) - len(EOS)), F.lit("\n"))
        text = F.when(F.col("is_last"), text).otherwise(open_end)
    return df.select(*kept, text.alias("text"))


def count_source(df: DataFrame) -> DataFrame:
    """Rows per split and source; no rows when there is no source column."""
    if "source" not in df.columns:
        return df.sparkSession.createDataFrame([], "split string, source string, rows bigint")
    split = F.col("split") if "split" in df.columns else F.lit("all").alias("split")
    return df.groupBy(split, "source").agg(F.count(F.lit(1)).alias("rows"))
