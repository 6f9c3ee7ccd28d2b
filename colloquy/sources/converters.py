"""Source records to two-message dialogues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType, VariantType

from colloquy.functions.dialogue import empty_dialogue, exchange
from colloquy.functions.text import let, norm_space, norm_text, strip_ws
from colloquy.functions.values import unwrap_text

# Converter name -> name stored in the ``source`` column where they differ.
STORED_NAME = {"natural-questions": "nq"}


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def alpaca_dialogue(df: DataFrame) -> Column:
    """Instruction, and the input after a space if there is one; answer as given."""
    extra = _text("input")
    user = F.when(extra == "", _text("instruction")).otherwise(F.concat(_text("instruction"), F.lit(" "), extra))
    return exchange(user, _text("output"))


def dolly_dialogue(df: DataFrame) -> Column:
    return exchange(_text("instruction"), _text("response"))


def sciq_answer(correct: Column, support: Column) -> Column:
    """The answer followed by its support, without saying it twice."""

    def combine(s: Column) -> Column:
        answer, sup = s["answer"], s["support"]
        return (
            F.when(answer == "", sup)
            .when(sup == "", answer)
            .when(F.startswith(F.lower(sup), F.lower(answer)), sup)
            .otherwise(F.concat(answer, F.lit(". "), sup))
        )

    return let(F.struct(norm_space(correct).alias("answer"), norm_space(support).alias("support")), combine)


def sciq_dialogue(df: DataFrame) -> Column:
    return exchange(norm_space(F.col("question")), sciq_answer(F.col("correct_answer"), F.col("support")))


def nq_short_answer(annotations: Column, dtype: DataType, empty_list_as_missing: bool = False) -> Column:
    """Text of the first short answer of the first annotation, or ''.

    An answer whose text is an empty list reads '[]', unless
    ``empty_list_as_missing``. JSON strings and VARIANT values of any of the
    known layouts are accepted next to typed columns.
    """
    if isinstance(dtype, StringType):
        annotations, dtype = F.try_parse_json(annotations), VariantType()
    if isinstance(dtype, VariantType):
        paths = ("$.short_answers[0].text", "$[0].short_answers[0].text")
        raw = F.coalesce(*(F.try_variant_get(annotations, p, "variant") for p in paths))
        raw_type: DataType = VariantType()
    else:
        if isinstance(dtype, ArrayType):
            annotations, dtype = F.get(annotations, F.lit(0)), dtype.elementType
        assert isinstance(dtype, StructType)
        answer = F.get(annotations["short_answers"], F.lit(0))
        raw, raw_type = answer["text"], dtype["short_answers"].dataType.elementType["text"].dataType
    found = unwrap_text(raw, raw_type)
    if empty_list_as_missing:
        found = F.when(found == "[]", "").otherwise(found)
    return let(found, lambda t: F.when(strip_ws(t) == "", "").otherwise(norm_text(t)))


def nq_dialogue(df: DataFrame) -> Column:
    """Empty when either side has no text."""
    question = norm_text(unwrap_text(F.col("question"), df.schema["question"].dataType))
    answer = nq_short_answer(F.col("annotations"), df.schema["annotations"].dataType)
    both = F.struct(question.alias("q"), answer.alias("a"))
    missing = lambda s: (s["q"] == "") | (s["a"] == "")
    return let(both, lambda s: F.when(missing(s), empty_dialogue()).otherwise(exchange(s["q"], s["a"])))


CONVERTERS: dict[str, Callable[[DataFrame], Column]] = {
    "alpaca": alpaca_dialogue,
    "dolly": dolly_dialogue,
    "sciq": sciq_dialogue,
    "natural-questions": nq_dialogue,
}
# Sources whose records may convert to an empty dialogue; the others always give
# two messages.
MAY_REJECT = frozenset({"natural-questions"})


def convert(df: DataFrame, name: str, *keep: str) -> DataFrame:
    """Only the ``dialogue`` of each record, and the ``keep`` columns.

    An unknown name is an error.
    """
    if name not in CONVERTERS:
        raise ValueError(f"unknown source {name!r}; known: {sorted(CONVERTERS)}")
    return df.select(*keep, CONVERTERS[name](df).alias("dialogue"))
