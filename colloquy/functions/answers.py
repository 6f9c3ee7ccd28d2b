"""Post-processing of generated text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.constants import ASSISTANT, EOS, STOP_STRINGS, USER, WS
from colloquy.functions.text import strip_ws

# From the start of the first line that holds a sentence end up to that end.
# Anchored at line starts, so a long text without any is read once, not once
# per character.
_FIRST_SENTENCE = rf"(?:^|\n)([^\n]+?[.!?])(?:{WS}|$)"


def generated_part(prompt: Column, full: Column) -> Column:
    """What follows the prompt, by length."""
    return F.substring(full, F.length(prompt) + 1, F.length(full))


def postprocess_response(prompt: Column, full: Column, long_chars: int = 300) -> Column:
    """The answer inside ``full`` = prompt + generation.

    Cut at the end-of-text token, then at a new user turn; drop assistant tags;
    keep the first paragraph; of an answer longer than ``long_chars`` keep the
    first sentence if it has one.
    """
    gen = F.substring_index(generated_part(prompt, full), EOS, 1)
    gen = F.substring_index(gen, "\n" + USER, 1)
    gen = strip_ws(F.replace(gen, F.lit(ASSISTANT), F.lit("")))
    paragraph = strip_ws(F.substring_index(gen, "\n\n", 1))
    sentence = F.regexp_extract(paragraph, _FIRST_SENTENCE, 1)
    return F.when((F.length(paragraph) > long_chars) & (sentence != ""), sentence).otherwise(paragraph)


def hits_stop(gen: Column, stops: Sequence[str] = STOP_STRINGS, window: int = 300) -> Column:
    """Whether a stop string lies within the last ``window`` characters."""
    tail = F.right(gen, F.lit(window))
    return F.coalesce(reduce(lambda a, b: a | b, (F.contains(tail, F.lit(s)) for s in stops)), F.lit(False))
