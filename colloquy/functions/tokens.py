"""Splitting text into pieces, and windows over piece arrays."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.constants import SPECIALS

# The published GPT-style split, without its lookahead. '<' never
# joins the space before it: that space would split a special tag that follows.
_WORDS = (r" ?\p{L}+", r" ?\p{N}+")
_REST = (
    r"'(?:s|t|re|ve|m|ll|d)",
    r" ?[^\p{Z}\t\n\x0B\f\r\x{85}\p{L}\p{N}<]+",
    r"<",
    r"[\p{Z}\t\n\x0B\f\r\x{85}]+",
)


def piece_pattern(specials: Sequence[str] = SPECIALS) -> str:
    """The alternation of all pieces; the most frequent ones are tried first."""
    return "|".join([*_WORDS, *(re.escape(tag) for tag in specials), *_REST])


def pretokenize(c: Column, specials: Sequence[str] = SPECIALS) -> Column:
    """Pieces that join back to the text; special tags are one piece each."""
    return F.regexp_extract_all(c, F.lit(piece_pattern(specials)), F.lit(0))


def truncate_head(tokens: Column, n: int) -> Column:
    """The first ``n`` elements."""
    return F.slice(tokens, 1, n)


def truncate_tail(tokens: Column, n: int) -> Column:
    """The last ``n`` elements."""
    return F.slice(tokens, F.greatest(F.size(tokens) - (n - 1), F.lit(1)), F.lit(n))


def pad_right(c: Column, length: Column, fill: int) -> Column:
    return F.concat(c, F.array_repeat(F.lit(fill), (length - F.size(c)).cast("int")))
