"""Text cleaning as Column expressions.

Each function is a chain in which every step refers to its input once. Inside a
lambda (``transform`` over the messages of a dialogue) Spark does not share
common subexpressions, so a second reference would run the whole chain again.
"""

from __future__ import annotations

import html.entities
import json
from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DecimalType, FractionalType

from colloquy.constants import CONTROL, CURLY_QUOTES, STRAIGHT_QUOTES, WS, WS_CHARS

# Markup, matched in one pass from its '<', so whichever construct starts first
# wins: a script tag inside a comment is part of the comment.
_MARKUP = (
    r"(?is)<(?:"
    # Content that is never shown.
    r"!--.*?(?:-->|\z)"
    r"|!\[CDATA\[.*?(?:\]\]>|\z)"
    r"|script\b(?:[^>]*[^/>])?>.*?(?:</script\s*>|\z)"
    r"|style\b(?:[^>]*[^/>])?>.*?(?:</style\s*>|\z)"
    r"|template\b(?:[^>]*[^/>])?>.*?(?:</template\s*>|\z)"
    r"|![a-z][^>]*>"
    r"|\?[^>]*>"
    # A tag starts with a letter ("a < b" is text); quoted values may hold '>'.
    # Possessive, so a tag with any number of attributes needs no stack.
    r"""|/?[a-z](?:[^"'>]*+(?:"[^"]*+"|'[^']*+'))*+[^"'>]*+>"""
    r"|/?[a-z][^>]*>"
    r")"
)
_ENTITY_PIECES = r"&#?[A-Za-z0-9]+;?|[^&]+|&"


def _named_entities() -> str:
    """HTML entity names (without ';') by first letter, as JSON in a SQL string."""
    table: dict[str, dict[str, str]] = defaultdict(dict)
    for name, char in html.entities.html5.items():
        table[name[0]][name.rstrip(";")] = char
    return json.dumps(table, sort_keys=True).replace("\\", "\\\\").replace("'", "\\'")


_NAMED_ENTITIES = _named_entities()
# Numeric references 128-159 mean Windows-1252 characters.
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_MEANT = bytes(range(0x80, 0xA0)).decode("cp1252", "replace")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a bound variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_ws(c: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.trim(c, F.lit(WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """Turn every run of white space into one space and trim."""
    return F.trim(F.regexp_replace(c, WS, " "))


def norm_space(c: Column) -> Column:
    """Null becomes '', other values become text with single spaces."""
    return collapse_ws(F.coalesce(c.cast("string"), F.lit("")))


def ensure_text(c: Column, dtype: DataType | None = None) -> Column:
    """Null becomes ''; an array is joined by spaces; anything else is cast.

    Pass ``dtype`` for columns that are no strings. A null inside an array prints
    as 'None' and booleans as 'True' and 'False'. Floating-point numbers are
    printed only where all engines print them alike, from 0.001 up to below
    10,000,000; others are an error, to be formatted by the caller.
    """
    if isinstance(dtype, ArrayType):
        parts = F.transform(c, lambda x: F.coalesce(_shown(x, dtype.elementType), F.lit("None")))
        return F.coalesce(F.array_join(parts, " "), F.lit(""))
    return F.coalesce(_shown(c, dtype), F.lit(""))


def _shown(c: Column, dtype: DataType | None) -> Column:
    text = c.cast("string")
    if isinstance(dtype, BooleanType):
        return F.initcap(text)
    if isinstance(dtype, FractionalType) and not isinstance(dtype, DecimalType):
        size = F.abs(c)
        plain = c.isNull() | (size == 0) | ((size >= 0.001) & (size < 1e7))
        return F.when(plain, text).otherwise(F.raise_error(F.concat(F.lit("format this number first: "), text)))
    return text


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, " ")


def straight_quotes(c: Column) -> Column:
    """Right single and both double curly quotes; the left single one stays."""
    for curly, straight in zip(CURLY_QUOTES, STRAIGHT_QUOTES):
        c = F.replace(c, F.lit(curly), F.lit(straight))
    return c


# One parsed lambda: built call by call it would cost more time than it runs.
# References that decode to nothing valid become U+FFFD; "&" and unknown names stay.
_DECODE_ENTITIES = f"""
text -> if(contains(text, '&'), array_join(transform(
  regexp_extract_all(text, '{_ENTITY_PIECES}', 0),
  piece -> CASE
    WHEN piece RLIKE '^&#[0-9]+;?$|^&#[xX][0-9A-Fa-f]+;?$' THEN translate(coalesce(decode(unhex(lpad(hex(
      transform(array(try_cast(
        if(substr(piece, 3, 1) IN ('x', 'X'), conv(rtrim(';', substr(piece, 4)), 16, 10), rtrim(';', substr(piece, 3)))
        AS bigint)), n -> if(n BETWEEN 1 AND 55295 OR n BETWEEN 57344 AND 1114111, n, NULL))[0]
      ), 8, '0')), 'UTF-32'), '\ufffd'), '{_C1}', '{_C1_MEANT}')
    WHEN startswith(piece, '&') THEN coalesce(
      try_element_at(try_element_at(
        from_json('{_NAMED_ENTITIES}', 'map<string,map<string,string>>'), substr(piece, 2, 1)),
        rtrim(';', substr(piece, 2))), piece)
    ELSE piece END), ''), text)
"""


def decode_entities(c: Column) -> Column:
    """Decode named and numeric character references in one pass.

    One pass means ``&amp;lt;`` yields ``&lt;``. Unknown names stay as written.
    """
    return F.get(F.call_function("transform", F.array(c), F.expr(_DECODE_ENTITIES)), F.lit(0))


def strip_html(c: Column) -> Column:
    """Visible text of an HTML fragment, a space where markup stood.

    White space inside is left for ``collapse_ws``; comments, doctype, CDATA sections,
    script, style and template content are not visible. Left open, they run to the end.
    """

    def drop_markup(t: Column) -> Column:
        # All markup starts with '<': text without one is not searched.
        return F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, _MARKUP, " ")).otherwise(t)

    return decode_entities(let(c, drop_markup))


def strip_tags(c: Column) -> Column:
    """The plain rule: anything between angle brackets becomes a space."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")


def norm_text(c: Column) -> Column:
    """HTML to text, straight quotes, single spaces; null becomes ''."""
    return collapse_ws(straight_quotes(strip_html(F.coalesce(c.cast("string"), F.lit("")))))


def clean_text(c: Column, dtype: DataType | None = None) -> Column:
    """Training text: control characters, HTML, white space, quotes, in that order."""
    return straight_quotes(collapse_ws(strip_html(strip_control(ensure_text(c, dtype)))))
