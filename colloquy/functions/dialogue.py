"""Messages and dialogues: ``array<struct<role string, content string>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy.constants import ASSISTANT, EOS, USER
from colloquy.functions.text import clean_text, ensure_text, strip_ws

DIALOGUE_TYPE = "array<struct<role:string,content:string>>"


def message(role: Column | str, content: Column) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def exchange(user: Column, assistant: Column) -> Column:
    """The two-message dialogue of a question and its answer."""
    return F.array(message("user", user), message("assistant", assistant))


def empty_dialogue() -> Column:
    return F.array().cast(DIALOGUE_TYPE)


def normalize_role(c: Column) -> Column:
    """Trimmed lower-case role; anything but user and assistant is the user."""
    role = F.lower(strip_ws(ensure_text(c)))
    return F.when(role == "assistant", "assistant").otherwise("user")


def clean_dialogue(c: Column) -> Column:
    """Clean every message and drop the ones left without text. Null becomes []."""
    cleaned = F.transform(c, lambda m: message(normalize_role(m["role"]), clean_text(m["content"])))
    return F.coalesce(F.filter(cleaned, lambda m: m["content"] != ""), empty_dialogue())


def has_content(c: Column) -> Column:
    return F.coalesce(F.exists(c, lambda m: F.coalesce(m["content"], F.lit("")) != ""), F.lit(False))


def tagged_line(role: Column, content: Column) -> Column:
    """One rendered message. Roles without a tag are printed as ``role: text``."""
    content = F.coalesce(content, F.lit(""))
    return (
        F.when(F.lower(role) == "user", F.concat(F.lit(USER + " "), content))
        .when(F.lower(role) == "assistant", F.concat(F.lit(ASSISTANT + " "), content))
        .otherwise(F.concat(F.coalesce(role, F.lit("")), F.lit(": "), content))
    )


def dialogue_to_text(c: Column) -> Column:
    """Rendered training text, closed by the end-of-text token."""
    lines = F.transform(c, lambda m: tagged_line(m["role"], m["content"]))
    return F.concat(F.coalesce(F.array_join(lines, "\n"), F.lit("")), F.lit(EOS))


def format_prompt(c: Column) -> Column:
    """A single-turn prompt that ends where the answer starts."""
    return F.concat(F.lit(USER + " "), c, F.lit("\n" + ASSISTANT + " "))
