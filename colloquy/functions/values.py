"""Nested and typed values: unwrapping, coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    MapType,
    NumericType,
    StringType,
    StructType,
    VariantType,
)

from colloquy.constants import TRUE_WORDS
from colloquy.functions.text import strip_ws

UNWRAP_STEPS = 50


def first_or_self(c: Column, dtype: DataType) -> Column:
    """First element of a non-empty array column; other columns unchanged.

    An array column has one type, so the empty array yields null here.
    """
    return F.get(c, F.lit(0)) if isinstance(dtype, ArrayType) else c



def unwrap_text(c: Column, dtype: DataType) -> Column:
    """Follow first elements and ``text`` / ``texts`` fields down to a string.

    The path is resolved from the column's type when the plan is built. Null
    becomes ''. An empty array prints as '[]'. A struct without either field
    prints as JSON. A VARIANT value, whose shape is not known before the rows are
    read, is followed for ``UNWRAP_STEPS`` steps.
    """
    if isinstance(dtype, ArrayType):
        inner = unwrap_text(F.get(c, F.lit(0)), dtype.elementType)
        return F.when(c.isNull(), "").when(F.size(c) == 0, "[]").otherwise(inner)
    if isinstance(dtype, StructType):
        for field in ("text", "texts"):
            if field in dtype.names:
                inner = unwrap_text(c[field], dtype[field].dataType)
                return F.when(c.isNull(), "").otherwise(inner)
        return F.when(c.isNull(), "").otherwise(F.to_json(c))
    if isinstance(dtype, MapType):
        out = F.when(F.size(c) == 0, "{}").otherwise(F.to_json(c))
        for field in ("texts", "text"):
            inner = unwrap_text(F.try_element_at(c, F.lit(field)), dtype.valueType)
            out = F.when(F.map_contains_key(c, field), inner).otherwise(out)
        return F.when(c.isNull(), "").otherwise(out)
    if isinstance(dtype, VariantType):
        return _unwrap_variant(c)
    return F.coalesce(c.cast("string"), F.lit(""))


def _unwrap_variant(c: Column) -> Column:
    """One step per round: first element, ``text`` or ``texts``; a scalar stays."""

    def step(v: Column, _: Column) -> Column:
        inner = (F.try_variant_get(v, path, "variant") for path in ("$[0]", "$.text", "$.texts"))
        return F.coalesce(*inner, v)

    last = F.aggregate(F.sequence(F.lit(1), F.lit(UNWRAP_STEPS)), c, step)
    return F.coalesce(F.try_variant_get(last, "$", "string"), F.lit(""))


def _reject(name: str, wanted: str, c: Column) -> Column:
    shown = F.coalesce(c.cast("string"), F.lit("null"))
    return F.raise_error(F.concat(F.lit(f"{name}: not a value of type {wanted}: "), shown))


def coerce_int(c: Column, name: str, dtype: DataType) -> Column:
    """Whole number or an error naming the field. 3.7 is 3, but '3.7' is an error."""
    if isinstance(dtype, StringType):
        text = strip_ws(c)
        digits = F.when(text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(text, F.lit("_"), F.lit("")))
        value = digits.try_cast("bigint")
    elif isinstance(dtype, (NumericType, BooleanType)):
        value = c.try_cast("bigint")
    else:
        raise TypeError(f"Field '{name}' must be int, column type is {dtype.simpleString()}")
    return F.when(value.isNull(), _reject(name, "int", c).cast("bigint")).otherwise(value)


# What Python reads as a float: single underscores between digits, no type suffix, no hex.
PYTHON_FLOAT = (
    r"(?i)^[+-]?(?:inf|infinity|nan|(?:[0-9]+(?:_[0-9]+)*\.?(?:[0-9]+(?:_[0-9]+)*)?|\.[0-9]+(?:_[0-9]+)*)"
    r"(?:e[+-]?[0-9]+(?:_[0-9]+)*)?)$"
)


def coerce_float(c: Column, name: str, dtype: DataType) -> Column:
    """Floating-point number or an error naming the field."""
    if isinstance(dtype, StringType):
        text = strip_ws(c)
        number = F.when(text.rlike(PYTHON_FLOAT), F.replace(text, F.lit("_"), F.lit("")))
        nan = text.rlike(r"(?i)^[+-]?nan$")
        value = F.when(nan, F.lit(float("nan"))).otherwise(number.try_cast("double"))
    elif isinstance(dtype, BooleanType):
        value = c.cast("int").cast("double")
    elif isinstance(dtype, NumericType):
        value = c.cast("double")
    else:
        raise TypeError(f"Field '{name}' must be float, column type is {dtype.simpleString()}")
    return F.when(value.isNull(), _reject(name, "float", c).cast("double")).otherwise(value)


def coerce_bool(c: Column, name: str, dtype: DataType) -> Column:
    """Booleans pass; the words 1, true, yes, y, on are true, other text is false."""
    if isinstance(dtype, BooleanType):
        value = c
    elif isinstance(dtype, StringType):
        value = F.lower(strip_ws(c)).isin(*TRUE_WORDS)
    else:
        raise TypeError(f"Field '{name}' must be bool, column type is {dtype.simpleString()}")
    return F.when(value.isNull(), _reject(name, "bool", c).cast("boolean")).otherwise(value)
