"""Row-level operators: columns, filters, user row functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, MapType, StructType

from colloquy.functions.dialogue import has_content
from colloquy.functions.text import strip_ws


def add_source(df: DataFrame, name: str) -> DataFrame:
    """Add the constant column ``source``."""
    return df.withColumn("source", F.lit(name))


def keep_columns(df: DataFrame, *keep: str) -> DataFrame:
    """Drop every column that is not in the keep-list."""
    return df.select(*keep)


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters will not recompute.

    A filter on a projected column is normally pushed below the projection and
    evaluates its expression a second time. Columns produced by a generator stay
    where they are, so a costly expression runs once per row.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline_outer(F.array(row)))


def filter_nonempty(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose string or list is not empty."""
    dtype = df.schema[column].dataType
    measure = F.size if isinstance(dtype, (ArrayType, MapType)) else F.length
    return df.filter(measure(F.col(column)) > 0)


def filter_turn_count(df: DataFrame, n: int = 2, column: str = "dialogue") -> DataFrame:
    """Keep dialogues of exactly ``n`` messages; ``n_turns`` counts where a dialogue spans rows."""
    count = F.col("n_turns") if "n_turns" in df.columns else F.size(column)
    return df.filter(count == n)


def filter_has_content(df: DataFrame, column: str = "dialogue") -> DataFrame:
    """Keep dialogues in which any message has text."""
    return df.filter(has_content(F.col(column)))


def filter_nonblank_text(df: DataFrame, column: str = "text") -> DataFrame:
    """Keep rows whose text is not null and not only white space."""
    return df.filter(strip_ws(F.col(column)) != "")


def filter_nonempty_tokens(df: DataFrame, column: str = "input_ids") -> DataFrame:
    return df.filter(F.size(column) > 0)


def map_rows(
    df: DataFrame,
    function: Callable[..., Mapping[str, Any]],
    returns: StructType | str,
    args: Any = None,
    remove_columns: Sequence[str] = (),
) -> DataFrame:
    """Apply a Python function to each row and merge the fields it returns.

    ``returns`` declares those fields. The function gets plain Python values (None,
    int, list, dict); columns that it does not return pass through untouched. ``args`` is passed on: a dict as keyword
    arguments, a list or tuple as positional ones, any other value as one
    argument. For what Column expressions can say, use ``df.transform`` instead.
    """
    if args is None:
        positional, named = (), {}
    elif isinstance(args, Mapping):
        positional, named = (), dict(args)
    elif isinstance(args, (list, tuple)):
        positional, named = tuple(args), {}
    else:
        positional, named = (args,), {}
    new = StructType.fromDDL(returns) if isinstance(returns, str) else returns
    kept = [f for f in df.schema.fields if f.name not in remove_columns and f.name not in new.names]
    out = StructType([*kept, *new.fields])

    places = [df.columns.index(f.name) for f in kept]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = to_arrow_schema(new).types
        for batch in batches:
            made = [{**row, **function(dict(row), *positional, **named)} for row in batch.to_pylist()]
            added = [pa.array([row[n] for row in made], t) for n, t in zip(new.names, types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), *added], names=out.names)

    return df.mapInArrow(apply, out)
