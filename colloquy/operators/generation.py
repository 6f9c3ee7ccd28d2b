"""Running a user's text generator over a table of prompts.

A *loader* is a function without arguments that returns a generator; a generator
takes a list of prompts and returns as many full texts, prompt included. The
loader runs once per task, so a model is loaded by the worker that uses it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from colloquy.functions.answers import postprocess_response

Generator = Callable[[Sequence[str]], Sequence[str]]
Loader = Callable[[], Generator]

CALL_ROWS = 256  # prompts in one call of a generator


def batch_generate(
    df: DataFrame, loader: Loader, prompt: str = "prompt", out: str = "full", n: int | None = None,
    key: str | None = None, call_rows: int = CALL_ROWS,
) -> DataFrame:
    """Add the generator's text for every prompt, or for the first ``n`` by ``key``.

    Only the prompts become Python values, ``call_rows`` at a time, which is also the most that
    one call of the generator gets; the other columns pass through as they are.
    """
    if n is not None:
        if key is None:
            raise ValueError("the first n prompts need a key to order by")
        df = df.orderBy(key).limit(n)
    schema = StructType(list(df.schema.fields)).add(out, StringType())

    at = df.columns.index(prompt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        generate = loader()
        for batch in batches:
            for start in range(0, batch.num_rows, call_rows):
                part = batch.slice(start, call_rows)
                texts = list(generate(part.column(at).to_pylist()))
                if len(texts) != part.num_rows:
                    raise ValueError(f"generator returned {len(texts)} texts for {part.num_rows} prompts")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def generate_answers(
    df: DataFrame, loader: Loader, prompt: str = "prompt", out: str = "generation", n: int | None = None,
    key: str | None = None,
) -> DataFrame:
    """``batch_generate`` followed by ``postprocess_response``."""
    full = batch_generate(df, loader, prompt, "__full", n, key)
    return full.withColumn(out, postprocess_response(F.col(prompt), F.col("__full"))).drop("__full")


def compare_models(df: DataFrame, loaders: Mapping[str, Loader], prompt: str = "prompt") -> DataFrame:
    """The answers of several generators side by side, one column per model.

    The models follow one another over the same rows, so nothing is shuffled.
    """
    for name, loader in loaders.items():
        df = generate_answers(df, loader, prompt, out=name)
    return df
