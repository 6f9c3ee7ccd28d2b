"""Cleaning an unbounded folder of dialogue records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from colloquy.functions.dialogue import DIALOGUE_TYPE
from colloquy.operators.dialogues import as_text, clean_corpus

SCHEMA = f"dialogue {DIALOGUE_TYPE}, source string"


def read_dialogue_stream(spark: SparkSession, path: str, schema: str = SCHEMA, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def clean_stream(df: DataFrame, *keep: str) -> DataFrame:
    """The batch operators, unchanged: they are stateless."""
    return as_text(clean_corpus(df), *keep)


def start_clean(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append cleaned rows to JSON lines; ``once`` stops when the input is used up."""
    writer = df.writeStream.format("json").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()
