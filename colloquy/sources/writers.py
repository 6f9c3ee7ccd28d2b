"""Writing corpora and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jsonl(df: DataFrame, path: str, by_split: bool = False, force_ascii: bool = False, mode: str = "errorifexists") -> str:
    """Write JSON lines into a folder and return its path.

    Null fields are written as null. ``force_ascii`` escapes other characters.
    ``by_split`` writes one sub-folder per value of ``split``.
    """
    if not hasattr(df, "sparkSession") or not hasattr(df, "write"):
        raise TypeError(f"write_jsonl needs a Spark DataFrame, got {type(df).__name__}")
    writer = (
        df.write.mode(mode)
        .option("ignoreNullFields", False)
        .option("writeNonAsciiCharacterAsCodePoint", force_ascii)
    )
    if by_split:
        writer = writer.partitionBy("split")
    writer.json(path)
    return path


def write_samples(df: DataFrame, path: str) -> str:
    """Append ``(prompt, generation)`` rows to a Parquet table."""
    df.select("prompt", "generation").write.mode("append").parquet(path)
    return path
