"""Corpus preparation, from source records to rendered splits."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.constants import SEED
from colloquy.operators.dialogues import as_text, clean_corpus, count_source
from colloquy.operators.mixing import (
    apply_cutoffs,
    apply_split,
    cap_one_source,
    held_out_shares,
    shuffle,
    source_cutoffs,
    split_limits,
    union_all,
)
from colloquy.operators.rows import compute_once, filter_nonempty, filter_turn_count
from colloquy.session import cut_lineage
from colloquy.sources.converters import CONVERTERS, MAY_REJECT, STORED_NAME
from colloquy.sources.writers import write_jsonl

# Share of each source and size of the mixture.
SHARES = {"alpaca": 0.25, "dolly": 0.25, "sciq": 0.20, "nq": 0.30}
TOTAL = 100_000


def default_targets(total: int = TOTAL) -> dict[str, int]:
    return {name: int(share * total) for name, share in SHARES.items()}


def two_message_dialogues(
    sources: Mapping[str, DataFrame], key: str = "id",
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """Convert every source and keep two-message dialogues: ``(key, source, dialogue)``.

    ``key`` becomes ``source:key``, unique over the mixture. Sources that always
    give two messages are not checked, so that a later step that asks only for
    keys reads no text from them. ``keep`` may drop source records before they
    are converted.
    """
    parts = []
    for name, df in sources.items():
        if name not in CONVERTERS:
            raise ValueError(f"unknown source {name!r}; known: {sorted(CONVERTERS)}")
        stored = STORED_NAME.get(name, name)
        named = df.withColumn(key, F.concat(F.lit(f"{stored}:"), F.col(key).cast("string")))
        records = keep(named, stored)
        dialogue = CONVERTERS[name](records)
        if name in MAY_REJECT:
            converted = filter_turn_count(compute_once(records, dialogue=dialogue))
        else:
            converted = records.withColumn("dialogue", dialogue)
        parts.append(converted.select(key, F.lit(stored).alias("source"), "dialogue"))
    return union_all(parts)


def prepare_corpus(
    sources: Mapping[str, DataFrame], targets: Mapping[str, int] | None = None, val: float = 0.02,
    test: float = 0.02, seed: int = SEED, key: str = "id", shuffled: bool = True,
) -> DataFrame:
    """Convert, reject, balance, split, clean, render and shuffle.

    Balancing and splitting come before cleaning, so the split sizes are those
    of the uncleaned mixture. The ``(source, key)`` pairs are written to the
    checkpoint folder and the cut-offs, a row per target and one for the splits,
    are computed from them. The texts then go from scan to result in one pass
    without a shuffle, and records above their source's cut-off are dropped
    before they are converted. A cut-off is a record that was not rejected, so
    dropping first keeps the same dialogues. At the end the rendered rows are
    sorted into the random order of the mixture, unless ``shuffled`` is false.

    Records of sources that may be rejected are converted twice, once for their
    keys and once for the result; carrying the dialogues instead would write all of
    them, kept or not.
    """
    targets = default_targets() if targets is None else targets
    index = cut_lineage(two_message_dialogues(sources, key).select("source", key))
    caps = cut_lineage(source_cutoffs(index, targets, key, seed))
    kept = apply_cutoffs(index, caps, targets, key, seed)
    limits = cut_lineage(split_limits(kept, *held_out_shares(val, test), key, seed))
    balanced = two_message_dialogues(
        sources, key, lambda df, name: cap_one_source(df, name, caps, targets, key, seed)
    )
    cleaned = filter_nonempty(clean_corpus(apply_split(balanced, limits, key, seed)), "dialogue")
    texts = as_text(cleaned, "split", key)
    return shuffle(texts, key, f"{seed}:mix") if shuffled else texts


def write_corpus(df: DataFrame, path: str) -> tuple[str, DataFrame]:
    """Write the splits as JSON lines; return the path and rows per split and source.

    The counts are read from the written files, two columns of them, instead of
    keeping the corpus in memory or computing it twice.
    """
    write_jsonl(df.select("dialogue", "source", "text", "split"), path, by_split=True)
    written = df.sparkSession.read.schema("source string, split string").json(path)
    return path, count_source(written)
