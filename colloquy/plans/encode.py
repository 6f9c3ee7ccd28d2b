"""From rendered text to padded training batches, and from prompts to answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.constants import BLOCK_SIZE, EOS, SEED
from colloquy.functions.tokens import pretokenize, truncate_head
from colloquy.operators.batching import collate, length_grouped_batches
from colloquy.operators.generation import Loader, generate_answers
from colloquy.operators.rows import filter_nonblank_text
from colloquy.operators.vocabulary import tokenize, tokenize_keep
from colloquy.session import cut_lineage


def encode_corpus(
    df: DataFrame, vocab: DataFrame, batch_size: int, key: str, pad_id: int | None = None,
    block_size: int = BLOCK_SIZE, seed: int = SEED, split: str | None = None,
) -> DataFrame:
    """Tokenize, batch by length, pad: one row per example with its ``batch_id``.

    With ``split`` every split is batched for itself and the column is kept. The token
    arrays are written once and moved once.
    """
    vocab = cut_lineage(vocab)  # used twice below
    if pad_id is None:
        pad_id = vocab.filter(F.col("token") == EOS).first()["id"]
    by = [] if split is None else [split]
    tokens = tokenize(df, vocab, block_size, keep=[key, *by])
    sized = cut_lineage(tokens.withColumn("n_tokens", F.size("input_ids")))
    batches = length_grouped_batches(sized, key, "n_tokens", batch_size, seed, by=by)
    return collate(batches, pad_id, longest="batch_size_max").drop("batch_size_max")


def score_prompts(
    df: DataFrame, loader: Loader, n: int | None = None, key: str | None = None, max_len: int = BLOCK_SIZE,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """Answers to the texts of a test table, each cut to its first ``max_len`` tokens.

    ``prompt`` is the text of the tokens that fit, ``generation`` the answer. With
    ``vocab`` the ids of those tokens are kept as ``input_ids``.
    """
    fitting = F.array_join(truncate_head(pretokenize(F.col("text")), max_len), "")
    texts = filter_nonblank_text(df) if vocab is None else tokenize_keep(df, vocab, max_len)
    prompts = texts.withColumn("prompt", fitting)
    return generate_answers(prompts, loader, "prompt", "generation", n, key)
