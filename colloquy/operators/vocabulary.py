"""Vocabulary tables and tokenization.

A vocabulary is a table ``(token string, id int)``.
"""

from __future__ import annotations

import secrets
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.constants import BLOCK_SIZE, EOS, SPECIALS
from colloquy.functions.dialogue import dialogue_to_text
from colloquy.functions.text import strip_ws
from colloquy.functions.tokens import pretokenize, truncate_head
from colloquy.operators.rows import filter_nonblank_text
from colloquy.session import cut_lineage, scratch_path

# A vocabulary up to this many tokens is sent to the workers; a larger one is joined, with equal results.
MAX_SHIPPED_TOKENS = 500_000
_SLICE_ROWS = 1024  # rows looked up at a time
_BLOCK_ROWS, _BLOCK_TOKENS = 2048, 1 << 20  # most rows, and tokens of several rows, that share one look-up in the joined path
_FILTER_BITS = 1 << 24  # fixed size of a filter that passes every token of a vocabulary and some others
_DICTIONARY_BYTES = 16 << 20  # so far written columns of tokens are dictionary-coded


def count_tokens(df: DataFrame, column: str = "text", specials: Sequence[str] = SPECIALS) -> DataFrame:
    """How often each token occurs, special tokens left out."""
    # explode_outer: a plain explode would evaluate the split twice, once in a
    # filter that Catalyst adds below it.
    pieces = df.select(F.explode_outer(pretokenize(F.col(column), specials)).alias("token"))
    ordinary = pieces.filter(F.col("token").isNotNull() & ~F.col("token").isin(*specials))
    return ordinary.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def build_vocab(
    df: DataFrame, size: int, column: str = "text", specials: Sequence[str] = SPECIALS
) -> DataFrame:
    """The ``size`` most frequent tokens by falling count, then the special tokens.

    The first special token also serves as padding and as the unknown token.
    """
    counts = count_tokens(df, column, specials)
    # Only tokens at least as frequent as the last one wanted are sorted. That
    # frequency comes from the number of tokens per frequency, a table with at
    # most sqrt(2 * total) rows; both uses share one shuffle of the counts.
    per_frequency = counts.groupBy("n").agg(F.count(F.lit(1)).alias("__tokens"))
    upto = F.sum("__tokens").over(W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, 0))
    least = per_frequency.withColumn("__upto", upto).filter(F.col("__upto") >= size).agg(F.max("n")).scalar()
    frequent = counts.filter(F.col("n") >= F.coalesce(least, F.lit(0)))
    top = frequent.orderBy(F.desc("n"), "token").limit(size)
    tail = df.sparkSession.createDataFrame(
        [(tag, -1 - i) for i, tag in enumerate(specials)], "token string, n bigint"
    )
    # The window sees at most size + len(specials) rows.
    order = W.orderBy(F.desc("n"), "token")
    return top.unionByName(tail).select("token", (F.row_number().over(order) - 1).cast("int").alias("id"))


def vocab_check(vocab: DataFrame, expected: int | None = None) -> DataFrame:
    """One row: size, distinct tokens, largest id, and whether all of them agree."""
    report = vocab.agg(
        F.count(F.lit(1)).alias("size"),
        F.countDistinct("token").alias("tokens"),
        F.countDistinct("id").alias("ids"),
        F.min("id").alias("min_id"),
        F.max("id").alias("max_id"),
    )
    ok = (F.col("tokens") == F.col("size")) & (F.col("ids") == F.col("size"))
    ok = ok & (F.coalesce("min_id", F.lit(0)) == 0) & (F.coalesce("max_id", F.lit(-1)) == F.col("size") - 1)
    if expected is not None:
        ok = ok & (F.col("size") == expected)
    return report.withColumn("ok", ok)


def assert_vocab(vocab: DataFrame, expected: int | None = None, name: str = "") -> None:
    """Raise when the vocabulary is inconsistent or not of the expected size."""
    row = vocab_check(vocab, expected).first()
    if not row["ok"]:
        raise ValueError(f"vocabulary {name!r} is inconsistent: wanted size {expected}, counted {row.asDict()}")


def encode_tokens(
    df: DataFrame, vocab: DataFrame, column: str = "tokens", out: str = "input_ids", unknown: str = EOS,
    max_shipped: int = MAX_SHIPPED_TOKENS,
) -> DataFrame:
    """Replace each token by its id; a token without one gets that of ``unknown``.

    A null array becomes an empty one; a vocabulary without ``unknown``, or with
    a token more than once, is an error. The size of the vocabulary decides only how the look-up runs: up to
    ``max_shipped`` tokens are sent to the workers and looked up on Arrow arrays; more
    are joined, block by block of a written copy of ``df``, with the same result.
    """
    table = vocab.select("token", F.col("id").cast("int").alias("id"))
    head = table.limit(max_shipped + 1).toArrow()
    ships = head.num_rows <= max_shipped
    if ships:  # what was sent holds all there is to check
        at = pc.index(head["token"], pa.scalar(unknown, head["token"].type)).as_py()
        unknown_id = head["id"][at].as_py() if at >= 0 else None
        counts = pc.value_counts(head["token"].combine_chunks())
        repeated = counts.filter(pc.greater(counts.field("counts"), 1)).field("values")[:1].to_pylist()
    else:
        table = cut_lineage(table)
        found = table.filter(F.col("token") == unknown).first()
        at, unknown_id = (-1, None) if found is None else (0, found["id"])
        repeated = [r["token"] for r in table.groupBy("token").count().filter(F.col("count") > 1).head(1)]
    if at < 0:
        raise ValueError(f"the vocabulary lacks its unknown token {unknown!r}")
    if repeated:  # one answer for either path
        raise ValueError(f"the vocabulary holds token {repeated[0]!r} more than once")
    if not ships:
        return _encode_by_join(df, table, column, out, unknown_id)
    shipped = df.sparkSession.sparkContext.broadcast((head["token"], head["id"], unknown_id))

    @F.arrow_udf("array<int>")
    def look_up(batch: pa.Array) -> pa.Array:
        parts = [_ids(batch.slice(at, _SLICE_ROWS), *shipped.value) for at in range(0, len(batch), _SLICE_ROWS)]
        return pa.concat_arrays(parts or [pa.array([], pa.list_(pa.int32()))])

    return df.withColumn(out, look_up(column))


def _ids(tokens: pa.Array, known: pa.ChunkedArray, ids: pa.ChunkedArray, unknown_id: int) -> pa.ListArray:
    """The ids of an array of token lists, all in Arrow: no token becomes a Python string."""
    at = pc.index_in(tokens.flatten(), value_set=known.combine_chunks())
    values = pc.fill_null(ids.combine_chunks().cast(pa.int32()).take(at), pa.scalar(unknown_id, pa.int32()))
    sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _encode_by_join(df: DataFrame, table: DataFrame, column: str, out: str, unknown_id: int) -> DataFrame:
    """The rows are written with their tokens numbered within blocks of rows; only the distinct
    tokens of a block that a filter passes are joined, and their ids go back to the block by these numbers.

    A token comes once in a block, so none has many of the rows that are joined.
    """
    path = scratch_path(df.sparkSession, "coded")
    coded = df.withColumn("__at", _numbers(df.sparkSession, column, _token_filter(table)))
    # Rows are compressed, as tokens take several times the room of their text.
    write = coded.write.option("compression", "zstd").option("parquet.dictionary.page.size", str(_DICTIONARY_BYTES))
    write.parquet(path)
    coded = df.sparkSession.read.schema(coded.schema).parquet(path)
    words = coded.select(F.col("__at.block").alias("__of"), F.inline("__at.words"))
    found = words.join(table.filter("id IS NOT NULL"), "token").select("__of", "code", "id")

    def by_code(block: pa.Table) -> pa.Table:
        codes = block["code"].to_numpy()
        ids, lacking = np.zeros(codes.max() + 1, dtype=np.int32), np.ones(codes.max() + 1, dtype=bool)
        ids[codes], lacking[codes] = block["id"].to_numpy(), False
        ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids, mask=lacking))
        return pa.table([block["__of"][:1], ids], names=["__of", "__ids"])

    known = found.groupBy("__of").applyInArrow(by_code, "__of bigint, __ids array<int>")
    joined = coded.join(known, F.col("__at.block") == F.col("__of"), "left")
    ids = F.transform("__at.codes", lambda code: F.coalesce(F.get("__ids", code), F.lit(unknown_id).cast("int")))
    return joined.withColumn(out, ids).drop("__at", "__of", "__ids")


def _bits(tokens: pa.Array) -> np.ndarray:
    """The place of each token in a filter."""
    each = tokens.cast(pa.large_binary()).to_pylist()
    return np.fromiter(map(zlib.crc32, each), dtype=np.uint32, count=len(each)) % np.uint32(_FILTER_BITS)


def _token_filter(table: DataFrame) -> np.ndarray:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, bit = np.divmod(np.unique(_bits(batch.column(0))).astype(np.int64), 32)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(1 << bit)], names=["word", "bit"])

    marked = table.select("token").filter("token IS NOT NULL").mapInArrow(mark, "word bigint, bit bigint")
    words = marked.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # _FILTER_BITS / 32 rows at most
    filled = np.zeros(_FILTER_BITS // 32, dtype=np.uint32)
    filled[words["word"].to_numpy()] = words["bits"].to_numpy()
    return filled


def _numbers(spark: SparkSession, column: str, passing: np.ndarray) -> Column:
    """``(block, codes, words)``: tokens by their numbers among the ``words`` of their block, which its first row has.

    A null token and one that the filter holds back is -1. Blocks have random numbers, so they are to be written
    before they are used.
    """
    word = pa.struct([("code", pa.int32()), ("token", pa.string())])
    kind = pa.struct([("block", pa.int64()), ("codes", pa.list_(pa.int32())), ("words", pa.list_(word))])
    shared = spark.sparkContext.broadcast(passing)

    @F.arrow_udf("block bigint, codes array<int>, words array<struct<code int, token string>>")
    def number(batch: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        parts, at = [], 0
        while at < len(batch):
            room = np.searchsorted(ends, ends[at] - sizes[at] + _BLOCK_TOKENS, side="right")
            end = min(len(batch), at + _BLOCK_ROWS, max(int(room), at + 1))
            tokens = batch.slice(at, end - at).flatten().dictionary_encode()
            bits = _bits(tokens.dictionary)
            known = (shared.value[bits // 32] >> (bits % 32)) & np.uint32(1) > 0
            codes = np.append(np.where(known, np.cumsum(known) - 1, -1), -1).astype(np.int32)
            codes = codes[pc.fill_null(tokens.indices, -1).to_numpy()]
            words = tokens.dictionary.filter(pa.array(known)).cast(pa.string())
            words = pa.StructArray.from_arrays([pa.array(np.arange(len(words), dtype=np.int32)), words], fields=list(word))
            columns = [
                pa.array(np.full(end - at, secrets.randbits(63), dtype=np.int64)),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes[at:end])), pa.int32()), pa.array(codes)),
                pa.ListArray.from_arrays(pa.array([0, *[len(words)] * (end - at)], pa.int32()), words),
            ]
            parts.append(pa.StructArray.from_arrays(columns, names=["block", "codes", "words"]).cast(kind))
            at = end
        return pa.concat_arrays(parts or [pa.array([], kind)])

    return number.asNondeterministic()(column)


def tokenize(
    df: DataFrame, vocab: DataFrame, block_size: int = BLOCK_SIZE, keep: Sequence[str] = ()
) -> DataFrame:
    """``input_ids`` and ``attention_mask`` of each row's text, nothing else.

    A ``dialogue`` column takes precedence over ``text`` and is rendered anew.
    Text is stripped, blank rows go, and the first ``block_size`` tokens stay.
    """
    text = dialogue_to_text(F.col("dialogue")) if "dialogue" in df.columns else F.col("text")
    others = [c for c in dict.fromkeys(keep) if c != "text"]
    rows = df.select(*others, strip_ws(F.coalesce(text, F.lit(""))).alias("text")).filter(F.col("text") != "")
    encoded = _encode_text(rows, vocab, block_size)
    return encoded.select(*others, "input_ids", "attention_mask")


def tokenize_keep(df: DataFrame, vocab: DataFrame, max_len: int = BLOCK_SIZE) -> DataFrame:
    """Add ``input_ids`` and ``attention_mask``; every other column stays.

    Blank texts go; the text itself is tokenized as it is, without stripping.
    """
    encoded = _encode_text(filter_nonblank_text(df), vocab, max_len)
    return encoded.select(*df.columns, "input_ids", "attention_mask")


def _encode_text(rows: DataFrame, vocab: DataFrame, block_size: int) -> DataFrame:
    # Rows without text are gone, and any other text has a token, so no filter on
    # the ids is needed: counting the rows does not tokenize them.
    pieces = rows.withColumn("__tokens", truncate_head(pretokenize(F.col("text")), block_size))
    encoded = encode_tokens(pieces, vocab, "__tokens").drop("__tokens")
    return encoded.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))
