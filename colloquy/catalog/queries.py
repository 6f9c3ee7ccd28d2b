"""One query per operator, over the whole test tables.

Results are flat: arrays are joined to text or exploded, so that values can be
compared with SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, VariantType

from colloquy.catalog import adapters as A
from colloquy.constants import EOS
from colloquy.functions import answers, text, tokens, values
from colloquy.functions import dialogue as dlg
from colloquy.operators import batching, dialogues, generation, mixing, ranking, rows, runlog, vocabulary
from colloquy.operators import prompts as prm
from colloquy.plans import corpus, encode
from colloquy.session import cut_lineage, scratch_path
from colloquy.sources import converters, readers, writers
from colloquy.streaming import chat, clean

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

VOCAB_SIZE = 50_256
BATCH = 8


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def joined(c: Column, sep: str = ",") -> Column:
    return F.array_join(c.cast("array<string>"), sep)


def digest(*columns: str) -> Column:
    """Hash of a record's columns: the record itself went through the operator."""
    return F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns)))


def read_with_position(spark, path: str, *columns: str) -> DataFrame:
    """Rows of a Parquet folder and their place in it: by file, then by row.

    Only the row counts of the files, one small row each, are put in order.
    """
    df = spark.read.parquet(path)
    name = F.col("_metadata.file_name").alias("__file")
    sizes = df.select(name).groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__file").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rows = df.select(*columns, name, F.col("_metadata.row_index").alias("__index"))
    position = (F.col("__before") + F.col("__index") + 1).alias("position")
    names = [c for c in rows.columns if c not in ("__file", "__index")]
    return rows.join(F.broadcast(offsets), "__file").select(*names, position)


def message_columns(c: Column | str = "dialogue") -> list[Column]:
    """A dialogue as three scalars: size, roles, contents."""
    c = F.col(c) if isinstance(c, str) else c
    return [
        F.size(c).alias("n_messages"),
        F.array_join(F.transform(c, lambda m: m["role"]), ",").alias("roles"),
        F.array_join(F.transform(c, lambda m: m["content"]), "¦").alias("contents"),
    ]


# --- sources and sinks ---------------------------------------------------------


@query
def read_source(spark, sf_dir):
    return readers.read_source(spark, f"{sf_dir}/documents.parquet", A.DOCUMENTS)


@query
def read_source_sample(spark, sf_dir):
    df = readers.read_source(spark, f"{sf_dir}/documents.parquet", sample_len=100)
    return df.select("doc_id", "text")


@query
def read_source_jsonl(spark, sf_dir):
    """Documents written as JSON lines in shuffled order, read back: the first 500 lines, with row ids."""
    path = scratch_path(spark, "lines")
    writers.write_jsonl(mixing.shuffle(A.table(spark, sf_dir, "documents"), "doc_id"), path)
    df = readers.read_source(spark, path, "doc_id bigint, text string", fmt="json", sample_len=500, row_id="row_id")
    return df.select("doc_id", F.md5("text").alias("digest"), F.expr("row_id LIKE '%.json#%'").alias("has_row_id"))


@query
def head_slice(spark, sf_dir):
    return readers.head_slice(A.table(spark, sf_dir, "orders"), 50, "o_orderkey").select("o_orderkey", "o_custkey")


@query
def read_jsonl_splits(spark, sf_dir):
    dialogues_ = A.conversation_dialogues(spark, sf_dir).select("conv_id", "dialogue")
    parts = mixing.split_dataset(dialogues_, 0.2, 0.2, "conv_id")
    path = scratch_path(spark, "splits")
    writers.write_jsonl(parts, path, by_split=True)
    schema = f"conv_id bigint, dialogue {dlg.DIALOGUE_TYPE}"
    read = readers.read_jsonl_splits(spark, {s: f"{path}/split={s}" for s in ("train", "val", "test")}, schema)
    return read.select("conv_id", "split", *message_columns())


def _round_trip(spark, sf_dir, name, force_ascii):
    docs = A.dirty_documents(spark, sf_dir).withColumn("extra", F.when(F.col("doc_id") % 3 == 0, F.col("source")))
    path = scratch_path(spark, name)
    writers.write_jsonl(docs, path, force_ascii=force_ascii)
    return path, spark.read.schema(docs.schema).option("mode", "FAILFAST").json(path)


@query
def write_jsonl(spark, sf_dir):
    return _round_trip(spark, sf_dir, "jsonl", False)[1]


@query
def write_jsonl_ascii(spark, sf_dir):
    path, read = _round_trip(spark, sf_dir, "ascii", True)
    # The file itself holds no other characters.
    raw = spark.read.text(path).agg(F.max(F.col("value").rlike(r"[^\x00-\x7F]")).alias("b")).scalar()
    return read.withColumn("non_ascii_bytes", raw)


@query
def write_samples(spark, sf_dir):
    path = scratch_path(spark, "samples")
    samples = A.responses(spark, sf_dir).select("doc_id", "prompt", F.col("full").alias("generation"))
    writers.write_samples(samples, path)
    return spark.read.parquet(path)


# --- projections and filters ---------------------------------------------------


@query
def add_source(spark, sf_dir):
    return rows.add_source(A.alpaca(spark, sf_dir), "alpaca").select("id", "source")


@query
def keep_columns(spark, sf_dir):
    return rows.keep_columns(A.table(spark, sf_dir, "documents"), "doc_id", "source", "text")


@query
def filter_nonempty(spark, sf_dir):
    texts = rows.filter_nonempty(A.alpaca(spark, sf_dir), "input").select(F.lit("string").alias("kind"), "id")
    lists = rows.filter_nonempty(rows.compute_once(A.nq(spark, sf_dir), dialogue=converters.nq_dialogue(A.nq(spark, sf_dir))), "dialogue")
    return texts.unionByName(lists.select(F.lit("list").alias("kind"), "id"))


@query
def filter_turn_count(spark, sf_dir):
    return rows.filter_turn_count(A.conversation_dialogues(spark, sf_dir)).select("conv_id", *message_columns())


@query
def filter_has_content(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents")
    blank = F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 1, F.lit(None)).otherwise(F.col("lang"))
    dialogue = dlg.exchange(blank, F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("text")))
    return rows.filter_has_content(docs.select("doc_id", dialogue.alias("dialogue"))).select("doc_id")


@query
def filter_nonblank_text(spark, sf_dir):
    return rows.filter_nonblank_text(A.dirty_documents(spark, sf_dir)).select("doc_id", "text")


@query
def filter_nonempty_tokens(spark, sf_dir):
    ids = F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))
    return rows.filter_nonempty_tokens(
        A.table(spark, sf_dir, "documents").select("doc_id", ids.alias("input_ids"))
    ).select("doc_id", F.size("input_ids").alias("n"))


# --- converters ----------------------------------------------------------------


def _converted(spark, sf_dir, name):
    return converters.convert(A.SOURCES[name](spark, sf_dir), name, "id")


@query
def from_alpaca(spark, sf_dir):
    return _converted(spark, sf_dir, "alpaca").select("id", *message_columns())


@query
def from_dolly(spark, sf_dir):
    return _converted(spark, sf_dir, "dolly").select("id", *message_columns())


@query
def from_sciq(spark, sf_dir):
    return _converted(spark, sf_dir, "sciq").select("id", *message_columns())


@query
def from_nq(spark, sf_dir):
    return _converted(spark, sf_dir, "natural-questions").select("id", *message_columns())


@query
def convert(spark, sf_dir):
    parts = [
        _converted(spark, sf_dir, name).select(
            F.lit(name).alias("name"), F.size("dialogue").alias("n_messages"),
            F.coalesce(F.length(F.get("dialogue", F.lit(1))["content"]), F.lit(0)).alias("n_chars"),
        )
        for name in A.SOURCES
    ]
    return mixing.union_all(parts).groupBy("name", "n_messages").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_chars").alias("answer_chars")
    )


# --- text functions --------------------------------------------------------------


@query
def norm_text(spark, sf_dir):
    return A.dirty_documents(spark, sf_dir).select("doc_id", text.norm_text(F.col("text")).alias("text"))


@query
def norm_space(spark, sf_dir):
    maybe = F.when(F.col("doc_id") % 9 != 0, F.col("text"))
    return A.dirty_documents(spark, sf_dir).select("doc_id", text.norm_space(maybe).alias("text"))


@query
def ensure_text(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 9 != 0, F.col("n_chars")).alias("number"),
        F.when(F.col("doc_id") % 7 != 0, F.array("lang", F.when(F.col("doc_id") % 2 == 0, F.col("source")))).alias("words"),
    )
    return docs.select(
        "doc_id",
        text.ensure_text(F.col("number")).alias("number"),
        text.ensure_text(F.col("words"), docs.schema["words"].dataType).alias("words"),
    )


@query
def strip_control(spark, sf_dir):
    return A.dirty_documents(spark, sf_dir).select("doc_id", text.strip_control(F.col("text")).alias("text"))


@query
def strip_html(spark, sf_dir):
    shown = text.collapse_ws(text.strip_html(F.col("html")))
    return A.table(spark, sf_dir, "pages").select("page_id", shown.alias("text"))


@query
def strip_tags(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query
def straight_quotes(spark, sf_dir):
    return A.dirty_documents(spark, sf_dir).select("doc_id", text.straight_quotes(F.col("text")).alias("text"))


@query
def sciq_answer(spark, sf_dir):
    answer = converters.sciq_answer(F.col("correct_answer"), F.col("support"))
    return A.sciq(spark, sf_dir).select("id", answer.alias("answer"))


@query
def nq_short_answer(spark, sf_dir):
    df = A.nq(spark, sf_dir)
    dtype = df.schema["annotations"].dataType
    as_json = F.to_json("annotations")
    return df.select(
        "id",
        converters.nq_short_answer(F.col("annotations"), dtype).alias("answer"),
        converters.nq_short_answer(F.col("annotations"), dtype, empty_list_as_missing=True).alias("strict_answer"),
        converters.nq_short_answer(as_json, StringType()).alias("json_answer"),
    )


@query
def unwrap_text(spark, sf_dir):
    df = A.table(spark, sf_dir, "pages").select(
        "page_id", F.array(F.array(F.struct(A.heading("h1").alias("texts")))).alias("nested")
    )
    variant = F.parse_json(F.to_json(F.struct(F.col("nested").alias("text"))))
    return df.select(
        "page_id",
        values.unwrap_text(F.col("nested"), df.schema["nested"].dataType).alias("typed"),
        values.unwrap_text(variant, VariantType()).alias("untyped"),
    )


@query
def first_or_self(spark, sf_dir):
    df = A.table(spark, sf_dir, "documents").select("doc_id", "lang", F.split("text", " ").alias("words"))
    return df.select(
        "doc_id",
        values.first_or_self(F.col("words"), df.schema["words"].dataType).alias("first_word"),
        values.first_or_self(F.col("lang"), df.schema["lang"].dataType).alias("lang"),
    )


@query
def normalize_role(spark, sf_dir):
    messy = F.when(F.col("turn") % 3 == 0, F.upper("role")).when(F.col("turn") % 3 == 1, F.concat(F.lit(" \t"), "role"))
    return A.table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", dlg.normalize_role(messy.otherwise(F.col("role"))).alias("role")
    )


@query
def clean_text(spark, sf_dir):
    return A.dirty_documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("text"))


@query
def clean_page_text(spark, sf_dir):
    return A.table(spark, sf_dir, "pages").select("page_id", text.clean_text(F.col("html")).alias("text"))


@query
def coerce_numbers(spark, sf_dir):
    part = A.table(spark, sf_dir, "part")
    padded = F.concat(F.lit(" "), F.col("p_size").cast("string"))
    return part.select(
        "p_partkey",
        values.coerce_int(padded, "p_size", StringType()).alias("size"),
        values.coerce_int(F.col("p_retailprice"), "p_retailprice", DoubleType()).alias("whole_price"),
        values.coerce_float(padded, "p_size", StringType()).alias("size_float"),
        values.coerce_float(F.col("p_size"), "p_size", IntegerType()).alias("size_as_float"),
    )


@query
def coerce_bool(spark, sf_dir):
    word = F.when(F.col("event_type") == "click", " Yes ").when(F.col("event_type") == "view", "ON")
    word = word.otherwise(F.col("event_type"))
    return A.table(spark, sf_dir, "events").select(
        "event_id", values.coerce_bool(word, "event_type", StringType()).alias("flag")
    )


# --- dialogues -------------------------------------------------------------------


@query
def clean_dialogue(spark, sf_dir):
    cleaned = dlg.clean_dialogue(F.col("dialogue"))
    return A.dirty_dialogues(spark, sf_dir).select("doc_id", cleaned.alias("dialogue")).select(
        "doc_id", *message_columns()
    )


@query
def clean_corpus(spark, sf_dir):
    split = mixing.split_dataset(A.dirty_dialogues(spark, sf_dir), key="doc_id")
    return dialogues.clean_corpus(split).select("doc_id", "split", *message_columns())


@query
def dialogue_to_text(spark, sf_dir):
    return A.conversation_dialogues(spark, sf_dir).select(
        "conv_id", dlg.dialogue_to_text(F.col("dialogue")).alias("text")
    )


@query
def as_text(spark, sf_dir):
    return dialogues.as_text(A.dirty_dialogues(spark, sf_dir)).select("source", "text")


@query
def format_prompt(spark, sf_dir):
    return A.prompts(spark, sf_dir)


@query
def build_dialogue(spark, sf_dir):
    return A.conversation_dialogues(spark, sf_dir).select("conv_id", *message_columns())


# --- mixing ----------------------------------------------------------------------


@query
def take_n(spark, sf_dir):
    return mixing.take_n(A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 1000, "o_orderkey")


@query
def union_all(spark, sf_dir):
    parts = [_converted(spark, sf_dir, n).select(F.lit(n).alias("name"), F.col("id").cast("string")) for n in ("alpaca", "dolly", "sciq")]
    return mixing.union_all([*parts, parts[0]])


@query
def shuffle(spark, sf_dir):
    """Whole documents in shuffled order, as they stand in the written files."""
    path = scratch_path(spark, "shuffled")
    mixing.shuffle(A.table(spark, sf_dir, "documents"), "doc_id").write.parquet(path)
    return read_with_position(spark, path, "doc_id", F.md5("text").alias("digest"))


@query
def shuffle_within_language(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ranking.hash_rank(docs, "doc_id", 42, by=["lang"], out="position")


def corpus_targets(spark, sf_dir) -> dict[str, int]:
    """One source above its target, one below, one exactly at it, one without."""
    n_parts = A.table(spark, sf_dir, "part").count()
    n_docs = A.table(spark, sf_dir, "documents").count()
    return {"alpaca": n_parts * 3 // 4, "dolly": 1_000_000_000, "sciq": n_docs}


@query
def balance_by_targets(spark, sf_dir):
    path = scratch_path(spark, "balanced")
    mixing.balance_by_targets(_whole_records(spark, sf_dir, A.SOURCES), corpus_targets(spark, sf_dir), "id").write.parquet(path)
    return read_with_position(spark, path, "id", "source", "digest")


def _whole_records(spark, sf_dir, names) -> dict[str, DataFrame]:
    """Source records as one JSON text each, under keys that are unique over all sources."""
    return {
        n: A.SOURCES[n](spark, sf_dir).select(
            F.concat(F.lit(f"{n}:"), F.col("id").cast("string")).alias("id"), F.to_json(F.struct("*")).alias("record"),
            F.md5(A.TEXT_OF[n]).alias("digest"),
        )
        for n in names
    }


@query
def split_keep_ratios(spark, sf_dir):
    split = mixing.split_keep_ratios(A.table(spark, sf_dir, "documents"), key="doc_id")
    return split.select("doc_id", "split", F.md5("text").alias("digest"))


@query
def split_dataset(spark, sf_dir):
    split = mixing.split_dataset(A.table(spark, sf_dir, "documents"), key="doc_id")
    return split.select("doc_id", "split", F.md5("text").alias("digest"))


@query
def mix_and_split(spark, sf_dir):
    parts = list(_whole_records(spark, sf_dir, ("alpaca", "sciq")).values())
    path = scratch_path(spark, "raw")
    split = mixing.mix_and_split(parts, path, key="id").select("id", "split", "digest")
    raw = readers.file_positions(spark.read.schema("id string").json(path)).select("id", F.col("__position").alias("position"))
    return split.join(raw, "id", "left")


# --- aggregations and windows ------------------------------------------------------


@query
def count_source(spark, sf_dir):
    return dialogues.count_source(
        mixing.split_dataset(A.table(spark, sf_dir, "documents").select("doc_id", "source"), key="doc_id")
    )


@query
def few_shot_prompt(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("  "), F.substring_index("text", "\n", 1), F.lit("\t"))
    shots = docs.select("doc_id", "lang", dlg.exchange(padded, F.col("text")).alias("dialogue"))
    return prm.few_shot_prompt(shots, ["lang"], "doc_id", shots=16)


@query
def perplexity(spark, sf_dir):
    log = A.table(spark, sf_dir, "events").select(
        "user_id",
        F.when(F.col("user_id") % 10 != 0, F.col("value") / 100).alias("loss"),
        (F.col("event_id") % 7 + 1).alias("n"),
    )
    both = log.groupBy("user_id").agg(
        runlog.perplexity_of("loss", "n").alias("perplexity"), runlog.perplexity_of("loss").alias("plain")
    )
    return both.select(
        "user_id",
        *(F.when(~F.isnan(c), F.round(c, 6)).alias(c) for c in ("perplexity", "plain")),
    )


@query
def build_prompts(spark, sf_dir):
    return prm.build_prompts(A.table(spark, sf_dir, "conversations"))


@query
def build_prompts_recent(spark, sf_dir):
    return prm.build_prompts(A.table(spark, sf_dir, "conversations"), history=3)


@query
def context_prompts(spark, sf_dir):
    cut = prm.context_prompts(A.table(spark, sf_dir, "conversations"), max_len=1024)
    return cut.select("conv_id", "turn", "prompt", F.size("tokens").alias("n_tokens"))


@query
def best_checkpoint(spark, sf_dir):
    return runlog.best_checkpoint(A.metric_log(spark, sf_dir))


@query
def best_checkpoint_greater(spark, sf_dir):
    return runlog.best_checkpoint(A.metric_log(spark, sf_dir), metric="learning_rate", greater_is_better=True)


@query
def early_stop_step(spark, sf_dir):
    return runlog.early_stop_step(A.metric_log(spark, sf_dir))


@query
def early_stop_step_greater(spark, sf_dir):
    return runlog.early_stop_step(A.metric_log(spark, sf_dir), metric="learning_rate", greater_is_better=True)


# --- tokens ------------------------------------------------------------------------


def _documents_text(spark, sf_dir):
    return A.table(spark, sf_dir, "documents").select("doc_id", "text")


def _vocab(spark, sf_dir):
    return vocabulary.build_vocab(_documents_text(spark, sf_dir), VOCAB_SIZE)


@query
def pretokenize(spark, sf_dir):
    pieces = tokens.pretokenize(dlg.format_prompt(F.col("text")))
    return _documents_text(spark, sf_dir).select("doc_id", pieces.alias("p")).select(
        "doc_id", F.size("p").alias("n"), F.array_join("p", "¦").alias("pieces")
    )


@query
def build_vocab(spark, sf_dir):
    return _vocab(spark, sf_dir)


@query
def vocab_check(spark, sf_dir):
    return vocabulary.vocab_check(_vocab(spark, sf_dir))


@query
def tokenize(spark, sf_dir):
    docs = A.dirty_dialogues(spark, sf_dir)
    encoded = vocabulary.tokenize(docs, _vocab(spark, sf_dir), keep=["doc_id"])
    return encoded.select("doc_id", joined(F.col("input_ids")).alias("ids"), F.size("attention_mask").alias("n"))


@query
def tokenize_keep(spark, sf_dir):
    encoded = vocabulary.tokenize_keep(A.dirty_documents(spark, sf_dir), _vocab(spark, sf_dir))
    return encoded.select(
        "doc_id", "source", "text", joined(F.col("input_ids")).alias("ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
    )


@query
def encode_tokens_joined(spark, sf_dir):
    """The look-up by join that vocabularies too large to be sent take."""
    pieces = _documents_text(spark, sf_dir).select("doc_id", tokens.pretokenize(F.col("text")).alias("tokens"))
    vocab = cut_lineage(_vocab(spark, sf_dir))  # used several times
    encoded = vocabulary.encode_tokens(pieces, vocab, max_shipped=100)
    return encoded.select("doc_id", joined(F.col("input_ids")).alias("ids"))


@query
def truncate_to_context(spark, sf_dir):
    cut = prm.truncate_to_context(_documents_text(spark, sf_dir), "text", 1024)
    return cut.select("doc_id", "text", F.size("tokens").alias("n_tokens"))


@query
def length_grouped_batches(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents")
    batches = batching.length_grouped_batches(docs, "doc_id", "n_chars", BATCH)
    return batches.select("doc_id", "batch_id", "batch_pos", "batch_size_max", F.md5("text").alias("digest"))


@query
def collate(spark, sf_dir):
    pieces = tokens.pretokenize(F.concat(F.col("text"), F.lit(EOS)))
    ids = F.transform(pieces, lambda p: F.when(p == EOS, 0).otherwise(F.length(p)))
    docs = _documents_text(spark, sf_dir).select(
        "doc_id", F.floor(F.col("doc_id") / BATCH).alias("batch_id"), ids.alias("input_ids")
    ).withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))
    padded = batching.collate(docs, pad_id=0)
    return padded.select(
        "doc_id", *(joined(F.col(c)).alias(c) for c in ("input_ids", "attention_mask", "labels"))
    )


# --- generation ----------------------------------------------------------------------


def answering(suffix: str) -> generation.Loader:
    """A generator anyone can predict: it repeats the prompt after a remark."""

    def load():
        return lambda batch: [f"{p}{suffix} {p}" for p in batch]

    return load


@query
def batch_generate(spark, sf_dir):
    return generation.batch_generate(A.prompts(spark, sf_dir), answering("Well."))


@query
def batch_generate_first(spark, sf_dir):
    return generation.generate_answers(A.prompts(spark, sf_dir), answering("Well."), n=5, key="item_id")


@query
def postprocess_response(spark, sf_dir):
    answer = answers.postprocess_response(F.col("prompt"), F.col("full"))
    return A.responses(spark, sf_dir).select("doc_id", answer.alias("answer"))


@query
def hits_stop(spark, sf_dir):
    gen = answers.generated_part(F.col("prompt"), F.col("full"))
    return A.responses(spark, sf_dir).select("doc_id", answers.hits_stop(gen).alias("stopped"))


@query
def compare_models(spark, sf_dir):
    return generation.compare_models(A.prompts(spark, sf_dir), {"base": answering("Hm."), "tuned": answering("Yes!")})


@query
def map_rows(spark, sf_dir):
    def count_words(row, unit):
        return {"words": len(row["text"].split(" ")), "unit": unit}

    return rows.map_rows(
        A.table(spark, sf_dir, "documents").select("doc_id", "text"), count_words, "words bigint, unit string",
        args=("word",), remove_columns=["text"],
    )


# --- streaming -------------------------------------------------------------------------


@query
def stream_clean(spark, sf_dir):
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    docs = A.dirty_dialogues(spark, sf_dir)
    writers.write_jsonl(docs, source)
    stream = clean.clean_stream(
        clean.read_dialogue_stream(spark, source, f"doc_id bigint, {clean.SCHEMA}"), "doc_id"
    )
    clean.start_clean(stream, out, state).awaitTermination()
    return spark.read.schema("doc_id bigint, source string, text string").json(out)


@query
def stream_prompts(spark, sf_dir):
    source, out, state = (scratch_path(spark, n) for n in ("in", "out", "state"))
    turns = A.chat_turns(spark, sf_dir)
    writers.write_jsonl(turns, source)
    stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1000).json(source)
    running = (
        chat.stream_prompts(stream).writeStream.format("parquet").outputMode("append").option("path", out)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.parquet(out)


# --- end to end ----------------------------------------------------------------------------


def corpus_sources(spark, sf_dir) -> dict[str, DataFrame]:
    return {name: adapt(spark, sf_dir) for name, adapt in A.SOURCES.items()}


@query
def prepare_corpus(spark, sf_dir):
    prepared = corpus.prepare_corpus(corpus_sources(spark, sf_dir), corpus_targets(spark, sf_dir))
    path = scratch_path(spark, "prepared")
    prepared.select("id", "source", "split", "text").write.parquet(path)
    return read_with_position(spark, path, "id", "source", "split", "text")


@query
def prepare_corpus_counts(spark, sf_dir):
    prepared = corpus.prepare_corpus(corpus_sources(spark, sf_dir), corpus_targets(spark, sf_dir))
    return corpus.write_corpus(prepared, scratch_path(spark, "corpus"))[1]


@query
def encode_corpus(spark, sf_dir):
    docs = A.dirty_dialogues(spark, sf_dir)
    path = scratch_path(spark, "texts")
    split = mixing.split_dataset(dialogues.as_text(docs, "doc_id"), 0.1, 0.1, "doc_id")
    writers.write_jsonl(split, path, by_split=True)
    schema = "doc_id bigint, source string, text string"
    read = readers.read_jsonl_splits(spark, {s: f"{path}/split={s}" for s in ("train", "val", "test")}, schema)
    batches = encode.encode_corpus(read, _vocab(spark, sf_dir), BATCH, "doc_id", split="split")
    return batches.select(
        "doc_id", "split", "batch_id", "n_tokens",
        *(joined(F.col(c)).alias(c) for c in ("input_ids", "attention_mask", "labels")),
    )


@query
def score_prompts(spark, sf_dir):
    """Test set from JSON lines, its ids, answers, and samples saved and read again."""
    source, path = scratch_path(spark, "test"), scratch_path(spark, "scored")
    writers.write_jsonl(A.dirty_documents(spark, sf_dir), source)
    test = spark.read.schema("doc_id bigint, source string, text string").json(source)
    scored = encode.score_prompts(test, answering("So."), vocab=_vocab(spark, sf_dir))
    # Samples are saved as prompt and generation; the ids ride along in the prompt's row.
    scored.select("doc_id", joined(F.col("input_ids")).alias("ids"), "prompt", "generation").write.parquet(path)
    writers.write_samples(scored, f"{path}-samples")
    saved = spark.read.parquet(f"{path}-samples").groupBy("prompt", "generation").agg(F.count(F.lit(1)).alias("saved"))
    return spark.read.parquet(path).join(saved, ["prompt", "generation"]).select("doc_id", "ids", "prompt", "generation")


__all__: Sequence[str] = ["QUERIES", "answering", "corpus_sources", "corpus_targets"]
