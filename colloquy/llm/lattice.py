"""Operator 9: document probability over all segmentations into subword pieces."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import stored

FOLDS, HELD_OUT = 7, 2
ROUNDS = 2  # re-estimations of the piece probabilities from the corpus
SMOOTH = 0.1  # added to the expected count of every piece
PLAIN = 1e-250  # forward sums from here on are plain probabilities, smaller ones logs
FLUSH = 200_000  # distinct words that a task counts before it passes them on
FREQUENT = 200_000  # most frequent words that are sent to the scoring tasks
BINS = 8  # frequency bins per factor of two
WORD_START = "▁"
END = "</s>"


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


class Pieces:
    """A fixed vocabulary with log probabilities; ``<0x..>`` pieces spell characters that are no piece."""

    def __init__(self, log_p: dict[str, float]):
        self.log_p = log_p
        self.p = {piece: math.exp(p) for piece, p in log_p.items()}
        self.longest = max((len(p) for p in log_p if not p.startswith("<0x")), default=1)
        # Probability of every piece that a text can hold, 0 for what only begins one.
        self.begun = {p[:n]: 0.0 for p in log_p if len(p) <= self.longest for n in range(1, len(p))}
        self.begun.update((p, q) for p, q in self.p.items() if len(p) <= self.longest)
        self.letters: dict[str, float] = {}  # spelled so far

    @classmethod
    def from_model(cls, path: str) -> Pieces:
        """Start from the scores of a sentencepiece model.

        Scores of merge vocabularies are falling ranks; by Zipf's law a piece of
        rank r gets a share of 1/r.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        weight = {END: 1.0}
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                weight[model.id_to_piece(i)] = 1e-4
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and model.get_score(i) > -1e8:
                weight[model.id_to_piece(i)] = 1.0 / (1.0 - model.get_score(i))
        return cls.normalized(weight)

    @classmethod
    def normalized(cls, weight: dict[str, float]) -> Pieces:
        total = math.log(sum(weight.values()))
        return cls({piece: math.log(w) - total for piece, w in weight.items()})

    def _spelled(self, letter: str) -> list[str]:
        return [f"<0x{b:02X}>" for b in letter.encode("utf-8", "surrogatepass")]

    def _letter(self, letter: str) -> float:
        """Probability of a letter that is no piece."""
        p = self.letters.get(letter)
        if p is None:
            p = self.letters[letter] = math.exp(sum(self.log_p[b] for b in self._spelled(letter)))
        return p

    def log_probability(self, word: str) -> float:
        """Log of the summed probability of all segmentations (forward recursion).

        Sums of plain probabilities; logs for words whose sums come near the end of floating point.
        """
        text, get = WORD_START + word, self.begun.get
        n = len(text)
        alpha = [1.0] + [0.0] * n
        for start in range(n):
            own = alpha[start]
            if own < PLAIN:
                return self._log_probability(text)
            if not get(text[start]):
                alpha[start + 1] += own * self._letter(text[start])
            for end in range(start + 1, n + 1):
                p = get(text[start:end])
                if p:
                    alpha[end] += own * p
                elif p is None:
                    break
        return math.log(alpha[n]) if alpha[n] >= PLAIN else self._log_probability(text)

    def _log_probability(self, text: str) -> float:
        exp, log = math.exp, math.log
        alpha = [0.0]
        for end in range(1, len(text) + 1):
            terms = [alpha[start] + p for start, _, p in self._arcs(text, end)]
            top = max(terms)
            alpha.append(top + log(sum([exp(t - top) for t in terms])) if len(terms) > 1 else top)
        return alpha[-1]

    def expected(self, word: str, times: float, into: dict[str, float]) -> None:
        """Add ``times`` the expected number of uses of every piece in ``word``.

        Forward and backward sums of plain probabilities; logs for words whose sums
        come near the end of floating point.
        """
        if not self._expected(word, times, into):
            self._expected_in_logs(word, times, into)

    def _expected(self, word: str, times: float, into: dict[str, float]) -> bool:
        """False, and nothing added, when a forward sum is below ``PLAIN``."""
        text, get = WORD_START + word, self.begun.get
        n = len(text)
        alpha, arcs = [1.0] + [0.0] * n, []
        for start in range(n):
            own = alpha[start]
            if own < PLAIN:
                return False
            if not get(text[start]):
                p = self._letter(text[start])
                alpha[start + 1] += own * p
                arcs.append((start, start + 1, "", p))
            for end in range(start + 1, n + 1):
                piece = text[start:end]
                p = get(piece)
                if p:
                    alpha[end] += own * p
                    arcs.append((start, end, piece, p))
                elif p is None:
                    break
        if alpha[n] < PLAIN:
            return False
        # An arc's share of all paths: the paths to it, itself, and those behind it.
        behind = [0.0] * n + [times / alpha[n]]
        for start, end, piece, p in reversed(arcs):
            p *= behind[end]
            behind[start] += p
            p *= alpha[start]
            if piece in into:
                into[piece] += p
            else:
                for used in [piece] if piece else self._spelled(text[start]):
                    into[used] = into.get(used, 0.0) + p
        return True

    def _arcs(self, text: str, end: int) -> list[tuple[int, str, float]]:
        """``(start, piece, log probability)`` of what ends at ``end``; no piece for a spelled letter."""
        spans = ((start, text[start:end]) for start in range(max(0, end - self.longest), end))
        arcs = [(start, piece, self.log_p[piece]) for start, piece in spans if piece in self.log_p]
        if text[end - 1] not in self.log_p:
            arcs.append((end - 1, "", sum(self.log_p[b] for b in self._spelled(text[end - 1]))))
        return arcs

    def _expected_in_logs(self, word: str, times: float, into: dict[str, float]) -> None:
        text, exp = WORD_START + word, math.exp
        n = len(text)
        alpha = [0.0]
        for end in range(1, n + 1):
            terms = [alpha[start] + p for start, _, p in self._arcs(text, end)]
            top = max(terms)
            alpha.append(top + math.log(sum(exp(t - top) for t in terms)))
        # Share of all paths that pass a position; behind it each arc has its part of the forward sum.
        passing = [0.0] * n + [times]
        for end in range(n, 0, -1):
            for start, piece, p in self._arcs(text, end):
                share = passing[end] * exp(alpha[start] + p - alpha[end])
                passing[start] += share
                for used in [piece] if piece else self._spelled(text[end - 1]):
                    into[used] = into.get(used, 0.0) + share


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, trained, seen)``: how often each word stands in training texts and in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained: Counter = Counter()
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = list(trained.keys() | held.keys())
            own = [trained[w] for w in words]
            total = [n + held[w] for n, w in zip(own, words)]
            trained.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(own, pa.int64()), pa.array(total, pa.int64())],
                names=["word", "trained", "seen"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                (held if is_held_out(doc_id) else trained).update(words_of(text.as_py()))
                if len(trained) + len(held) > FLUSH:
                    yield flush()
        yield flush()

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    parts = texts.mapInArrow(count, "word binary, trained bigint, seen bigint")
    return parts.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


def fit_pieces(words: DataFrame, texts: int, pieces: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Piece probabilities re-estimated from the training words (expectation maximization).

    The vocabulary stays as it is. Every distinct word is looked at once per round,
    weighted by its count; one number per piece comes back.
    """
    trained = words.filter("trained > 0").select("word", "trained")
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], pieces: Pieces = pieces) -> Iterator[pa.RecordBatch]:
            total: dict[str, float] = {}
            for batch in batches:
                for word, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    pieces.expected(word.decode("utf-8", "surrogatepass"), times, total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.float64())], names=["piece", "n"]
            )

        sums = trained.mapInArrow(expect, "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        found = {r["piece"]: r["n"] for r in sums.collect()}  # at most the vocabulary
        found[END] = float(texts)
        pieces = Pieces.normalized({piece: found.get(piece, 0.0) + SMOOTH for piece in pieces.log_p})
    return pieces


def _frequent_from(words: DataFrame, bound: int) -> int:
    """A count that at most ``bound`` words reach, from a histogram over few bins."""
    level = F.floor(F.log2(F.col("seen")) * BINS).cast("int")
    bins = words.groupBy(level.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("seen").alias("least")).collect()
    reached, least = 0, None
    for row in sorted(bins, key=lambda r: -r["bin"]):
        reached += row["n"]
        if reached > bound:
            break
        least = row["least"]
    return least if least is not None else (1 << 62)


def score_documents(
    docs: DataFrame, model_path: str, rounds: int = ROUNDS, frequent: int = FREQUENT
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row.

    ``score`` is the log10 probability of a text: over its words the probability
    of every segmentation into pieces of a given vocabulary, summed, and one end.
    The probabilities of the pieces are learned from the training documents, those
    whose ``crc32(doc_id) % 7`` is not 2. ``base_score`` is the add-one unigram
    score of whole words, the end included.

    Each distinct word of the corpus runs through the lattice once. Scores of the
    most frequent words, at most ``frequent``, are sent to the tasks that read the
    texts; the others, some percent of all tokens, are joined by word.

    Null text: the end alone. A null id trains. Repeated rows: each trained on and
    scored. No rows: no rows. Other columns are ignored.
    """
    words = stored(word_counts(docs), "words")
    ids = docs.select(F.col("doc_id").cast("bigint").cast("string").alias("id"))
    fold = F.pmod(F.crc32(F.coalesce("id", F.lit(""))), F.lit(FOLDS))
    texts = ids.filter(fold != HELD_OUT).count()
    row = words.agg(F.sum("trained").alias("n"), F.count_if(F.col("trained") > 0).alias("v")).first()
    total = (row["n"] or 0) + texts
    distinct = row["v"] + (1 if texts else 0)
    pieces = fit_pieces(words, texts, Pieces.from_model(model_path), rounds)

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                pieces.log_probability(w.decode("utf-8", "surrogatepass")) / math.log(10)
                for w in batch.column(0).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=["word", "trained", "seen", "lattice"]
            )

    scored = words.mapInArrow(through, "word binary, trained bigint, seen bigint, lattice double")
    scored = stored(scored, "word-scores")
    known = scored.filter(F.col("seen") >= _frequent_from(scored, frequent)).select("word", "trained", "lattice")
    scale = total + distinct + 1
    table = {
        bytes(r["word"]): (math.log10((r["trained"] + 1) / scale), r["lattice"], r["trained"] > 0) for r in known.toLocalIterator()
    }
    shared = docs.sparkSession.sparkContext.broadcast(table)
    end_base = math.log10(((texts if texts else 0) + 1) / scale)
    end_score = pieces.log_p[END] / math.log(10)

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = shared.value
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, ends, others, often = [], [0], [], []  # words that are not in the table, and how often

            def full() -> pa.RecordBatch:
                columns = [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(names), types)]
                rest = pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(others, pa.binary()), pa.array(often, pa.int64()))
                return pa.RecordBatch.from_arrays([*columns, rest], names=[*names, "others"])

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                base, score, n_known = end_base, end_score, 1 if texts else 0
                for word, times in Counter(words).items():
                    found = table.get(word)
                    if found is None:
                        others.append(word)
                        often.append(times)
                    else:
                        base += times * found[0]
                        score += times * found[1]
                        if found[2]:
                            n_known += times
                rows.append((number, doc_id, int(is_held_out(doc_id)), len(words) + 1, n_known, base, score))
                ends.append(len(others))
                number += 1
                if len(others) > 100_000:
                    yield full()
                    rows, ends, others, often = [], [0], [], []
            yield full()

    schema = (
        "row bigint, doc_id bigint, held_out int, n_tokens bigint, n_known bigint, base_score double, score double, "
        "others map<binary, bigint>"
    )
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    parts = stored(source.mapInArrow(read, schema), "scored-parts")
    rare = parts.select("row", F.explode("others").alias("word", "times")).join(
        scored.select("word", "trained", "lattice"), "word"
    )
    none = F.lit(None)
    rare = rare.select(
        "row", none.cast("bigint").alias("doc_id"), none.cast("int").alias("held_out"), none.cast("bigint").alias("n_tokens"),
        F.when(F.col("trained") > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10((F.col("trained") + 1) / F.lit(float(scale)))).alias("base_score"),
        (F.col("times") * F.col("lattice")).alias("score"),
    )
    own = parts.select(*rare.columns)
    sums = own.union(rare).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
    )
    return sums.select(
        "doc_id", (F.col("held_out") == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
