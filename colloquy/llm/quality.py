"""Operator 1: hierarchical empirical Bayes over text, host and path."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from colloquy.llm.common import stored

FIT_ROWS = 40_000  # labelled documents that the text evidence is fitted on
MAX_WEIGHTS = 50_000  # features sent to the workers
MIN_GAIN = 25.0  # a feature counts when its likelihood ratio statistic is at least this, some five standard errors
WORD_ODDS = 4.0  # words count only when they raise the log odds by this much or more
SHAPE = "="  # first letter of features that are no words
SHRINK = 50.0  # likelihood ratio statistic at which a feature keeps half of its log odds
PREFIX = 4
GROUND = 0.5  # pseudo-count of every feature in either class

_LETTERS = re.compile(r"[^\W\d_]+")
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"!#$%&*+/<=>@[\\]^_`{|}~"


def _bin(share: float) -> int:
    return int(np.searchsorted((0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9), share))


def features(text: str | None) -> set[str]:
    """Distinct words, their prefixes, and binned shapes of the text."""
    text = text or ""
    words = _LETTERS.findall(text.lower())
    counts = Counter(words)
    raw = text.encode("utf-8", "surrogatepass")
    size, n = max(1, len(raw)), max(1, len(words))
    lines = [line for line in text.split("\n") if line.strip()]

    def share(letters: bytes) -> float:
        return (len(raw) - len(raw.translate(None, letters))) / size

    shapes = {
        "upper": share(_UPPER), "digit": share(_DIGITS), "symbol": share(_SYMBOLS), "bar": share(b"|"),
        "repeated": 1 - len(counts) / n, "top": max(counts.values(), default=0) / n,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
    }
    found = {f"={name}:{_bin(value)}" for name, value in shapes.items()}
    # Longer texts repeat more words; the two are judged together.
    found.add(f"=size:{len(words).bit_length()}:{_bin(shapes['repeated'])}:{_bin(shapes['top'])}")
    found.update(counts)
    found.update(f"{w[:PREFIX]}*" for w in counts if len(w) > PREFIX)
    return found


def sampled_labels(labels: DataFrame, verdicts: Mapping[str, Column], rows: int) -> DataFrame:
    """About ``rows`` labels at most, chosen by a hash of the id: ``(doc_id, verdicts...)``."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        *(F.max(F.coalesce(bad, F.lit(False)).cast("int")).alias(name) for name, bad in verdicts.items())
    )
    total = max(1, known.count())
    share = min(1.0, rows / total)
    return known.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) < int(share * (1 << 30)))


def fit_evidence(
    docs: DataFrame, labels: DataFrame, verdicts: Mapping[str, Column], rows: int = FIT_ROWS,
    max_weights: int = MAX_WEIGHTS, min_gain: float = MIN_GAIN,
) -> dict[str, dict[str, float]]:
    """Log odds of every telling feature, per verdict.

    Fitted on a bounded sample of the labels; features are counted in grouped
    aggregations, and only those that tell the classes apart beyond doubt are
    kept, the surest ``max_weights`` of them. Words count only as marks of bad
    texts: the many that are a little more common in one class are so because of
    their language or of copies, and their sum would outweigh everything else. Log
    odds are shrunk towards 0 by how little their counts prove.
    """
    names = list(verdicts)
    sample = F.broadcast(sampled_labels(labels, verdicts, rows))
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).join(sample, "doc_id")
    texts = texts.withColumn("__copy", F.xxhash64("text")).dropDuplicates(["__copy"])  # copies tell nothing new

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            flags = list(zip(*(batch.column(2 + i).to_pylist() for i in range(len(names)))))
            for text, flag in zip(batch.column(1), flags):
                code = sum(bool(f) << i for i, f in enumerate(flag))
                total.update((f, code) for f in features(text.as_py()))
                total[("", code)] += 1
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([total[k] for k in keys], pa.int64()),
                ],
                names=["feature", "code", "n"],
            )

    counted = texts.select("doc_id", "text", *names).mapInArrow(count, "feature string, code int, n bigint")
    per_verdict = []
    for i in range(len(names)):
        bad = F.col("code").bitwiseAND(F.lit(1 << i)) != 0
        per_verdict += [
            F.sum(F.when(bad, F.col("n")).otherwise(0)).alias(f"bad{i}"),
            F.sum(F.when(bad, 0).otherwise(F.col("n"))).alias(f"good{i}"),
        ]
    table = stored(counted.groupBy("feature").agg(*per_verdict), "features")
    totals = table.filter(F.col("feature") == "").first()
    weights: dict[str, dict[str, float]] = {}
    for i, name in enumerate(names):
        weights[name] = {}
        if totals is None or not totals[f"bad{i}"] or not totals[f"good{i}"]:
            continue  # one class only: the text tells nothing
        b, g = F.col(f"bad{i}") + GROUND, F.col(f"good{i}") + GROUND
        odds = F.log(b / g) - F.log(F.lit((totals[f"bad{i}"] + 2 * GROUND) / (totals[f"good{i}"] + 2 * GROUND)))
        rate = totals[f"bad{i}"] / (totals[f"bad{i}"] + totals[f"good{i}"])
        seen = F.col(f"bad{i}") + F.col(f"good{i}")

        def surprise(n: Column, expected: Column) -> Column:
            return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

        gain = 2 * (surprise(F.col(f"bad{i}"), seen * rate) + surprise(F.col(f"good{i}"), seen * (1 - rate)))
        surest = table.filter(F.col("feature") != "").select("feature", odds.alias("odds"), gain.alias("gain"))
        telling = F.col("feature").startswith(SHAPE) | (F.col("odds") >= WORD_ODDS)
        surest = surest.filter((F.col("gain") >= min_gain) & telling).orderBy(F.desc("gain"), "feature").limit(max_weights)
        weights[name] = {r["feature"]: r["odds"] * r["gain"] / (r["gain"] + SHRINK) for r in surest.collect()}
    return weights


def with_evidence(docs: DataFrame, weights: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``docs`` and one ``__evidence_<verdict>`` column: the summed log odds of the text."""
    names = list(weights)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: list[list[float]] = [[] for _ in names]
            for text in batch.column(batch.num_columns - 1):
                found = features(text.as_py())
                for out, name in zip(sums, names):
                    own = weights[name]
                    out.append(sum(sorted(own[f] for f in own.keys() & found)))
            columns = [*batch.columns[:-1], *(pa.array(s, pa.float64()) for s in sums)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    schema = StructType([*docs.schema.fields, *(StructField(f"__evidence_{n}", DoubleType()) for n in names)])
    return docs.withColumn("__text", F.col("text").cast("string")).mapInArrow(judge, schema)


def _concentration(groups: DataFrame, n: str, x: str, mean: Column | str) -> float:
    """How many labels the prior ``mean`` is worth: beta-binomial, by moments.

    The spread of the groups' shares around their prior, less what chance alone
    gives, is the variance of the true shares.
    """
    m = F.col(mean) if isinstance(mean, str) else mean
    rate = F.col(x) / F.col(n)
    row = groups.select(F.col(n).alias("n"), rate.alias("r"), m.alias("m")).agg(
        F.sum(F.col("n") * (F.col("r") - F.col("m")) ** 2).alias("spread"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("chance"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("unit"),
        F.sum("n").alias("total"),
    ).first()
    if not row["total"] or not row["unit"]:
        return 1e6
    share = max((row["spread"] - row["chance"]) / row["unit"], 1e-6)
    return min(1e6, max(1.0, 1 / share - 1))


def site_priors(
    docs: DataFrame, labels: DataFrame, verdicts: Mapping[str, Column], host: Column, path: Column
) -> tuple[DataFrame, DataFrame, dict[str, float]]:
    """Posterior share of every verdict per path, per host, and over all labels.

    Every label counts. A path's share is shrunk towards its host's, a host's
    towards the global one; how far is estimated from the groups themselves, so
    sparse sites keep the prior and large ones their own rate.
    """
    names = list(verdicts)
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        *(F.max(F.coalesce(bad, F.lit(False)).cast("int")).alias(name) for name, bad in verdicts.items())
    )
    sites = docs.select(F.col("doc_id").cast("bigint"), host.alias("host"), path.alias("path")).join(known, "doc_id")
    sums = [F.count(F.lit(1)).alias("n"), *(F.sum(c).alias(c) for c in names)]
    paths = stored(sites.groupBy("host", "path").agg(*sums), "paths")
    hosts = stored(paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ["n", *names])), "hosts")
    total = hosts.agg(*(F.sum(c).alias(c) for c in ["n", *names])).first()
    overall = {c: ((total[c] or 0) + 0.5) / ((total["n"] or 0) + 1.0) for c in names}
    for c in names:
        worth = _concentration(hosts, "n", c, F.lit(overall[c]))
        hosts = hosts.withColumn(f"host_{c}", (F.col(c) + worth * overall[c]) / (F.col("n") + worth))
    hosts = stored(hosts.select("host", *(f"host_{c}" for c in names)), "hosts")
    paths = stored(paths.join(hosts, "host"), "paths")
    for c in names:
        worth = _concentration(paths, "n", c, f"host_{c}")
        paths = paths.withColumn(f"path_{c}", (F.col(c) + worth * F.col(f"host_{c}")) / (F.col("n") + worth))
    return stored(paths.select("host", "path", *(f"path_{c}" for c in names)), "paths"), hosts, overall


def default_verdicts() -> dict[str, Column]:
    return {"toxic": F.col("toxic") == 1, "poor": F.col("quality") == 0}


def judged(
    docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
    verdicts: Mapping[str, Column] | None = None, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``docs`` with ``__host``, ``__path``, and per verdict ``__evidence_``, ``__prior_``
    and ``__posterior_<verdict>``, and ``__keep``.

    The posterior log odds of a document are those of its site plus the evidence
    of its text; a document is kept when no verdict is more likely than not. The
    host is ``source`` and the path ``lang`` unless given.

    A null text is empty, a null host or path a site of its own, a site without
    labels has its host's share or the global one. Null ids and repeated rows are
    judged like others; of labels that repeat an id the worst counts; null labels
    are not bad. Without labels everything is kept. No rows: no rows.
    """
    host = F.coalesce(F.col("source").cast("string") if host is None else host, F.lit(""))
    path = F.coalesce(F.col("lang").cast("string") if path is None else path, F.lit(""))
    verdicts = default_verdicts() if verdicts is None else verdicts
    weights = fit_evidence(docs, labels, verdicts, fit_rows)
    paths, hosts, overall = site_priors(docs, labels, verdicts, host, path)
    out = with_evidence(docs, weights).withColumns({"__host": host, "__path": path})
    # Small tables of sites are broadcast by the planner, larger ones joined by shuffle.
    paths = paths.withColumnsRenamed({"host": "__host", "path": "__path"})
    out = out.join(paths, ["__host", "__path"], "left")
    out = out.join(hosts.withColumnRenamed("host", "__host"), "__host", "left")
    keep = F.lit(True)
    for c in verdicts:
        prior = F.coalesce(f"path_{c}", f"host_{c}", F.lit(overall[c]))
        out = out.withColumn(f"__prior_{c}", prior)
        odds = F.log(F.col(f"__prior_{c}") / (1 - F.col(f"__prior_{c}"))) + F.col(f"__evidence_{c}")
        out = out.withColumn(f"__posterior_{c}", 1 / (1 + F.exp(-odds)))
        keep = keep & (F.col(f"__posterior_{c}") <= 0.5)
    return out.withColumn("__keep", keep)


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that no verdict rejects, with their own columns."""
    return judged(docs, labels, **options).filter("__keep").select(*docs.columns)
