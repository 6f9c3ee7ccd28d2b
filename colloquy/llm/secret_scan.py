"""Operator 4: secrets, and who owns them across the corpus. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from colloquy.llm.common import stored

KINDS = ("assign", "access", "hex", "owned")
MAX_OWNERS = 2  # a candidate with more owners is a copied example
MASK = "[secret]"

# What the three base kinds look like. Shorter runs of the last two fail as a whole.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Added kind: long runs with digits and letters of both cases, judged by their owners.
OWNED = r"[A-Za-z0-9+/_-]{20,}"
OWNED_RUN = r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"
PATTERNS = (ASSIGN, ACCESS, HEX, OWNED)

CANDIDATE = "array<struct<kind:int,pos:int,gap:int,len:int,hash:string,fits:boolean>>"


def _found(text: Column, kind: int) -> Column:
    """All matches of a kind: the length of the text before each (from the match before), and its own."""
    pattern = PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def candidate(gap: Column, match: Column) -> Column:
        value = F.regexp_extract(match, pattern, 2) if kind == 0 else match
        fits = F.length(value) >= ASSIGN_VALUE if kind == 0 else F.lit(True)
        fits = match.rlike(OWNED_RUN) if kind == 3 else fits
        return F.struct(
            F.lit(kind).alias("kind"), F.length(gap).alias("gap"), F.length(match).alias("len"),
            F.sha2(value, 256).alias("hash"), fits.alias("fits"),
        )

    found = F.filter(F.zip_with(gaps, matches, candidate), lambda c: c["len"].isNotNull())
    numbered = F.transform(
        found,
        lambda c, i: F.struct(c["kind"].alias("kind"), i.alias("pos"), c["gap"], c["len"], c["hash"], c["fits"]),
    ).cast(CANDIDATE)
    return F.when(text.rlike(pattern), numbered).otherwise(F.array().cast(CANDIDATE))


def _any(text: Column) -> Column:
    hit = F.lit(False)
    for pattern in PATTERNS:
        hit = hit | text.rlike(pattern)
    return hit


def _located(candidates: DataFrame) -> DataFrame:
    """Start and end of every candidate that fits, from running sums of the lengths: one row each."""
    each = candidates.select("row", "owner", "repository", F.inline("found"))
    before = W.partitionBy("row", "kind").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("len")).over(before.rowsBetween(W.unboundedPreceding, 0))
    placed = each.withColumn("end", end.cast("bigint")).withColumn("start", F.col("end") - F.col("len"))
    return placed.filter("fits").select("row", "owner", "repository", "kind", "start", "end", "hash")


def ownership(located: DataFrame) -> DataFrame:
    """``(hash, n, n_repositories, n_owners)`` of every candidate value over the corpus.

    Counted in three steps, each with partial sums, so a value copied into a third
    of all documents is a few rows per task before anything is shuffled.
    """
    repositories = located.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = repositories.groupBy("hash", "owner").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_repositories")
    )
    return owners.groupBy("hash").agg(
        F.sum("n").alias("n"), F.sum("n_repositories").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")
    )


def _judged(located: DataFrame, max_owners: int) -> DataFrame:
    """The spans to report, with ``live``: base kinds all, added ones only if live and apart from base ones."""
    located = stored(located, "located")
    owners = stored(ownership(located).select("hash", "n_owners"), "owners")
    known = located.join(owners, "hash").withColumn("live", F.col("n_owners") <= max_owners)
    by_start = W.partitionBy("row").orderBy("start", "kind")
    base = F.col("kind") < 3
    ends = F.max(F.when(base, F.col("end"))).over(by_start.rowsBetween(W.unboundedPreceding, 0))
    starts = F.min(F.when(base, F.col("start"))).over(by_start.rowsBetween(0, W.unboundedFollowing))
    marked = known.withColumns({"__ends": F.coalesce(ends, F.lit(0)), "__starts": starts})
    apart = (F.col("__ends") <= F.col("start")) & (F.col("__starts").isNull() | (F.col("__starts") >= F.col("end")))
    return marked.filter(base | (F.col("live") & apart)).select("row", "kind", "start", "end", "live", "n_owners")


def _owner(docs: DataFrame, owner: Column | None, repository: Column | None) -> tuple[Column, Column]:
    owner = F.coalesce(F.col("source").cast("string") if owner is None else owner, F.lit(""))
    repository = F.coalesce(F.col("lang").cast("string") if repository is None else repository, F.lit(""))
    return owner.alias("owner"), repository.alias("repository")


def _listing(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def scan(
    docs: DataFrame, owner: Column | None = None, repository: Column | None = None, max_owners: int = MAX_OWNERS
) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_live)`` per row.

    Spans are ``kind:start:end`` in code points, by start and kind. Base kinds are
    matched leftmost and without overlap, each for itself. Runs that only look
    like keys are added as ``owned`` when at most ``max_owners`` owners of the
    whole corpus have the same value; values of more owners are copied examples.
    ``n_live`` counts the spans, of any kind, that are not copied examples. The
    owner is ``source`` and the repository ``lang`` within it unless given.

    Null text: empty; null owners or repositories are one of their own. Null ids
    and repeated rows: one row each. No rows: no rows. Texts are read once; what
    is shuffled are the candidates.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = F.concat(*(_found(text, kind) for kind in range(len(PATTERNS))))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        *_owner(docs, owner, repository), found.alias("found"),
    )
    rows = stored(rows, "rows")
    spans = _judged(_located(rows.filter(F.size("found") > 0)), max_owners)
    in_order = F.array_sort(F.collect_list(F.struct("start", "kind", "end", "live")))
    per_row = spans.groupBy("row").agg(in_order.alias("all")).withColumn(
        "base", F.filter("all", lambda s: s["kind"] < 3)
    )

    def number(test) -> Column:
        return F.size(F.filter("all", test)).cast("bigint")

    def of_kind(kind: int):
        return lambda s: s["kind"] == kind

    per_row = per_row.select(
        "row", *(number(of_kind(k)).alias(f"n_{KINDS[k]}") for k in range(len(KINDS))),
        F.sha2(_listing(F.col("base")), 256).alias("base_sha256"), _listing(F.col("all")).alias("spans"),
        number(lambda s: s["live"]).alias("n_live"),
    )
    joined = rows.select("row", "doc_id").join(per_row, "row", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", *(F.coalesce(f"n_{k}", zero).alias(f"n_{k}") for k in KINDS[:3]),
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_owned", zero).alias("n_owned"), F.coalesce("n_live", zero).alias("n_live"),
    )


def redacted(
    docs: DataFrame, owner: Column | None = None, repository: Column | None = None, max_owners: int = MAX_OWNERS,
    mask: str = MASK,
) -> DataFrame:
    """``docs`` with every live secret replaced by ``mask``; copied examples stay.

    Texts without a candidate pass by untouched; only the others, a small part,
    are written and joined. ``n_chars``, where there is one, is counted anew.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.filter(~_any(text))
    found = F.concat(*(_found(text, kind) for kind in range(len(PATTERNS))))
    hits = docs.filter(_any(text)).select(
        F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"),
        *_owner(docs, owner, repository), found.alias("found"),
    )
    hits = stored(hits, "hits")
    spans = _judged(_located(hits.select("row", "owner", "repository", "found")), max_owners).filter("live")
    in_order = F.array_sort(F.collect_list(F.struct("start", "end")))
    per_row = spans.groupBy("row").agg(in_order.alias("all"))
    whole = F.col("doc.text").cast("string")

    def step(state: Column, span: Column) -> Column:
        kept = F.substring(whole, state["at"] + 1, span["start"] - state["at"])
        apart = span["start"] >= state["at"]
        out = F.when(apart, F.concat(state["out"], kept, F.lit(mask))).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], span["end"]).cast("int").alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    spans_int = F.transform("all", lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
    clean = F.aggregate(
        spans_int, start, step, lambda s: F.concat(s["out"], F.substring(whole, s["at"] + 1, F.length(whole)))
    )
    joined = hits.select("row", "doc").join(per_row, "row", "left")
    joined = joined.withColumn("__text", F.coalesce(clean, whole))
    columns = [F.col("__text").alias(c) if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    changed = joined.select(*columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.length("text").cast(kind)
        changed = changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), counted)).select(*docs.columns)
    return plain.unionByName(changed)
