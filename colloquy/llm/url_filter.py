"""Operator 3: URL rules, and a tree of path templates judged by labelled purity.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import stored

DEPTH = 6  # levels of the tree; what lies deeper is one last wildcard
BRANCHES = 32  # only in the SQL: there a node with more children keeps those with at least their even share
Z = 3.0  # a branch stays apart when its bad share differs from its sibling's by this many errors
STRENGTH = 20.0  # labels that the overall purity is worth
MIN_PURITY = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if there is none.

    Rules are ``(verdict, "host/path")`` pairs. A rule fits its host and every
    subdomain when the path starts with the rule's.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        own_host, slash, rest = text.partition("/")
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _shapes(path: Column, depth: int) -> Column:
    """Path segments with identifiers replaced: ``%`` for long hex ones, ``#`` for every number."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    shaped = F.transform(
        segments,
        lambda s: F.when(s.rlike("^[0-9a-f-]{12,}$"), F.lit("%")).otherwise(F.regexp_replace(s, "[0-9]+", "#")),
    )
    deep = F.size(shaped) > depth
    return F.when(deep, F.concat(F.slice(shaped, 1, depth), F.array(F.lit("**")))).otherwise(shaped)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]


def _alike_groups(children: DataFrame, z: float) -> DataFrame:
    """``(host, template, child, segment)``: the siblings under every node, alike ones merged.

    The sibling with the most labels leads; all whose bad share is within ``z`` errors of
    its own join it. The rest go on under a leader of their own until none is left, so a
    sibling with few labels joins the best known group that it may belong to. A round
    is one grouped maximum per node and a join, however many children a node has, and
    there are as many rounds as a node has groups.
    """
    keys = ["host", "template"]
    left, grouped = children.filter(F.col("labelled") > 0).select(*keys, "child", "labelled", "bad"), None
    while left.head(1):
        leaders = left.groupBy(*keys).agg(F.max(F.struct("labelled", "bad", "child")).alias("leader"))
        led = left.join(leaders, keys)
        n, bad = F.col("leader.labelled"), F.col("leader.bad")
        gap = F.col("bad") / F.col("labelled") - bad / n
        share = (F.col("bad") + bad) / (F.col("labelled") + n)
        differs = gap * gap > z * z * share * (1 - share) * (1 / F.col("labelled") + 1 / n)
        led = stored(led.withColumn("__differs", differs & (F.col("child") != F.col("leader.child"))), "led")
        joined = led.filter(~F.col("__differs")).select(*keys, "child", "leader")
        grouped = joined if grouped is None else grouped.union(joined)
        left = led.filter("__differs").select(*keys, "child", "labelled", "bad")
    names = children.select(*keys, "child")
    if grouped is None:
        return names.withColumn("segment", F.lit("*"))
    groups = stored(grouped.groupBy(*keys, "leader").agg(F.count(F.lit(1)).alias("members")), "groups")
    widest = F.max(F.when(F.col("members") > 1, F.col("leader"))).alias("widest")
    nodes = groups.groupBy(*keys).agg(F.count(F.lit(1)).alias("groups"), widest)
    plain = (F.col("groups") == 1) | F.coalesce(F.col("leader") == F.col("widest"), F.lit(False))
    # No segment is empty, so "/name" below a slash is not the name of any branch.
    segment = F.when(plain, F.lit("*")).when(F.col("members") == 1, F.col("leader.child"))
    segment = segment.otherwise(F.concat(F.lit("/"), F.col("leader.child")))
    called = groups.join(nodes, keys).select(*keys, "leader", segment.alias("segment"))
    apart = grouped.join(called, [*keys, "leader"]).filter(F.col("segment") != "*").select(*keys, "child", "segment")
    merged = names.join(apart, [*keys, "child"], "left")
    return merged.select(*keys, "child", F.coalesce("segment", F.lit("*")).alias("segment"))


def templates(pages: DataFrame, depth: int = DEPTH, z: float = Z) -> DataFrame:
    """``(host, shapes, template, n, labelled, bad)`` per distinct shape of path.

    ``pages`` has ``host``, ``shapes`` and a nullable boolean ``bad``. From the top
    of every host's tree down, siblings whose labels do not tell them apart are merged,
    however many there are, and their subtrees with them. Of a node's merged groups the one
    with the most labelled leader reads ``*``, and so do children without labels and all children if they
    are one group; another group reads ``/`` and its leader's name, a branch that is alone keeps its own.
    All work is grouped sums over distinct shapes.
    """
    tree = pages.groupBy("host", "shapes").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.count_if("bad").alias("bad")
    )
    tree = stored(tree.withColumn("template", F.lit("")), "tree")
    for level in range(depth):
        step = F.get("shapes", F.lit(level))
        keys = ["host", "template"]
        children = tree.withColumn("child", step).filter(F.col("child").isNotNull())
        children = stored(children.groupBy(*keys, "child").agg(*_sums()), "children")
        if not children.head(1):
            break
        named = _alike_groups(children, z).withColumnsRenamed({"child": "__child", "segment": "__segment"})
        named = stored(named, "segments")
        joined = tree.withColumn("__child", step).join(named, [*keys, "__child"], "left")
        longer = F.concat("template", F.lit("/"), F.col("__segment"))
        tree = joined.withColumn("template", F.coalesce(longer, "template")).drop("__child", "__segment")
        tree = stored(tree, "tree")
    return tree


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], bad: Column, min_purity: float = MIN_PURITY,
    strength: float = STRENGTH, depth: int = DEPTH,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` per row.

    A rule decides where one fits. Otherwise the page's path template does: it is
    blocked when its smoothed share of good labels is below ``min_purity``. The
    smoothing adds ``strength`` labels of the overall purity, so templates with
    few labels follow the corpus. ``bad`` is a nullable boolean column of
    ``pages``: null where a page has no label.

    Null or malformed urls have an empty host and path and are judged as their own
    template. Null ids and repeated rows: one row each. Without labels everything
    no rule blocks is allowed. No rows: no rows.
    """
    url = F.col("url").cast("string")
    narrow = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        bad.cast("boolean").alias("bad"),
    ).withColumn("shapes", _shapes(F.col("path"), depth))
    narrow = stored(narrow, "urls")
    tree = templates(narrow, depth)
    judged = tree.groupBy("host", "template").agg(*_sums())
    overall = tree.agg(*_sums()).first()
    labelled, bad_labels = overall["labelled"] or 0, overall["bad"] or 0
    mean = (labelled - bad_labels + 1) / (labelled + 1)
    purity = (F.col("labelled") - F.col("bad") + F.lit(strength * mean)) / (F.col("labelled") + F.lit(strength))
    judged = judged.select("host", "template", purity.alias("purity"))
    named = stored(tree.select("host", "shapes", "template").join(judged, ["host", "template"]), "named")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))
    return narrow.join(named, ["host", "shapes"]).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "template", "purity"
    )
