"""One query per operator of this package, over its whole table, and its result as SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import alignment, decontaminate, lexical, neighbours, fingerprints, lattice, packing, quality, secret_scan, simhash, url_filter, warc, windows
from colloquy.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
    ("block", "net/fr/"),
]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_quality_classifier(spark, sf_dir):
    judged = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    verdicts = [
        F.col(f"__{kind}_{name}").alias(f"{name}_{kind}")
        for name in ("toxic", "poor") for kind in ("evidence", "prior", "posterior")
    ]
    return judged.select(
        "doc_id", F.col("__host").alias("host"), F.col("__path").alias("path"), *verdicts, F.col("__keep").alias("keep")
    )


@query
def op2_benchmark_decontamination(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with ``bad``, the label of the document that the first number of the url's path names."""
    number = F.regexp_extract(url_filter.path_of(F.col("url")), "([0-9]{1,18})", 1).try_cast("bigint")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", number.alias("doc_id"))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return pages.join(labels, "doc_id", "left")


@query
def op3_url_filter(spark, sf_dir):
    return url_filter.filter_urls(labelled_pages(spark, sf_dir), URL_RULES, F.col("bad"))


def _tree_sql() -> str:
    """The template tree in SQL: one step per level, as in the operator."""
    u = url_filter
    steps = [
        "t0 AS (SELECT host, shapes, count(*)::DOUBLE n, count(bad)::DOUBLE labelled, "
        "(count(*) FILTER (WHERE bad))::DOUBLE bad, '' AS template FROM urls GROUP BY host, shapes)"
    ]
    for level in range(u.DEPTH):
        t, c, k, s = f"t{level}", f"c{level}", f"k{level}", f"s{level}"
        steps += [
            f"{c} AS (SELECT host, template, shapes[{level + 1}] child, sum(n) n, sum(labelled) labelled, sum(bad) bad "
            f"FROM {t} WHERE len(shapes) > {level} GROUP BY ALL)",
            f"{k} AS (SELECT *, count(*) OVER w nc, sum(n) OVER w an, sum(labelled) OVER w al, sum(bad) OVER w ab "
            f"FROM {c} WINDOW w AS (PARTITION BY host, template))",
            f"{s} AS (SELECT host, template, child, CASE WHEN nc > {u.BRANCHES} AND n * {u.BRANCHES} < an THEN '*' "
            f"WHEN labelled > 0 AND al - labelled > 0 AND pow(bad / labelled - (ab - bad) / (al - labelled), 2) > "
            f"{u.Z * u.Z} * (ab / al) * (1 - ab / al) * (1 / labelled + 1 / (al - labelled)) "
            f"THEN child ELSE '*' END segment FROM {k})",
            f"t{level + 1} AS (SELECT t.host, t.shapes, t.n, t.labelled, t.bad, "
            f"coalesce(t.template || '/' || s.segment, t.template) AS template FROM {t} t LEFT JOIN {s} s "
            f"ON t.host = s.host AND t.template = s.template AND t.shapes[{level + 1}] = s.child)",
        ]
    return ",\n".join(steps)


def _rule_sql() -> tuple[str, str]:
    rule, verdict = "CASE", "CASE"
    for says, text in sorted(URL_RULES, key=lambda r: -len(r[1])):
        host, _, rest = text.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}')"
        rule += f" WHEN {fits} THEN '{text}'"
        verdict += f" WHEN {fits} THEN '{says}'"
    return f"{rule} END", f"{verdict} END"


def _url_sql() -> str:
    u = url_filter
    parts = u.PARTS
    rule, verdict = _rule_sql()
    last = f"t{u.DEPTH}"
    return f"""
WITH l AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) bad FROM labels GROUP BY doc_id),
p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{parts}', 1), ''), '{u.UPPER}', '{u.LOWER}') host,
  coalesce(regexp_extract(url, '{parts}', 2), '') path FROM pages),
q AS (SELECT *, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s:
  CASE WHEN regexp_matches(s, '^[0-9a-f-]{{12,}}$') THEN '%' ELSE regexp_replace(s, '[0-9]+', '#', 'g') END) a FROM p),
urls AS (SELECT page_id, host, path, bad,
  CASE WHEN len(a) > {u.DEPTH} THEN list_append(a[1:{u.DEPTH}], '**') ELSE a END shapes
  FROM q LEFT JOIN l ON l.doc_id = try_cast(regexp_extract(path, '([0-9]{{1,18}})', 1) AS BIGINT)),
{_tree_sql()},
m AS (SELECT (sum(labelled) - sum(bad) + 1) / (sum(labelled) + 1) mean FROM {last}),
j AS (SELECT host, template, (sum(labelled) - sum(bad) + {u.STRENGTH} * mean) / (sum(labelled) + {u.STRENGTH}) purity
  FROM {last}, m GROUP BY host, template, mean)
SELECT page_id, host, path, {rule} AS rule,
  coalesce({verdict}, CASE WHEN purity < {u.MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template, purity
FROM urls JOIN (SELECT host, shapes, template FROM {last}) USING (host, shapes) JOIN j USING (host, template)
"""


ORACLE["op3_url_filter"] = _url_sql()


@query
def op4_secret_scans(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def _secret_sql() -> str:
    s = secret_scan
    kinds = []
    for kind, pattern in enumerate(s.PATTERNS):
        p = "'" + pattern.replace("'", "''") + "'"
        kinds.append(
            f"SELECT rid, owner, {kind} kind, regexp_extract_all(t, {p}) m, string_split_regex(t, {p}) g, "
            f"unnest(range(1, len(regexp_extract_all(t, {p})) + 1)) i FROM d WHERE regexp_matches(t, {p})"
        )
    assign = "'" + s.ASSIGN.replace("'", "''") + "'"
    names = "list_value(" + ", ".join(f"'{k}'" for k in s.KINDS) + ")[kind + 1]"
    listing = f"string_agg({names} || ':' || s || ':' || e, ',' ORDER BY s, kind)"
    return f"""
WITH d AS (SELECT row_number() OVER () rid, doc_id, coalesce(source, '') AS owner, coalesce(text, '') t FROM documents),
f AS ({' UNION ALL '.join(kinds)}),
v AS (SELECT rid, owner, kind, i, m[i] x, length(m[i]) n, length(g[i]) before,
  CASE WHEN kind = 0 THEN regexp_extract(m[i], {assign}, 2) ELSE m[i] END AS v FROM f),
c AS (SELECT *, (sum(before + n) OVER (PARTITION BY rid, kind ORDER BY i))::BIGINT e FROM v),
o AS (SELECT rid, owner, kind, e - n s, e, v FROM c WHERE CASE WHEN kind = 0 THEN length(v) >= {s.ASSIGN_VALUE}
  WHEN kind = 3 THEN regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
  ELSE true END),
w AS (SELECT v, count(DISTINCT owner) owners FROM o GROUP BY v),
a AS (SELECT o.*, owners <= {s.MAX_OWNERS} live FROM o JOIN w USING (v)),
b AS (SELECT * FROM a WHERE kind < 3 UNION ALL SELECT * FROM a WHERE kind = 3 AND live AND NOT EXISTS (
  FROM a z WHERE z.rid = a.rid AND z.kind < 3 AND z.s < a.e AND a.s < z.e)),
r AS (SELECT rid, count(*) FILTER (WHERE kind = 0) n_assign, count(*) FILTER (WHERE kind = 1) n_access,
  count(*) FILTER (WHERE kind = 2) n_hex, count(*) FILTER (WHERE kind = 3) n_owned, count(*) FILTER (WHERE live) n_live,
  sha256(coalesce({listing} FILTER (WHERE kind < 3), '')) AS base_sha256,
  {listing} AS spans FROM b GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0) AS n_owned,
  coalesce(n_live, 0) AS n_live FROM d LEFT JOIN r USING (rid)
"""


ORACLE["op4_secret_scans"] = _secret_sql()


@query
def op7_simhash_near_dedup(spark, sf_dir):
    return simhash.near_components(table(spark, sf_dir, "documents"))


@query
def op10_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), word_vocabulary())


@query
def op6_document_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


ORACLE["op5_warc"] = f"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) digest, strlen(coalesce(html, '')) bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) first FROM p)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN bytes >= {warc.REVISIT_BYTES} AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN bytes >= {warc.REVISIT_BYTES} AND first <> page_id THEN first END AS refers_to FROM f
"""


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op9_lm_scoring(spark, sf_dir):
    return lattice.score_documents(table(spark, sf_dir, "documents"), piece_model())


@query
def op8_substring_dedup(spark, sf_dir):
    return windows.repeated_passages(table(spark, sf_dir, "documents"))


@query
def op12_ranked_lexical_search(spark, sf_dir):
    ranked = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.withColumnRenamed("qid", "item_id")


def _lexical_sql() -> str:
    split = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        f"'{lexical.TERM_PATTERN}')"
    )
    return f"""
WITH d AS (SELECT doc_id, {split} AS t FROM documents),
s AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n, t FROM d WHERE len(t) > 0),
tot AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM s),
occ AS (SELECT doc_id, n, unnest(t) AS term FROM s),
tf AS (SELECT term, doc_id, n, CAST(count(*) AS BIGINT) AS tf FROM occ GROUP BY term, doc_id, n),
q AS (SELECT DISTINCT item_id, unnest({split}) AS term FROM benchmark),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000.0 * ln((2.0 * big_n + 2) / (2.0 * df + 1))) AS BIGINT) AS w FROM dfs, tot),
sc AS (
  SELECT q.item_id, tf.doc_id,
         CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * tf.n * tot.big_n) // tot.big_l)))) AS BIGINT) AS score
  FROM q JOIN tf ON q.term = tf.term JOIN w ON w.term = q.term, tot
  GROUP BY q.item_id, tf.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, CAST(doc_id AS BIGINT) AS doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0)
WHERE rank <= 10
"""


ORACLE["op12_ranked_lexical_search"] = _lexical_sql()


@query
def op13_approximate_nearest_neighbours(spark, sf_dir):
    return neighbours.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


ORACLE["op13_approximate_nearest_neighbours"] = """
WITH ok AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
v AS (SELECT * FROM ok WHERE len(e) = (SELECT len(e) FROM ok GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
WHERE rank <= 10
"""


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op11_cross_tokenizer_alignment(spark, sf_dir):
    import public_tokenizers

    return alignment.alignment(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"),
        a_ranks=(tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
    )
