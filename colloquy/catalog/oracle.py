"""The expected results of the query catalog, as DuckDB SQL.

Written from the semantics, not from the Spark plans: plain ``row_number`` where
Spark selects cut-offs, one regular expression per kind of markup, and so on.
"""

from __future__ import annotations

# Fixed values, written out here so that a slip in the library shows.
EOS, USER, ASSISTANT = "<|endoftext|>", "<|user|>", "<|assistant|>"
SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = (
    r" ?\p{L}+| ?\p{N}+|<\|endoftext\|>|<\|user\|>|<\|assistant\|>|'(?:s|t|re|ve|m|ll|d)"
    r"| ?[^\p{Z}\t\n\x0B\f\r\x{85}\p{L}\p{N}<]+|<|[\p{Z}\t\n\x0B\f\r\x{85}]+"
)

WS_CHARS, WS = SPACES, r"[\t-\r\x1C-\x20\x{85}\p{Z}]+"
CONTROL = r"[\x00-\x08\x0B-\x0C\x0E-\x1F]"

VOCAB_SIZE = 50_256
BATCH = 8


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- expressions -----------------------------------------------------------------


def strip(x: str) -> str:
    return f"trim({x}, {lit(WS_CHARS)})"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit(WS)}, ' ', 'g'), ' ')"


def norm_space(x: str) -> str:
    return collapse(f"coalesce(CAST({x} AS VARCHAR), '')")


def strip_html(x: str) -> str:
    for name in ("script", "style", "template"):
        x = f"regexp_replace({x}, {lit(rf'(?is)<{name}\b[^>]*>.*?</{name}\s*>')}, ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)<![a-z][^>]*>', ' ', 'g')"
    x = f"regexp_replace({x}, '</?[A-Za-z][^>]*>', ' ', 'g')"
    for entity, char in (("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, {lit(entity)}, {lit(char)})"
    return x


def quotes(x: str) -> str:
    return f"translate({x}, '’“”', {lit(chr(39) + chr(34) * 2)})"


def control(x: str) -> str:
    return f"regexp_replace({x}, {lit(CONTROL)}, ' ', 'g')"


def norm_text(x: str) -> str:
    return collapse(quotes(strip_html(x)))


def clean(x: str) -> str:
    return quotes(collapse(strip_html(control(x))))


def role(x: str) -> str:
    return f"CASE WHEN lower({strip(x)}) = 'assistant' THEN 'assistant' ELSE 'user' END"


def hashed(salt: str, key: str) -> str:
    return f"md5('{salt}:' || CAST({key} AS VARCHAR))"


def rank(salt: str, key: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY {hashed(salt, key)}, {key})"


def split_of(position: str, n: str, held_out: float, share: float) -> str:
    held = f"ceil(CAST({held_out!r} AS DOUBLE) * {n})"
    test = f"ceil(CAST({share!r} AS DOUBLE) * {held})"
    return f"CASE WHEN {position} <= {test} THEN 'test' WHEN {position} <= {held} THEN 'val' ELSE 'train' END"


def split_rows(table: str, key: str, held_out: float, share: float) -> str:
    position = rank("42:split", key)
    return f"SELECT *, {split_of(position, 'count(*) OVER ()', held_out, share)} AS split FROM {table}"


def columns(dialogue: str = "dialogue") -> str:
    """A list of (role, content) structs as three scalars."""
    return (
        f"CAST(len({dialogue}) AS INTEGER) AS n_messages, "
        f"coalesce(array_to_string([m.role for m in {dialogue}], ','), '') AS roles, "
        f"coalesce(array_to_string([m.content for m in {dialogue}], '¦'), '') AS contents"
    )


def exchange(user: str, assistant: str) -> str:
    return f"[{{'role': 'user', 'content': {user}}}, {{'role': 'assistant', 'content': {assistant}}}]"


def rendered(dialogue: str) -> str:
    line = f"CASE m.role WHEN 'user' THEN '{USER} ' WHEN 'assistant' THEN '{ASSISTANT} ' ELSE m.role || ': ' END || m.content"
    return f"coalesce(array_to_string([{line} for m in {dialogue}], chr(10)), '') || '{EOS}'"


def cleaned_dialogue(dialogue: str) -> str:
    return f"[x for x in [{{'role': {role('m.role')}, 'content': {clean('m.content')}}} for m in {dialogue}] if x.content <> '']"


def pieces(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(PIECE)})"


def prompt(x: str) -> str:
    return f"'{USER} ' || {x} || chr(10) || '{ASSISTANT} '"


# --- the test tables as corpora ------------------------------------------------------

DIRT = """CASE WHEN doc_id % 4 = 0 THEN text
  WHEN doc_id % 4 = 1 THEN '<p>' || text || '</p><br/>“x” it’s &amp; y'
  WHEN doc_id % 4 = 2 THEN chr(1) || text || chr(9) || chr(160) || '  z'
  WHEN doc_id % 8 = 3 THEN ' ' || chr(8195) || chr(10)
  ELSE '<script>a</script>' || text END"""

ALPACA = """SELECT p_partkey AS id, p_name AS instruction,
  CASE p_size % 3 WHEN 1 THEN '' WHEN 2 THEN p_type END AS input, p_brand AS output FROM part"""
DOLLY = """SELECT u.conv_id || '-' || u.turn AS id, u.text AS instruction, a.text AS response
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'"""
SCIQ = """SELECT doc_id AS id, split_part(text, chr(10), 1) AS question,
  CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 2 = 0 THEN split_part(text, ' ', 1) ELSE lang END AS correct_answer,
  CASE WHEN doc_id % 11 = 0 THEN '' ELSE text END AS support FROM documents"""
NQ = """SELECT page_id AS id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS question,
  CASE WHEN page_id % 7 = 0 THEN '' WHEN page_id % 5 = 0 THEN '[]'
    ELSE regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) END AS answer FROM pages"""
DIRTY_DOCS = f"SELECT doc_id, source, {DIRT} AS text FROM documents"
DIRTY_DIALOGUES = (
    "SELECT doc_id, source, "
    + exchange("CASE WHEN doc_id % 16 = 3 THEN ' ' ELSE 'about ' || chr(9) || source END", "text")
    + f" AS dialogue FROM ({DIRTY_DOCS})"
)
CONVERSATIONS = (
    "SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS dialogue FROM conversations GROUP BY conv_id"
)
METRIC_LOG = """SELECT user_id AS run_id, event_id AS step,
  CASE WHEN user_id % 5 = 0 THEN 500.0::DOUBLE / (event_id + 1) ELSE value END AS value FROM events"""
LEARNING_RATES = "SELECT user_id AS run_id, event_id AS step, value / (event_id % 13 + 1) AS value FROM events"
RESPONSES = f"""SELECT doc_id, p AS prompt, p || CASE doc_id % 4 WHEN 0 THEN text
    WHEN 1 THEN text || '{EOS} more'
    WHEN 2 THEN '{ASSISTANT} ' || text || chr(10) || '{USER} next'
    ELSE 'A first part.' || chr(10) || chr(10) || text END AS full_text
  FROM (SELECT *, {prompt('lang')} AS p FROM documents)"""
CHAT = """SELECT conv_id, turn, role, CASE WHEN role = 'user' AND turn = 2 AND conv_id % 5 = 1 THEN 'exit'
    WHEN role = 'user' AND turn = 2 AND conv_id % 5 = 2 THEN ' Sair '
    WHEN role = 'user' AND turn = 2 AND conv_id % 5 = 3 THEN '  ' ELSE text END AS text FROM conversations"""

ALPACA_DIALOGUE = exchange("instruction || CASE WHEN coalesce(input, '') = '' THEN '' ELSE ' ' || input END", "output")
SCIQ_ANSWER = f"""CASE WHEN {norm_space('correct_answer')} = '' THEN {norm_space('support')}
  WHEN {norm_space('support')} = '' THEN {norm_space('correct_answer')}
  WHEN starts_with(lower({norm_space('support')}), lower({norm_space('correct_answer')})) THEN {norm_space('support')}
  ELSE {norm_space('correct_answer')} || '. ' || {norm_space('support')} END"""
NQ_TEXTS = f"SELECT id, {norm_text('question')} AS q, {norm_text('answer')} AS a FROM ({NQ})"
NQ_DIALOGUE = "CASE WHEN q = '' OR a = '' THEN [] ELSE " + exchange("q", "a") + " END"

CONVERTED = f"""
  SELECT 'alpaca' AS source, id, {ALPACA_DIALOGUE} AS dialogue FROM ({ALPACA})
  UNION ALL SELECT 'dolly', id, {exchange('instruction', 'response')} FROM ({DOLLY})
  UNION ALL SELECT 'sciq', id, {exchange(norm_space('question'), SCIQ_ANSWER)} FROM ({SCIQ})
  UNION ALL SELECT 'nq', id, {NQ_DIALOGUE} FROM ({NQ_TEXTS})"""
TARGETS = """SELECT * FROM (VALUES ('alpaca', (SELECT count(*) * 3 // 4 FROM part)), ('dolly', 1000000000),
  ('sciq', (SELECT count(*) FROM documents))) t(name, target)"""


def capped(table: str) -> str:
    return f"""SELECT * EXCLUDE (name, target, r) FROM (
      SELECT c.*, name, target, {rank('42', 'id', 'source')} AS r FROM ({table}) c
      LEFT JOIN ({TARGETS}) ON name = c.source) WHERE target IS NULL OR r <= target"""


PREPARED = f"""WITH converted AS ({CONVERTED}),
  two AS (SELECT source, source || ':' || id AS id, dialogue FROM converted WHERE len(dialogue) = 2),
  mixed AS ({capped('SELECT * FROM two')}),
  split AS ({split_rows('mixed', 'id', 0.04, 0.5)}),
  cleaned AS (SELECT id, source, split, {cleaned_dialogue('dialogue')} AS dialogue FROM split)
  SELECT id, source, split, {rendered('dialogue')} AS text FROM cleaned WHERE len(dialogue) > 0"""

VOCAB = f"""vocab_counts AS (SELECT token, count(*) AS n FROM (SELECT unnest({pieces('text')}) AS token FROM documents)
    WHERE token NOT IN ('{EOS}', '{USER}', '{ASSISTANT}') GROUP BY token),
  vocab_top AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS id FROM vocab_counts
    QUALIFY id < {VOCAB_SIZE}),
  vocab AS (SELECT token, id FROM vocab_top UNION ALL
    SELECT token, (SELECT count(*) FROM vocab_top) + i FROM (VALUES ('{EOS}', 0), ('{USER}', 1), ('{ASSISTANT}', 2)) s(token, i))"""


def encoded(table: str, key: str, block: int) -> str:
    """CTEs that turn ``table(key, text)`` into ``encoded(key, ids)``."""
    return f"""pieces AS (SELECT {key}, unnest(p) AS token, generate_subscripts(p, 1) AS pos
      FROM (SELECT {key}, {pieces('text')}[1:{block}] AS p FROM {table})),
    encoded AS (SELECT {key}, list(coalesce(v.id, (SELECT id FROM vocab WHERE token = '{EOS}')) ORDER BY pos) AS ids
      FROM pieces LEFT JOIN vocab v USING (token) GROUP BY {key})"""


def batched(table: str, key: str, size: str, by: str = "") -> str:
    """Length-grouped batches of ``table``, with ``batch_id`` and ``batch_pos``."""
    groups, within = (f"PARTITION BY {by}", f"{by}, ") if by else ("", "")
    return f"""SELECT * EXCLUDE (r, n, per, mega, spot), CAST(mega * per + spot // {BATCH} AS BIGINT) AS batch_id,
        CAST(spot % {BATCH} AS INTEGER) AS batch_pos FROM (
      SELECT *, row_number() OVER (PARTITION BY {within}mega ORDER BY {size} DESC, {key}) - 1 AS spot FROM (
      SELECT *, (r - 1) // (per * {BATCH}) AS mega FROM (
      SELECT *, greatest(least(n // ({BATCH} * 4), 50), 1) AS per FROM (
      SELECT *, {rank('42:batch', key, by)} AS r, count(*) OVER ({groups}) AS n FROM {table}))))"""


def joined(x: str) -> str:
    return f"array_to_string({x}, ',')"


def padded(ids: str, pad: str) -> str:
    """Padded ids, mask and labels; needs ``longest`` and the list ``ids``."""
    fill = f"longest - len({ids})"
    full = f"list_concat({ids}, [{pad} for i in range({fill})])"
    return (
        f"{joined(full)} AS input_ids, "
        f"{joined(f'list_concat([1 for i in {ids}], [0 for i in range({fill})])')} AS attention_mask, "
        f"{joined(f'[CASE WHEN i = {pad} THEN -100 ELSE i END for i in {full}]')} AS labels"
    )


def answer(full: str, prompt_: str) -> str:
    gen = f"substr({full}, length({prompt_}) + 1)"
    gen = f"split_part({gen}, '{EOS}', 1)"
    gen = f"split_part({gen}, chr(10) || '{USER}', 1)"
    gen = strip(f"replace({gen}, '{ASSISTANT}', '')")
    return strip(f"split_part({gen}, chr(10) || chr(10), 1)")


def first_sentence(g: str) -> str:
    pattern = lit(rf"([^\n]+?[.!?])(?:{WS}|$)")
    return f"CASE WHEN length({g}) > 300 AND regexp_matches({g}, {pattern}) THEN regexp_extract({g}, {pattern}, 1) ELSE {g} END"


def history(table: str, frame: str = "UNBOUNDED PRECEDING") -> str:
    line = f"CASE role WHEN 'user' THEN '{USER} ' ELSE '{ASSISTANT} ' END || text"
    return f"""SELECT conv_id, turn, array_to_string(lines, chr(10)) || chr(10) || '{ASSISTANT} ' AS prompt FROM (
      SELECT *, list({line}) OVER (PARTITION BY conv_id ORDER BY turn
        ROWS BETWEEN {frame} AND CURRENT ROW) AS lines FROM {table}) WHERE role = 'user'"""


def repeated(suffix: str, prompt_: str = "prompt") -> str:
    """What the test generator makes of a prompt."""
    return f"{prompt_} || '{suffix} ' || {prompt_}"


PROMPTS = f"SELECT item_id, {prompt('text')} AS prompt FROM benchmark"
ALL_IDS = f"""SELECT 'alpaca' AS source, 'alpaca:' || id AS id, md5(instruction) AS digest FROM ({ALPACA})
  UNION ALL SELECT 'dolly', 'dolly:' || id, md5(response) FROM ({DOLLY})
  UNION ALL SELECT 'sciq', 'sciq:' || id, md5(question) FROM ({SCIQ})
  UNION ALL SELECT 'natural-questions', 'natural-questions:' || id, md5(question) FROM ({NQ})"""
IDS_ALPACA_SCIQ = f"SELECT id, digest FROM ({ALL_IDS}) WHERE source IN ('alpaca', 'sciq')"
DOCUMENT_IDS = "(SELECT doc_id, md5(text) AS digest FROM documents)"


def stops(log: str) -> str:
    return f"""SELECT run_id, min(step) AS stop_step FROM (
        SELECT run_id, step, pos - max(CASE WHEN best IS NULL OR value < best THEN pos END)
            OVER (PARTITION BY run_id ORDER BY step) AS waited FROM (
        SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS pos, min(value) OVER (PARTITION BY run_id
            ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM ({log})))
        WHERE waited >= 3 GROUP BY run_id"""


ORACLE: dict[str, str] = {
    "read_source": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "read_source_sample": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100",
    "head_slice": "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50",
    "read_jsonl_splits": f"SELECT conv_id, split, {columns()} FROM ({split_rows(f'({CONVERSATIONS})', 'conv_id', 0.4, 0.5)})",
    "write_jsonl": f"SELECT *, CASE WHEN doc_id % 3 = 0 THEN source END AS extra FROM ({DIRTY_DOCS})",
    "write_jsonl_ascii": f"SELECT *, CASE WHEN doc_id % 3 = 0 THEN source END AS extra, false AS non_ascii_bytes FROM ({DIRTY_DOCS})",
    "write_samples": f"SELECT prompt, full_text AS generation FROM ({RESPONSES})",
    "add_source": "SELECT p_partkey AS id, 'alpaca' AS source FROM part",
    "keep_columns": "SELECT doc_id, source, text FROM documents",
    "filter_nonempty": f"""SELECT 'string' AS kind, id FROM ({ALPACA}) WHERE length(input) > 0
        UNION ALL SELECT 'list', id FROM ({NQ_TEXTS}) WHERE q <> '' AND a <> ''""",
    "filter_turn_count": f"SELECT conv_id, {columns()} FROM ({CONVERSATIONS}) WHERE len(dialogue) = 2",
    "filter_has_content": """SELECT doc_id FROM documents
        WHERE doc_id % 3 = 2 AND lang <> '' OR doc_id % 2 = 1 AND text <> ''""",
    "filter_nonblank_text": f"SELECT doc_id, text FROM ({DIRTY_DOCS}) WHERE {strip('text')} <> ''",
    "filter_nonempty_tokens": """SELECT doc_id, CAST(n AS INTEGER) AS n FROM
        (SELECT doc_id, len(regexp_extract_all(text, '[0-9]+')) AS n FROM documents) WHERE n > 0""",
    "from_alpaca": f"SELECT id, {columns(ALPACA_DIALOGUE)} FROM ({ALPACA})",
    "from_dolly": f"SELECT id, {columns(exchange('instruction', 'response'))} FROM ({DOLLY})",
    "from_sciq": f"SELECT id, {columns(exchange(norm_space('question'), SCIQ_ANSWER))} FROM ({SCIQ})",
    "from_nq": f"SELECT id, {columns()} FROM (SELECT id, {NQ_DIALOGUE} AS dialogue FROM ({NQ_TEXTS}))",
    "convert": f"""SELECT CASE source WHEN 'nq' THEN 'natural-questions' ELSE source END AS name,
        CAST(len(dialogue) AS INTEGER) AS n_messages, count(*) AS rows,
        CAST(sum(coalesce(length(dialogue[2].content), 0)) AS BIGINT) AS answer_chars FROM ({CONVERTED}) GROUP BY 1, 2""",
    "norm_text": f"SELECT doc_id, {norm_text('text')} AS text FROM ({DIRTY_DOCS})",
    "norm_space": f"""SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE {norm_space('text')} END AS text
        FROM ({DIRTY_DOCS})""",
    "ensure_text": """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE CAST(n_chars AS VARCHAR) END AS number,
        CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 2 = 0 THEN lang || ' ' || source ELSE lang || ' None' END AS words
        FROM documents""",
    "strip_control": f"SELECT doc_id, {control('text')} AS text FROM ({DIRTY_DOCS})",
    "strip_html": f"SELECT page_id, {collapse(strip_html('html'))} AS text FROM pages",
    "strip_tags": "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS text FROM pages",
    "straight_quotes": f"SELECT doc_id, {quotes('text')} AS text FROM ({DIRTY_DOCS})",
    "sciq_answer": f"SELECT id, {SCIQ_ANSWER} AS answer FROM ({SCIQ})",
    "nq_short_answer": f"""SELECT id, a AS answer, CASE WHEN a = '[]' THEN '' ELSE a END AS strict_answer,
        a AS json_answer FROM ({NQ_TEXTS})""",
    "unwrap_text": """SELECT page_id, h AS typed, h AS untyped
        FROM (SELECT page_id, regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS h FROM pages)""",
    "first_or_self": "SELECT doc_id, split_part(text, ' ', 1) AS first_word, lang FROM documents",
    "normalize_role": "SELECT conv_id, turn, CASE role WHEN 'assistant' THEN role ELSE 'user' END AS role FROM conversations",
    "clean_text": f"SELECT doc_id, {clean('text')} AS text FROM ({DIRTY_DOCS})",
    "clean_page_text": f"SELECT page_id, {clean('html')} AS text FROM pages",
    "coerce_numbers": """SELECT p_partkey, CAST(p_size AS BIGINT) AS size, CAST(trunc(p_retailprice) AS BIGINT) AS whole_price,
        CAST(p_size AS DOUBLE) AS size_float, CAST(p_size AS DOUBLE) AS size_as_float FROM part""",
    "coerce_bool": "SELECT event_id, event_type IN ('click', 'view') AS flag FROM events",
    "clean_dialogue": f"""SELECT doc_id, {columns()} FROM (SELECT doc_id, {cleaned_dialogue('dialogue')} AS dialogue
        FROM ({DIRTY_DIALOGUES}))""",
    "clean_corpus": f"""SELECT doc_id, split, {columns()} FROM (SELECT doc_id, split, {cleaned_dialogue('dialogue')} AS dialogue
        FROM ({split_rows(f'({DIRTY_DIALOGUES})', 'doc_id', 0.05, 0.5)})) WHERE len(dialogue) > 0""",
    "dialogue_to_text": f"SELECT conv_id, {rendered('dialogue')} AS text FROM ({CONVERSATIONS})",
    "as_text": f"SELECT source, {rendered('dialogue')} AS text FROM ({DIRTY_DIALOGUES})",
    "format_prompt": PROMPTS,
    "build_dialogue": f"SELECT conv_id, {columns()} FROM ({CONVERSATIONS})",
    "take_n": f"""SELECT o_orderkey, o_custkey FROM orders
        QUALIFY {rank('42', 'o_orderkey')} <= 1000""",
    "union_all": f"""SELECT 'alpaca' AS name, id FROM ({ALPACA}) UNION ALL SELECT 'dolly', id FROM ({DOLLY})
        UNION ALL SELECT 'sciq', id FROM ({SCIQ}) UNION ALL SELECT 'alpaca', id FROM ({ALPACA})""",
    "read_source_jsonl": f"SELECT doc_id, md5(text) AS digest, true AS has_row_id FROM documents QUALIFY {rank('42', 'doc_id')} <= 500",
    "shuffle": f"SELECT doc_id, md5(text) AS digest, {rank('42', 'doc_id')} AS position FROM documents",
    "shuffle_within_language": f"SELECT doc_id, lang, {rank('42', 'doc_id', 'lang')} AS position FROM documents",
    "balance_by_targets": f"SELECT id, source, digest, {rank('42:mix', 'id')} AS position FROM ({capped(ALL_IDS)})",
    "split_keep_ratios": split_rows(DOCUMENT_IDS, "doc_id", 0.04, 0.5),
    "split_dataset": split_rows(DOCUMENT_IDS, "doc_id", 0.05, 0.5),
    "mix_and_split": f"SELECT *, {rank('42', 'id')} AS position FROM ({split_rows(f'({IDS_ALPACA_SCIQ})', 'id', 0.05, 0.5)})",
    "count_source": f"""SELECT split, source, count(*) AS rows
        FROM ({split_rows('(SELECT doc_id, source FROM documents)', 'doc_id', 0.05, 0.5)}) GROUP BY split, source""",
    "few_shot_prompt": f"""SELECT lang, block, chr(10) || string_agg('{USER}: ' || {strip("'  ' || split_part(text, chr(10), 1) || chr(9)")}
          || chr(10) || '{ASSISTANT}: ' || text, chr(10) ORDER BY doc_id) || chr(10) || '{ASSISTANT}: ' AS prompt
        FROM (SELECT *, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 16 AS block FROM documents)
        GROUP BY lang, block""",
    "perplexity": """SELECT user_id, round(exp(sum(loss * n) / sum(n)), 6) AS perplexity, round(exp(avg(loss)), 6) AS plain
        FROM (SELECT user_id, CASE WHEN user_id % 10 <> 0 THEN value / 100 END AS loss, event_id % 7 + 1 AS n FROM events)
        GROUP BY user_id""",
    "build_prompts": history("conversations"),
    "build_prompts_recent": history("conversations", "3 PRECEDING"),
    "context_prompts": f"""SELECT conv_id, turn, array_to_string(t, '') AS prompt, CAST(len(t) AS INTEGER) AS n_tokens FROM (
        SELECT conv_id, turn, p[greatest(len(p) - 1023, 1):] AS t FROM (
        SELECT conv_id, turn, {pieces('prompt')} AS p FROM ({history('conversations')})))""",
    "best_checkpoint": f"""SELECT run_id, step AS best_step, value AS best_value FROM ({METRIC_LOG})
        QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY value, step) = 1""",
    "best_checkpoint_greater": f"""SELECT run_id, step AS best_step, value AS best_value FROM ({LEARNING_RATES})
        QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY value DESC, step) = 1""",
    "early_stop_step": stops(METRIC_LOG),
    "early_stop_step_greater": stops(f"SELECT run_id, step, -value AS value FROM ({LEARNING_RATES})"),
    "pretokenize": f"""SELECT doc_id, CAST(len(p) AS INTEGER) AS n, array_to_string(p, '¦') AS pieces
        FROM (SELECT doc_id, {pieces(prompt('text'))} AS p FROM documents)""",
    "build_vocab": f"WITH {VOCAB} SELECT token, CAST(id AS INTEGER) AS id FROM vocab",
    "vocab_check": f"""WITH {VOCAB} SELECT count(*) AS size, count(DISTINCT token) AS tokens, count(DISTINCT id) AS ids,
        CAST(min(id) AS INTEGER) AS min_id, CAST(max(id) AS INTEGER) AS max_id, true AS ok FROM vocab""",
    "tokenize": f"""WITH {VOCAB}, texts AS (SELECT doc_id, {strip(rendered('dialogue'))} AS text FROM ({DIRTY_DIALOGUES})),
        {encoded('texts', 'doc_id', 512)}
        SELECT doc_id, {joined('ids')} AS ids, CAST(len(ids) AS INTEGER) AS n FROM encoded""",
    "tokenize_keep": f"""WITH {VOCAB}, texts AS (SELECT * FROM ({DIRTY_DOCS}) WHERE {strip('text')} <> ''),
        {encoded('texts', 'doc_id', 512)}
        SELECT doc_id, source, text, {joined('ids')} AS ids, CAST(len(ids) AS INTEGER) AS mask_sum
        FROM encoded JOIN texts USING (doc_id)""",
    "encode_tokens_joined": f"""WITH {VOCAB}, texts AS (SELECT doc_id, text FROM documents),
        {encoded('texts', 'doc_id', 1 << 30)} SELECT doc_id, {joined('ids')} AS ids FROM encoded""",
    "truncate_to_context": f"""SELECT doc_id, array_to_string(t, '') AS text, CAST(len(t) AS INTEGER) AS n_tokens FROM (
        SELECT doc_id, p[greatest(len(p) - 1023, 1):] AS t FROM (SELECT doc_id, {pieces('text')} AS p FROM documents))""",
    "length_grouped_batches": f"""SELECT doc_id, digest, batch_id, batch_pos, max(n_chars) OVER (PARTITION BY batch_id) AS batch_size_max
        FROM ({batched('(SELECT doc_id, n_chars, md5(text) AS digest FROM documents)', 'doc_id', 'n_chars')})""",
    "collate": f"""SELECT doc_id, {padded('ids', '0')} FROM (SELECT *, max(len(ids)) OVER (PARTITION BY doc_id // {BATCH}) AS longest
        FROM (SELECT doc_id, [CASE WHEN p = '{EOS}' THEN 0 ELSE length(p) END
          for p in {pieces(f"(text || '{EOS}')")}] AS ids FROM documents))""",
    "batch_generate": f'SELECT item_id, prompt, {repeated("Well.")} AS "full" FROM ({PROMPTS})',
    "batch_generate_first": f"""SELECT item_id, prompt, {first_sentence('g')} AS generation FROM (
        SELECT *, {answer(f"({repeated('Well.')})", 'prompt')} AS g FROM ({PROMPTS}) ORDER BY item_id LIMIT 5)""",
    "postprocess_response": f"""SELECT doc_id, {first_sentence('g')} AS answer
        FROM (SELECT doc_id, {answer('full_text', 'prompt')} AS g FROM ({RESPONSES}))""",
    "hits_stop": f"""SELECT doc_id, contains(tail, '{EOS}') OR contains(tail, chr(10) || '{USER}') AS stopped FROM (
        SELECT doc_id, right(substr(full_text, length(prompt) + 1), 300) AS tail FROM ({RESPONSES}))""",
    "compare_models": f"""SELECT item_id, prompt, {first_sentence('b')} AS base, {first_sentence('t')} AS tuned FROM (
        SELECT *, {answer(f"({repeated('Hm.')})", 'prompt')} AS b, {answer(f"({repeated('Yes!')})", 'prompt')} AS t
        FROM ({PROMPTS}))""",
    "map_rows": "SELECT doc_id, len(string_split(text, ' ')) AS words, 'word' AS unit FROM documents",
    "stream_clean": f"""SELECT doc_id, source, {rendered('dialogue')} AS text FROM (
        SELECT doc_id, source, {cleaned_dialogue('dialogue')} AS dialogue FROM ({DIRTY_DIALOGUES})) WHERE len(dialogue) > 0""",
    "stream_prompts": f"""WITH marked AS (SELECT conv_id, turn, role, {strip('text')} AS t, text, role = 'user'
          AND lower({strip('text')}) IN ('exit', 'quit', 'sair') AS leaves FROM ({CHAT})),
        sessions AS (SELECT *, coalesce(sum(CAST(leaves AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY turn), 0) AS session FROM marked),
        spoken AS (SELECT conv_id, turn, role, session, CASE role WHEN 'user' THEN t ELSE text END AS text FROM sessions
          WHERE NOT leaves AND NOT (role = 'user' AND t = ''))
        SELECT conv_id, turn, array_to_string(p[greatest(len(p) - 1023, 1):], '') AS prompt, false AS late FROM (
        SELECT conv_id, turn, {pieces(f"(array_to_string(lines, chr(10)) || chr(10) || '{ASSISTANT} ')")} AS p FROM (
          SELECT *, list(CASE role WHEN 'user' THEN '{USER} ' ELSE '{ASSISTANT} ' END || text) OVER (
            PARTITION BY conv_id, session ORDER BY turn) AS lines FROM spoken) WHERE role = 'user')""",
    "prepare_corpus": f"SELECT *, {rank('42:mix', 'id')} AS position FROM ({PREPARED})",
    "prepare_corpus_counts": f"SELECT split, source, count(*) AS rows FROM ({PREPARED}) GROUP BY split, source",
    "encode_corpus": f"""WITH {VOCAB}, texts AS (SELECT doc_id, {strip(rendered('dialogue'))} AS text FROM ({DIRTY_DIALOGUES})),
        {encoded('texts', 'doc_id', 512)}, sized AS (SELECT doc_id, split, ids, len(ids) AS n_tokens FROM encoded
          JOIN ({split_rows('(SELECT doc_id FROM documents)', 'doc_id', 0.2, 0.5)}) USING (doc_id)),
        batches AS ({batched('sized', 'doc_id', 'n_tokens', 'split')}),
        wide AS (SELECT *, max(n_tokens) OVER (PARTITION BY split, batch_id) AS longest,
          (SELECT id FROM vocab WHERE token = '{EOS}') AS pad FROM batches)
        SELECT doc_id, split, batch_id, CAST(n_tokens AS INTEGER) AS n_tokens,
          {padded('ids', 'pad')} FROM wide""",
    "score_prompts": f"""WITH {VOCAB}, texts AS (SELECT * FROM ({DIRTY_DOCS}) WHERE {strip('text')} <> ''),
        {encoded('texts', 'doc_id', 512)},
        cut AS (SELECT doc_id, array_to_string({pieces('text')}[1:512], '') AS prompt FROM texts),
        answered AS (SELECT doc_id, prompt, {answer(f"({repeated('So.')})", 'prompt')} AS g FROM cut)
        SELECT doc_id, {joined('ids')} AS ids, prompt, {first_sentence('g')} AS generation FROM answered JOIN encoded USING (doc_id)""",
}
