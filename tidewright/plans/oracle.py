"""DuckDB SQL that gives the results of the queries in ``catalog``."""

from __future__ import annotations

from tidewright.operators.minhash import PRIME, Settings, bands, coefficients

_NEAR = Settings()
_BANDS, _ROWS = bands(_NEAR)
_BLANK = r"\s\x0B\p{Z}\x{1C}-\x{1F}\x{85}"
_WORD = r"[\p{L}\p{N}_]+"
_TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{_BLANK}]"


def _squash(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '[{_BLANK}]+', ' ', 'g'))"


def _tokens(x: str) -> str:
    return f"len(regexp_extract_all(coalesce({x}, ''), '{_TOKEN}'))"


_TURNS = f"""
turns AS (
  SELECT conv_id, turn, {_squash("text")} AS content,
         coalesce(nullif(lower({_squash("role")}), ''), 'user') AS role
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY logged_at DESC NULLS LAST, {_squash("text")} DESC, lower({_squash("role")}) DESC) AS rn
        FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL)
  WHERE rn = 1
), said AS (SELECT * FROM turns WHERE content <> ''),
chat AS (
  SELECT conv_id, string_agg(role || ': ' || content, chr(10) || chr(10) ORDER BY turn) AS text, count(*)::INT AS message_count,
         (count(*) FILTER (role = 'assistant'))::INT AS assistant_turn_count, (count(*) FILTER (role = 'user'))::INT AS user_turn_count,
         arg_max(content, turn) FILTER (role = 'assistant') AS answer, arg_min(content, turn) FILTER (role = 'user') AS prompt,
         arg_min(content, turn) FILTER (role = 'assistant') AS response, arg_max(role, turn) AS last_role, max(turn) AS last_turn
  FROM said GROUP BY conv_id
)"""

def _grams(name: str, key: str, table: str) -> str:
    return f"""
{name} AS (
  SELECT DISTINCT id, array_to_string(list_slice(w, i, i + 7), ' ') AS gram
  FROM (SELECT id, w, unnest(range(1, len(w) - 6)) AS i FROM (SELECT {key} AS id, regexp_extract_all(lower(text), '{_WORD}') AS w FROM {table} WHERE text IS NOT NULL) WHERE len(w) >= 8)
)"""


_SCORES = (
    _grams("mine", "doc_id", "documents")
    + ","
    + _grams("theirs", "item_id", "benchmark")
    + """,
known AS (SELECT DISTINCT gram FROM theirs),
sums AS (SELECT m.id, count(*)::INT AS total, count(k.gram)::INT AS matched FROM mine m LEFT JOIN known k USING (gram) GROUP BY m.id),
scores AS (
  SELECT d.doc_id, coalesce(s.matched, 0) AS matched, coalesce(s.total, 0) AS total, CASE WHEN s.total > 0 THEN s.matched::DOUBLE / s.total ELSE 0.0 END AS ratio
  FROM documents d LEFT JOIN sums s ON s.id = d.doc_id
)"""
)

_PAIRS = ", ".join(f"({k}, {a}::BIGINT, {c}::BIGINT)" for k, (a, c) in enumerate(coefficients(_NEAR.num_permutations, _NEAR.seed)))


def _minhash(table: str, key: str, text: str) -> str:
    return f"""
tokens AS (SELECT {key} AS id, list_filter(string_split({_squash(f"lower({text})")}, ' '), lambda t: t <> '') AS t FROM {table}),
shingles AS (
  SELECT DISTINCT id, array_to_string(list_slice(t, i, i + 4), ' ') AS s
  FROM (SELECT id, t, unnest(range(1, greatest(1, len(t) - 4) + 1)) AS i FROM tokens WHERE len(t) > 0)
),
hashes AS (SELECT id, ('0x' || substr(md5(s), 1, 8))::BIGINT % {PRIME} AS h FROM shingles),
perms(k, a, c) AS (VALUES {_PAIRS}),
sigs AS (SELECT id, k, min((a * h + c) % {PRIME}) AS v FROM hashes CROSS JOIN perms GROUP BY id, k),
bands AS (SELECT id, k // {_ROWS} AS band, string_agg(v::VARCHAR, ',' ORDER BY k) AS key FROM sigs WHERE k < {_BANDS * _ROWS} GROUP BY id, k // {_ROWS}),
least AS (SELECT band, key, min(id) AS src FROM bands GROUP BY band, key HAVING count(*) > 1),
links AS (SELECT DISTINCT l.src, b.id AS dst FROM bands b JOIN least l USING (band, key) WHERE b.id <> l.src)"""


_COMPONENTS = """,
edges AS (SELECT src AS a, dst AS b FROM links UNION SELECT dst, src FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
dropped AS (SELECT a AS id FROM reach GROUP BY a HAVING min(b) < a)"""

_DOCS = _minhash("documents", "doc_id", "text")

# brute force: every pair that shares a shingle, by the similarity of the whole sets
_EXACT = f"""
tokens AS (SELECT doc_id AS id, list_filter(string_split({_squash("lower(text)")}, ' '), lambda t: t <> '') AS t FROM documents),
shingles AS (
  SELECT DISTINCT id, array_to_string(list_slice(t, i, i + 4), ' ') AS s
  FROM (SELECT id, t, unnest(range(1, greatest(1, len(t) - 4) + 1)) AS i FROM tokens WHERE len(t) > 0)
),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
shared AS (SELECT a.id AS src, b.id AS dst, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
links AS (SELECT s.src, s.dst FROM shared s JOIN sizes a ON a.id = s.src JOIN sizes b ON b.id = s.dst WHERE s.n::DOUBLE / (a.n + b.n - s.n) >= 0.8)"""

SQL = {
    "normalize_conversations": f"WITH {_TURNS} SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::BIGINT AS position, role || ': ' || content AS block FROM said",
    "turn_signals": f"WITH {_TURNS} SELECT conv_id, length(text)::INT AS char_count, message_count, assistant_turn_count, user_turn_count FROM chat",
    "last_assistant_answer": f"WITH {_TURNS} SELECT conv_id, answer FROM chat",
    "quality_filter": f"""WITH {_TURNS}, counted AS (SELECT *, {_tokens("text")}::INT AS token_count, length(text)::INT AS char_count FROM chat)
SELECT conv_id, token_count, message_count, assistant_turn_count, char_count FROM counted
WHERE token_count BETWEEN 200 AND 100000 AND message_count >= 2 AND assistant_turn_count >= 1""",
    "prompt_response_adapter": f"""WITH {_TURNS}
SELECT conv_id::VARCHAR AS sample_id, concat_ws(chr(10) || chr(10), 'user: ' || prompt, 'assistant: ' || response) AS text, response AS answer, 'pairs' AS source,
       ((prompt IS NOT NULL)::INT + (response IS NOT NULL)::INT)::INT AS message_count FROM chat""",
    "sft_export": f"""WITH {_TURNS}
SELECT conv_id::VARCHAR AS id, 'conversations' AS data_source, 'system=Be brief.|user=' || coalesce(prompt, '') || '|assistant=' || response AS messages FROM chat WHERE response <> ''""",
    "token_counter": f"""WITH {_TURNS}, prompts AS (
  SELECT s.conv_id, string_agg(s.role || ': ' || s.content || chr(10), '' ORDER BY s.turn) AS p
  FROM said s JOIN chat c USING (conv_id) WHERE NOT (c.last_role = 'assistant' AND s.turn = c.last_turn) GROUP BY s.conv_id
)
SELECT c.conv_id, {_tokens("p.p")}::INT AS prompt_tokens, (CASE WHEN length(c.answer) > 0 THEN {_tokens("c.answer")} + 1 ELSE 0 END)::INT AS response_tokens,
       ({_tokens("p.p")} + CASE WHEN length(c.answer) > 0 THEN {_tokens("c.answer")} + 1 ELSE 0 END)::INT AS total_tokens
FROM chat c LEFT JOIN prompts p USING (conv_id)""",
    "render_prompt": f"""WITH {_TURNS}
SELECT conv_id, rtrim('Rate conversation ' || conv_id || ' (' || message_count || ' messages).' || chr(10) || chr(10) || coalesce(answer, '') || chr(10), ' ' || chr(10)) AS prompt FROM chat""",
    "normalize_text_source": f"""SELECT doc_id::VARCHAR AS sample_id, CASE WHEN length(text) > 0 THEN {_squash("text")} ELSE '' END AS text, NULL::VARCHAR AS answer, 'documents' AS source, lang,
  length({_squash("text")})::INT AS char_count, (length(coalesce(text, '')) > 0)::INT AS message_count, (length(coalesce(text, '')) > 0)::INT AS user_turn_count FROM documents""",
    "stable_sample_id": f"SELECT doc_id, 'documents-' || lpad(doc_id::VARCHAR, 8, '0') || '-' || substr(sha1({_squash('text')}), 1, 12) AS sample_id FROM documents",
    "union_sources": f"""SELECT source, count(*) AS records, sum(length(t)) AS chars, count(DISTINCT t) AS texts FROM (
  SELECT 'documents' AS source, {_squash("text")} AS t FROM documents UNION ALL SELECT 'benchmark', {_squash("text")} FROM benchmark) GROUP BY source""",
    "token_counts": f"SELECT doc_id, {_tokens('text')}::INT AS token_count FROM documents",
    "token_summary": f"""SELECT count(*) AS sample_count, min(n)::DOUBLE AS min, max(n)::DOUBLE AS max, avg(n) AS mean, quantile_cont(n, 0.1) AS p10, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90
FROM (SELECT {_tokens("text")}::DOUBLE AS n FROM documents)""",
    "alphanumeric_filter": r"SELECT doc_id FROM documents WHERE length(text) > 0 AND length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))::DOUBLE / length(text) >= 0.8",
    "decontam_score": f"WITH {_SCORES} SELECT doc_id, matched, total, ratio FROM scores",
    "decontam_filter": f"WITH {_SCORES} SELECT doc_id FROM scores WHERE matched < 1 OR ratio <= 0.05",
    "decontam_excluded": f"WITH {_SCORES} SELECT doc_id, matched, total FROM scores WHERE NOT (matched < 1 OR ratio <= 0.05)",
    "minhash_signature": f"WITH {_DOCS}, joined AS (SELECT id, string_agg(v::VARCHAR, ',' ORDER BY k) AS signature FROM sigs GROUP BY id) SELECT d.doc_id, j.signature FROM documents d LEFT JOIN joined j ON j.id = d.doc_id",
    "lsh_candidates": f"WITH {_DOCS} SELECT src, dst FROM links",
    "near_dedup": f"WITH RECURSIVE {_EXACT}{_COMPONENTS} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM dropped)",
    "minhash_block": f"WITH RECURSIVE {_EXACT}{_COMPONENTS} SELECT id AS doc_id FROM dropped",
    "shard_manifest": """SELECT shard, count(*) AS rows FROM (
  SELECT ((CASE WHEN r < m * (q + 1) THEN r // (q + 1) ELSE m + (r - m * (q + 1)) // greatest(q, 1) END))::INT AS shard
  FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () // k AS q, count(*) OVER () % k AS m FROM documents, (SELECT greatest(1, (count(*) + 127) // 128) AS k FROM documents))) GROUP BY shard""",
    "numeric_filter_threshold": "SELECT doc_id, n_chars FROM documents WHERE n_chars >= 900",
    "numeric_filter_percentile": "SELECT doc_id, n_chars FROM documents WHERE NOT coalesce(n_chars > (SELECT quantile_cont(n_chars, 0.75) FROM documents), false)",
    "metadata_stats": """SELECT count(*) AS total, count(v) AS count, min(v) AS min, max(v) AS max, avg(v) AS mean, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75,
  quantile_cont(v, 0.9) AS p90, quantile_cont(v, 0.95) AS p95, quantile_cont(v, 0.99) AS p99 FROM (SELECT quality_signals.token_count::DOUBLE AS v FROM samples)""",
    "sample_num": "SELECT doc_id, n_chars FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100",
    "judge_parse": r"""WITH raw AS (SELECT sample_id, ingested_at, trim(coalesce(judge.raw_response, ''), ' ' || chr(9) || chr(10) || chr(13)) AS r FROM samples),
read AS (
  SELECT *, CASE WHEN json_valid(r) AND json_type(r) = 'OBJECT' THEN CASE WHEN json_exists(r, '$.score') THEN try_cast(json_extract_string(r, '$.score') AS DOUBLE) ELSE 0.0 END END AS j,
         try_cast(nullif(regexp_extract(r, '[0-9]+(\.[0-9]+)?'), '') AS DOUBLE) AS n
  FROM raw
), scored AS (SELECT *, coalesce(j, n, 0.0) AS score FROM read)
SELECT sample_id, strftime(ingested_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ingested_at) % 1000000 = 0 THEN '' ELSE '.' || rtrim(lpad((microsecond(ingested_at) % 1000000)::VARCHAR, 6, '0'), '0') END AS ingested_at,
       score, CASE WHEN isnan(score) THEN score ELSE least(score / 10, 1.0) END AS normalized_score FROM scored""",
    "judge_filter": """SELECT sample_id, strftime(ingested_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ingested_at) % 1000000 = 0 THEN '' ELSE '.' || rtrim(lpad((microsecond(ingested_at) % 1000000)::VARCHAR, 6, '0'), '0') END AS ingested_at
FROM samples WHERE judge.score >= 7.0 AND NOT isnan(judge.score)""",
    "judge_summary": "SELECT count(s) AS sample_count, min(s) AS min, max(s) AS max, avg(s) AS mean FROM (SELECT judge.score AS s FROM samples) WHERE NOT isnan(s)",
    "callable_generation": "SELECT item_id, trim(upper(trim(suite || '/' || item_id || ': ' || text, ' ' || chr(9) || chr(10) || chr(13)))) AS generated_answer, 'echo' AS model, NULL::VARCHAR AS error FROM benchmark",
    "pipeline_stage_counts": f"""WITH RECURSIVE {_EXACT}{_COMPONENTS},{_SCORES},
unique_docs AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT id FROM dropped)),
clean AS (SELECT u.* FROM unique_docs u JOIN scores s USING (doc_id) WHERE s.matched < 1 OR s.ratio <= 0.05),
good AS (SELECT * FROM clean WHERE {_tokens("text")} BETWEEN 100 AND 400 AND length(text) > 0)
SELECT 'normalized' AS stage, count(*) AS rows FROM documents UNION ALL SELECT 'deduplicated', count(*) FROM unique_docs
UNION ALL SELECT 'decontaminated', count(*) FROM clean UNION ALL SELECT 'quality_filtered', count(*) FROM good""",
}
