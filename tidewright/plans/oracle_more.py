"""DuckDB SQL that gives the results of the queries in ``catalog_records`` and ``catalog_io``."""

from __future__ import annotations

from tidewright.plans.oracle import _COMPONENTS, _EXACT, _SCORES, _squash, _tokens

_STAMP = (
    "strftime(ingested_at AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ingested_at) % 1000000 = 0 THEN '' ELSE '.' || rtrim(lpad((microsecond(ingested_at) % 1000000)::VARCHAR, 6, '0'), '0') END"
)


def _stripped(x: str) -> str:
    return f"trim(regexp_replace({x}, '^[\\s\\x0B]+|[\\s\\x0B]+$', '', 'g'))"


def _call(field: str) -> str:
    return f"json_extract_string(calls, '$[0].{field}')"


_SORTED_CALLS = (
    "'[{\"arguments\": {\"limit\": ' || " + _call("arguments.limit") + " || ', \"mode\": \"' || " + _call("arguments.mode") + " || '\", \"node\": \"' || " + _call("arguments.node")
    + " || '\", \"since\": \"' || " + _call("arguments.since") + " || '\"}, \"call\": \"' || " + _call("call") + " || '\", \"name\": \"' || " + _call("name") + " || '\"}]'"
)
_SAID = f"""
rec AS (SELECT row_number() OVER () AS rid, * FROM samples),
said AS (
  SELECT rid, i, lower(coalesce(nullif({_squash("m.role")}, ''), 'user')) AS role, {_squash("m.content")} AS content, m.tool_calls AS calls
  FROM (SELECT rid, unnest(messages) AS m, unnest(range(len(messages))) AS i FROM rec)
)"""
_PARAGRAPH = "chr(10) || chr(10)"
_ADAPTED = f"""WITH {_SAID},
body AS (
  SELECT rid, string_agg(role || ': ' || content || coalesce({_PARAGRAPH} || 'tool_calls: ' || {_SORTED_CALLS}, ''), {_PARAGRAPH} ORDER BY i) AS text, count(*) AS n,
         count(*) FILTER (role = 'assistant') AS a, count(*) FILTER (role = 'user') AS u, arg_max(content, i) FILTER (role = 'assistant') AS answer
  FROM said WHERE content <> '' GROUP BY rid
), whole AS (
  SELECT r.sample_id, nullif({_squash("r.system_prompt")}, '') AS system_prompt, b.*
  FROM rec r LEFT JOIN body b USING (rid)
), made AS (SELECT *, coalesce(concat_ws({_PARAGRAPH}, 'system: ' || system_prompt, text), '') AS rendered FROM whole)
SELECT sample_id, rendered AS text, system_prompt, answer, length(rendered)::INT AS char_count, coalesce(n, 0)::INT AS message_count, coalesce(a, 0)::INT AS assistant_turn_count, coalesce(u, 0)::INT AS user_turn_count FROM made"""
_WITH_EMPTY = f"""WITH {_SAID}, kept AS (SELECT rid, i, CASE WHEN content = '' THEN 'user' ELSE role END AS role, content FROM said),
body AS (SELECT rid, string_agg(role || '=' || content, '|' ORDER BY i) AS messages, count(*) AS n, count(*) FILTER (role = 'assistant') AS a, count(*) FILTER (role = 'user') AS u FROM kept GROUP BY rid)
SELECT r.sample_id, coalesce(b.messages, '') AS messages, coalesce(n, 0)::INT AS message_count, coalesce(a, 0)::INT AS assistant_turn_count, coalesce(u, 0)::INT AS user_turn_count FROM rec r LEFT JOIN body b USING (rid)"""


def _json(x: str) -> str:
    return f"coalesce(to_json({x})::VARCHAR, 'null')"


_METADATA = "'{' || " + " || ', ' || ".join(f"'\"{n}\": ' || {_json(f'metadata.{n}')}" for n in ("adapter", "conv_id", "domain", "lang", "source_name", "source_path")) + " || '}'"


def _generated(backend: str) -> str:
    return f"""SELECT sample_id, {_STAMP} AS ingested_at, md5(p) || ' ' || length(p) AS generated_answer, '{backend}' AS backend, 'digest' AS model, augmentation.error AS error
FROM (SELECT *, {_stripped("sample_id || chr(10) || coalesce(text, '')")} AS p FROM samples)"""


_PROMPTED = f"(SELECT *, {_stripped("coalesce(text, '')")} AS p FROM samples)"
_REPLY = "'{\"score\": ' || length(p) % 11 || ', \"reason\": \"length ' || length(p) || '\", \"style\": ' || length(p) % 5 || ', \"depth\": ' || length(p) % 7 || '}'"

# --- a run over the documents; of near-duplicates the first in the file stays
_RUN = f"""WITH RECURSIVE docs AS (SELECT *, row_number() OVER () AS place FROM documents),
{_EXACT.replace("doc_id AS id", "place AS id").replace("FROM documents)", "FROM docs)", 1)}{_COMPONENTS},{_SCORES},
texts AS (SELECT d.place, d.doc_id, {_squash("d.text")} AS t FROM docs d),
s1 AS (SELECT * FROM texts WHERE place NOT IN (SELECT id FROM dropped)),
s2 AS (SELECT u.*, s.matched FROM s1 u JOIN scores s USING (doc_id) WHERE s.matched < 1 OR s.ratio <= 0.05),
s3 AS (SELECT *, {_tokens("t")}::INT AS token_count FROM s2 WHERE {_tokens("t")} BETWEEN 100 AND 400 AND length(t) > 0),
s4 AS (SELECT * FROM s3 WHERE length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}]', '', 'g'))::DOUBLE / length(t) BETWEEN 0.8 AND 1.0),
s5 AS (SELECT * FROM s4 WHERE length(t) % 11 >= 3),
stages AS (
  SELECT 0 AS k, 'normalized' AS stage, (SELECT count(*) FROM texts) AS rows UNION ALL SELECT 1, 'deduplicated', (SELECT count(*) FROM s1) UNION ALL SELECT 2, 'decontaminated', (SELECT count(*) FROM s2)
  UNION ALL SELECT 3, 'quality_filtered', (SELECT count(*) FROM s3) UNION ALL SELECT 4, 'operator_alphanumeric', (SELECT count(*) FROM s4) UNION ALL SELECT 5, 'augmented', (SELECT count(*) FROM s4)
  UNION ALL SELECT 6, 'judge_filtered', (SELECT count(*) FROM s5)
)"""
_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars, domain FROM documents"
_RATIO = r"CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))::DOUBLE / length(text) ELSE 0.0 END"

SQL = {
    "adapt_messages": _ADAPTED,
    "adapt_messages_with_empty": _WITH_EMPTY,
    "map_metadata": "SELECT sample_id, metadata.source_name AS source_name, 'tidewright' AS adapter, metadata.lang AS lang, metadata.domain AS domain, source, 6 AS fields FROM samples",
    "struct_metadata": """SELECT sample_id, CASE WHEN metadata IS NULL THEN 'samples' ELSE metadata.source_name END AS source_name, CASE WHEN metadata IS NULL THEN '' ELSE metadata.source_path END AS source_path,
  CASE WHEN metadata IS NULL THEN 'tidewright' ELSE metadata.adapter END AS adapter, metadata.lang AS lang, metadata.conv_id AS conv_id FROM samples""",
    "string_functions": f"SELECT doc_id, md5({_squash('text')}) AS squashed, {_squash('text')} = '' AS blank, {_RATIO} AS ratio FROM documents",
    "sorted_tool_calls": f"SELECT sample_id, {_SORTED_CALLS} AS tool_calls FROM (SELECT sample_id, unnest(messages).tool_calls AS calls FROM samples) WHERE calls IS NOT NULL",
    "render_prompt_json": f"SELECT sample_id, '{{' || lpad(coalesce(source, ''), greatest(24, length(coalesce(source, '')))::INT, ' ') || '}} ' || CASE WHEN metadata IS NULL THEN '{{}}' ELSE {_METADATA} END || chr(10) || '{{}}' AS prompt FROM samples",
    "generation_stage": _generated("callable"),
    "generation_by_engine": _generated("ray_vllm"),
    "generation_over_http": _generated("async_http"),
    "judge_stage": f"""SELECT sample_id, (length(p) % 11)::DOUBLE AS score, 'length ' || length(p) AS reason, least((length(p) % 11)::DOUBLE / 10, 1.0) AS normalized_score, {_REPLY} AS raw_response, 'length' AS model
FROM {_PROMPTED} WHERE length(p) % 11 >= 5""",
    "batch_serving": f"SELECT sample_id, 2 AS answers, md5(p) || ' ' || length(p) AS second, 'stop' AS finish_reason, ({_tokens('p')} + 2)::INT AS total_tokens, metadata.lang AS lang FROM {_PROMPTED}",
    "judge_dimensions": f"SELECT sample_id, (length(p) % 5)::DOUBLE AS style, (length(p) % 7)::DOUBLE AS depth, 'length ' || length(p) AS reason, metadata.domain AS domain FROM {_PROMPTED}",
    "sft_from_results": f"SELECT source AS data_source, metadata.domain AS domain, 'user=' || coalesce(text, '') || '|assistant=' || md5(p) || ' ' || length(p) AS messages FROM {_PROMPTED}",
    "injected_operators": f"SELECT doc_id, length(text)::INT AS chars FROM documents WHERE {_RATIO} BETWEEN 0.8 AND 1.0 AND length(text) >= 300",
    "chained_blocks": "SELECT doc_id, CASE WHEN coalesce(n_chars >= 900, false) THEN CASE WHEN lang = 'en' THEN 'english_output' ELSE 'english_excluded' END ELSE 'long_excluded' END AS output FROM documents",
    "experiment_grid": "SELECT 1.0::DOUBLE AS sample_rate, least::INT AS least, l AS lang, (SELECT count(*) FROM documents d WHERE d.n_chars >= t.least AND d.lang = t.l) AS result FROM (VALUES (300, 'en'), (300, 'de'), (900, 'en'), (900, 'de')) t(least, l)",
    "metric_sample": "SELECT (row_number() OVER (ORDER BY doc_id) - 1)::INT AS place, n_chars::DOUBLE AS value FROM (SELECT doc_id, n_chars FROM documents WHERE n_chars IS NOT NULL ORDER BY doc_id LIMIT 100)",
    **{name: _DOCUMENTS for name in ("source_json", "source_detected", "source_arrow", "source_feather", "written_export")},
    **{name: "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang, nullif(source, '') AS source, n_chars, nullif(domain, '') AS domain FROM documents" for name in ("source_csv", "source_tsv")},
    "source_json_array": "SELECT item_id, text, suite FROM benchmark",
    "source_text": "SELECT r_name AS text FROM region",
    "load_union": f"""SELECT doc_id::VARCHAR AS sample_id, 'documents' AS source, 0 AS source_ord, lang, NULL::VARCHAR AS suite, length({_squash("text")})::INT AS chars FROM documents
UNION ALL SELECT 'benchmark-' || lpad((row_number() OVER () - 1)::VARCHAR, 8, '0') || '-' || substr(sha1({_squash("text")}), 1, 12), 'benchmark', 1, NULL, suite, length({_squash("text")})::INT FROM benchmark""",
    "written_shards": """SELECT shard AS shard_id, count(*) AS rows, count(*) AS found, min(doc_id) AS first_id, max(doc_id) AS last_id FROM (
  SELECT doc_id, (CASE WHEN r < m * (q + 1) THEN r // (q + 1) ELSE m + (r - m * (q + 1)) // greatest(q, 1) END)::INT AS shard
  FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r, count(*) OVER () // k AS q, count(*) OVER () % k AS m FROM documents, (SELECT greatest(1, (count(*) + 127) // 128) AS k FROM documents))) GROUP BY shard""",
    "written_chunks": "SELECT doc_id::VARCHAR AS id, text, lang, 'chunk' AS kind FROM documents",
    "pipeline_run": f"{_RUN} SELECT stage, rows FROM stages",
    "pipeline_export": f"""{_RUN} SELECT doc_id::VARCHAR AS sample_id, md5(t) || ' ' || length(t) AS generated_answer, (length(t) % 11)::DOUBLE AS score, 'length ' || length(t) AS reason, token_count, matched AS contamination_matched_ngrams FROM s5""",
    "pipeline_metrics": f"""{_RUN} SELECT 'agent_pipeline_stage_rows' AS metric, stage, rows::DOUBLE AS value FROM stages UNION ALL SELECT 'agent_pipeline_stage_rows', 'exported', rows FROM stages WHERE k = 6
UNION ALL SELECT 'agent_pipeline_final_rows', NULL, rows FROM stages WHERE k = 6 UNION ALL SELECT 'agent_pipeline_run_success', NULL, 1.0""",
    "pipeline_report": f"""{_RUN} SELECT 's' || k || '["' || stage || '<br/>' || rows || ' rows"]' AS node FROM stages""",
    "pipeline_artifacts": f"""{_RUN} SELECT 0 AS missing, count(*) AS rows, count(*) AS judged, max(length(t) % 11)::DOUBLE AS best FROM s5""",
    "alerts": "SELECT * FROM (VALUES ('PipelineRunFailed', 'agent_pipeline_run_success == 0', '1m', 'critical'), ('PipelineStageSlow', 'agent_pipeline_stage_duration_seconds > 1800', '10m', 'warning')) t(alert, expr, wait, severity)",
    "stream_clean": f"SELECT doc_id::VARCHAR AS sample_id, {_tokens('text')}::INT AS token_count, length({_squash('text')})::INT AS char_count FROM documents WHERE {_tokens('text')} BETWEEN 100 AND 400 AND length(text) > 0",
}
