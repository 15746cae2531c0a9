"""DuckDB SQL for the queries that SQL can express over whole tables."""

_LATEST = """
WITH latest AS (
  SELECT sample_id, source,
         CASE WHEN NOT isnan(judge.score) AND judge.score BETWEEN 0 AND 10 THEN judge.score END AS score
  FROM samples WHERE sample_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC NULLS LAST, judge.score DESC NULLS LAST) = 1
), wanted AS (
  SELECT source, max(CASE WHEN NOT isnan(keep_fraction) THEN keep_fraction END) AS keep_fraction
  FROM cutoff_targets WHERE source IS NOT NULL GROUP BY source
), scored AS (
  SELECT l.source, l.sample_id, l.score FROM latest l WHERE l.source IS NOT NULL AND l.score IS NOT NULL
), steps AS (
  SELECT source, score, count(*) AS ties,
         sum(count(*)) OVER (PARTITION BY source ORDER BY score DESC) AS at_least,
         sum(count(*)) OVER (PARTITION BY source) AS total
  FROM scored GROUP BY source, score
), best AS (
  SELECT s.source, max(s.score) AS cutoff
  FROM steps s JOIN wanted w USING (source)
  WHERE w.keep_fraction > 0 AND s.at_least::DOUBLE / s.total >= least(w.keep_fraction, 1.0) GROUP BY s.source
)
"""


def _delivered(columns: str) -> str:
    return f"""delivered AS (
  SELECT {columns} FROM samples WHERE sample_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY ingested_at DESC NULLS LAST) = 1
)"""


def _words(text: str, marks: str) -> str:
    """Words in lower case, every Han character one of its own."""
    return rf"regexp_extract_all(regexp_replace(lower(coalesce({text}, '')), '(\p{{Han}})', ' \1 ', 'g'), '[{marks}]+')"


# --- repetition: words inside a run that occurred earlier
_REPEATED = rf"""
WITH {_delivered("sample_id, augmentation.generated_answer AS answer")},
spoken AS (SELECT sample_id, {_words("answer", r"\p{L}\p{M}")} AS w FROM delivered),
sized AS (SELECT sample_id, w, len(w) AS n, CASE WHEN len(list_filter(w, lambda x: regexp_matches(x, '^\p{{Han}}$'))) * 2 > len(w) THEN 8 ELSE 4 END AS size FROM spoken WHERE len(w) > 0),
runs AS (SELECT sample_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS run FROM (SELECT *, unnest(range(1, n - size + 2)) AS i FROM sized WHERE n >= size)),
again AS (SELECT sample_id, size, i FROM (SELECT *, min(i) OVER (PARTITION BY sample_id, run) AS first FROM runs) WHERE i > first),
covered AS (SELECT DISTINCT sample_id, unnest(range(i, i + size)) AS at FROM again)
SELECT sample_id FROM sized JOIN (SELECT sample_id, count(*) AS c FROM covered GROUP BY sample_id) USING (sample_id) WHERE c / n >= 0.3"""

# --- near-duplicates by brute force: every pair of sets that share a run, by the similarity of the whole sets


def _near(size: int, threshold: float) -> str:
    return rf"""WITH RECURSIVE {_delivered("sample_id, text")},
spoken AS (SELECT sample_id, {_words("text", r"\p{L}\p{N}\p{M}")} AS w FROM delivered),
runs AS (SELECT DISTINCT sample_id, array_to_string(list_slice(w, i, i + {size - 1}), ' ') AS run FROM (SELECT sample_id, w, unnest(range(1, greatest(1, len(w) - {size - 1}) + 1)) AS i FROM spoken WHERE len(w) > 0)),
sets AS (SELECT sample_id, count(*) AS n, md5(string_agg(run, '|' ORDER BY run)) AS key FROM runs GROUP BY sample_id),
named AS (SELECT sample_id, n, min(sample_id) OVER (PARTITION BY key) AS name FROM sets),
one AS (SELECT r.sample_id AS name, r.run, s.n FROM runs r JOIN named s ON s.sample_id = r.sample_id AND s.name = r.sample_id),
shared AS (SELECT a.name AS a, b.name AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM one a JOIN one b ON a.run = b.run AND a.name < b.name GROUP BY a.name, b.name),
links AS (SELECT a, b FROM shared WHERE c / (na + nb - c) >= {threshold} - 1e-12),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
roots AS (SELECT a AS name, least(a, min(b)) AS root FROM reach GROUP BY a),
degree AS (SELECT a AS name, count(*) AS links FROM edges GROUP BY a),
classes AS (SELECT n.sample_id, coalesce(r.root, n.name) AS class_id, coalesce(d.links, 0) AS links FROM named n LEFT JOIN roots r USING (name) LEFT JOIN degree d USING (name))
"""


# --- records that are equal apart from formatting; JSON by the paths and values of its leaves


def _plain(x: str) -> str:
    flat = rf"trim(regexp_replace(replace(lower({x}), 'ß', 'ss'), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))"
    return rf"regexp_replace(regexp_replace({flat}, '(\p{{Han}}) ', '\1', 'g'), ' (\p{{Han}})', '\1', 'g')"


def _leaves(json: str) -> str:
    return f"(SELECT string_agg(t.fullkey || '=' || {_plain('t.atom::VARCHAR')}, '|' ORDER BY t.fullkey) FROM json_tree({json}) t WHERE t.atom IS NOT NULL)"


_RECORDS = f"""
WITH {_delivered("sample_id, messages, text")},
said AS (SELECT sample_id, i, m.role AS role, m.content AS content, m.tool_calls AS calls FROM (SELECT sample_id, unnest(messages) AS m, unnest(range(len(messages))) AS i FROM delivered WHERE len(messages) > 0)),
listed AS (
  SELECT sample_id, 'm' || string_agg(coalesce(lower(trim(role)), '') || chr(1) || {_plain("coalesce(content, '')")} || chr(1) || coalesce({_leaves("calls")}, ''), chr(2) ORDER BY i) AS canon FROM said GROUP BY sample_id
),
other AS (
  SELECT sample_id, 't' || CASE WHEN regexp_matches(text, '^\\s*[\\[{{]') AND json_valid(text) THEN chr(3) || {_leaves("CASE WHEN json_valid(text) THEN text END")} ELSE {_plain("text")} END AS canon
  FROM delivered WHERE coalesce(len(messages), 0) = 0
),
canons AS (SELECT * FROM listed UNION ALL SELECT * FROM other),
groups AS (SELECT canon, min(sample_id) AS first_id, count(*) AS copies FROM canons WHERE canon IS NOT NULL GROUP BY canon)
"""

SQL = {
    "p1_found": _LATEST + "SELECT sample_id FROM scored JOIN best USING (source) WHERE score >= cutoff",
    "p1_cutoffs": _LATEST
    + """
SELECT w.source, w.keep_fraction, coalesce(t.total, 0)::BIGINT AS scored, b.cutoff, coalesce(s.at_least, 0)::BIGINT AS kept,
       coalesce(s.ties, 0)::BIGINT AS ties, coalesce(s.at_least, 0)::DOUBLE / t.total AS actual_fraction
FROM wanted w LEFT JOIN best b USING (source)
LEFT JOIN steps s ON s.source = b.source AND s.score = b.cutoff
LEFT JOIN (SELECT source, count(*) AS total FROM scored GROUP BY source) t ON t.source = w.source
""",
    "p3_found": _REPEATED,
    "p5_found": _RECORDS + "SELECT g.first_id, c.sample_id AS copy_id FROM canons c JOIN groups g USING (canon) WHERE c.sample_id <> g.first_id",
    "p5_records": _RECORDS + "SELECT first_id AS record_id, copies FROM groups UNION ALL SELECT sample_id, 1 FROM canons WHERE canon IS NULL",
    "p6_found": _near(3, 0.6) + "SELECT a.sample_id AS sample_id_a, b.sample_id AS sample_id_b FROM classes a JOIN classes b USING (class_id) WHERE a.sample_id < b.sample_id",
    "p6_classes": _near(5, 0.8) + "SELECT sample_id, class_id, links FROM classes",
}
