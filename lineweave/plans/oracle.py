"""DuckDB SQL for the catalog's queries, written from the definitions and not from the plans."""

from __future__ import annotations

from ..operators.lexicon import VARIANTS
from ..operators.review import RULES

HE = r"\x{0590}-\x{05FF}"
PAIR = r"\d+\s*[/\\-]\s*\d+"
SCAN = rf"""(\s+|{PAIR}|[{HE}]+(?:[-\x{{05BE}}][{HE}]+)*|[a-zA-Z]+(?:-[a-zA-Z]+)*|\d+(?:\.\d+)?|mm|°|cm|%|[.,;:!?()\[\]{{}}\x{{05F4}}"''`]|[\s\S])"""
WORDS = "אבגדהוזחטיכלמנסעפצקרשתםןףץ"

LINES = r"""
lines AS (
  SELECT * FROM (SELECT doc_id, CAST(unnest(generate_series(0, len(p) - 1)) AS INTEGER) AS line_no, regexp_replace(unnest(p), '^\s+|\s+$', '', 'g') AS raw_text
    FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)) WHERE raw_text <> ''
)"""
NOTES = f"""
notes AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d')) AS key,
    translate(split_part(p_name, ' ', 2), 'abcdefghijklmnopqrstuvwxyz', '{WORDS}') || p_size || ' ' || l_linenumber || '/' || CAST(l_quantity AS INTEGER) || ' ' || p_size || 'ממ' AS raw_text, l_linenumber, p_size
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""
ALL = f"""{LINES}, {NOTES},
al AS (SELECT concat_ws('.', 'd', doc_id, line_no) AS key, raw_text FROM lines UNION ALL SELECT key, raw_text FROM notes)"""
#: Spacing, then units: s1 to s4 after each step, u after units, t without white space at the end.
STEPS = rf"""
s1 AS (SELECT *, regexp_replace(r0, '([{HE}])(\d)', '\1 \2', 'g') AS s1 FROM (SELECT key, raw_text, nfc_normalize(raw_text) AS r0 FROM al)),
s2 AS (SELECT *, regexp_replace(s1, '(\d)([{HE}])', '\1 \2', 'g') AS s2 FROM s1),
s3 AS (SELECT *, regexp_replace(s2, '([a-zA-Z])(\d)', '\1 \2', 'g') AS s3 FROM s2),
s4 AS (SELECT *, regexp_replace(s3, '(\d)([a-zA-Z])', '\1 \2', 'g') AS s4 FROM s3),
un AS (SELECT *, replace(replace(replace(replace(replace(s4, 'ממ', 'mm'), 'מ"מ', 'mm'), 'מילימטר', 'mm'), 'millimeter', 'mm'), 'מעלות', '°') AS u FROM s4),
n0 AS (SELECT *, regexp_replace(u, '\s+$', '') AS t FROM un)"""


def scan(source: str, keys: str, text: str) -> str:
    """CTE tok: tokens with spans of the rows of source."""
    return rf"""
pc AS (SELECT {keys}, unnest(m) AS text, unnest(generate_series(0, len(m) - 1)) AS n FROM (SELECT {keys}, regexp_extract_all({text}, '{SCAN}') AS m FROM {source}) WHERE len(m) > 0),
sp AS (SELECT *, sum(length(text)) OVER w AS e, sum(CASE WHEN regexp_matches(text, '^\s') THEN 0 ELSE 1 END) OVER w - 1 AS idx FROM pc WINDOW w AS (PARTITION BY {keys} ORDER BY n ROWS UNBOUNDED PRECEDING)),
tok AS (SELECT {keys}, CAST(idx AS INTEGER) AS idx, text, CAST(e - length(text) AS INTEGER) AS s, CAST(e AS INTEGER) AS e,
  CASE WHEN regexp_full_match(text, '{PAIR}') THEN 'pair' WHEN text IN ('mm', 'cm', '°', '%') THEN 'unit' WHEN text SIMILAR TO '\d.*' THEN 'number' WHEN regexp_full_match(text, '[.,;:!?()\[\]{{}}"''`]') THEN 'punct' ELSE 'word' END AS kind,
  CASE WHEN regexp_matches(text, '^\d') THEN 'digit' WHEN regexp_matches(text, '^[{HE}]') THEN 'he' WHEN regexp_matches(text, '^[a-zA-Z]') THEN 'en' WHEN text IN ('°', '%') OR regexp_full_match(text, '[.,;:!?()\[\]{{}}"''`]') THEN NULL ELSE 'mixed' END AS script
  FROM sp WHERE NOT regexp_matches(text, '^\s'))"""


TALK = scan("conversations", "conv_id, turn", "text")
ENTRIES = """
ent AS (
  SELECT row_number() OVER (ORDER BY label) - 1 AS seq, 'W:' || label AS iri, label, CASE WHEN length(label) % 3 = 0 THEN [reverse(label)] ELSE [] END AS synonyms FROM (
    SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS label FROM benchmark
    UNION SELECT DISTINCT lower(regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)', 1)) FROM benchmark WHERE regexp_matches(text, '^[A-Za-z]+ [A-Za-z]+'))
),
srf AS (
  SELECT surface, iri, label, match_type, score_lex, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY surface ORDER BY CASE match_type WHEN 'label' THEN 1 ELSE 2 END, seq) AS rn FROM (
      SELECT label AS surface, iri, label, 'label' AS match_type, 1.0::DOUBLE AS score_lex, seq * 1000 AS seq FROM ent
      UNION ALL SELECT synonyms[1], iri, label, 'synonym', 0.9, seq * 1000 + 1 FROM ent WHERE len(synonyms) > 0)) WHERE rn = 1
)"""
WORD = r"""wd AS (SELECT *, regexp_replace(lower(text), '\s+', ' ', 'g') AS norm FROM tok WHERE kind = 'word')"""
TRIPLES = """
tri AS (
  SELECT 'R:' || r_regionkey AS subj, 'label' AS pred, array_to_string(list_transform(string_split(r_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS obj, 'en' AS lang, true AS literal FROM region
  UNION ALL SELECT 'R:' || r_regionkey, 'type', 'Region', NULL, false FROM region
  UNION ALL SELECT 'R:' || r_regionkey, 'definition', 'region ' || lower(r_name), NULL, true FROM region
  UNION ALL SELECT 'N:' || n_nationkey, 'label', n_name, 'fr', true FROM nation
  UNION ALL SELECT 'N:' || n_nationkey, 'label', lower(n_name), 'de', true FROM nation
  UNION ALL SELECT 'N:' || n_nationkey, 'synonym', replace(n_name, '_', ' '), NULL, true FROM nation
  UNION ALL SELECT 'N:' || n_nationkey, 'type', 'Nation', NULL, false FROM nation
  UNION ALL SELECT 'N:' || n_nationkey, 'part_of', 'R:' || n_regionkey, NULL, false FROM nation
  UNION ALL SELECT 'P:' || p_partkey, 'label', p_name, 'en', true FROM part
  UNION ALL SELECT 'P:' || p_partkey, 'label', upper(p_name), 'en', true FROM part
  UNION ALL SELECT 'P:' || p_partkey, 'synonym', p_name || ' ' || lower(p_type), NULL, true FROM part
  UNION ALL SELECT 'P:' || p_partkey, 'type', p_type, NULL, false FROM part
  UNION ALL SELECT 'P:' || p_partkey, 'brand', p_brand, NULL, true FROM part
),
lex AS (
  SELECT subj AS iri, label, list_sort(list_distinct(list_filter(alls, lambda x: x <> label) || syn)) AS synonyms, coalesce(definition, '') AS definition FROM (
    SELECT subj, arg_min(obj, (CASE WHEN lang = 'en' THEN 0 ELSE 1 END, coalesce(lang, 'und'), obj)) FILTER (pred = 'label') AS label,
      list(obj) FILTER (pred = 'label') AS alls, coalesce(list(obj) FILTER (pred = 'synonym'), []) AS syn, min(obj) FILTER (pred = 'definition') AS definition
    FROM tri GROUP BY subj) WHERE label IS NOT NULL
)"""
RANKED = """
li AS (
  SELECT l.*, p_name FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey, max(l_quantity) AS l_quantity, max(l_discount) AS l_discount, max(l_tax) AS l_tax FROM lineitem GROUP BY ALL) l JOIN part ON l_partkey = p_partkey
),
men AS (SELECT l_orderkey AS line_id, 'm' || l_linenumber AS mention_id, p_name AS surface, l_linenumber * 20 AS s, l_linenumber * 20 + length(p_name) AS e FROM li),
lexc AS (
  SELECT l_orderkey AS line_id, 'm' || l_linenumber AS mention_id, CASE l_partkey % 3 WHEN 0 THEN 'http://purl.obolibrary.org/obo/OHD_' WHEN 1 THEN 'http://purl.obolibrary.org/obo/FMA_' ELSE 'DEVICE:' END || (l_partkey % 40) AS iri,
    p_name AS label, round(1.0 - l_discount * 2, 2) AS score_lex, l_tax AS score_prior, CASE l_suppkey % 4 WHEN 0 THEN 'ohd_label' WHEN 1 THEN 'ohd_synonym' WHEN 2 THEN 'alias_only' ELSE 'resolved_alias' END AS iri_source, l_partkey, l_suppkey, l_quantity, l_linenumber FROM li
),
vec AS (
  SELECT line_id, 'v' || l_linenumber AS vec_id, CASE WHEN l_suppkey % 5 = 0 THEN 'zzz' ELSE split_part(label, ' ', CAST(l_suppkey % 2 + 1 AS INTEGER)) END AS surface,
    CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE l_linenumber * 20 + 7 END AS s, CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE l_linenumber * 20 + 12 END AS e, l_partkey, l_quantity, iri FROM lexc
),
cnd AS (
  SELECT line_id, vec_id, CASE WHEN n = 0 THEN iri ELSE 'http://purl.obolibrary.org/obo/OHD_' || ((l_partkey + n * 7) % 40) END AS iri, round(((l_quantity + n * 13) % 50) / 50, 2) AS score_vec, n FROM vec, (SELECT unnest([0, 1, 2]) AS n)
),
att AS (
  SELECT line_id, vec_id, arg_min(mention_id, (s, mention_id)) AS mention_id FROM (SELECT v.line_id, v.vec_id, m.mention_id, m.s FROM vec v JOIN men m ON v.line_id = m.line_id AND contains(lower(m.surface), lower(v.surface))) GROUP BY ALL
),
vc AS (SELECT c.line_id, a.mention_id, c.iri, max(score_vec) AS score_vec, min(n) AS vseq FROM cnd c JOIN att a USING (line_id, vec_id) GROUP BY ALL),
mer AS (
  SELECT line_id, mention_id, iri, coalesce(score_lex, 0) AS score_lex, score_vec, coalesce(score_prior, 0) AS score_prior, iri_source, coalesce(CASE WHEN label IS NOT NULL THEN 0 END, vseq + 1000000000000) AS seq FROM lexc FULL JOIN vc USING (line_id, mention_id, iri)
),
nrm AS (
  SELECT *, CASE WHEN score_vec > 0 AND max(score_vec) OVER w > min(score_vec) OVER w THEN (score_vec - min(score_vec) OVER w) / (max(score_vec) OVER w - min(score_vec) OVER w) ELSE 0 END AS norm_vec FROM mer WINDOW w AS (PARTITION BY line_id, mention_id)
)"""
SCORED = """
raw AS (SELECT *, CASE WHEN norm_vec > 0 THEN (0.6 * score_lex + 0.3 * norm_vec) / 0.9 ELSE score_lex END AS raw FROM nrm),
cut AS (SELECT *, CASE WHEN iri_source IN ('alias_only', 'placeholder') THEN greatest(0, raw - 0.1) ELSE raw END AS cut FROM raw),
sco AS (SELECT *, CASE WHEN norm_vec > 0 AND iri LIKE 'http://purl.obolibrary.org/obo/OHD\\_%' ESCAPE '\\' THEN cut + 0.05 WHEN norm_vec > 0 AND iri LIKE 'http://purl.obolibrary.org/obo/FMA\\_%' ESCAPE '\\' THEN greatest(0, cut - 0.03) ELSE cut END AS score_final FROM cut),
flag AS (
  SELECT *, coalesce(iri_source IN ('ohd_label', 'ohd_synonym', 'resolved_alias'), false) AS ok, count(*) OVER w AS alls, sum(CASE WHEN iri_source IN ('ohd_label', 'ohd_synonym', 'resolved_alias') AND score_lex >= 0.9 THEN 1 ELSE 0 END) OVER w AS strongs FROM sco WINDOW w AS (PARTITION BY line_id, mention_id)
),
rnk AS (
  SELECT * FROM (SELECT *, (alls = 1 OR strongs = 1) AND ok AND score_final >= 0.75 AS confident, row_number() OVER (PARTITION BY line_id, mention_id ORDER BY round(score_final, 9) DESC, seq, iri) AS rank
    FROM flag WHERE alls = 1 OR strongs <> 1 OR (ok AND score_lex >= 0.9)) WHERE rank <= 5
)"""

SQL = {
    "line_source": f"WITH {LINES} SELECT * FROM lines",
    "n0_spacing": f"""WITH {ALL}, {STEPS.replace("nfc_normalize(raw_text)", "raw_text")}
SELECT key, s4 AS spaced, array_to_string(list_filter([CASE WHEN s1 <> r0 THEN 'inserted_space_hebrew_digit' END, CASE WHEN s2 <> s1 THEN 'inserted_space_digit_hebrew' END, CASE WHEN s3 <> s2 THEN 'inserted_space_english_digit' END, CASE WHEN s4 <> s3 THEN 'inserted_space_digit_english' END], lambda x: x IS NOT NULL), ';') AS notes FROM s4""",
    "n0_pairs": rf"""WITH {ALL}, {STEPS},
p AS (SELECT key, u, unnest(m) AS p, unnest(generate_series(0, len(m) - 1)) AS n FROM (SELECT key, u, regexp_extract_all(r0, '{PAIR}') AS m FROM n0) WHERE len(m) > 0),
q AS (SELECT key, u, n, regexp_extract(p, '(\d+)\s*([/\\-])\s*(\d+)', 1) AS a, regexp_extract(p, '(\d+)\s*([/\\-])\s*(\d+)', 2) AS sep, regexp_extract(p, '(\d+)\s*([/\\-])\s*(\d+)', 3) AS b FROM p),
f AS (SELECT *, regexp_extract(u, a || '\s*' || CASE sep WHEN '\' THEN '\\' WHEN '-' THEN '\-' ELSE sep END || '\s*' || b) AS text FROM q)
SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY n) - 1 AS INTEGER) AS n, text, a, b, sep, CAST(instr(u, text) - 1 AS INTEGER) AS s, CAST(instr(u, text) - 1 + length(text) AS INTEGER) AS e FROM f WHERE text <> ''""",
    "n0_numbers": rf"WITH {ALL}, {STEPS} SELECT key, array_to_string(regexp_extract_all(u, '\d+'), ',') AS numbers FROM n0 WHERE regexp_matches(u, '\d')",
    "n0_units": f"""WITH {ALL}, {STEPS},
m AS (SELECT key, t, CASE WHEN contains(s4, 'ממ') OR contains(s4, 'מ"מ') OR contains(s4, 'מילימטר') OR contains(s4, 'millimeter') THEN 'mm' END AS a, CASE WHEN contains(u, '°') THEN '°' END AS b FROM n0)
SELECT key, t AS normalized_text, concat_ws(',', a, b) AS units FROM m WHERE a IS NOT NULL OR b IS NOT NULL""",
    "n0_dates": rf"""WITH {ALL}, {STEPS},
ev AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || ' ' || strftime(ts, '%d/%m/%y') AS x FROM events),
b AS (SELECT event_id, x FROM ev UNION ALL SELECT NULL, u FROM n0),
c AS (SELECT event_id, regexp_extract_all(x, '\d{{1,2}}[/.-]\d{{1,2}}[/.-]\d{{2,4}}') || regexp_extract_all(x, '\d{{2,4}}[/.-]\d{{1,2}}[/.-]\d{{1,2}}') AS m FROM b)
SELECT event_id, array_to_string(m, ',') AS dates FROM c WHERE event_id IS NOT NULL OR len(m) > 0""",
    "n0_times": r"""SELECT event_id, strftime(ts, '%H:%M:%S') || ',' || (CASE WHEN hour(ts) % 12 = 0 THEN 12 ELSE hour(ts) % 12 END) || strftime(ts, '.%M') || ' PM' AS times FROM events""",
    "n0_nfc": "SELECT doc_id, md5(nfc_normalize(text)) AS composed FROM documents",
    "t1_tokens": f"WITH {LINES}, al AS (SELECT CAST(doc_id AS VARCHAR) || '.' || line_no AS key, doc_id, line_no, raw_text FROM lines), {STEPS.replace('SELECT key, raw_text, nfc', 'SELECT key, doc_id, line_no, raw_text, nfc')}, {scan('n0', 'doc_id, line_no', 't')} SELECT doc_id, line_no, idx, text, kind, script, s, e FROM tok",
    "t1_kind_counts": f"WITH {ALL}, {STEPS}, {scan('n0', 'key', 't')} SELECT kind, script, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, CAST(sum(s * CAST(idx + 1 AS BIGINT)) AS BIGINT) AS mark FROM tok GROUP BY ALL",
    "t1_pairs_view": rf"WITH {ALL}, {STEPS}, {scan('n0', 'key', 't')} SELECT key, idx, text, regexp_extract(text, '^\d+') AS a, regexp_extract(text, '\d+$') AS b, regexp_extract(text, '[/\\-]') AS sep FROM tok WHERE kind = 'pair'",
    "term_cleanup": r"""SELECT p_partkey, CASE WHEN lower(p_name) = lower(p_type) THEN p_name ELSE p_name || ';' || lower(p_type) END AS terms,
  p_name || ';' || p_type || ';' || p_type || ' ' || p_name AS guarded FROM part""",
    "lexicon_build": f"WITH {TRIPLES} SELECT iri, label, array_to_string(synonyms, ';') AS synonyms, definition FROM lex",
    "nodes_full": f"""WITH {TRIPLES},
g AS (SELECT subj, CASE WHEN pred IN ('type', 'label', 'synonym', 'definition') THEN pred ELSE 'annotation' END AS role, CASE WHEN pred = 'label' THEN coalesce(lang, 'und') ELSE pred END AS k, list_sort(list(DISTINCT obj)) AS v FROM tri WHERE literal OR pred = 'type' GROUP BY ALL),
o AS (SELECT subj, array_to_string(list(array_to_string(v, ';')) FILTER (role = 'type'), ';') AS types, array_to_string(list(k || '=' || array_to_string(v, '|') ORDER BY k) FILTER (role = 'label'), ';') AS labels, array_to_string(list(array_to_string(v, ';')) FILTER (role = 'synonym'), ';') AS synonyms, array_to_string(list(array_to_string(v, ';')) FILTER (role = 'definition'), ';') AS definitions, array_to_string(list(k || '=' || array_to_string(v, '|') ORDER BY k) FILTER (role = 'annotation'), ';') AS annotations FROM g GROUP BY subj)
SELECT subj AS iri, coalesce(types, '') AS types, label, coalesce(labels, '') AS labels, coalesce(o.synonyms, '') AS synonyms, coalesce(definitions, '') AS definitions, coalesce(annotations, '') AS annotations FROM o LEFT JOIN lex ON iri = subj""",
    "edges": "SELECT 'N:' || n_nationkey AS subj, 'part_of' AS pred, 'R:' || n_regionkey AS obj FROM nation",
    "embed_text": f"WITH {TRIPLES} SELECT iri, label || CASE WHEN len(synonyms) > 0 THEN ' || ' || array_to_string(synonyms, ' | ') ELSE '' END || CASE WHEN definition <> '' THEN ' ## ' || definition ELSE '' END AS text FROM lex",
    "gaz_exact": f"WITH {TALK}, {WORD}, {ENTRIES} SELECT conv_id, turn, idx, norm, iri, match_type, score_lex FROM wd JOIN srf ON norm = surface",
    "gaz_phonetic": rf"""WITH {TALK}, {WORD}, {ENTRIES},
c1 AS (SELECT DISTINCT x, substr(y, 1, 1) || regexp_replace(substr(y, 2), '[aeiou]', '', 'g') AS z FROM (SELECT surface AS x, regexp_replace(surface, '[^A-Za-z]', '', 'g') AS y FROM srf WHERE regexp_full_match(surface, '[A-Za-z ]+') UNION SELECT text, lower(text) FROM wd WHERE regexp_full_match(text, '[A-Za-z]+'))),
c2 AS (SELECT x, array_to_string(list_filter(string_split(z, ''), lambda c, i: i = 1 OR c <> z[i - 1]), '') AS code FROM c1),
ph AS (SELECT code, arg_min(iri, seq) AS iri FROM srf JOIN c2 ON surface = x GROUP BY code)
SELECT conv_id, turn, idx, text, iri, 'phonetic' AS match_type, 0.83::DOUBLE AS score_lex FROM wd JOIN c2 ON text = x JOIN ph USING (code) WHERE regexp_full_match(text, '[A-Za-z]+')""",
    "gaz_fuzzy": f"""WITH {TALK}, {WORD}, {ENTRIES},
q AS (SELECT DISTINCT norm FROM wd WHERE regexp_full_match(text, '[A-Za-z]+')),
f AS (SELECT norm, surface, iri, seq FROM q JOIN srf ON norm <> surface AND abs(length(norm) - length(replace(surface, ' ', ''))) <= 1 AND damerau_levenshtein(norm, replace(surface, ' ', '')) <= 1
  UNION SELECT norm, surface, iri, seq FROM q JOIN srf ON norm <> surface AND length(norm) >= 18 AND length(replace(surface, ' ', '')) >= 18 AND 1 - levenshtein(norm, replace(surface, ' ', '')) / greatest(length(norm), length(replace(surface, ' ', ''))) >= 0.9),
b AS (SELECT norm, arg_min(iri, seq) AS iri, arg_min(surface, seq) AS surface FROM f GROUP BY norm)
SELECT conv_id, turn, idx, norm, iri, round(least(0.85, greatest(0.70, 0.70 + (0.85 - 0.70) * (1 - levenshtein(norm, surface) / greatest(length(norm), length(surface))))), 4) AS score_lex FROM wd JOIN b USING (norm) WHERE regexp_full_match(text, '[A-Za-z]+')""",
    "gaz_chunks": f"""WITH {TALK}, {WORD}, {ENTRIES},
f AS (SELECT * FROM wd WHERE norm NOT IN (SELECT surface FROM srf)),
r AS (SELECT *, idx - row_number() OVER (PARTITION BY conv_id, turn ORDER BY idx) AS run FROM f),
c AS (SELECT *, CAST((row_number() OVER (PARTITION BY conv_id, turn, run ORDER BY idx) - 1) // 5 AS INTEGER) AS chunk FROM r)
SELECT conv_id, turn, CAST(run AS INTEGER) AS run, chunk, min(s) AS s, max(e) AS e, string_agg(norm, ' ' ORDER BY idx) AS surf, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS idxs FROM c GROUP BY ALL""",
    "gaz_ngram": f"""WITH {TALK}, {WORD}, {ENTRIES},
r AS (SELECT *, idx - row_number() OVER (PARTITION BY conv_id, turn ORDER BY idx) AS run FROM wd),
c AS (SELECT *, CAST((row_number() OVER (PARTITION BY conv_id, turn, run ORDER BY idx) - 1) // 5 AS INTEGER) AS chunk FROM r),
g AS (SELECT conv_id, turn, run, chunk, min(s) AS s, max(e) AS e, list(norm ORDER BY idx) AS w FROM c GROUP BY ALL),
p AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM g), k AS (SELECT *, unnest(range(1, len(w) - i + 2)) AS n FROM p),
m AS (SELECT k.*, iri, match_type, score_lex, row_number() OVER (PARTITION BY conv_id, turn, run, chunk ORDER BY i, n DESC, seq) AS rn FROM k JOIN srf ON array_to_string(w[i:i + n - 1], ' ') = surface)
SELECT conv_id, turn, CAST(run AS INTEGER) AS run, chunk, s, e, iri, match_type, score_lex FROM m WHERE rn = 1""",
    "span_filter": f"""WITH {ALL}, {STEPS}, {scan('n0', 'key', 't')}
SELECT a.key, count(*) AS n, CAST(sum(a.s + a.e + 1) AS BIGINT) AS mark FROM tok a WHERE NOT regexp_full_match(a.text, '\\d+') AND NOT EXISTS (SELECT 1 FROM tok b WHERE a.key = b.key AND b.kind IN ('number', 'pair', 'unit') AND b.s < a.e + 1 AND b.e > a.s) GROUP BY a.key""",
    "surface_hints": "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'device_hint' WHEN 1 THEN 'finding_hint,material_hint' ELSE '' END AS hints FROM part",
    "freq_prior": rf"""WITH {LINES}, {scan('lines', 'doc_id, line_no', 'raw_text')}, {WORD},
c AS (SELECT norm, count(*) AS freq FROM wd WHERE length(norm) > 2 AND NOT regexp_full_match(norm, '\d+') GROUP BY norm)
SELECT norm, freq, round(freq / max(freq) OVER (), 6) AS share FROM c""",
    "coverage_stats": f"""WITH {TALK}, {WORD}, {ENTRIES}, h AS (SELECT count(*) AS c FROM wd JOIN srf ON norm = surface), t AS (SELECT count(*) AS n FROM tok)
SELECT n AS total_tokens, c AS covered_tokens, round(c / n, 4) AS coverage_ratio, c AS mentions FROM h, t""",
    "placeholder_suppress": f"WITH {RANKED} SELECT line_id, mention_id, iri FROM lexc a WHERE NOT (iri LIKE 'DEVICE:%' AND EXISTS (SELECT 1 FROM lexc b WHERE a.line_id = b.line_id AND b.iri LIKE 'http://%'))",
    "vec_topk": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS qid, e.vec_id AS iri, list_inner_product(q.v, e.v) AS x FROM e q, e WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(x, 9) DESC, iri) AS rank FROM s)
SELECT qid, iri, round(x, 6) AS score_raw, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
    "vec_rerank": """WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT q.vec_id AS qid, e.vec_id AS iri, list_inner_product(q.v, list_transform(e.v, lambda y: y * (e.vec_id % 3 + 1))) AS x, list_cosine_similarity(q.v, e.v) AS c FROM e q, e WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(x, 9) DESC, iri) AS k FROM s)
SELECT qid, iri, round(c, 5) AS score_cos, CAST(row_number() OVER (PARTITION BY qid ORDER BY round(c, 9) DESC, iri) AS INTEGER) AS rank FROM r WHERE k <= 10""",
    "vec_context": f"""WITH {TALK},
c AS (SELECT a.conv_id, a.turn, a.idx, any_value(a.text) AS text, any_value(a.kind) AS kind, coalesce(list(b.text ORDER BY b.idx) FILTER (b.idx IS NOT NULL), []) AS near FROM tok a LEFT JOIN tok b ON a.conv_id = b.conv_id AND a.turn = b.turn AND b.idx <> a.idx AND b.idx BETWEEN a.idx - 2 AND a.idx + 2 GROUP BY ALL)
SELECT conv_id, turn, idx, array_to_string(near, ' ') AS context, trim(text || ' ' || array_to_string(near[1:2], ' ')) AS query FROM c WHERE kind NOT IN ('number', 'pair', 'unit')""",
    "vec_hist": """SELECT count(*) FILTER (value <= 10) AS le_10, count(*) FILTER (value > 10 AND value <= 30) AS le_30, count(*) FILTER (value > 30 AND value <= 60) AS le_60, count(*) FILTER (value > 60 AND value <= 120) AS le_120, count(*) FILTER (value > 120) AS gt_120,
  round(avg(value), 3) AS avg_ms, quantile_disc(value, 0.95) AS p95_ms, count(value) AS n FROM events""",
    "hybrid_attach": f"WITH {RANKED} SELECT * FROM att",
    "hybrid_fresh": f"WITH {RANKED} SELECT line_id, vec_id FROM vec v WHERE NOT EXISTS (SELECT 1 FROM att a WHERE a.line_id = v.line_id AND a.vec_id = v.vec_id) AND ((s = 0 AND e = 0) OR NOT EXISTS (SELECT 1 FROM men m WHERE m.line_id = v.line_id AND m.s < v.e AND m.e > v.s))",
    "hybrid_score": f"WITH {RANKED}, {SCORED} SELECT line_id, mention_id, iri, round(norm_vec, 6) AS norm_vec, round(score_final, 6) AS score_final FROM sco",
    "hybrid_rank": f"WITH {RANKED}, {SCORED} SELECT line_id, mention_id, iri, round(score_final, 6) AS score_final, CAST(rank AS INTEGER) AS rank, confident FROM rnk",
    "select_top1": f"WITH {RANKED}, {SCORED} SELECT men.line_id, men.mention_id, surface, s, e, iri, round(score_final, 6) AS score_final, coalesce(confident, false) AS confident FROM men LEFT JOIN (SELECT * FROM rnk WHERE rank = 1) r USING (line_id, mention_id)",
    "rescue_gate": f"WITH {TALK}, {WORD}, {ENTRIES} SELECT conv_id, turn FROM conversations EXCEPT SELECT conv_id, turn FROM wd JOIN srf ON norm = surface WHERE match_type = 'synonym'",
    "rescue_terms": "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'dental implant' ELSE 'multi-unit abutment' END AS terms FROM part WHERE p_size % 4 < 2",
    "line_stats": f"WITH {NOTES}, al AS (SELECT key, raw_text FROM notes), {STEPS}, {scan('n0', 'key', 't')} SELECT (SELECT count(*) FROM n0) AS lines, (SELECT count(*) FROM tok) AS tokens, round((SELECT count(*) FROM tok) / (SELECT count(*) FROM n0), 6) AS avg_tokens, (SELECT count(*) FROM tok WHERE kind = 'pair') AS pairs, CAST((SELECT sum(len(regexp_extract_all(u, '\\d+'))) FROM n0) AS BIGINT) AS numbers",
    "lexicon_gap": f"WITH {TALK}, {WORD}, {ENTRIES} SELECT iri, label FROM ent WHERE label NOT IN (SELECT norm FROM wd)",
    "nested_items": """WITH e AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, CASE WHEN k % 5 > 0 THEN i - 1 END AS n, CASE WHEN k % 5 > 0 THEN CAST(k + i AS INTEGER) END AS tooth, CASE WHEN k % 5 > 0 THEN 'M/' || i END AS surfaces FROM (SELECT *, unnest(CASE WHEN k % 5 > 0 THEN range(1, k % 3 + 2) ELSE [1] END) AS i FROM e)""",
    "hint_join": f"""WITH {TALK},
h AS (SELECT conv_id, turn, CAST((turn + n * (conv_id % 2)) % 5 * 9 AS INTEGER) AS idx, n, 'h' || n AS hint, 'g' || ((conv_id + n) % 4) AS g FROM conversations, (SELECT unnest([1, 2]) AS n)),
l AS (SELECT conv_id, turn, idx, max(n) AS n FROM h GROUP BY ALL),
d AS (SELECT 'g' || r_regionkey AS g, r_name FROM region WHERE r_regionkey < 3)
SELECT t.conv_id, t.turn, t.idx, t.text, h.hint, d.g AS tooth_group, d.r_name AS fdi FROM tok t LEFT JOIN l USING (conv_id, turn, idx) LEFT JOIN h ON h.conv_id = t.conv_id AND h.turn = t.turn AND h.idx = t.idx AND h.n = l.n LEFT JOIN d ON d.g = h.g""",
    "gazetteer_surfaces": f"WITH {TRIPLES}, {{SURFACES}} SELECT seq, surface, iri, label, match_type, score_lex, iri_source FROM sf",
    "gaz_dedupe": f"WITH {TRIPLES}, {{SURFACES}} SELECT surface, iri, label, match_type, score_lex FROM (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY CASE match_type WHEN 'label' THEN 1 ELSE 2 END, seq) AS rn FROM sf) WHERE rn = 1",
    "resolve_alias": f"""WITH {ENTRIES},
a AS (SELECT DISTINCT alias FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS alias FROM benchmark UNION ALL SELECT n_name FROM nation UNION ALL SELECT reverse(label) FROM ent)),
n AS (SELECT seq, iri, label, label AS name, 1 AS stage FROM ent UNION ALL SELECT seq, iri, label, synonyms[1], 2 FROM ent WHERE len(synonyms) > 0),
x AS (SELECT alias, iri, label, stage, seq, 0 AS size FROM a JOIN n ON lower(trim(alias)) = name UNION ALL SELECT alias, iri, label, 3, seq, length(label) FROM a JOIN n ON contains(name, lower(trim(alias))) OR contains(lower(trim(alias)), name) WHERE trim(alias) <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY stage, size, seq) AS rn FROM x)
SELECT alias, iri, label, CASE stage WHEN 1 THEN 'ohd_label' WHEN 2 THEN 'ohd_synonym' ELSE 'resolved_alias' END AS iri_source, stage FROM r WHERE rn = 1""",
    "bundles": f"""WITH {RANKED}, {SCORED},
t AS (SELECT men.line_id, mention_id, men.s // 20 AS s, men.s // 20 + 1 AS e, surface || CASE WHEN line_id % 4 = 0 THEN ' 4mm' ELSE '' END AS surface, CASE WHEN line_id % 2 = 0 THEN 'DEVICE:1' ELSE r.iri END AS iri, score_lex, score_final FROM men LEFT JOIN (SELECT * FROM rnk WHERE rank = 1) r USING (line_id, mention_id)),
g AS (SELECT *, sum(CASE WHEN piri = iri AND pe = s THEN 0 ELSE 1 END) OVER (PARTITION BY line_id ORDER BY s, e, mention_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, lag(iri) OVER w AS piri, lag(e) OVER w AS pe FROM t WINDOW w AS (PARTITION BY line_id ORDER BY s, e, mention_id)) WHERE iri IS NOT NULL),
m AS (SELECT line_id, first(mention_id ORDER BY s, e, mention_id) AS mention_id, first(iri) AS iri, CAST(min(s) AS INTEGER) AS s, CAST(max(e) AS INTEGER) AS e, string_agg(surface, ' ' ORDER BY s, e, mention_id) AS surface, first(score_lex ORDER BY s, e, mention_id) AS sl, first(score_final ORDER BY s, e, mention_id) AS sf FROM g GROUP BY line_id, g),
k AS (SELECT line_id, mention_id, iri, s, e, surface FROM m WHERE NOT (sl = 0 AND sf < 0.15))
SELECT *, false AS bundle FROM k UNION ALL SELECT *, true FROM k WHERE (iri LIKE 'DEVICE:%' OR iri LIKE 'IMPLANT:%') AND regexp_matches(surface, '[0-9]')""",
    "grid_search": f"""WITH {RANKED},
w AS (SELECT row_number() OVER (ORDER BY a, b, c) AS nth, a AS w_lex, b AS w_vec, c AS w_prior FROM (SELECT unnest([0.4, 0.6, 0.8])::DOUBLE AS a), (SELECT unnest([0.1, 0.2, 0.3])::DOUBLE AS b), (SELECT unnest([0.0, 0.05, 0.1])::DOUBLE AS c)),
g AS (SELECT lower(p_name) AS k, 'http://purl.obolibrary.org/obo/OHD_' || (max(p_partkey) % 40) AS want FROM part GROUP BY ALL),
x AS (SELECT nth, w_lex, w_vec, w_prior, line_id, mention_id, want, iri, row_number() OVER (PARTITION BY nth, line_id, mention_id ORDER BY round(w_lex * score_lex + w_vec * norm_vec + w_prior * score_prior, 9) DESC, seq, iri) AS rn FROM nrm JOIN men USING (line_id, mention_id) JOIN g ON lower(surface) = k, w)
SELECT CAST(nth AS INTEGER) AS nth, w_lex, w_vec, w_prior, round(avg(CASE WHEN iri = want THEN 1 ELSE 0 END), 6) AS accuracy, count(*) AS n FROM x WHERE rn = 1 GROUP BY ALL""",
}

#: Pairs of notes with their spans, by line; numbers; the line's view for a reviewer.
PAIRS = rf"""
p0 AS (SELECT key, u, unnest(m) AS p, unnest(generate_series(0, len(m) - 1)) AS n FROM (SELECT key, u, regexp_extract_all(r0, '{PAIR}') AS m FROM n0) WHERE len(m) > 0),
q0 AS (SELECT key, u, n, regexp_extract(p, '(\d+)\s*([/\\-])\s*(\d+)', 1) AS a, regexp_extract(p, '(\d+)\s*([/\\-])\s*(\d+)', 2) AS sep, regexp_extract(p, '(\d+)\s*([/\\-])\s*(\d+)', 3) AS b FROM p0),
f0 AS (SELECT *, regexp_extract(u, a || '\s*' || CASE sep WHEN '\' THEN '\\' WHEN '-' THEN '\-' ELSE sep END || '\s*' || b) AS text FROM q0),
pa AS (SELECT key, n, text, a, b, sep, instr(u, text) - 1 AS s, instr(u, text) - 1 + length(text) AS e FROM f0 WHERE text <> '')"""
NOTE_TOKENS = f"{NOTES}, al AS (SELECT key, raw_text FROM notes), {STEPS}, {scan('n0', 'key', 't')}, {PAIRS}, nu AS (SELECT key, regexp_extract_all(u, '\\d+') AS numbers FROM n0)"


def section(tag: str, body: str) -> str:
    return f"'<{tag}>' || chr(10) || {body} || chr(10) || '</{tag}>'"


def lines(*texts: str) -> str:
    return " || chr(10) || ".join("'" + t.replace("'", "''") + "'" for t in texts)


VIEW = rf"""
tl AS (SELECT key, string_agg('[' || idx || '] ' || text || ' (' || kind || ', span=[' || s || ', ' || e || '], script=' || coalesce(script, 'None') || ')'
  || CASE WHEN kind = 'pair' THEN ' [A=' || regexp_extract(text, '^\d+') || ', B=' || regexp_extract(text, '\d+$') || ', sep=' || regexp_extract(text, '[/\\-]') || ']' ELSE '' END, chr(10) ORDER BY idx) AS tl,
  string_agg('[' || idx || '] ' || text || ' (' || kind || ')', chr(10) ORDER BY idx) FILTER (idx < 20) AS few FROM tok GROUP BY key),
pl AS (SELECT key, string_agg('- ' || text || ': A=' || a || ', B=' || b || ', separator=''' || sep || ''', span=[' || s || ', ' || e || ']', chr(10) ORDER BY n) AS pl FROM pa GROUP BY key),
vw AS (SELECT n0.key, few, concat_ws(chr(10) || chr(10),
  {section("LEGEND", lines("word: letters, with inner hyphens", "number: digits, with decimals", "pair: two numbers and a separator", "unit: mm, cm, °, %", "punct: a mark"))},
  {section("TEXT", "'Original: ' || raw_text || chr(10) || 'Normalized: ' || t")},
  {section("TOKENS", "tl")},
  CASE WHEN pl IS NOT NULL THEN {section("PAIRS", "pl")} END,
  CASE WHEN len(numbers) > 0 THEN {section("NUMBERS", "'Found numbers: ' || array_to_string(numbers, ', ') || chr(10) || 'Count: ' || len(numbers)")} END,
  {section("SAFETY_RULES", lines(*(f"{i}. {r}" for i, r in enumerate(RULES, 1))))},
  {section("INSTRUCTIONS", lines('Return JSON with "ops", "canonical_terms", "tooth_groups", "intent_hints" and "ambiguous", and nothing else.'))}) AS view
  FROM n0 JOIN tl USING (key) LEFT JOIN pl USING (key) JOIN nu USING (key))"""
#: Edits of notes: a space after token a, and a merge (or an unknown edit) of tokens b to c.
OPS = """
kd AS (SELECT key, list(kind ORDER BY idx) AS kinds, count(*) AS n FROM tok GROUP BY key),
od AS (SELECT key, kinds, n, CAST(l_linenumber % 6 - 1 AS INTEGER) AS a, CAST(p_size % 5 AS INTEGER) AS b, CAST(p_size % 5 + l_linenumber % 3 - 1 AS INTEGER) AS c, p_size % 11 = 0 AS erase FROM notes JOIN kd USING (key))"""
EDITED = """
gp AS (SELECT tok.key, idx, tok.text, n0.t, a, b, c, erase, n, substr(n0.t, tok.e + 1, coalesce(lead(tok.s) OVER (PARTITION BY tok.key ORDER BY idx), length(n0.t)) - tok.e) AS gap, tok.s FROM tok JOIN od USING (key) JOIN n0 ON n0.key = tok.key),
lf AS (SELECT *, CASE WHEN NOT erase AND b <= idx AND idx < c AND idx < n - 1 AND trim(gap) = '' THEN '' ELSE gap END AS rest FROM gp),
ed AS (SELECT key, any_value(t) AS t, any_value(substr(t, 1, CAST(s AS BIGINT))) FILTER (idx = 0) || string_agg(text || CASE WHEN idx = a AND NOT starts_with(rest, ' ') THEN ' ' ELSE '' END || rest, '' ORDER BY idx) AS edited FROM lf GROUP BY key)"""
FREQ = r"""
fq AS (SELECT norm, count(*) AS freq FROM wd WHERE length(norm) > 2 AND NOT regexp_full_match(norm, '\d+') GROUP BY norm),
sh AS (SELECT norm, freq / max(freq) OVER () AS share FROM fq)"""
#: Strings near a surface: one edit apart without joiners, or of 18 and more characters and nine tenths alike. Surfaces are ASCII; any other
#: character, of which DuckDB compares the bytes, counts as one that they never have.
NEAR = r"""
nq AS (SELECT DISTINCT norm, regexp_replace(norm, '[^\x00-\x7F]', '#', 'g') AS plain, regexp_replace(replace(replace(norm, ' ', ''), '-', ''), '[^\x00-\x7F]', '#', 'g') AS qs FROM asked),
nk AS (SELECT surface, replace(replace(surface, ' ', ''), '-', '') AS ks, iri, label, seq, iri_source FROM srs),
nf AS (
  SELECT norm, plain, surface, iri, label, seq, iri_source FROM nq JOIN nk ON norm <> surface AND abs(length(qs) - length(ks)) <= 1 AND damerau_levenshtein(qs, ks) <= 1
  UNION SELECT norm, plain, surface, iri, label, seq, iri_source FROM nq JOIN nk ON norm <> surface AND length(qs) >= 18 AND length(ks) >= 18 AND abs(length(qs) - length(ks)) * 10 <= greatest(length(qs), length(ks)) AND 1 - levenshtein(qs, ks) / greatest(length(qs), length(ks)) >= 0.9
),
nb AS (SELECT *, CASE WHEN length(norm) <= 4 THEN 0.65 ELSE 0.70 END::DOUBLE AS lo, CASE WHEN length(norm) <= 4 THEN 0.88 ELSE 0.85 END::DOUBLE AS hi, 1 - levenshtein(plain, surface) / greatest(length(norm), length(surface)) AS ratio FROM nf),
ns AS (SELECT *, round(least(hi, greatest(lo, lo + (hi - lo) * ratio)), 4) AS sc FROM nb),
nt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY sc DESC, seq) AS rn FROM ns) WHERE rn <= 3)"""
SOURCED = "srs AS (SELECT *, CASE match_type WHEN 'label' THEN 'ohd_label' ELSE 'ohd_synonym' END AS iri_source FROM srf)"
HITS = rf"""{TALK}, {WORD}, {ENTRIES}, {SOURCED}, {FREQ},
ex AS (SELECT conv_id, turn, idx, s, e, r.iri, r.label, match_type, score_lex, iri_source, r.seq FROM wd JOIN srs r ON norm = surface),
lw AS (SELECT * FROM wd WHERE norm NOT IN (SELECT surface FROM srs)),
c1 AS (SELECT DISTINCT x, substr(y, 1, 1) || regexp_replace(substr(y, 2), '[aeiou]', '', 'g') AS z FROM (SELECT surface AS x, regexp_replace(surface, '[^A-Za-z]', '', 'g') AS y FROM srs WHERE regexp_full_match(surface, '[A-Za-z ]+') UNION SELECT text, lower(text) FROM wd WHERE regexp_full_match(text, '[A-Za-z]+'))),
c2 AS (SELECT x, array_to_string(list_filter(string_split(z, ''), lambda c, i: i = 1 OR c <> z[i - 1]), '') AS code FROM c1),
ph AS (SELECT code, arg_min(struct_pack(iri := iri, label := label, seq := seq, src := iri_source), seq) AS p FROM srs JOIN c2 ON surface = x GROUP BY code),
so AS (SELECT conv_id, turn, idx, s, e, p.iri, p.label, 'phonetic' AS match_type, 0.83::DOUBLE AS score_lex, p.src, p.seq FROM lw JOIN c2 ON text = x JOIN ph USING (code) WHERE regexp_full_match(text, '[A-Za-z]+')),
sg AS (SELECT * FROM ex UNION ALL SELECT * FROM so),
fr AS (SELECT * FROM wd WHERE NOT EXISTS (SELECT 1 FROM sg WHERE sg.conv_id = wd.conv_id AND sg.turn = wd.turn AND sg.idx = wd.idx)),
ru AS (SELECT *, idx - row_number() OVER (PARTITION BY conv_id, turn ORDER BY idx) AS run FROM fr),
cu AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, turn, run ORDER BY idx) - 1) // 5 AS chunk FROM ru),
ch AS (SELECT conv_id, turn, run, chunk, min(s) AS s, max(e) AS e, list(norm ORDER BY idx) AS w, list(idx ORDER BY idx) AS idxs, string_agg(norm, ' ' ORDER BY idx) AS norm FROM cu GROUP BY ALL),
ci AS (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM ch), ck AS (SELECT *, unnest(range(1, len(w) - i + 2)) AS k FROM ci),
cm AS (SELECT c.*, r.iri, r.label, match_type, score_lex, iri_source, r.seq, row_number() OVER (PARTITION BY conv_id, turn, run, chunk ORDER BY i, k DESC, r.seq) AS rn FROM ck c JOIN srs r ON array_to_string(w[i:i + k - 1], ' ') = surface),
inn AS (SELECT * FROM cm WHERE rn = 1),
asked AS (SELECT * FROM ch WHERE NOT EXISTS (SELECT 1 FROM inn WHERE inn.conv_id = ch.conv_id AND inn.turn = ch.turn AND inn.run = ch.run AND inn.chunk = ch.chunk)),
{NEAR},
al AS (
  SELECT conv_id, turn, s, e, [idx] AS idxs, iri, label, match_type, score_lex, iri_source, seq, 0 AS pass FROM sg
  UNION ALL SELECT conv_id, turn, s, e, idxs, iri, label, match_type, score_lex, iri_source, seq, 1 FROM inn
  UNION ALL SELECT conv_id, turn, s, e, idxs, iri, label, 'fuzzy', sc, iri_source, seq, 1 FROM asked JOIN nt USING (norm)
),
on1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, s, e ORDER BY pass, seq) AS rn FROM al) o WHERE rn = 1
  AND NOT EXISTS (SELECT 1 FROM tok b WHERE b.conv_id = o.conv_id AND b.turn = o.turn AND b.kind IN ('number', 'pair', 'unit') AND b.s < o.e AND b.e > o.s)),
ix AS (SELECT conv_id, turn, s, e, unnest(idxs) AS idx FROM on1),
pr AS (SELECT ix.conv_id, ix.turn, ix.s, ix.e, round(avg(share), 4) AS prior FROM ix JOIN wd USING (conv_id, turn, idx) JOIN sh USING (norm) GROUP BY ALL),
hi AS (SELECT o.*, 'm' || o.conv_id || '.' || o.turn || '_' || o.s || '_' || o.e AS mention_id, coalesce(prior, 0) AS prior FROM on1 o LEFT JOIN pr USING (conv_id, turn, s, e))"""
RESOLVED = """
nm AS (SELECT n AS seq, iri, label, lower(label) AS name, 1 AS stage FROM sq UNION ALL SELECT n, iri, label, lower(unnest(synonyms)), 2 FROM sq),
xr AS (SELECT alias, iri, label, stage, seq, 0 AS size FROM wants JOIN nm ON lower(trim(alias)) = name
  UNION ALL SELECT alias, iri, label, 3, seq, length(label) FROM wants JOIN nm ON contains(name, lower(trim(alias))) OR contains(lower(trim(alias)), name) WHERE trim(alias) <> ''),
rs AS (SELECT alias, iri, CASE stage WHEN 1 THEN 'ohd_label' WHEN 2 THEN 'ohd_synonym' ELSE 'resolved_alias' END AS src FROM (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY stage, size, seq) AS rn FROM xr) WHERE rn = 1)"""
VARIANT_ROWS = "va(seq, alias, held, en) AS (VALUES " + ", ".join(f"({i}, '{a}', '{h}', '{e}')" for i, (a, h, e) in enumerate(VARIANTS)) + ")"

SQL |= {
    "marked_view": f"WITH {NOTE_TOKENS}, {VIEW} SELECT key, view FROM vw",
    "hint_prompt": f"""WITH {NOTE_TOKENS}, {VIEW} SELECT key, md5({lines('Say of which kind these tokens are. Return JSON with "token_hints" (idx, device_hint, tooth_group, clinical_term), "overall_intent" and "detected_procedures"; change no token.')}
  || chr(10) || chr(10) || view || chr(10) || chr(10) || 'Tokens:' || chr(10) || few) AS prompt FROM vw""",
    "validate_ops": f"""WITH {NOTE_TOKENS}, {OPS},
er AS (SELECT key, list_sort(CASE WHEN erase THEN ['op:erase'] ELSE
    list_transform(list_filter(range(b, c + 1), lambda i: i < n AND kinds[i + 1] IN ('number', 'pair')), lambda i: 'number:' || i) || list_transform(list_filter(range(b, c + 1), lambda i: i < n AND kinds[i + 1] = 'pair'), lambda i: 'pair_merge:' || i)
    || CASE WHEN c > n - 1 THEN ['merge_bounds:' || b || '-' || c] WHEN b > c THEN ['merge_order:' || b || '-' || c] ELSE [] END END
  || CASE WHEN a < 0 OR a > n - 1 THEN ['insert_range:' || a] WHEN kinds[a + 1] = 'pair' THEN ['pair_insert:' || a] ELSE [] END) AS er FROM od)
SELECT key, array_to_string(er, ';') AS errors, len(er) = 0 AS valid FROM er""",
    "apply_ops": f"WITH {NOTE_TOKENS}, {OPS}, {EDITED} SELECT key, edited, list_sort(regexp_extract_all(t, '\\d')) <> list_sort(regexp_extract_all(edited, '\\d')) AS digit_mismatch FROM ed",
    "op_survivors": f"""WITH {NOTE_TOKENS}, {OPS}, {EDITED},
af AS (SELECT key, replace(regexp_replace(edited, '\\d$', ''), '1', '') AS x FROM ed),
pm AS (SELECT key, list('pair:' || text ORDER BY n) AS m FROM pa JOIN af USING (key) WHERE NOT contains(x, text) GROUP BY key)
SELECT key, array_to_string(list_transform(list_filter(numbers, lambda v: NOT contains(x, v)), lambda v: 'number:' || v) || coalesce(m, []), ';') AS missing FROM af JOIN nu USING (key) LEFT JOIN pm USING (key)""",
    "text_merged": f"WITH {NOTE_TOKENS}, tn AS (SELECT key, count(*) AS c FROM tok GROUP BY key), pn AS (SELECT key, count(*) AS c FROM pa GROUP BY key) SELECT n0.key, t AS normalized_text, CAST(coalesce(tn.c, 0) AS INTEGER) AS n_tokens, CAST(coalesce(pn.c, 0) AS INTEGER) AS n_pairs, CAST(len(numbers) AS INTEGER) AS n_numbers FROM n0 LEFT JOIN tn USING (key) LEFT JOIN pn USING (key) JOIN nu ON nu.key = n0.key",
    "run_summary": f"""WITH {NOTE_TOKENS}, c AS (SELECT (SELECT count(*) FROM n0) AS l, (SELECT count(*) FROM tok) AS t, (SELECT count(*) FROM pa) AS p, (SELECT sum(len(numbers)) FROM nu) AS m)
SELECT CAST(unnest([0, 1, 2, 3, 4]) AS INTEGER) AS nth, unnest(['Lines Processed', 'Total Pairs Found', 'Total Numbers', 'Total Tokens', 'Avg Tokens/Line']) AS metric, unnest([CAST(l AS VARCHAR), CAST(p AS VARCHAR), CAST(CAST(m AS BIGINT) AS VARCHAR), CAST(t AS VARCHAR), printf('%.1f', round(t / l, 6))]) AS value FROM c""",
    "hebrew_text": rf"""WITH {NOTES}, m AS (SELECT key, raw_text, 'ab' || split_part(raw_text, ' ', 1) AS x FROM notes)
SELECT key, lower(trim(regexp_replace(translate(raw_text, 'ךםןףץ', 'כמנפצ'), '\s+', ' ', 'g'))) AS norm, length(regexp_replace(raw_text, '[^א-ת]', '', 'g')) * 2 >= length(regexp_replace(raw_text, '[^\p{{L}}]', '', 'g')) AS hebrew,
  length(regexp_replace(x, '[^א-ת]', '', 'g')) * 2 >= length(regexp_replace(x, '[^\p{{L}}]', '', 'g')) AS mixed FROM m""",
    "fdi_rule": """WITH e AS (SELECT p_partkey, list_sort(list_transform(list_distinct(list_filter([CAST(p_size AS INTEGER), CAST(p_partkey % 90 AS INTEGER)], lambda x: x < 11 OR x > 48)), lambda x: 'fdi:' || x)) AS er FROM part)
SELECT p_partkey, array_to_string(er, ';') AS errors, len(er) = 0 AS valid FROM e""",
    "gazetteer_hits": f"""WITH {HITS} SELECT mention_id, conv_id, turn, s, e, iri, match_type, score_lex, concat_ws(',', CASE WHEN contains(lower(label), 'abutment') OR contains(lower(label), 'implant') OR lower(label) IN ('mu', 'mua') THEN 'device_hint' END,
  CASE WHEN contains(lower(label), 'caries') THEN 'finding_hint' END, CASE WHEN contains(lower(label), 'zirconia') OR contains(lower(label), 'titanium') THEN 'material_hint' END) AS hints, round(prior, 3) AS score_prior FROM hi""",
    "linked_lexical": f"WITH {HITS} SELECT conv_id, turn, mention_id, label AS surface, s, e, iri, round(score_lex, 6) AS score_final, score_lex >= 0.75 AS confident FROM hi",
    "gaz_window_fuzzy": f"WITH {TALK}, {WORD}, {ENTRIES}, {SOURCED}, asked AS (SELECT norm, count(*) AS n FROM wd GROUP BY norm), {NEAR} SELECT norm AS surf, n, iri, sc AS score_lex FROM asked JOIN nt USING (norm)",
    "gaz_priors": f"WITH {TALK}, {WORD}, {ENTRIES}, {FREQ} SELECT conv_id, turn, s, e, iri, round(round(coalesce(share, 0), 4), 3) AS score_prior FROM wd JOIN srf ON norm = surface LEFT JOIN sh USING (norm)",
    "gaz_build": f"""WITH {TRIPLES}, {VARIANT_ROWS}, {{SURFACES}},
vo AS (SELECT 'http://purl.obolibrary.org/obo/' AS v),
ai AS (SELECT n_nationkey AS seq, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE '9q9' || n_name || '9q9' END AS alias, CASE WHEN n_nationkey % 3 = 0 THEN v || 'OHD_9' ELSE 'DEVICE:' || n_nationkey END AS mapped FROM nation, vo),
he AS (SELECT p_partkey AS seq, translate(split_part(p_name, ' ', 1), 'abcdefghijklmnopqrstuvwxyz', '{WORDS}') AS k, split_part(p_name, ' ', 1) || CASE WHEN p_partkey % 2 = 0 THEN '9q9' ELSE '' END || p_partkey AS alias FROM part WHERE p_partkey <= 50),
wants AS (SELECT en AS alias FROM va UNION SELECT alias FROM ai WHERE mapped NOT LIKE 'http%' UNION SELECT alias FROM he), {RESOLVED},
als AS (
  SELECT seq, surface, iri, label, match_type, score_lex, iri_source FROM sf WHERE iri_source <> 'brand_synonym'
  UNION ALL SELECT n_nationkey + 1000000000, 'ab' || n_nationkey, 'ABBR:ab' || n_nationkey, n_name, 'label', 1.0, 'abbreviation' FROM nation
  UNION ALL SELECT min(p_partkey) + 2000000000, lower(p_brand), 'BRAND:' || p_brand, p_brand, 'label', 1.0, 'brand_label' FROM part GROUP BY p_brand
  UNION ALL SELECT p_partkey + 2000000001, lower(p_brand || ' ' || p_type), 'BRAND:' || p_brand, p_brand, 'synonym', 0.9, 'brand_synonym' FROM part
  UNION ALL SELECT va.seq + 3000000000, lower(va.alias), coalesce(iri, held), va.alias, 'label', 1.0, coalesce(src, 'placeholder') FROM va LEFT JOIN rs ON rs.alias = en
  UNION ALL SELECT ai.seq + 4000000000, lower(ai.alias), coalesce(iri, mapped), ai.alias, 'alias', CASE WHEN iri IS NULL THEN 0.7 ELSE 0.9 END, coalesce(src, 'alias_only') FROM ai LEFT JOIN rs ON rs.alias = ai.alias AND mapped NOT LIKE 'http%'
  UNION ALL SELECT he.seq + 5000000000, lower(he.alias), coalesce(iri, 'HE2EN:' || k), he.alias, 'he_en_alias', CASE WHEN iri IS NULL THEN 0.7 ELSE 0.9 END, coalesce(src, 'placeholder') FROM he LEFT JOIN rs USING (alias)
)
SELECT surface, iri, label, match_type, CAST(score_lex AS DOUBLE) AS score_lex, iri_source FROM (SELECT *, row_number() OVER (PARTITION BY surface ORDER BY CASE WHEN iri_source IN ('alias_only', 'placeholder') THEN 5 WHEN match_type = 'label' THEN 1 WHEN match_type = 'synonym' THEN 2 ELSE 4 END, seq) AS rn FROM als) WHERE rn = 1""",
    "vec_query_terms": f"""WITH {TALK},
c AS (SELECT a.conv_id, a.turn, a.idx, any_value(a.text) AS text, any_value(a.kind) AS kind, coalesce(list(b.text ORDER BY b.idx) FILTER (b.idx IS NOT NULL), []) AS near FROM tok a LEFT JOIN tok b ON a.conv_id = b.conv_id AND a.turn = b.turn AND b.idx <> a.idx AND b.idx BETWEEN a.idx - 2 AND a.idx + 2 GROUP BY ALL)
SELECT conv_id, turn, idx, CASE WHEN turn % 3 = 0 THEN 'first ' || conv_id || ' third' WHEN kind = 'word' AND length(text) = 4 THEN 'en ' || text ELSE trim(text || ' ' || array_to_string(near[1:2], ' ')) END AS query FROM c WHERE kind NOT IN ('number', 'pair', 'unit')""",
    "vec_encode": f"WITH {TRIPLES}, t AS (SELECT iri, label || CASE WHEN len(synonyms) > 0 THEN ' || ' || array_to_string(synonyms, ' | ') ELSE '' END || CASE WHEN definition <> '' THEN ' ## ' || definition ELSE '' END AS x FROM lex), n AS (SELECT iri, length(x) AS c, length(x) - length(replace(x, ' ', '')) AS w FROM t) SELECT iri, round(c / sqrt(c * c + w * w + 1), 4) AS chars, round(w / sqrt(c * c + w * w + 1), 4) AS spaces, round(1 / sqrt(c * c + w * w + 1), 4) AS one FROM n",
    "force_vectors": f"WITH {RANKED} SELECT line_id, mention_id, bool_and(iri_source IN ('alias_only', 'placeholder') OR iri LIKE 'DEVICE:%') AS force FROM lexc GROUP BY ALL",
    "best_point": f"SELECT nth, w_lex, w_vec, w_prior, accuracy FROM ({SQL['grid_search']}) ORDER BY accuracy DESC, nth LIMIT 1",
    "label_sample": f"WITH {TRIPLES} SELECT iri, label FROM lex WHERE length(label) BETWEEN 4 AND 25 ORDER BY md5('sample' || iri), iri LIMIT 5",
    "jsonl_files": "SELECT p_partkey, p_name, p_brand || '|' || p_type AS tags FROM part",
    "lexicon_file": "SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS seq, 'N:' || n_nationkey AS iri, n_name AS label, lower(n_name) AS synonyms, '' AS definition FROM nation WHERE n_nationkey % 5 > 1",
    "dictionary_file": "SELECT r_name AS key, CAST(0 AS INTEGER) AS nth, lower(r_name) AS value FROM region UNION ALL SELECT r_name, 1, CAST(r_regionkey AS VARCHAR) FROM region",
    "ntriples_files": f"WITH {TRIPLES} SELECT subj, pred, obj, lang, literal FROM tri WHERE subj NOT LIKE 'P:%'",
    "rdf_xml_file": """SELECT 'N:' || n_nationkey AS subj, 'rdfs:label' AS pred, n_name AS obj, 'en' AS lang, true AS literal FROM nation
  UNION ALL SELECT 'N:' || n_nationkey, 'obo:IAO_0000118', 'syn ' || n_name, NULL, true FROM nation UNION ALL SELECT 'N:' || n_nationkey, 'obo:IAO_0000115', 'def ' || n_regionkey, NULL, true FROM nation
  UNION ALL SELECT 'N:' || n_nationkey, 'rdfs:subClassOf', 'R:' || n_regionkey, NULL, false FROM nation UNION ALL SELECT 'N:' || n_nationkey, 'rdf:type', 'owl:Class', NULL, false FROM nation""",
    "vector_index_files": "SELECT count(*) AS n, count(DISTINCT vec_id) AS iris, CAST(max(len(embedding)) AS INTEGER) AS dim, count(*) AS count, 'driver' AS model FROM embeddings",
}

SURFACES = """
sq AS (SELECT *, row_number() OVER (ORDER BY iri) - 1 AS n FROM lex),
fn AS (SELECT * FROM sq WHERE length(label) > 2 AND NOT regexp_full_match(label, '[0-9]+')),
sf AS (
  SELECT n * 1000 AS seq, lower(label) AS surface, iri, label, 'label' AS match_type, 1.0::DOUBLE AS score_lex, 'ohd_label' AS iri_source FROM fn
  UNION ALL SELECT n * 1000 + i, lower(synonyms[i]), iri, label, 'synonym', 0.9, 'ohd_synonym' FROM (SELECT *, unnest(range(1, len(synonyms) + 1)) AS i FROM fn)
  UNION ALL SELECT p_partkey + 1000000000, lower(p_brand || ' ' || p_type), 'BRAND:' || p_brand, p_brand, 'synonym', 0.9, 'brand_synonym' FROM part
)"""
SQL = {k: v.replace("{SURFACES}", SURFACES) for k, v in SQL.items()}
