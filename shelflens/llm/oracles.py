"""DuckDB SQL for the queries that SQL can express.

Compression sizes, the 64-bit hashes of Spark, alignments and learned models
are out of SQL's reach; tests/llm holds those queries against brute force.
"""

from __future__ import annotations

from shelflens.llm.licenses import COVERAGE, DRIFT, GRAM, PHRASES, STRETCH, TEMPLATES
from shelflens.llm.url_filters import DAMPING, TOLERANCE

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def url_filters(rules) -> str:
    cases = []
    for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        cases.append((fits, host + path, verdict))
    rule = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in cases)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in cases)

    def walk(name, seeds, source, target):
        return f"""{name}0 AS MATERIALIZED (SELECT host, seed * {1 - DAMPING!r} AS score FROM {seeds}),
{name}w(k, host, score, total, change) AS (
  SELECT 0, host, score, sum(score) OVER (), CAST('infinity' AS DOUBLE) FROM {name}0 WHERE EXISTS (FROM edges)
  UNION ALL
  SELECT k + 1, host, score, sum(score) OVER (), sum(score) OVER () - old FROM (
    SELECT k, host, sum(score) AS score, max(total) AS old FROM (
      SELECT r.k, b.host, b.score, r.total FROM {name}0 b, (SELECT DISTINCT k, total FROM {name}w WHERE change > {TOLERANCE!r}) r UNION ALL
      SELECT s.k, e.{target}, s.score * {DAMPING!r} / e.{name}_degree, s.total FROM {name}w s JOIN edges e ON e.{source} = s.host WHERE s.change > {TOLERANCE!r})
    GROUP BY k, host)),
{name} AS MATERIALIZED (SELECT host, score FROM {name}w WHERE k = (SELECT max(k) FROM {name}w) UNION ALL SELECT * FROM {name}0 WHERE NOT EXISTS (FROM edges))"""

    return f"""WITH RECURSIVE read AS (SELECT page_id, html, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
judged AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS fit FROM read),
links AS (SELECT DISTINCT host AS src, {_LOWER.format("dst")} AS dst FROM (SELECT host, unnest(regexp_extract_all(coalesce(html, ''),
  '(?i)href\\s*=\\s*["'']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\\s>]+)', 1)) AS dst FROM read)),
plain AS (SELECT * FROM links WHERE src <> '' AND dst <> '' AND src <> dst),
edges AS MATERIALIZED (SELECT src, dst, count(*) OVER (PARTITION BY src) AS t_degree, count(*) OVER (PARTITION BY dst) AS d_degree FROM plain),
seeds AS MATERIALIZED (SELECT host, count(*) FILTER (fit = 'allow') AS a, count(*) FILTER (fit = 'block') AS b
  FROM judged WHERE host <> '' AND fit IS NOT NULL GROUP BY host),
good AS (SELECT host, a::DOUBLE / greatest((SELECT sum(a) FROM seeds), 1)::DOUBLE AS seed FROM seeds WHERE a > 0),
bad AS (SELECT host, b::DOUBLE / greatest((SELECT sum(b) FROM seeds), 1)::DOUBLE AS seed FROM seeds WHERE b > 0),
{walk("t", "good", "src", "dst")},
{walk("d", "bad", "dst", "src")}
SELECT page_id, j.host AS host, path, rule, coalesce(fit, CASE WHEN coalesce(d.score, 0) > coalesce(t.score, 0) THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(t.score, 0.0::DOUBLE) AS trust, coalesce(d.score, 0.0::DOUBLE) AS distrust
FROM judged j LEFT JOIN t ON t.host = j.host LEFT JOIN d ON d.host = j.host"""


def licenses() -> str:
    templates = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{label}', string_split('{text}', ' '))" for label, text in PHRASES)
    gram = lambda w, i: " || ' ' || ".join(f"{w}[{i} + {j}]" for j in range(GRAM))
    return f"""WITH docs AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
phrases(label, p) AS (VALUES {phrases}),
places AS (SELECT doc_id, label, unnest(list_filter(range(len(w) - len(p) + 1), lambda i: w[i + 1:i + len(p)] = p)) AS place
  FROM docs, phrases WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' ' || array_to_string(p, ' ') || ' ')),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
templates(template, label, t) AS (SELECT a, b, string_split(c, ' ') FROM (VALUES {templates}) AS v(a, b, c)),
tgrams AS (SELECT template, label, len(t) - {GRAM - 1} AS n, i - 1 AS place, {gram("t", "i")} AS g
  FROM (SELECT *, unnest(range(1, len(t) - {GRAM - 2})) AS i FROM templates)),
grams AS (SELECT doc_id, i - 1 AS p, {gram("w", "i")} AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {GRAM - 2})) AS i FROM docs WHERE len(w) >= {GRAM})),
hits AS (SELECT DISTINCT doc_id, template, label, n, place, p, p - place AS diagonal FROM grams JOIN tgrams USING (g)),
diagonals AS (SELECT DISTINCT doc_id, template, diagonal FROM hits),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {DRIFT} THEN 1 ELSE 0 END AS apart FROM diagonals),
grouped AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS grp FROM marked),
merged AS (SELECT doc_id, template, label, n, grp, count(DISTINCT place) AS hits, min(p) AS a, max(p) AS z
  FROM hits JOIN grouped USING (doc_id, template, diagonal) GROUP BY ALL),
spans AS (SELECT doc_id, label, hits / n AS coverage FROM merged WHERE hits / n >= {COVERAGE} AND z - a + 1 <= {STRETCH} * n + {DRIFT}),
found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(coverage) AS coverage FROM spans GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(coverage, 0.0)::DOUBLE END AS score
FROM docs d LEFT JOIN base b USING (doc_id) LEFT JOIN found f USING (doc_id)"""


def jaccard_join() -> str:
    return f"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * o >= 75 * (p.n + q.n - o)),
ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b.y, r.root FROM reach r JOIN ways b ON b.x = r.doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)"""
