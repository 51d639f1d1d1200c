"""DuckDB SQL for the queries that SQL can express, from the operators' own constants."""

from __future__ import annotations

from keylane.llm import filter_audit, licenses, line_dedup, quality, secret_scans, vector_codes
from keylane.llm.shared import WORD

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES = """lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def line_dedup_sql() -> str:
    return f"""
WITH {LINES},
keyed AS (SELECT *, translate(trim(line, {BLANK}), '{UPPER}', '{LOWER}') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {line_dedup.LEAST_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.LEAST_DOCUMENTS}),
marked AS (SELECT k.*, coalesce(c.keeper <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN common c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


def quality_sql(rules: quality.Rules = quality.Rules()) -> str:
    def covered(n: int) -> str:
        gram = " || ' ' || ".join(["w", *[f"lead(w, {i}) OVER p" for i in range(1, n)]])
        return f"""
g{n} AS (SELECT doc_id, i, {gram} AS g FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
r{n} AS (SELECT DISTINCT doc_id, i + k AS i FROM (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g{n} WHERE g IS NOT NULL), range({n}) t(k) WHERE c > 1),
s{n} AS (SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM words JOIN r{n} USING (doc_id, i) GROUP BY doc_id)"""

    lengths = (3, *rules.covered)
    passes = " AND ".join([f"dup_line_chars <= CAST({rules.dup_lines} AS DOUBLE) * word_chars",
                           *[f"dup_{n}gram_chars <= CAST({most} AS DOUBLE) * word_chars" for n, most in rules.covered.items()]])
    return f"""
WITH words AS (
  SELECT doc_id, unnest(l) AS w, unnest(range(len(l))) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS l FROM documents)),
{LINES},
copies AS (
  SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS chars FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS copy FROM lines WHERE regexp_matches(line, '{WORD}'))
  WHERE copy > 1 GROUP BY doc_id),
{",".join(covered(n) for n in lengths)},
totals AS (SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM words GROUP BY doc_id),
measured AS (
  SELECT d.doc_id, coalesce(t.n, 0) AS n_words, CAST(coalesce(t.chars, 0) AS BIGINT) AS word_chars,
    length(regexp_replace(coalesce(d.text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(c.n, 0) AS n_dup_lines,
    coalesce(s3.n, 0) AS n_repeat_words, CAST(coalesce(c.chars, 0) AS BIGINT) AS dup_line_chars,
    {", ".join(f"CAST(coalesce(s{n}.chars, 0) AS BIGINT) AS dup_{n}gram_chars" for n in rules.covered)}
  FROM documents d LEFT JOIN totals t USING (doc_id) LEFT JOIN copies c USING (doc_id)
    {" ".join(f"LEFT JOIN s{n} USING (doc_id)" for n in lengths)}),
judged AS (
  SELECT *, n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed FROM measured)
SELECT *, NOT base_failed AND {passes} AS kept FROM judged"""


def license_sql() -> str:
    def shingles(text: str) -> str:
        found = f"regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}]+')"
        return f"""(SELECT list_distinct([array_to_string(l[i:i + {licenses.SHINGLE - 1}], ' ')
      FOR i IN range(1, len(l) - {licenses.SHINGLE - 2})]) FROM (SELECT {found} AS l))"""

    listed = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in licenses.TEMPLATES.items())
    return f"""
WITH templates AS (SELECT license, {shingles("body")} AS t FROM (VALUES {listed}) v(license, body)),
held AS (SELECT doc_id, {shingles("text")} AS s FROM documents),
met AS (SELECT doc_id, license, len(list_intersect(t, s)) AS shingles, len(t) AS most FROM held, templates)
SELECT doc_id, license, CAST(shingles AS DOUBLE) / most AS containment, shingles FROM met
WHERE CAST(shingles AS DOUBLE) / most >= {licenses.CONTAINMENT}"""


def secret_sql() -> str:
    def spans(rank: int, rule: secret_scans.Rule) -> str:
        pattern = quoted(rule.pattern)
        return f"""
  SELECT doc_id, {rank} AS rank, {quoted(rule.kind)} AS kind, start, start + long AS stop FROM (
    SELECT doc_id, long, good, sum(gap + long) OVER (PARTITION BY doc_id ORDER BY i) - long AS start FROM (
      SELECT doc_id, i, length(g[i + 1]) AS gap, length(m[i + 1]) AS long, length(v[i + 1]) >= {rule.least} AS good FROM (
        SELECT doc_id, string_split_regex(text, {pattern}) AS g, regexp_extract_all(text, {pattern}, 0) AS m,
          regexp_extract_all(text, {pattern}, {rule.group}) AS v, unnest(range(len(regexp_extract_all(text, {pattern}, 0)))) AS i
        FROM documents WHERE text IS NOT NULL))) WHERE good"""

    base = len(secret_scans.BASE_KINDS)
    one = "concat(kind, ':', CAST(start AS BIGINT), ':', CAST(stop AS BIGINT))"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in secret_scans.BASE_KINDS)
    return f"""
WITH spans AS ({" UNION ALL ".join(spans(n, r) for n, r in enumerate(secret_scans.RULES))})
SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({one}, ',' ORDER BY start, rank) FILTER (WHERE rank < {base}), '')) AS base_sha256,
  coalesce(string_agg({one}, ',' ORDER BY start, rank) FILTER (WHERE rank IS NOT NULL), '') AS spans
FROM documents d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""


SQL = {
    "op3_line_dedup": line_dedup_sql(),
    "op4_quality_rules": quality_sql(),
    "op6_license_scan": license_sql(),
    "op7_secret_scan": secret_sql(),
    "op12_filter_audit": filter_audit.SQL,
    "op13_vector_codes": vector_codes.sql(),
}
