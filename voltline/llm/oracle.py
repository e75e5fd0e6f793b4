"""DuckDB SQL of the training-data queries that SQL can express, each a direct
form: all pairs by shared shingle, windows as text, plain counts."""

from __future__ import annotations

from voltline.llm.jaccard import PERCENT, WORDS
from voltline.llm.reputation import MAX_BAD, RHO, RULES, TWO_LABEL_SUFFIXES, Z
from voltline.llm.substring import SPAN

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s:s + {WORDS - 1}], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - {WORDS - 1}, 1))) AS s
        FROM words WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.least AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS least FROM reach GROUP BY a) r ON r.a = d.doc_id
"""

SUBSTRING = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
placed AS (
  SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS pos FROM words),
windows AS (
  SELECT doc_id, s, array_to_string(ws[s:s + {SPAN - 1}], ' ') AS body
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - {SPAN - 1})) AS s
        FROM words WHERE len(ws) >= {SPAN})),
owners AS (SELECT body, min(doc_id) AS owner FROM windows GROUP BY body),
repeated AS (SELECT w.doc_id, w.s FROM windows w JOIN owners o ON w.body = o.body WHERE o.owner < w.doc_id),
judged AS (
  SELECT p.doc_id, p.pos, p.word, coalesce(max(r.s) OVER (
    PARTITION BY p.doc_id ORDER BY p.pos ROWS BETWEEN {SPAN - 1} PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM placed p LEFT JOIN repeated r ON r.doc_id = p.doc_id AND r.s = p.pos),
told AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
         string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
  FROM judged GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(t.n_removed, 0) AS n_removed,
       sha256(coalesce(t.kept, '')) AS kept_sha256
FROM words w LEFT JOIN told t ON t.doc_id = w.doc_id
"""


def _rule_cases(what: str) -> str:
    whens = "\n".join(
        f"    WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{r.name if what == 'name' else r.verdict}'"
        for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE\n{whens}\n    ELSE NULL END"


def _strength(joined: str) -> str:
    """Prior strength from the spread of a level's units (n, bad) around their parents' means m."""
    return f"""(
  SELECT 1 / least(greatest(coalesce((sum(n * pow(bad / n - m, 2)) - sum(m * (1 - m)))
      / nullif(sum(m * (1 - m) * (n - 1)), 0), {RHO[0]}), {RHO[0]}), {RHO[1]}) - 1 AS k
  FROM {joined} WHERE n > 0)"""


REPUTATION = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut),
outcomes AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE toxic IS NOT NULL OR quality IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, count(o.bad) AS n, coalesce(sum(o.bad), 0) AS bad, string_split(host, '.') AS labels
  FROM parsed LEFT JOIN outcomes o ON o.page_id = parsed.page_id GROUP BY host),
hosts AS (
  SELECT host, n, bad, array_to_string(labels[greatest(len(labels) - width + 1, 1):], '.') AS suffix,
         array_to_string(labels[greatest(len(labels) - width, 1):], '.') AS domain
  FROM (SELECT *, CASE WHEN array_to_string(labels[greatest(len(labels) - 1, 1):], '.')
                            IN ({", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)}) THEN 2 ELSE 1 END AS width
        FROM counted)),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
whole AS (
  SELECT coalesce(sum(bad), 0) + 0.5::DOUBLE AS pa, coalesce(sum(n - bad), 0) + 0.5::DOUBLE AS pb FROM suffixes),
suffix_in AS (SELECT s.*, (pa - bad) / (pa + pb - n) AS m FROM suffixes s, whole),
suffix_out AS (
  SELECT suffix, bad + k * m AS pa, n - bad + k * (1 - m) AS pb FROM suffix_in, {_strength("suffix_in")}),
domain_in AS (
  SELECT d.*, (pa - bad) / (pa + pb - n) AS m FROM domains d JOIN suffix_out s ON d.suffix = s.suffix),
domain_out AS (
  SELECT suffix, domain, bad + k * m AS pa, n - bad + k * (1 - m) AS pb FROM domain_in, {_strength("domain_in")}),
host_in AS (
  SELECT h.*, (pa - bad) / (pa + pb - n) AS m
  FROM hosts h JOIN domain_out d ON h.suffix = d.suffix AND h.domain = d.domain),
host_out AS (
  SELECT host, bad + k * m AS a, n - bad + k * (1 - m) AS b FROM host_in, {_strength("host_in")}),
bounds AS (
  SELECT host, a / (a + b) - {Z} * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) AS lower FROM host_out)
SELECT p.page_id, p.host, p.path, {_rule_cases("name")} AS rule,
  coalesce({_rule_cases("verdict")}, CASE WHEN lower > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  round(lower, 6) AS lower
FROM (SELECT parsed.*, bounds.lower FROM parsed JOIN bounds ON parsed.host = bounds.host) p
"""

FILL_IN_MIDDLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
         ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4
  FROM cut),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM formed)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

LINES = f"""
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (
  SELECT row, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM placed),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 3),
judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.keeper AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row
"""

ORACLE_SQL: dict[str, str] = {"op5_jaccard": JACCARD, "op9_substring": SUBSTRING, "op10_reputation": REPUTATION,
                              "op11_fill_in_middle": FILL_IN_MIDDLE, "op13_lines": LINES}
