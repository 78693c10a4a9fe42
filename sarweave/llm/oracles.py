"""DuckDB SQL that gives the same rows as the queries of the same names."""

from __future__ import annotations

from sarweave.llm import licenses, quality_rules

_WORDS = "[^\\x20\\x09-\\x0D]+"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _gone(chars: str) -> str:
    return f"length(t) - length(regexp_replace(t, '[{chars}]', '', 'g'))"


def _quality_rules() -> str:
    stops = ", ".join(sorted({_quoted(w) for ws in quality_rules.STOP_WORDS for w in ws.split()}))
    tests = ", ".join(f"CASE WHEN {quality_rules._broken(r)} THEN '{r.name}' END" for r in quality_rules.RULES)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '{_WORDS}') AS ws FROM d),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c FROM u WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g WHERE c IS NOT NULL) WHERE n >= 2),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS ls FROM d),
m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    ({_gone('#*$%&|<>')})::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines,
    ({_gone('!')})::BIGINT AS n_exclamations,
    len(list_filter(regexp_split_to_array(lower(t), '[^\\p{{L}}]+'), lambda x: x IN ({stops})))::BIGINT AS n_stop_words,
    ({_gone(chr(92) + 'p{Lu}')})::BIGINT AS n_upper,
    ({_gone(chr(92) + 'p{L}')})::BIGINT AS n_letters
  FROM d JOIN w USING (doc_id) JOIN l USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, list_filter([{tests}], lambda x: x IS NOT NULL) AS failed, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(failed) = 0 AS kept, coalesce(array_to_string(failed, ','), '') AS failed_rules
FROM f"""


def _licenses() -> str:
    def norm(t: str) -> str:
        pattern = licenses.COPYRIGHT_LINE
        out = f"lower(regexp_replace({t}, {_quoted(pattern)}, ' ', 'g'))"
        out = f"regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')"
        for plain, others in licenses.SPELLINGS.items():
            for p in others:
                out = f"regexp_replace({out}, '\\b{p}\\b', '{plain}', 'g')"
        return f"trim({out})"

    known = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, ts in licenses.KNOWN.items() for t in ts)
    ok = ", ".join(_quoted(x) for x in licenses.PERMISSIVE)
    return f"""
WITH k AS (SELECT DISTINCT license, sha256({norm('known')}) AS digest FROM (VALUES {known}) AS v(license, known)),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT d.doc_id, string_agg(license, ',' ORDER BY license) AS license FROM d JOIN k ON k.digest = sha256({norm('t')}) GROUP BY d.doc_id),
l AS (SELECT DISTINCT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
f AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, bool_and(license IN ({ok})) AS fine FROM l JOIN k ON k.digest = sha256({norm('line')}) GROUP BY doc_id),
x AS (SELECT doc_id, bool_and(n IN ({ok})) AS fine FROM (SELECT doc_id, unnest(string_split(license, ',')) AS n FROM w) GROUP BY doc_id)
SELECT d.doc_id, w.license, coalesce(f.line_licenses, '') AS line_licenses,
  CASE WHEN x.fine IS NULL THEN f.fine WHEN f.fine IS NULL THEN x.fine ELSE x.fine AND f.fine END AS permissive
FROM d LEFT JOIN w USING (doc_id) LEFT JOIN f USING (doc_id) LEFT JOIN x USING (doc_id)"""


SUBSTRING_DEDUP = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)),
f AS (SELECT h, min(doc_id) AS first FROM p GROUP BY h HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT doc_id, i FROM p JOIN f USING (h) WHERE first < doc_id),
c AS (SELECT DISTINCT doc_id, i + k AS i FROM g, (SELECT unnest(range(50)) AS k)),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
k AS (SELECT w.doc_id, count(*) AS n_words, count(c.i) AS n_removed, string_agg(CASE WHEN c.i IS NULL THEN word END, ' ' ORDER BY w.i) AS kept FROM w LEFT JOIN c ON c.doc_id = w.doc_id AND c.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)"""

SUFFIX_DEDUP = r"""WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
p AS (SELECT doc_id, i, md5(t[i:i + 199]) AS h FROM (SELECT doc_id, t, unnest(range(1, octet_length(t) - 198)) AS i FROM d)),
g AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM p) WHERE n > 1),
b AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM g),
m AS (SELECT doc_id, i, sum((before IS NULL OR i > before + 200)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + 199 AS z FROM m GROUP BY doc_id, run),
k AS (SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z FROM r GROUP BY doc_id)
SELECT d.doc_id, octet_length(t)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(CASE WHEN k.a IS NULL THEN t ELSE list_reduce(list_transform(range(1, len(k.a) + 2), lambda j: t[CASE WHEN j = 1 THEN 1 ELSE k.z[j - 1] + 1 END:CASE WHEN j > len(k.a) THEN octet_length(t) ELSE k.a[j] - 1 END]), lambda x, y: x || y) END) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)"""

NEAR_DUPLICATES = r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, md5_number(array_to_string(ws[i:i + 4], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 85 * (x.n + y.n - both_)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS seed FROM documents UNION SELECT e.b, r.seed FROM r JOIN e ON e.a = r.doc_id WHERE r.seed < e.b),
c AS (SELECT doc_id, min(seed) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)"""

ORACLES = {"op1_substring_dedup": SUBSTRING_DEDUP, "op2_suffix_dedup": SUFFIX_DEDUP, "op8_minhash": NEAR_DUPLICATES, "op4_quality_rules": _quality_rules(), "op5_license_scan": _licenses()}
