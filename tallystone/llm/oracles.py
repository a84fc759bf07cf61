"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

import math

from tallystone.llm import rules

_TESTS = len(rules.RULES) * len(rules.GRID) * (len(rules.STRATA) + 1)
_P = rules.RISK / len(rules.RULES)
_IN = ", ".join(f"'{s}'" for s in rules.STRATA)
_SHARES = {"symbols": "n_symbols / word_chars", "dup_lines": "n_dup_lines / n_lines",
           "repeats": "n_repeat_words / n_words", "shouted": "n_shouted / n_words"}
_RULES = " UNION ALL ".join(
    f"SELECT doc_id, stratum, good, '{r}' AS rule, coalesce({_SHARES[r]}, 0.0) AS share FROM held" for r in rules.RULES)
_CUTS = ", ".join(f"({c}::DOUBLE)" for c in rules.GRID)
_OVER = " AND ".join(
    f"NOT coalesce({_SHARES[r]} > (SELECT b.cut FROM best b WHERE b.stratum = m.stratum AND b.rule = '{r}'), false)"
    for r in rules.RULES)

#: Documents are numbered, so repeated rows stay apart.
OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                  CASE WHEN lang IN ({_IN}) THEN lang ELSE 'other' END AS stratum FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS s
            FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1),
cover AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
          FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
c AS (SELECT w.r, doc_id, stratum, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
             coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(w, lambda x: x LIKE '%!!'))::BIGINT AS n_shouted
      FROM w LEFT JOIN cover ON cover.r = w.r),
m AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
good AS (SELECT doc_id, max(quality) >= 1 AS good FROM labels
         WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT m.*, good FROM m JOIN good USING (doc_id) WHERE NOT base_failed),
long AS ({_RULES}),
per AS (SELECT stratum, rule, cut, count(*) FILTER (WHERE good) AS n,
               count(*) FILTER (WHERE good AND share > cut) AS k,
               count(*) FILTER (WHERE NOT good AND share > cut) AS bad
        FROM long, (VALUES {_CUTS}) g(cut) GROUP BY stratum, rule, cut),
tail AS (SELECT *, CASE WHEN k >= n * {_P!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
            exp(lgamma(n + 1) - CASE WHEN j = 0 THEN 0 ELSE lgamma(j + 1) END - lgamma(n - j + 1)
                + j * ({math.log(_P)!r}) + (n - j) * ({math.log1p(-_P)!r})))) END AS p
         FROM per WHERE bad > 0),
best AS (SELECT stratum, rule, arg_max(cut, {{'bad': bad, 'cut': cut}}) AS cut
         FROM tail WHERE p <= {rules.DELTA / _TESTS!r} GROUP BY stratum, rule)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_OVER} AS kept
FROM m
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Every phrase is counted apart here; the query sums up prefixes of the longest windows.
OP11 = rf"""
WITH pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p
                FROM (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents)),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
starts AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) o(k) WHERE len(w) >= k),
f AS (SELECT lang, k, w[i:i + k - 1] AS w, count(*)::HUGEINT AS f FROM starts GROUP BY ALL),
c AS (SELECT lang, k, w, f AS a FROM f WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, k, w, a, unnest(range(1, k)) AS cut FROM c),
scored AS (SELECT cuts.*, x.f AS l, y.f AS r, 2000000 * a // (x.f + y.f) AS score FROM cuts
           JOIN f x ON x.lang = cuts.lang AND x.w = cuts.w[:cut] JOIN f y ON y.lang = cuts.lang AND y.w = cuts.w[cut + 1:]),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, w, a, k, size, unnest(range(1, k - size + 2)) AS i FROM c, (VALUES (2), (3)) s(size) WHERE size < k),
longer AS (SELECT lang, w[i:i + size - 1] AS w, max(a) AS longer FROM inner_ GROUP BY ALL),
kept AS (SELECT low.*, array_to_string(low.w, ' ') AS phrase FROM low
         LEFT JOIN longer ON longer.lang = low.lang AND longer.w = low.w WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = rf"""
WITH d AS (SELECT * FROM (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
size AS (SELECT count(*) AS nn, sum(len(t)) AS ll FROM d),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM d) GROUP BY ALL),
items AS (SELECT row_number() OVER () AS q, * FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT DISTINCT q, item_id, unnest({_TERMS}) AS term FROM items),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
weight AS (SELECT q, item_id, term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
           FROM asked JOIN df USING (term), size),
m AS (SELECT d, doc_id, 100 - 50 + ((50 * len(t) * nn) // ll) AS m FROM d, size),
scores AS (SELECT q, item_id, doc_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM weight JOIN tf USING (term) JOIN m USING (d) GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
