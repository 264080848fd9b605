"""DuckDB SQL for the operators' queries, where SQL can express them at a bearable cost."""

from __future__ import annotations

from marketlake.llm import license_scan as licenses
from marketlake.llm import quality_rules as rules

_quoted = lambda p: "'" + p.replace("'", "''") + "'"
_LINE_WORDS = f"len(regexp_extract_all(x, '{rules.NOT_SPACE}+'))"
_PASSES = " AND ".join(
    [f"greatest(1, {_LINE_WORDS}) <= {rules.WORDS_A_SENTENCE} * len(regexp_extract_all(x, {_quoted(rules.ENDS)}))"]
    + [
        f"NOT (len(regexp_extract_all(x, '{p}')) >= {rules.MARKS} AND {rules.WORDS_A_MARK} * len(regexp_extract_all(x, '{p}')) > {_LINE_WORDS})"
        for p in (rules.SHOUTS, rules.NAVIGATES, rules.SYMBOLIC)
    ]
    + [f"NOT (regexp_matches(x, '{rules.BOILERPLATE}') AND length(x) <= {rules.BOILERPLATE_CHARS})"]
)

OP10 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{rules.NOT_SPACE}+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{rules.NOT_SPACE}')) AS lines
  FROM documents
), grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM d, unnest(range(1, len(w) - 1)) AS u(i)
), twice AS (
  SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM grams JOIN twice USING (r, g) CROSS JOIN (VALUES (0), (1), (2)) AS v(k) GROUP BY r
), base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '{rules.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, list_filter(lines, lambda x: {_PASSES}) AS passed
  FROM d LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, len(passed)::BIGINT AS kept_lines,
         length(regexp_replace(array_to_string(passed, ''), '{rules.SPACE}+', '', 'g'))::BIGINT AS kept_chars
  FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, kept_lines, kept_chars,
       NOT base_failed AND kept_chars >= {rules.MIN_KEPT} * word_chars AS kept
FROM judged
"""

_WORDS = r"regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^$', ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item AS (
  SELECT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(i) WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT k FROM item),
win AS (
  SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM d, sizes, unnest(range(1, len(w) - k + 2)) AS u(i) WHERE len(w) >= k
),
hit AS (SELECT DISTINCT r, i, k, item_id FROM win JOIN (SELECT DISTINCT item_id, k, g FROM item) USING (k, g)),
n AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(0, k)) AS v(j) GROUP BY r),
of AS (SELECT r, list_sort(list_distinct(list(item_id::VARCHAR))) AS items FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(array_to_string(coalesce(items, []::VARCHAR[]), ',')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN of USING (r)
"""

_PHRASES = ", ".join(f"('{phrase}', '{label}', {len(phrase.split())})" for phrase, label in licenses.PHRASES.items())
_GRAMS = ", ".join(f"({number}, '{label}', {size}, {at}, '{' '.join(gram)}')" for number, label, size, at, gram in licenses.template_grams())
_K = licenses.GRAM_WORDS

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
phrase(phrase, label, k) AS (VALUES {_PHRASES}),
place AS (
  SELECT r, i - 1 AS p, phrase, label FROM d, phrase, unnest(range(1, len(w) - k + 2)) AS u(i)
  WHERE len(w) >= k AND contains(array_to_string(w, ' '), phrase) AND array_to_string(w[i : i + k - 1], ' ') = phrase
),
base AS (
  SELECT r, count(*) AS n, min(p) AS first_word, max(p) AS last_word, list_sort(list_distinct(list(label))) AS labels FROM place GROUP BY r
),
gram(template, label, size, a, g) AS (VALUES {_GRAMS}),
spread AS (SELECT r, i - 1 AS p, array_to_string(w[i : i + {_K - 1}], ' ') AS g FROM d, unnest(range(1, len(w) - {_K} + 2)) AS u(i) WHERE len(w) >= {_K}),
hit AS (SELECT r, template, label, size, p, a, p - a AS diagonal FROM spread JOIN gram USING (g)),
apart AS (
  SELECT r, template, diagonal, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licenses.DIAGONAL_GAP}, false)::INT AS new
  FROM (SELECT DISTINCT r, template, diagonal FROM hit)
),
numbered AS (SELECT r, template, diagonal, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS span FROM apart),
extent AS (
  SELECT r, template, label, size, span, max(p) + {_K} - min(p) AS words FROM hit JOIN numbered USING (r, template, diagonal) GROUP BY ALL
),
cover AS (
  SELECT r, template, span, count(DISTINCT a + k) AS covered FROM hit JOIN numbered USING (r, template, diagonal), unnest(range(0, {_K})) AS u(k) GROUP BY ALL
),
verified AS (
  SELECT r, label, covered / size AS share FROM extent JOIN cover USING (r, template, span)
  WHERE 100 * covered >= {licenses.MIN_PERCENT} * greatest(size, words)
),
found AS (SELECT r, list(label) AS labels, max(share) AS share FROM verified GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       array_to_string(coalesce(base.labels, []::VARCHAR[]), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []::VARCHAR[]), coalesce(found.labels, []::VARCHAR[])))), ',') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)
"""

_TERMS = r"list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
size AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
asked AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, {_TERMS} AS w FROM benchmark), unnest(w) AS u(t)),
posting AS (SELECT r, t, count(*)::BIGINT AS tf FROM d, unnest(w) AS u(t) WHERE t IN (SELECT t FROM asked) GROUP BY r, t),
weight AS (
  SELECT t, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posting, total GROUP BY t
),
impact AS (
  SELECT r, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS i
  FROM posting JOIN size USING (r) JOIN weight USING (t), total
),
scored AS (SELECT item_id, r, doc_id, sum(i)::BIGINT AS score FROM impact JOIN asked USING (t) GROUP BY item_id, r, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS k FROM scored WHERE score > 0)
SELECT item_id, k::INT AS rank, doc_id, score FROM ranked WHERE k <= 10
"""

#: crc32 of a decimal number, a bit at a time: each character, then its eight steps.
_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)"""

OP12 = rf"""
WITH turns AS (
  SELECT conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, length(coalesce(text, ''))::BIGINT AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, conv_id - conv_id % 100 AS base, xor({_CRC}, 4294967295::BIGINT) % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS part, place, digest, chars FROM convs c JOIN turns t ON t.conv_id = c.base WHERE place <= h
  UNION ALL SELECT c.conv_id, 1, place, digest, chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE place > h
),
rebuilt AS (SELECT conv_id, digest, chars, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM parts),
member AS (
  SELECT conv_id, depth, chars, md5(string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
),
ended AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM member),
node AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(chars) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends
  FROM ended GROUP BY depth, prefix
),
linked AS (
  SELECT n.*, p.conv_id AS parent FROM node n LEFT JOIN member m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1 LEFT JOIN node p ON p.depth = m.depth AND p.prefix = m.prefix
),
children AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY 1, 2),
full_node AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c USING (conv_id, depth)),
below AS (
  SELECT m.depth, m.prefix, sum((f.n_children = 0)::INT) AS n_leaves, sum(f.saved) AS saved
  FROM full_node f JOIN member m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.depth, m.prefix
)
SELECT f.conv_id::BIGINT AS conv_id, f.depth::BIGINT AS depth, f.parent::BIGINT AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_node f JOIN below b USING (depth, prefix)
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_decontamination": OP8, "op10_quality_rules": OP10, "op11_license_scan": OP11, "op12_prefix_trie": OP12, "op13_lexical_search": OP13}
