"""SQL, for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from notepairs.llm import divergence, interaction, mixing, ownership, preference, quality

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


EXACT_DEDUP = rf"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') AS bare FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size,
  row_number() OVER g = 1 AS kept, sha256(bare) AS text_sha256
FROM t WINDOW g AS (PARTITION BY bare ORDER BY n DESC, doc_id)"""

_LINE_PASSES = f"""
  right(rtrim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) IN ({", ".join(map(_quoted, quality.CLOSING))})
  AND NOT (NOT regexp_matches(line, '{quality.LOWER}') AND regexp_matches(line, '[A-ZÀ-ÖØ-Þ]')
    AND len(regexp_extract_all(line, '{WORD}')) >= {quality.SHOUTED_WORDS})
  AND NOT (len(regexp_extract_all(line, '{quality.SYMBOL}')) * 100 >= length(line) * {quality.MAX_SYMBOLS})
  AND NOT regexp_matches(line, '{quality.NAVIGATION}')
  AND NOT ({" OR ".join(f"contains(lower(line), '{phrase}')" for phrase in quality.BOILERPLATE)})"""

_FAILED = f"(n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words)"

QUALITY_RULES = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words FROM t),
pos AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) > 2),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM pos),
hit AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM win WHERE n > 1) GROUP BY r),
l AS (SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
good AS (SELECT r, sum(n - 1)::BIGINT AS dups,
  coalesce(sum(len(regexp_extract_all(line, '{WORD}'))) FILTER ({_LINE_PASSES}), 0) AS surviving FROM l GROUP BY r),
b AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
  len(regexp_extract_all(text, '{quality.SYMBOL}')) AS n_symbols, coalesce(dups, 0) AS n_dup_lines,
  coalesce(hit.n, 0) AS n_repeat_words, coalesce(surviving, 0) AS surviving
  FROM w LEFT JOIN hit USING (r) LEFT JOIN good USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_FAILED} AS base_failed,
  NOT {_FAILED} AND 100 * surviving >= {quality.MIN_SURVIVING} * n_words AS kept
FROM b"""

MIXING = rf"""
WITH d AS (SELECT doc_id, coalesce('=' || source, '') AS part, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
s AS (SELECT part, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY (part = ''), part) - 1 AS rank FROM d GROUP BY part),
w AS (SELECT *, list_extract({list(mixing.WEIGHTS)}, (rank % {len(mixing.WEIGHTS)} + 1)::INT) AS weight,
  list_extract({list(mixing.RISE)}, (rank % {len(mixing.RISE)} + 1)::INT)::DOUBLE AS rise FROM s),
o AS (SELECT *, (sum(source_size) OVER () - {mixing.MAX_EPOCHS} * coalesce(sum(source_size) OVER (g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS rest,
  (sum(weight) OVER (g ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS weights
  FROM w WINDOW g AS (ORDER BY source_size / weight, part)),
lv AS (SELECT *, rest * weight / weights > {mixing.MAX_EPOCHS} * source_size AS capped FROM o),
f AS (SELECT rest, weights FROM lv WHERE NOT capped ORDER BY source_size / weight, part LIMIT 1),
t AS (SELECT lv.*, CASE WHEN capped THEN ({mixing.MAX_EPOCHS} * source_size)::DOUBLE ELSE f.rest * weight / f.weights END AS target FROM lv, f),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rise,
  coalesce(sum(d.size) OVER (PARTITION BY d.part ORDER BY md5(d.doc_id::VARCHAR), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t USING (part)),
e AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE least(floor(target / source_size)
    + (before + size / 2.0::DOUBLE <= target - floor(target / source_size) * source_size)::INT, {mixing.MAX_EPOCHS}) END::BIGINT AS epochs,
  coalesce(least(1.0, before::DOUBLE / nullif(target, 0)), 0.0) AS share FROM p)
SELECT doc_id, size, source_size, target, epochs * size AS taken,
  CASE WHEN rise = 1 THEN share ELSE least(1.0, (sqrt(rise * rise + 4 * (1 - rise) * share) - rise) / (2 * (1 - rise))) END AS position
FROM e"""

_PATTERNS = {
    "assign": ownership.ASSIGN, "access": ownership.ACCESS, "hex": ownership.HEX, "bare": f"{ownership.RUN}{{{ownership.BARE_CHARS},}}",
}
_MATCHES = "\nUNION ALL ".join(
    f"SELECT r, repo, owner, {i} AS kind, unnest(regexp_extract_all(text, {_quoted(p)})) AS m,"
    f" unnest(regexp_extract_all(text, {_quoted(p)}, {2 if k == 'assign' else 0})) AS v, unnest(list_slice(string_split_regex(text, {_quoted(p)}), 1, -2)) AS gap,"
    f" generate_subscripts(regexp_extract_all(text, {_quoted(p)}), 1) AS i FROM t"
    for i, (k, p) in enumerate(_PATTERNS.items())
)

SECRETS = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, concat_ws('/', source, lang, (doc_id // 100)::VARCHAR) AS repo, source AS owner, coalesce(text, '') AS text FROM documents),
m AS ({_MATCHES}),
p AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY i)::BIGINT AS e FROM m),
h AS (SELECT r, owner, repo, kind, e - length(m) AS s, e, v FROM p WHERE (kind > 0 OR length(v) >= {ownership.ASSIGN_CHARS})
  AND (kind < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')))),
n AS (SELECT v, count(DISTINCT coalesce('=' || owner, '')) > {ownership.MAX_OWNERS} OR count(DISTINCT (coalesce('=' || owner, ''), repo)) > {ownership.MAX_REPOSITORIES} AS example, length(v) >= {ownership.BARE_CHARS}
  AND len(regexp_extract_all(v, '[0-9]')) >= {ownership.LIVE_DIGITS} AND len(regexp_extract_all(v, '[A-Za-z]')) >= {ownership.LIVE_LETTERS}
  AND len(list_distinct(string_split(v, ''))) >= {ownership.LIVE_DIFFERENT} AS live FROM h GROUP BY v),
k AS (SELECT h.*, example, live FROM h JOIN n USING (v) WHERE kind < 3 OR (live AND NOT example
  AND NOT EXISTS (SELECT 1 FROM h AS b WHERE b.r = h.r AND b.kind < 3 AND b.s < h.e AND b.e > h.s))),
x AS (SELECT *, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e AS label FROM k)
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(label, ',' ORDER BY s, kind) FILTER (kind < 3), '')) AS base_sha256, coalesce(string_agg(label, ',' ORDER BY s, kind), '') AS spans,
  count(*) FILTER (kind = 3) AS n_owned, count(*) FILTER (kind < 3 AND live AND NOT example) AS n_live, count(*) FILTER (kind < 3 AND example) AS n_examples
FROM t LEFT JOIN x USING (r) GROUP BY r, doc_id"""

PREFERENCE = rf"""
WITH c AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS a,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k FROM conversations),
l AS (SELECT conv_id, max(k) AS last, arg_max(a, k) AS reply FROM c WHERE role = 'assistant' GROUP BY conv_id),
t AS (SELECT c.conv_id AS pair_id, c.role, c.a, c.k, o.reply IS NOT NULL AS paired, CASE WHEN c.k = m.last THEN o.reply ELSE c.a END AS b
  FROM c LEFT JOIN l AS m ON m.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN l AS o ON o.conv_id = xor(c.conv_id, 1) AND m.last IS NOT NULL),
n AS (SELECT pair_id, CASE WHEN bool_and(paired) THEN coalesce(min(k) FILTER (a <> b) - 1, count(*)) ELSE 0 END AS n FROM t GROUP BY pair_id),
p AS (SELECT t.*, n, '{preference.START}' || role || chr(10) AS head, '<|im_end|>' || chr(10) AS tail, (role = 'assistant')::INT || ':' AS flag
  FROM t JOIN n ON t.pair_id IS NOT DISTINCT FROM n.pair_id)
SELECT pair_id, any_value(n) AS prefix_turns, coalesce(string_agg(head || a || tail, '' ORDER BY k) FILTER (k <= n), '') AS prompt,
  coalesce(string_agg(head || a || tail, '' ORDER BY k) FILTER (k > n), '') AS chosen,
  coalesce(string_agg('0:' || length(head) || ',' || flag || length(a || tail), ',' ORDER BY k) FILTER (k > n), '') AS chosen_mask,
  coalesce(string_agg(head || b || tail, '' ORDER BY k) FILTER (k > n AND paired), '') AS rejected,
  coalesce(string_agg('0:' || length(head) || ',' || flag || length(b || tail), ',' ORDER BY k) FILTER (k > n AND paired), '') AS rejected_mask,
  coalesce(bool_or(role = 'assistant') FILTER (k > n AND paired), FALSE) AS usable
FROM p GROUP BY pair_id"""

INTERACTIONS = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, [len(words) < {interaction.MIN_WORDS},
  100 * len(list_distinct(words)) < {interaction.MIN_DISTINCT} * len(words), 100 * len(regexp_extract_all(text, '[A-Z]')) > {interaction.MAX_CAPITALS} * length(text),
  regexp_matches(text, '[{interaction.SYMBOLS}]'), coalesce(min(d.doc_id) OVER (PARTITION BY text) < d.doc_id, FALSE)] AS fails FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails),
a AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [p.i, q.i, r.i, s.i, t.i] AS path FROM a p, a q, a r, a s, a t WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
z AS (SELECT path, a.i AS step, path[a.i] AS own, path[1:a.i - 1] AS before FROM o, a),
m AS (SELECT part, path, step, own, n, good, toxic, fails[own] AS bad, len(list_filter(before, lambda k: fails[k])) > 0 AS gone,
  len(list_filter(fails, lambda b: b)) AS many FROM c, z),
s AS (SELECT part, path, step, own, coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (bad AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (bad AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (bad AND many = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (bad AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (bad AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM m GROUP BY part, path, step, own)
SELECT part, array_to_string(list_transform(path, lambda k: '{interaction.FILTERS}'[k]), '') AS filter_order, step::INT AS step, kept, removed, redundant,
  unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM s"""

_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = "((p - q) * (p - q)) // (p + q)"

DIVERGENCE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '{_TERM}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, total FROM g JOIN k USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) USING (lang, source, term)),
w AS (SELECT *, count(*) OVER s AS v, sum(n) OVER s AS size, sum(total) OVER s AS whole FROM c WINDOW s AS (PARTITION BY lang, source)),
p AS (SELECT lang, source, term, n, (1 + ({divergence.SCALE}::HUGEINT * (n + 2)) // (size + 2 * v))::BIGINT AS p,
  (1 + ({divergence.SCALE}::HUGEINT * (total + 2)) // (whole + 2 * v))::BIGINT AS q FROM w),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ({_GAP})::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}"""

SEARCH = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20"""
