"""Queries and SQL for concepts and cloze data."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from checks.corpus import _quoted, filled, folder
from checks.evaluation import GREEDY, ROUGE_PARTS, _prf, evals, rounded
from checks.views import view, with_views
from notepairs import constants as C
from notepairs.functions.answers import answers_of, json_answers, listed_answers, parse_list
from notepairs.operators import cloze
from notepairs.operators import concepts as K
from notepairs.plans import generation
from notepairs.session import stage, tune
from notepairs.sources import sinks
from notepairs.sources.tables import read_concept_names, read_concept_types

LOOSE = 0.5


def concepts(spark, sf_dir):
    return K.concept_table(view(tune(spark), sf_dir, "fx_names"), view(spark, sf_dir, "fx_types"))


def pairs(spark, sf_dir):
    return view(tune(spark), sf_dir, "fx_pairs")


def summaries(spark, sf_dir):
    return pairs(spark, sf_dir).select("pair_id", F.col("summary").alias("text"))


def mentions(spark, sf_dir):
    texts = summaries(spark, sf_dir)
    return K.mention_texts(K.match_exact(texts, concepts(spark, sf_dir)), texts)


def damaged(spark, sf_dir):
    """Mentions whose text was changed where the offset ends in one, as a test of the checks."""
    changed = F.when(F.col("start_at") % 10 == 1, F.upper("source_value")).otherwise(F.col("source_value"))
    return mentions(spark, sf_dir).withColumn("source_value", changed)


def masks(spark, sf_dir, **options):
    return cloze.mask_all(pairs(spark, sf_dir), mentions(spark, sf_dir), **options)


def _responses(df, form):
    """Made-up model answers in six shapes, picked by a digest of the pair."""
    a = answers_of(F.col("answers"))
    numbered = F.array_join(F.transform(a, lambda x, i: F.concat((i + 1).cast("string"), F.lit(': "'), x, F.lit('"'))), ", ")
    missing = F.array_join(F.transform(a, lambda x, i: F.concat((i + 2).cast("string"), F.lit(': "'), x, F.lit('"'))), ", ")
    shape = F.substring(F.md5("pair_id"), 1, 1)
    if form == "list":
        text = F.when(shape < "5", F.array_join(a, " , ")).when(shape < "a", F.concat(F.array_join(a, ","), F.lit(",more, and more"))).otherwise("one")
    else:
        text = (
            F.when(shape < "5", F.concat(F.lit("Sure: {"), numbered, F.lit("} done {}")))
            .when(shape < "8", F.concat(F.lit("{"), numbered, F.lit(', 01: "NOT_FOUND"}')))
            .when(shape < "a", F.concat(F.lit("{"), missing, F.lit("}")))
            .when(shape < "c", F.lit('{1: "at 10:30"}'))
            .when(shape < "e", F.concat(F.lit("no brackets "), numbered))
            .otherwise(F.concat(F.lit("{"), numbered, F.lit(', "1": "again"}')))
        )
    return df.select("pair_id", text.alias("response"))


def concept_dim(spark, sf_dir):
    """Dictionary from pipe-delimited files of names and types, written first."""
    names, types = view(tune(spark), sf_dir, "fx_names"), view(spark, sf_dir, "fx_types")
    filler = lambda n: [F.lit("").alias(f"f{n}_{i}") for i in range(n)]
    sinks.write_pipes(names.select("cui", *filler(10), F.lit("ICD10").alias("source"), *filler(1), F.lit("I0").alias("code"), "name", *filler(3)), a := folder(spark, "names"))
    sinks.write_pipes(types.select("cui", "type_id", *filler(4)), b := folder(spark, "types"))
    table = K.concept_table(read_concept_names(spark, a).select("cui", "name"), read_concept_types(spark, b))
    return table.select("cui", "name", F.array_join("type_ids", ",").alias("type_ids"))


def cui_icd10(spark, sf_dir):
    return K.code_map(view(tune(spark), sf_dir, "fx_codes"))


def concept_match_exact(spark, sf_dir):
    return mentions(spark, sf_dir).select("pair_id", "start_at", "end_at", "source_value", "detected_name", "cui")


def concept_match_anchor(spark, sf_dir):
    texts = summaries(spark, sf_dir)
    found = K.mention_texts(K.match_anchored(texts, concepts(spark, sf_dir)), texts)
    return found.select("pair_id", "start_at", "end_at", "source_value", "detected_name", "cui")


def similar(threshold):
    return lambda spark, sf_dir: K.match_similar(
        summaries(spark, sf_dir), concepts(spark, sf_dir), threshold=threshold
    ).select("pair_id", "start_at", "end_at", "detected_name", F.round("similarity", 6).alias("similarity"))


def concept_sets(spark, sf_dir):
    return K.concept_sets(K.match_exact(summaries(spark, sf_dir), concepts(spark, sf_dir), types=C.SCORE_TYPES))


def concept_prf(spark, sf_dir):
    return rounded(K.concept_scores(evals(spark, sf_dir), concepts(spark, sf_dir)))


def mentions_typed(spark, sf_dir):
    return K.of_types(mentions(spark, sf_dir), C.MASK_TYPES).select("pair_id", "start_at", "end_at", "cui")


def parse_type_ids(spark, sf_dir):
    df = view(tune(spark), sf_dir, "fx_type_texts")
    parsed = parse_list(F.col("type_ids"))
    return df.select("doc_id", F.size(parsed).alias("n"), F.array_join(parsed, "|").alias("parsed"))


def mask_one(spark, sf_dir):
    return cloze.mask_one(pairs(spark, sf_dir), mentions(spark, sf_dir)).select(
        "mention_id", "masked_summary", "answer", "detected_name", F.array_join("type_ids", ",").alias("type_ids")
    )


def mask_all(spark, sf_dir):
    return masks(spark, sf_dir)


def mention_integrity(spark, sf_dir):
    return cloze.broken_mentions(pairs(spark, sf_dir), damaged(spark, sf_dir))


def mask_count_check(spark, sf_dir):
    return cloze.mask_checks(masks(spark, sf_dir, overlaps="raw")).select("pair_id", "masked_summary", "n_masks", "n_answers")


def summary_override(spark, sf_dir):
    given = view(tune(spark), sf_dir, "fx_candidates").select("pair_id", F.col("candidate").alias("text"))
    return cloze.override_summaries(pairs(spark, sf_dir), given)


def _capitals():
    """Stand-in for an extractor: capitalised words, and one mention that does not fit where a text has a digit."""

    def run(texts):
        out = []
        for t in texts:
            found = [(m.start(), m.end(), "C" + hashlib.md5(m.group().encode()).hexdigest()[:7], m.group().lower(), ("T047",)) for m in re.finditer("[A-Z][a-z]+", t)]
            out.append(found + [(len(t), len(t) + 5, "C0", "beyond", ("T999",))] * bool(re.search("[0-9]", t)))
        return out

    return run


def extracted(spark, sf_dir):
    given = view(tune(spark), sf_dir, "fx_candidates").select("pair_id", F.col("candidate").alias("text"))
    return K.extract_mentions(given, _capitals, tasks=8)


def extract_mentions(spark, sf_dir):
    return extracted(spark, sf_dir).select("pair_id", "start_at", "end_at", "cui", "detected_name", F.array_join("type_ids", ",").alias("type_ids"), "source_value", "intact")


def coverage_check(spark, sf_dir):
    """Summaries of pairs with a document against what the extractor found in candidates: each side lacks some of the other."""
    return cloze.coverage(pairs(spark, sf_dir).where("document <> ''"), extracted(spark, sf_dir).where("intact"))


def cloze_prompts(spark, sf_dir):
    return generation.cloze_prompts(masks(spark, sf_dir))


def cloze_train_text(spark, sf_dir):
    return cloze.training_texts(masks(spark, sf_dir), eos="</s>")


def _parsed(spark, sf_dir, form, parse):
    m = stage(masks(spark, sf_dir))
    joined = m.join(_responses(m, form), "pair_id")
    parsed = joined.select("pair_id", parse(F.col("response"), answers_of(F.col("answers"))).alias("a"))
    return parsed.select("pair_id", F.array_join("a", "|").alias("parsed")).filter(F.col("parsed").isNotNull())


def answers_json(spark, sf_dir):
    return _parsed(spark, sf_dir, "json", json_answers)


def answers_csv(spark, sf_dir):
    return _parsed(spark, sf_dir, "list", listed_answers)


def fill(form):
    def run(spark, sf_dir):
        m = stage(masks(spark, sf_dir))
        return cloze.refilled(m, _responses(m, form), form=form).select("pair_id", "text")

    return run


QUERIES = {
    "concept_dim": concept_dim, "cui_icd10": cui_icd10, "concept_match_exact": concept_match_exact, "concept_match_anchor": concept_match_anchor,
    "concept_match_fuzzy": similar(C.MATCH_THRESHOLD), "concept_match_fuzzy_loose": similar(LOOSE),
    "concept_sets": concept_sets, "concept_prf": concept_prf, "mentions_typed": mentions_typed,
    "parse_type_ids": parse_type_ids, "mask_one": mask_one, "mask_all": mask_all,
    "mention_integrity": mention_integrity, "mask_count_check": mask_count_check,
    "summary_override": summary_override, "coverage_check": coverage_check, "extract_mentions": extract_mentions,
    "cloze_prompts": cloze_prompts, "cloze_train_text": cloze_train_text, "answers_json": answers_json, "answers_csv": answers_csv,
    "fill_masks": fill("json"), "fill_masks_list": fill("list"),
}


def _windows(name: str, source: str, longest: int) -> str:
    """CTEs with every run of up to ``longest`` tokens of ``source(id, text)``."""
    lead = [f"lead(lower(tok), {k}) OVER w" for k in range(1, longest)]
    ends = ["e"] + [f"lead(e, {k}) OVER w" for k in range(1, longest)]
    runs = ["lower(tok)"] + [" || ' ' || ".join(["lower(tok)"] + lead[:k]) for k in range(1, longest)]
    return f"""
{name}_a AS (SELECT id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS toks, regexp_split_to_array(text, '[\\p{{L}}\\p{{N}}]+') AS gaps FROM {source}),
{name}_b AS (SELECT id, unnest(toks) AS tok, unnest(gaps[:len(toks)]) AS gap, generate_subscripts(toks, 1) AS i FROM {name}_a),
{name}_c AS (SELECT id, i, tok, CAST(sum(length(gap) + length(tok)) OVER (PARTITION BY id ORDER BY i) AS INTEGER) AS e FROM {name}_b),
{name}_d AS (SELECT id, CAST(e - length(tok) AS INTEGER) AS s, [{', '.join(ends)}] AS es, [{', '.join(runs)}] AS ns FROM {name}_c WINDOW w AS (PARTITION BY id ORDER BY i)),
{name} AS (SELECT * FROM (SELECT id, s AS start_at, unnest(es) AS end_at, unnest(ns) AS norm FROM {name}_d) AS x WHERE norm IS NOT NULL)"""


_DIM = """
dim AS (SELECT n.cui, n.name, list_sort(list(DISTINCT t.type_id)) AS type_ids FROM fx_names AS n JOIN fx_types AS t ON n.cui = t.cui GROUP BY n.cui, n.name)"""
_MENTIONS = f"""{_DIM}, texts AS (SELECT pair_id AS id, summary AS text FROM fx_pairs), {_windows('win', 'texts', 5)},
mentions AS (SELECT w.id AS pair_id, start_at, end_at, substr(text, CAST(start_at AS BIGINT) + 1, CAST(end_at - start_at AS BIGINT)) AS source_value,
  d.name AS detected_name, cui, type_ids FROM win AS w JOIN dim AS d ON w.norm = d.name JOIN texts AS t ON t.id = w.id),
typed AS (SELECT * FROM mentions WHERE list_has_any(type_ids, {list(C.MASK_TYPES)}))"""
_HEAD = with_views("fx_pairs", "fx_names", "fx_types")
_HEAD_R = _HEAD.replace("WITH", "WITH RECURSIVE", 1)


def _near_names(windows: str, threshold: float) -> str:
    """Shared grams per (window, name) of fitting sizes, counted over all grams."""
    g = "list_distinct([substr({0}, j, 3) for j in range(1, greatest(length({0}) - 1, 2))])"
    return f"""
wn AS (SELECT DISTINCT norm FROM {windows}),
wg AS (SELECT norm, len({g.format('norm')}) AS n, unnest({g.format('norm')}) AS gram FROM wn),
dg AS (SELECT name, len({g.format('name')}) AS n, unnest({g.format('name')}) AS gram FROM (SELECT DISTINCT name FROM dim) AS names),
shared AS (SELECT norm, name, wg.n AS a, dg.n AS b, count(*) AS k FROM wg JOIN dg ON wg.gram = dg.gram
  AND dg.n >= wg.n * {threshold} - 1e-9 AND dg.n <= wg.n / {threshold} + 1e-9 GROUP BY ALL),
near AS (SELECT norm, name, k / CAST(a + b - k AS DOUBLE) AS similarity FROM shared WHERE k / CAST(a + b - k AS DOUBLE) >= {threshold} - 1e-12)"""


def _near(threshold: float) -> str:
    return f"""{_HEAD}, {_DIM}, texts AS (SELECT pair_id AS id, summary AS text FROM fx_pairs), {_windows('win', 'texts', 5)}, {_near_names('win', threshold)}
SELECT w.id AS pair_id, start_at, end_at, n.name AS detected_name, round(similarity, 6) AS similarity FROM win AS w JOIN near AS n ON w.norm = n.norm"""


def _concept_counts(evals_cte: str) -> str:
    return f"""{_DIM}, both_texts AS (SELECT ['r', pair_id] AS id, reference AS text FROM {evals_cte} UNION ALL SELECT ['c', pair_id], candidate FROM {evals_cte}),
{_windows('cw', 'both_texts', 5)}, {_near_names('cw', C.MATCH_THRESHOLD)},
cs AS (SELECT DISTINCT id[1] AS side, id[2] AS pair_id, cui FROM cw JOIN near ON cw.norm = near.norm JOIN dim AS d ON near.name = d.name
  WHERE list_has_any(type_ids, {list(C.SCORE_TYPES)})),
cn AS (SELECT e.pair_id, (SELECT count(*) FROM cs WHERE cs.pair_id = e.pair_id AND side = 'r') AS nr,
  (SELECT count(*) FROM cs WHERE cs.pair_id = e.pair_id AND side = 'c') AS nc,
  (SELECT count(*) FROM cs AS a JOIN cs AS b ON a.pair_id = b.pair_id AND a.cui = b.cui AND a.side = 'r' AND b.side = 'c' WHERE a.pair_id = e.pair_id) AS nb FROM {evals_cte} AS e),
concept_prf AS (SELECT pair_id, CASE WHEN nc = 0 THEN CAST(1 AS DOUBLE) ELSE nb / CAST(nc AS DOUBLE) END AS precision,
  CASE WHEN nr = 0 THEN CAST(1 AS DOUBLE) ELSE nb / CAST(nr AS DOUBLE) END AS recall FROM cn)"""


_SPAN_LIST = """
spans AS (SELECT pair_id, list(s ORDER BY s.e - s.s DESC, s.s) AS todo, list(s ORDER BY s.s DESC, s.e DESC) AS ordered FROM (
  SELECT DISTINCT pair_id, {'s': start_at, 'e': end_at, 'v': source_value} AS s FROM typed) AS x GROUP BY pair_id)"""
# Take the best span left, drop what overlaps it, until none is left.
_PICK = f"""{_SPAN_LIST},
pick AS (SELECT pair_id, todo, todo[:0] AS kept FROM spans UNION ALL
  SELECT pair_id, list_filter(todo, lambda x: x.e <= todo[1].s OR x.s >= todo[1].e), list_append(kept, todo[1]) FROM pick WHERE len(todo) > 0),
chosen AS (SELECT pair_id, list_sort(kept) AS kept FROM pick WHERE len(todo) = 0),
gaps AS (SELECT c.pair_id, i, k.s AS s, k.e AS e, k.v AS v, coalesce(lag(k.e) OVER (PARTITION BY c.pair_id ORDER BY i), 0) AS before FROM (
  SELECT pair_id, unnest(kept) AS k, generate_subscripts(kept, 1) AS i FROM chosen) AS c),
masks AS (SELECT p.pair_id, document, string_agg(substr(summary, CAST(before AS BIGINT) + 1, CAST(s - before AS BIGINT)) || 'MASK', '' ORDER BY i)
  || substr(summary, CAST(max(e) AS BIGINT) + 1) AS masked_summary, string_agg(v, ' WORD_SEP ' ORDER BY i) AS answers, list(v ORDER BY i) AS a
  FROM gaps AS g JOIN fx_pairs AS p ON g.pair_id = p.pair_id GROUP BY p.pair_id, document, summary)"""
_RAW = f"""{_SPAN_LIST.replace('SELECT DISTINCT', 'SELECT')},
fold AS (SELECT s.pair_id, ordered AS todo, summary AS text FROM spans AS s JOIN fx_pairs AS p ON s.pair_id = p.pair_id UNION ALL
  SELECT pair_id, todo[2:], substr(text, 1, CAST(todo[1].s AS BIGINT)) || 'MASK' || substr(text, CAST(todo[1].e AS BIGINT) + 1) FROM fold WHERE len(todo) > 0)"""
_MASKS = f"{_HEAD_R}, {_MENTIONS}, {_PICK}"

# What each shape of answer must come to, told from the shape alone.
_JSON = """
shaped AS (SELECT *, substr(md5(pair_id), 1, 1) AS d FROM masks),
parsed_json AS (SELECT pair_id, masked_summary, CASE WHEN len([x for x in a if contains(x, chr(10))]) > 0 THEN NULL WHEN d < '8' THEN a WHEN d < 'e' THEN NULL
  ELSE list_concat(['again'], a[2:]) END AS got FROM shaped)"""
_LIST = """
shaped AS (SELECT *, substr(md5(pair_id), 1, 1) AS d FROM masks),
listed AS (SELECT pair_id, masked_summary, a, [trim(x) for x in string_split(CASE WHEN d < '5' THEN array_to_string(a, ' , ')
  WHEN d < 'a' THEN array_to_string(a, ',') || ',more, and more' ELSE 'one' END, ',')] AS given FROM shaped),
parsed_list AS (SELECT pair_id, masked_summary, list_concat(given, a[len(given) + 1:])[:len(a)] AS got FROM listed)"""


def _refill(source: str) -> str:
    return f"""
pieces AS (SELECT pair_id, unnest(string_split(masked_summary, 'MASK')) AS piece, generate_subscripts(string_split(masked_summary, 'MASK'), 1) AS i, got
  FROM {source} WHERE got IS NOT NULL)
SELECT pair_id, string_agg(piece || coalesce(got[i], ''), '' ORDER BY i) AS text FROM pieces GROUP BY pair_id"""


_EXTRACTED = f"""{with_views('fx_candidates')}, given AS (SELECT pair_id, candidate AS text FROM fx_candidates),
pieces AS (SELECT pair_id, unnest(regexp_extract_all(text, '[A-Z][a-z]+')) AS m, unnest(regexp_split_to_array(text, '[A-Z][a-z]+')[:-2]) AS gap,
  generate_subscripts(regexp_extract_all(text, '[A-Z][a-z]+'), 1) AS i FROM given),
found AS (SELECT pair_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY pair_id ORDER BY i) AS e FROM pieces)"""

SQL = {
    "concept_dim": f"{_HEAD}, {_DIM} SELECT cui, name, array_to_string(type_ids, ',') AS type_ids FROM dim",
    "cui_icd10": f"""{with_views('fx_codes')} SELECT cui, code FROM (SELECT cui, code, row_number() OVER (
PARTITION BY cui ORDER BY line_no DESC, code DESC) AS r FROM fx_codes) AS x WHERE r = 1""",
    "concept_match_exact": f"{_HEAD}, {_MENTIONS} SELECT pair_id, start_at, end_at, source_value, detected_name, cui FROM mentions",
    "concept_match_anchor": f"{_HEAD}, {_MENTIONS} SELECT pair_id, start_at, end_at, source_value, detected_name, cui FROM mentions",
    "concept_match_fuzzy": _near(C.MATCH_THRESHOLD),
    "concept_match_fuzzy_loose": _near(LOOSE),
    "concept_sets": f"""{_HEAD}, {_MENTIONS} SELECT DISTINCT pair_id, cui FROM mentions WHERE list_has_any(type_ids, {list(C.SCORE_TYPES)})""",
    "concept_prf": f"""{with_views('fx_pairs', 'fx_candidates', 'fx_names', 'fx_types')},
evals AS (SELECT p.pair_id, p.summary AS reference, c.candidate FROM fx_pairs AS p JOIN fx_candidates AS c ON p.pair_id = c.pair_id WHERE p.document <> ''),
{_concept_counts('evals')} SELECT pair_id, round(precision, 6) AS precision, round(recall, 6) AS recall FROM concept_prf""",
    "mentions_typed": f"{_HEAD}, {_MENTIONS} SELECT pair_id, start_at, end_at, cui FROM typed",
    "parse_type_ids": f"""{with_views('fx_type_texts')}, p AS (SELECT doc_id, string_split(trim(trim(type_ids, '"'), '[]'), ', ') AS items FROM fx_type_texts)
SELECT doc_id, CAST(len([x for x in items if x <> '']) AS INTEGER) AS n, array_to_string([trim(x, '''') for x in items], '|') AS parsed FROM p""",
    "mask_one": f"""{_HEAD}, {_MENTIONS} SELECT concat_ws('_', t.pair_id, start_at, end_at) AS mention_id,
substr(summary, 1, CAST(start_at AS BIGINT)) || 'MASK' || substr(summary, CAST(end_at AS BIGINT) + 1) AS masked_summary, source_value AS answer, detected_name,
array_to_string(type_ids, ',') AS type_ids FROM typed AS t JOIN fx_pairs AS p ON t.pair_id = p.pair_id""",
    "mask_all": f"{_MASKS} SELECT pair_id, document, masked_summary, answers FROM masks",
    "mention_integrity": f"""{_HEAD}, {_MENTIONS} SELECT pair_id, start_at, end_at, upper(source_value) AS source_value, source_value AS found FROM mentions
WHERE start_at % 10 = 1 AND upper(source_value) <> source_value""",
    "mask_count_check": f"""{_HEAD_R}, {_MENTIONS}, {_RAW} SELECT f.pair_id, text AS masked_summary, CAST(len(string_split(text, 'MASK')) - 1 AS INTEGER) AS n_masks,
CAST(len(ordered) AS INTEGER) AS n_answers FROM fold AS f JOIN spans AS s ON f.pair_id = s.pair_id WHERE len(f.todo) = 0""",
    "summary_override": f"""{with_views('fx_pairs', 'fx_candidates')} SELECT p.pair_id, document, coalesce(candidate, summary) AS summary
FROM fx_pairs AS p LEFT JOIN fx_candidates AS c ON p.pair_id = c.pair_id""",
    "extract_mentions": f"""{_EXTRACTED} SELECT pair_id, CAST(e - length(m) AS INT) AS start_at, CAST(e AS INT) AS end_at, 'C' || substr(md5(m), 1, 7) AS cui, lower(m) AS detected_name,
'T047' AS type_ids, m AS source_value, TRUE AS intact FROM found
UNION ALL SELECT pair_id, CAST(length(text) AS INT), CAST(length(text) + 5 AS INT), 'C0', 'beyond', 'T999', NULL, FALSE FROM given WHERE regexp_matches(text, '[0-9]')""",
    "coverage_check": f"""{_EXTRACTED}, wanted AS (SELECT pair_id FROM fx_turns WHERE document <> '')
SELECT pair_id, 'extraction' AS missing FROM wanted WHERE pair_id NOT IN (SELECT pair_id FROM found)
UNION ALL SELECT DISTINCT pair_id, 'summary' FROM found WHERE pair_id NOT IN (SELECT pair_id FROM wanted)""",
    "cloze_prompts": f"""{_MASKS} SELECT pair_id, '<|system|>' || chr(10) || {_quoted(C.CLOZE_SYSTEM)} || chr(10) || '<|user|>' || chr(10)
|| {filled(C.CLOZE_USER, "len(a)", 'document', 'masked_summary')} || chr(10) AS text FROM masks WHERE len(string_split(masked_summary, 'MASK')) - 1 = len(a)""",
    "cloze_train_text": f"""{_MASKS} SELECT pair_id, {filled(C.CLOZE_TEMPLATE, 'document', 'masked_summary', "array_to_string(a, ', ')")} || '</s>' AS text FROM masks""",
    "answers_json": f"{_MASKS}, {_JSON} SELECT pair_id, array_to_string(got, '|') AS parsed FROM parsed_json WHERE got IS NOT NULL",
    "answers_csv": f"{_MASKS}, {_LIST} SELECT pair_id, array_to_string(got, '|') AS parsed FROM parsed_list",
    "fill_masks": f"{_MASKS}, {_JSON}, {_refill('parsed_json')}",
    "fill_masks_list": f"{_MASKS}, {_LIST}, {_refill('parsed_list')}",
    "metric_means": f"""{with_views('fx_pairs', 'fx_candidates', 'fx_names', 'fx_types', 'fx_vectors').replace('WITH', 'WITH RECURSIVE', 1)},
evals AS (SELECT p.pair_id, p.summary AS reference, c.candidate FROM fx_pairs AS p JOIN fx_candidates AS c ON p.pair_id = c.pair_id WHERE p.document <> ''),
{ROUGE_PARTS}, {_concept_counts('evals')}, {GREEDY[GREEDY.index('sims AS'):]},
m AS (UNPIVOT (SELECT avg(rouge1_precision) AS rouge1_precision, avg(rouge1_recall) AS rouge1_recall, avg(rouge1_f1) AS rouge1_f1 FROM (SELECT {_prf('rouge1', digits='')} FROM n1) AS x) ON COLUMNS(*) INTO NAME metric VALUE mean
UNION ALL UNPIVOT (SELECT avg(rouge2_precision) AS rouge2_precision, avg(rouge2_recall) AS rouge2_recall, avg(rouge2_f1) AS rouge2_f1 FROM (SELECT {_prf('rouge2', digits='')} FROM n2) AS x) ON COLUMNS(*) INTO NAME metric VALUE mean
UNION ALL UNPIVOT (SELECT avg(rougeL_precision) AS rougeL_precision, avg(rougeL_recall) AS rougeL_recall, avg(rougeL_f1) AS rougeL_f1 FROM (SELECT {_prf('rougeL', digits='')} FROM lcs) AS x) ON COLUMNS(*) INTO NAME metric VALUE mean
UNION ALL UNPIVOT (SELECT avg(p) AS p, avg(r) AS r, avg(f1) AS f1 FROM greedy) ON COLUMNS(*) INTO NAME metric VALUE mean
UNION ALL UNPIVOT (SELECT avg(precision) AS precision, avg(recall) AS recall FROM concept_prf) ON COLUMNS(*) INTO NAME metric VALUE mean)
SELECT 'model' AS model, metric, round(mean, 6) AS mean FROM m""",
}
