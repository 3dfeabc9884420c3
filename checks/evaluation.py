"""Queries and SQL for scores, text folders and preference data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.corpus import _TOKENS, filled
from checks.stems import stems
from checks.views import view, with_views
from notepairs import constants as C
from notepairs.functions.stemming import stem_table
from notepairs.operators import embedding, preference, scores
from notepairs.operators.concepts import concept_scores
from notepairs.plans import evaluation
from notepairs.session import shared_folder, spread, stage, tune
from notepairs.sources.tables import read_texts
from notepairs.sources.textfiles import export_texts

SHORT = 40
BASELINE = 0.25
MAX_PROMPT = 400
VECTOR_BLOCK = 16  # so that the pairs of the test vectors, tens to hundreds a side, span many tiles


def evals(spark, sf_dir, **options):
    tune(spark)
    return scores.eval_pairs(view(spark, sf_dir, "fx_pairs"), view(spark, sf_dir, "fx_candidates"), **options)


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def eval_pairs(spark, sf_dir):
    return evals(spark, sf_dir)


def eval_restricted(spark, sf_dir):
    return evals(spark, sf_dir, max_tokens=SHORT)


def rouge(n, stemmed):
    return lambda spark, sf_dir: rounded(scores.rouge_n(evals(spark, sf_dir), n, stemmed=stemmed))


def rouge_l(spark, sf_dir):
    return rounded(scores.rouge_l(evals(spark, sf_dir), stemmed=False))


def rouge_l_documents(spark, sf_dir):
    """Longest common subsequences of whole documents: each with the next one of its language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    evals = docs.select(F.col("doc_id").cast("string").alias("pair_id"), F.col("text").alias("reference"), "lang", (F.col("doc_id") + 1).alias("next")).join(
        docs.select(F.col("doc_id").alias("next"), "lang", F.col("text").alias("candidate")), ["next", "lang"]
    )
    return rounded(scores.rouge_l(spread(evals), stemmed=False))


def rouge_stemmed(spark, sf_dir):
    return rounded(scores.rouge(evals(spark, sf_dir)))


def stem_dim(spark, sf_dir):
    texts = evals(spark, sf_dir).select(F.explode(F.array("reference", "candidate")).alias("text"))
    return stem_table(texts.select(F.explode(scores.score_tokens(F.col("text"))).alias("token")))


def vectors(spark, sf_dir):
    return view(tune(spark), sf_dir, "fx_vectors")


def embed_greedy(spark, sf_dir):
    return rounded(embedding.greedy_scores(vectors(spark, sf_dir), block=VECTOR_BLOCK))


def embed_rescaled(spark, sf_dir):
    raw = embedding.greedy_scores(vectors(spark, sf_dir), block=VECTOR_BLOCK)
    return rounded(raw.select("pair_id", *[scores.rescaled(F.col(c), BASELINE).alias(c) for c in ("p", "r", "f1")]))


def evaluated_embeddings(spark, sf_dir):
    """The embedding table that a whole evaluation stores: pairs with an empty candidate are not in it."""
    tune(spark)
    pairs, candidates = view(spark, sf_dir, "fx_pairs"), view(spark, sf_dir, "fx_candidates")
    known = pairs.select("pair_id", F.split("pair_id", "_").alias("n")).select("pair_id", (F.col("n")[0].cast("long") * 8 + F.col("n")[1].cast("long")).alias("at"))
    sided = known.select("pair_id", F.inline(F.array(
        F.struct(F.lit("reference").alias("side"), F.col("at").alias("vec_id")), F.struct(F.lit("candidate").alias("side"), (F.col("at") + 1).alias("vec_id"))
    )))
    vectors = sided.join(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id").select("pair_id", "side", F.col("vec_id").alias("token"), F.col("embedding").alias("vector"))
    path = f"{shared_folder(spark)}/evaluation-{uuid.uuid4().hex}"
    evaluation.evaluate("model", pairs, candidates, path, vectors=vectors)
    return rounded(spark.read.parquet(f"{path}/embedding"))


def metric_means(spark, sf_dir):
    pairs = stage(evals(spark, sf_dir))
    from checks.concepts import concepts

    tables = [
        scores.rouge(pairs, stemmed=False), embedding.greedy_scores(vectors(spark, sf_dir), block=VECTOR_BLOCK),
        concept_scores(pairs, concepts(spark, sf_dir)),
    ]
    return rounded(scores.metric_means("model", *tables))


def scan_responses(spark, sf_dir):
    df = view(tune(spark), sf_dir, "fx_turns").select("pair_id", F.col("summary").alias("text"))
    folder = f"{shared_folder(spark)}/texts-{uuid.uuid4().hex}"
    export_texts(df, folder)
    return read_texts(spark, folder)


def rejected(spark, sf_dir):
    return preference.rejected_summaries(view(tune(spark), sf_dir, "fx_rejected"))


def preference_triples(spark, sf_dir):
    return preference.preference_triples(rejected(spark, sf_dir), view(spark, sf_dir, "fx_doc_pairs"), eos="</s>")


def preference_gate(spark, sf_dir):
    return preference.preference_triples(
        rejected(spark, sf_dir), view(spark, sf_dir, "fx_doc_pairs"), eos="</s>", max_prompt_tokens=MAX_PROMPT
    ).select("pair_id")


QUERIES = {
    "eval_pairs": eval_pairs, "eval_restricted": eval_restricted, "rouge1": rouge(1, False),
    "rouge2": rouge(2, False), "rougeL": rouge_l, "rougeL_documents": rouge_l_documents, "rouge_stemmed": rouge_stemmed, "stem_dim": stem_dim,
    "embed_greedy": embed_greedy, "embed_rescaled": embed_rescaled, "metric_means": metric_means,
    "evaluated_embeddings": evaluated_embeddings,
    "scan_responses": scan_responses, "rejected_summaries": rejected,
    "preference_triples": preference_triples, "preference_gate": preference_gate,
}

_EVALS = """
evals AS (SELECT p.pair_id, p.summary AS reference, c.candidate FROM fx_pairs AS p
  JOIN fx_candidates AS c ON p.pair_id = c.pair_id WHERE p.document <> '')"""
EVALS = f"{with_views('fx_pairs', 'fx_candidates')}, {_EVALS}"
_TOKEN_ROWS = """
words AS (SELECT pair_id, 'r' AS side, unnest(regexp_extract_all(lower(reference), '[a-z0-9]+')) AS w,
    generate_subscripts(regexp_extract_all(lower(reference), '[a-z0-9]+'), 1) AS i FROM evals
  UNION ALL SELECT pair_id, 'c', unnest(regexp_extract_all(lower(candidate), '[a-z0-9]+')),
    generate_subscripts(regexp_extract_all(lower(candidate), '[a-z0-9]+'), 1) FROM evals)"""


def _prf(name: str, both: str = "both_n", ref: str = "ref_n", cand: str = "cand_n", digits: str = "6") -> str:
    p, r = f"{both} / CAST(greatest({cand}, 1) AS DOUBLE)", f"{both} / CAST(greatest({ref}, 1) AS DOUBLE)"
    f1 = f"CASE WHEN {both} = 0 THEN CAST(0 AS DOUBLE) ELSE 2 * ({p}) * ({r}) / (({p}) + ({r})) END"
    wrap = (lambda x: f"round({x}, {digits})") if digits else (lambda x: x)
    return f"{wrap(p)} AS {name}_precision, {wrap(r)} AS {name}_recall, {wrap(f1)} AS {name}_f1"


def _ngrams(n: int) -> str:
    gram = "w" if n == 1 else "w || ' ' || lead(w) OVER (PARTITION BY pair_id, side ORDER BY i)"
    return f"""
g{n} AS (SELECT pair_id, side, gram, count(*) AS k FROM (SELECT pair_id, side, {gram} AS gram FROM words) AS x
  WHERE gram IS NOT NULL GROUP BY ALL),
n{n} AS (SELECT e.pair_id, coalesce((SELECT sum(k) FROM g{n} AS g WHERE g.pair_id = e.pair_id AND side = 'r'), 0) AS ref_n,
  coalesce((SELECT sum(k) FROM g{n} AS g WHERE g.pair_id = e.pair_id AND side = 'c'), 0) AS cand_n,
  coalesce((SELECT sum(least(a.k, b.k)) FROM g{n} AS a JOIN g{n} AS b ON a.pair_id = b.pair_id AND a.gram = b.gram
    AND a.side = 'r' AND b.side = 'c' WHERE a.pair_id = e.pair_id), 0) AS both_n FROM evals AS e)"""


# One step per candidate token: the best length so far is a running maximum over the reference tokens.
_LCS = """
sized AS (SELECT pair_id, count(*) FILTER (WHERE side = 'r') AS ref_n, count(*) FILTER (WHERE side = 'c') AS cand_n FROM words GROUP BY pair_id),
steps AS (
  SELECT r.pair_id, r.i, r.w, 0 AS step, CAST(0 AS BIGINT) AS best FROM words AS r WHERE side = 'r'
  UNION ALL
  SELECT pair_id, i, w, step, max(reach) OVER (PARTITION BY pair_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) FROM (
    SELECT s.pair_id, s.i, s.w, s.step + 1 AS step, greatest(s.best, CASE WHEN s.w = c.w
      THEN coalesce(lag(s.best) OVER (PARTITION BY s.pair_id ORDER BY s.i), 0) + 1 ELSE 0 END) AS reach
    FROM steps AS s JOIN words AS c ON c.pair_id = s.pair_id AND c.side = 'c' AND c.i = s.step + 1) AS moved),
longest AS (SELECT pair_id, max(best) AS both_n FROM steps GROUP BY pair_id),
lcs AS (SELECT e.pair_id, coalesce(both_n, 0) AS both_n, coalesce(ref_n, 0) AS ref_n, coalesce(cand_n, 0) AS cand_n
  FROM evals AS e LEFT JOIN longest AS l ON e.pair_id = l.pair_id LEFT JOIN sized AS z ON e.pair_id = z.pair_id)"""

_GREEDY = f"""{with_views('fx_vectors')},
sims AS (SELECT r.pair_id, r.token AS rt, c.token AS ct, list_cosine_similarity(CAST(r.vector AS DOUBLE[]), CAST(c.vector AS DOUBLE[])) AS s
  FROM fx_vectors AS r JOIN fx_vectors AS c ON r.pair_id = c.pair_id AND r.side = 'reference' AND c.side = 'candidate'),
greedy AS (SELECT pair_id, p, r, 2 * p * r / (p + r) AS f1 FROM (SELECT pair_id, avg(s) AS p FROM (
  SELECT pair_id, ct, max(s) AS s FROM sims GROUP BY ALL) AS a GROUP BY pair_id) AS x JOIN (SELECT pair_id, avg(s) AS r FROM (
  SELECT pair_id, rt, max(s) AS s FROM sims GROUP BY ALL) AS b GROUP BY pair_id) AS y USING (pair_id))"""

_REJECTED = f"""{with_views('fx_rejected', 'fx_doc_pairs')},
rl AS (SELECT pair_id, unnest(string_split(response, chr(10))) AS line, generate_subscripts(string_split(response, chr(10)), 1) AS i FROM fx_rejected),
opened AS (SELECT pair_id, min(i) AS a FROM rl WHERE contains(lower(line), 'hallucinated summary') AND length(line) <= 30 GROUP BY pair_id),
closed AS (SELECT rl.pair_id, min(i) AS b FROM rl JOIN opened AS o ON rl.pair_id = o.pair_id AND i > a
  WHERE contains(lower(line), 'hallucinate') OR contains(lower(line), 'hallucination') GROUP BY rl.pair_id),
rejected AS (SELECT * FROM (SELECT rl.pair_id, trim(string_agg(line, chr(10) ORDER BY i), chr(10)) AS rejected_summary FROM rl
  JOIN opened AS o ON rl.pair_id = o.pair_id AND i > a LEFT JOIN closed AS c ON rl.pair_id = c.pair_id
  WHERE b IS NULL OR i < b GROUP BY rl.pair_id) AS x WHERE rejected_summary <> ''),
triples AS (SELECT r.pair_id, {filled(C.PREFERENCE_TEMPLATE, 'document')} AS prompt, summary || '</s>' AS chosen,
  rejected_summary || '</s>' AS rejected FROM rejected AS r LEFT JOIN fx_doc_pairs AS d ON r.pair_id = d.pair_id)"""

_RECURSIVE = EVALS.replace("WITH", "WITH RECURSIVE", 1)
ROUGE_PARTS = f"{_TOKEN_ROWS}, {_ngrams(1)}, {_ngrams(2)}, {_LCS}"
GREEDY = _GREEDY

_STEMMED = f"""{_TOKEN_ROWS.replace('words AS', 'plain AS', 1)},
tokens AS (SELECT w AS token FROM plain),
{stems('tokens')},
words AS (SELECT pair_id, side, stem AS w, i FROM plain JOIN stems ON plain.w = stems.token)"""

SQL = {
    "evaluated_embeddings": f"""{EVALS}, places AS (SELECT pair_id, CAST(split_part(pair_id, '_', 1) AS BIGINT) * 8 + CAST(split_part(pair_id, '_', 2) AS BIGINT) AS v FROM evals WHERE candidate <> ''),
s AS (SELECT pair_id, list_cosine_similarity(CAST(r.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS s FROM places JOIN embeddings AS r ON r.vec_id = v JOIN embeddings AS c ON c.vec_id = v + 1)
SELECT pair_id, round(s, 6) AS p, round(s, 6) AS r, round(2 * s * s / (s + s), 6) AS f1 FROM s""",
    "stem_dim": f"{EVALS}, {_STEMMED} SELECT token, stem FROM stems",
    "rouge_stemmed": f"""{_RECURSIVE}, {_STEMMED}, {_ngrams(1)}, {_ngrams(2)}, {_LCS}
SELECT n1.pair_id, {_prf('rouge1', 'n1.both_n', 'n1.ref_n', 'n1.cand_n')}, {_prf('rouge2', 'n2.both_n', 'n2.ref_n', 'n2.cand_n')},
{_prf('rougeL', 'lcs.both_n', 'lcs.ref_n', 'lcs.cand_n')} FROM n1 JOIN n2 ON n1.pair_id = n2.pair_id JOIN lcs ON n1.pair_id = lcs.pair_id""",
    "eval_pairs": f"{EVALS} SELECT * FROM evals",
    "eval_restricted": f"""{with_views('fx_pairs', 'fx_candidates')} SELECT p.pair_id, p.summary AS reference, c.candidate FROM fx_pairs AS p
JOIN fx_candidates AS c ON p.pair_id = c.pair_id WHERE p.document <> '' AND {_TOKENS('p.document')} < {SHORT}""",
    "rouge1": f"{EVALS}, {_TOKEN_ROWS}, {_ngrams(1)} SELECT pair_id, {_prf('rouge1')} FROM n1",
    "rouge2": f"{EVALS}, {_TOKEN_ROWS}, {_ngrams(2)} SELECT pair_id, {_prf('rouge2')} FROM n2",
    "rougeL": f"{_RECURSIVE}, {_TOKEN_ROWS}, {_LCS} SELECT pair_id, {_prf('rougeL')} FROM lcs",
    "embed_greedy": f"{_GREEDY} SELECT pair_id, round(p, 6) AS p, round(r, 6) AS r, round(f1, 6) AS f1 FROM greedy",
    "embed_rescaled": f"""{_GREEDY} SELECT pair_id, round((p - {BASELINE}) / (1 - {BASELINE}), 6) AS p,
round((r - {BASELINE}) / (1 - {BASELINE}), 6) AS r, round((f1 - {BASELINE}) / (1 - {BASELINE}), 6) AS f1 FROM greedy""",
    "scan_responses": f"{with_views('fx_turns')} SELECT pair_id, summary AS text FROM fx_turns",
    "rejected_summaries": f"{_REJECTED} SELECT * FROM rejected",
    "preference_triples": f"{_REJECTED} SELECT * FROM triples",
    "preference_gate": f"{_REJECTED} SELECT pair_id FROM triples WHERE {_TOKENS('prompt')} < {MAX_PROMPT}",
}
