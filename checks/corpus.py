"""Queries and SQL for notes, outcomes, pairs, splits and prompts."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import functions as F

from checks.views import view, with_views
from notepairs import constants as C
from notepairs.functions import prompts as P
from notepairs.functions.sections import strip_signature, with_headings
from notepairs.functions.text import clean_text, count_tokens, settle
from notepairs.operators import pairs as N
from notepairs.operators import splits as S
from notepairs.operators.inference import batch_infer, resume_inference, run_records, stored_inference
from notepairs.session import shared_folder, stage, tune
from notepairs.sources import csvfiles, sinks
from notepairs.sources.tables import NOTES, missing_tables, read_csv

MAX_TOKENS = 600
SEED = "7"


def _start(name):
    """Tuned view of one test folder."""
    return lambda spark, sf_dir: view(tune(spark), sf_dir, name)


notes, admissions = _start("fx_notes"), _start("fx_admissions")


def closing(spark, sf_dir):
    return N.discharge_notes(notes(spark, sf_dir))


def graded(spark, sf_dir):
    return N.outcomes(closing(spark, sf_dir))


def admitted(spark, sf_dir):
    return N.admission_notes(notes(spark, sf_dir), admissions(spark, sf_dir))


def prior(spark, sf_dir):
    closed = N.admission_notes(closing(spark, sf_dir), admissions(spark, sf_dir))
    return N.prior_notes(closed, N.other_notes(notes(spark, sf_dir)))


def pairs(spark, sf_dir):
    closed = N.admission_notes(closing(spark, sf_dir), admissions(spark, sf_dir))
    return N.build_pairs(stage(N.outcomes(closed)), notes(spark, sf_dir))


def folder(spark, name):
    """A new folder among those that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Queries


def scan_notes(spark, sf_dir):
    """Notes stored as CSV, read again and counted."""
    sinks.write_csv(notes(spark, sf_dir), path := folder(spark, "csv"))
    return read_csv(spark, path, NOTES).groupBy("category").agg(
        F.count("*").alias("n"), F.count("charttime").alias("n_timed"), F.count("hadm_id").alias("n_admitted"),
        F.sum(F.length("text")).alias("n_chars"),
    )


def missing_sources(spark, sf_dir):
    return missing_tables(view(tune(spark), sf_dir, "fx_files"))


def patient_layout(spark, sf_dir):
    n = notes(spark, sf_dir)
    tables = {
        "patients": n.select("subject_id").distinct(), "admissions": admissions(spark, sf_dir), "noteevents": n,
    }
    root = folder(spark, "subjects")
    for name, df in tables.items():
        sinks.write_by_subject(df, f"{root}/{name}")
    counts = [
        spark.read.parquet(f"{root}/{name}").groupBy("subject_id").agg(F.count("*").alias("n")).withColumn("table_name", F.lit(name))
        for name in tables
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def discharge_notes(spark, sf_dir):
    return closing(spark, sf_dir).select("pair_id", "row_id", F.length("text").alias("n_chars"))


def anchor_time(spark, sf_dir):
    return closing(spark, sf_dir).select("pair_id", F.date_format("anchor", "yyyy-MM-dd HH:mm:ss").alias("anchor"))


def clean_notes(spark, sf_dir):
    return notes(spark, sf_dir).select("row_id", clean_text(F.col("text")).alias("cleaned"))


def note_blocks(spark, sf_dir):
    return N.with_blocks(N.other_notes(notes(spark, sf_dir))).select("row_id", "block")


def admission_notes(spark, sf_dir):
    return admitted(spark, sf_dir).select("subject_id", "hadm_id", "row_id")


def prior_notes(spark, sf_dir):
    return prior(spark, sf_dir).select("pair_id", "row_id", "time")


def documents_by_admission(spark, sf_dir):
    closed = N.admission_notes(closing(spark, sf_dir), admissions(spark, sf_dir))
    blocks = N.with_blocks(N.other_notes(notes(spark, sf_dir)))
    return N.documents(N.prior_notes(closed, blocks)).select("pair_id", "document")


def note_positions(spark, sf_dir):
    return N.note_positions(prior(spark, sf_dir)).select("pair_id", "row_id", "position")


def strip_signatures(spark, sf_dir):
    return closing(spark, sf_dir).select(
        "pair_id", F.coalesce(strip_signature(F.col("text")), F.lit("")).alias("stripped")
    )


def heading_hits(spark, sf_dir):
    found = with_headings(closing(spark, sf_dir).select("pair_id", "text"))
    return found.select(
        "pair_id", F.size("_hits").alias("n_hits"), F.coalesce("_heading", F.lit("")).alias("first_heading"),
        F.coalesce(F.try_element_at("_heads", F.col("_next") + 1), F.lit("")).alias("next_heading"),
    )


def unknown_heads(spark, sf_dir):
    found = with_headings(closing(spark, sf_dir).select("pair_id", "text"))
    flags = settle(found.select("pair_id", F.col("_unknown").cast("int").alias("unknown")), "unknown")
    return flags.filter(F.col("unknown").isNotNull())


def outcome_codes(spark, sf_dir):
    return graded(spark, sf_dir).select("pair_id", "code")


def sections(spark, sf_dir):
    return graded(spark, sf_dir).filter(F.col("summary").isNotNull()).select(
        "pair_id", "heading", "summary", "summary_words"
    )


def outcome_counts(spark, sf_dir):
    return N.outcome_counts(graded(spark, sf_dir))


def pairs_all(spark, sf_dir):
    """All stored pairs, of all codes and headings."""
    made = pairs(spark, sf_dir)
    sinks.write_pairs(made, path := folder(spark, "pairs"))
    return sinks.read_pairs(spark, path).select(*[F.col(c).cast(t).alias(c) for c, t in made.dtypes])


def outcome_ids(spark, sf_dir):
    closed = N.admission_notes(closing(spark, sf_dir), admissions(spark, sf_dir))
    table = stage(N.outcomes(closed))
    words = N.build_pairs(table, notes(spark, sf_dir)).select("pair_id", "document_words", "summary_words")
    listed = table.select("pair_id", "code").join(words, "pair_id", "left")
    made = listed.na.fill(0, ["document_words", "summary_words"])
    sinks.write_outcomes(made, path := folder(spark, "outcomes"))
    return sinks.read_outcomes(spark, path).select(*[F.col(c).cast(t).alias(c) for c, t in made.dtypes])


def pairs_by_code_heading(spark, sf_dir):
    made = graded(spark, sf_dir).filter(F.col("summary").isNotNull()).select(
        "pair_id", "code", N.heading_index(F.col("heading")).alias("heading_idx"), "summary"
    )
    sinks.write_pairs(made, path := folder(spark, "pairs"))
    return sinks.read_pairs(spark, path).groupBy("code", "heading_idx").agg(F.count("*").alias("n"))


def doc_stats(spark, sf_dir):
    return N.doc_stats(pairs(spark, sf_dir))


def scan_large_csv(spark, sf_dir):
    """Notes from a CSV delivery whose files may be cut anywhere, inside texts too."""
    sinks.write_csv(notes(spark, sf_dir), path := folder(spark, "large"))
    return csvfiles.read_large_csv(spark, path, NOTES)[0].select("row_id", "subject_id", "hadm_id", "chartdate", "charttime", "category", "text")


def scan_bad_rows(spark, sf_dir):
    """Rows set aside by reason: every seventh document lacks a field, has no number as its id, or has no text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    k, quoted = F.pmod("doc_id", F.lit(7)), F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    number = F.concat(F.when(k == 2, F.lit("no. ")).otherwise(F.lit("")), F.col("doc_id").cast("string"))
    record = F.when(k == 1, F.concat(number, F.lit(","), quoted)).otherwise(F.concat_ws(",", number, F.when(k == 3, F.lit("")).otherwise(quoted), "lang"))
    docs.select(record.alias("value")).write.text(path := folder(tune(spark), "bad"))
    good, bad = csvfiles.read_large_csv(spark, path, "id long, text string, lang string", required=("text",), names=("id", "text", "lang"))
    return csvfiles.bad_counts(bad).unionByName(good.agg(F.lit("none").alias("reason"), F.count("*").alias("n")))


def merged_lengths(spark, sf_dir):
    """Lengths from the stored sketches of three runs, each over some of the subjects."""
    store, made = folder(spark, "lengths"), stage(pairs(spark, sf_dir))
    for run in range(3):
        N.length_sketches(made.where(F.pmod(F.crc32("pair_id"), F.lit(3)) == run)).write.mode("append").parquet(store)
    return N.length_stats(N.merge_lengths(spark.read.parquet(store)))


def bucketed_notes(spark, sf_dir):
    """Closing notes with the earlier notes of their admission, joined in place from bucketed tables."""
    names = tuple(f"{kind}_{uuid.uuid4().hex}" for kind in ("notes", "admissions"))
    stored, on_record = sinks.write_bucketed_records(notes(spark, sf_dir), admissions(spark, sf_dir), names, 8, folder=shared_folder(spark))
    closed = N.admission_notes(N.discharge_notes(stored), on_record)
    return N.prior_notes(closed, N.other_notes(stored)).select("pair_id", "row_id", "time")


def length_gate(spark, sf_dir):
    return S.length_gate(view(tune(spark), sf_dir, "fx_doc_pairs"), MAX_TOKENS).select("pair_id")


def _splits(spark, sf_dir):
    return S.split_pairs(view(tune(spark), sf_dir, "fx_doc_pairs"), MAX_TOKENS, seed=SEED)


def split_sets(spark, sf_dir):
    return _splits(spark, sf_dir).select("pair_id", "split", "document", "summary")


def split_reused(spark, sf_dir):
    """Splits stored by one call and taken from there by the next, which has no pairs of its own."""
    df, path = view(tune(spark), sf_dir, "fx_doc_pairs"), folder(spark, "splits")
    sinks.load_or_split(df, path, C.SUMMARY_TEMPLATE, MAX_TOKENS, seed=SEED)
    return sinks.load_or_split(df.limit(0), path, C.SUMMARY_TEMPLATE, MAX_TOKENS, seed=SEED).select("pair_id", "split")


def split_counts(spark, sf_dir):
    return _splits(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


def split_manifest(spark, sf_dir):
    return S.split_manifest(
        _splits(spark, sf_dir), C.SUMMARY_TEMPLATE, seed=SEED, ratio=(0.9, 0.1), max_tokens=MAX_TOKENS
    )


def render_prompts(spark, sf_dir):
    df = view(tune(spark), sf_dir, "fx_pairs")
    d, s = F.col("document"), F.col("summary")
    return df.select(
        "pair_id",
        P.with_eos(P.render(C.SUMMARY_TEMPLATE, d, s), "</s>").alias("summary_prompt"),
        P.render(P.inference_template(C.SUMMARY_TEMPLATE), d).alias("inference_prompt"),
        P.render(C.PREFERENCE_TEMPLATE, d).alias("preference_prompt"),
        P.render(C.ZERO_SHOT_USER, d).alias("zero_shot_prompt"),
        P.render(C.HALLUCINATION_USER, d, s).alias("hallucination_prompt"),
        P.with_eos(P.render(C.CLOZE_TEMPLATE, d, s, F.lit("a, b")), "</s>").alias("cloze_prompt"),
        P.render(P.inference_template(C.CLOZE_TEMPLATE), d, s).alias("cloze_inference_prompt"),
        P.render(C.CLOZE_USER, F.lit(2), d, s).alias("cloze_user_prompt"),
    )


def completion_span(spark, sf_dir):
    text = P.with_eos(P.render(C.SUMMARY_TEMPLATE, F.col("document"), F.col("summary")), "</s>")
    df = view(tune(spark), sf_dir, "fx_pairs").select("pair_id", text.alias("text"))
    return df.select(
        "pair_id", P.prompt_part(F.col("text"), C.SUMMARY_MARKER).alias("prompt_part"),
        P.completion_part(F.col("text"), C.SUMMARY_MARKER).alias("completion_part"),
    )


def chat_render(spark, sf_dir):
    df = view(tune(spark), sf_dir, "fx_turns")
    return df.select("pair_id", P.render_chat(P.chat(F.lit("Summarise."), F.col("summary"))).alias("chat"))


def response_join(spark, sf_dir):
    df = view(tune(spark), sf_dir, "fx_turns")
    outputs = F.array("document", "summary", F.coalesce("candidate", F.lit("")))
    return df.select("pair_id", P.join_outputs(outputs).alias("response"))


def response_body(spark, sf_dir):
    df = view(tune(spark), sf_dir, "fx_responses")
    return df.select(
        "conv_id", "turn", P.response_body(F.col("response")).alias("body"), P.response_body(F.col("text")).alias("rest")
    )


def _longest_line():
    """Stand-in for a model: answers with the longest line of the prompt, the first one on ties."""
    return lambda texts: [max(t.split("\n"), key=len) for t in texts]


def batch_inference(spark, sf_dir):
    df = view(tune(spark), sf_dir, "fx_pairs").select(
        "pair_id", P.render(C.ZERO_SHOT_USER, F.col("document")).alias("text")
    )
    return stored_inference(df, _longest_line, folder(spark, "generated"), tasks=8)


def _fails_on(marks: str):
    """Predictor that fails on prompts whose digest starts with one of ``marks``."""

    def factory():
        predict = _longest_line()

        def run(texts: list[str]) -> list[str]:
            if any(hashlib.sha256(t.encode()).hexdigest()[0] in marks for t in texts):
                raise ValueError("no answer")
            return predict(texts)

        return run

    return factory


def resumed_inference(spark, sf_dir):
    """A run that fails on half of its prompts, then one that asks for the rest."""
    df = view(tune(spark), sf_dir, "fx_pairs").select("pair_id", P.render(C.ZERO_SHOT_USER, F.col("document")).alias("text"))
    store = folder(spark, "responses")
    resume_inference(df, _fails_on("01234567"), store, tasks=8)
    return resume_inference(df, _longest_line, store, tasks=8, rows_per_wave=2000)


def resumed_records(spark, sf_dir):
    """What the two runs left in the store, run by run."""
    df = view(tune(spark), sf_dir, "fx_pairs").select("pair_id", P.render(C.ZERO_SHOT_USER, F.col("document")).alias("text"))
    store = folder(spark, "responses")
    resume_inference(df, _fails_on("01234567"), store, tasks=8)
    resume_inference(df, _longest_line, store, tasks=8)
    return run_records(spark, store).groupBy((F.col("failed") == 0).alias("healthy")).agg(*[F.sum(c).alias(c) for c in ("asked", "answered", "failed")])


def balanced_inference(spark, sf_dir):
    """The same predictions from tasks of equal numbers of words instead of rows."""
    df = view(tune(spark), sf_dir, "fx_pairs").select("pair_id", P.render(C.ZERO_SHOT_USER, F.col("document")).alias("text"))
    return batch_infer(df, _longest_line, tasks=8, cost=count_tokens(F.col("text")))


QUERIES = {
    "scan_notes": scan_notes, "missing_sources": missing_sources, "patient_layout": patient_layout,
    "discharge_notes": discharge_notes, "anchor_time": anchor_time, "clean_notes": clean_notes,
    "note_blocks": note_blocks, "admission_notes": admission_notes, "prior_notes": prior_notes,
    "documents_by_admission": documents_by_admission, "note_positions": note_positions,
    "strip_signature": strip_signatures, "heading_hits": heading_hits, "unknown_heads": unknown_heads,
    "outcome_codes": outcome_codes, "sections": sections, "outcome_counts": outcome_counts,
    "outcome_ids": outcome_ids, "pairs_by_code_heading": pairs_by_code_heading, "pairs_all": pairs_all,
    "scan_large_csv": scan_large_csv, "scan_bad_rows": scan_bad_rows, "doc_stats": doc_stats, "merged_lengths": merged_lengths, "prior_notes_bucketed": bucketed_notes, "length_gate": length_gate, "split_sets": split_sets,
    "split_reused": split_reused, "split_counts": split_counts, "split_manifest": split_manifest, "render_prompts": render_prompts,
    "completion_span": completion_span, "chat_render": chat_render, "response_join": response_join,
    "response_body": response_body, "batch_infer": batch_inference, "infer_resumed": resumed_inference,
    "infer_resumed_records": resumed_records, "infer_balanced": balanced_inference,
}

# SQL

_IN = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
_LINES = "unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i"
_PARA = """coalesce(sum(CASE WHEN line = '' OR line = lastval THEN 1 ELSE 0 END) OVER (
  PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p"""


def clean_sql(name: str, source: str) -> str:
    """CTEs that normalise the texts of ``source(id, text)`` line by line into ``name(id, clean)``."""
    return f"""
{name}_l AS (SELECT id, {_LINES} FROM {source} WHERE text IS NOT NULL),
{name}_e AS (SELECT id, min(i) AS lo, max(i) AS hi FROM {name}_l WHERE NOT regexp_full_match(line, '\\s*') GROUP BY id),
{name}_k AS (SELECT l.id, i, CASE WHEN line IN ('#', '.') THEN '' ELSE line END AS line, i = hi AS final
  FROM {name}_l AS l JOIN {name}_e AS e ON l.id = e.id AND i BETWEEN lo AND hi),
{name}_t AS (SELECT *, max(CASE WHEN final THEN line END) OVER (PARTITION BY id) AS lastval FROM {name}_k),
{name}_p AS (SELECT *, {_PARA} FROM {name}_t),
{name}_q AS (SELECT id, p, lower(trim(regexp_replace(string_agg(line, ' ' ORDER BY i), '\\s+', ' ', 'g'))) AS para
  FROM {name}_p GROUP BY id, p),
{name}_j AS (SELECT id, string_agg(para, chr(10) ORDER BY p) AS clean FROM {name}_q WHERE para <> '' GROUP BY id),
{name} AS (SELECT s.id, coalesce(j.clean, '') AS clean FROM {source} AS s LEFT JOIN {name}_j AS j ON s.id = j.id)"""


_CLOSING = """
closing AS (SELECT row_id AS id, concat_ws('_', row_id, subject_id, hadm_id) AS pair_id, subject_id, hadm_id, text, description,
  coalesce(CAST(charttime AS TIMESTAMP), CAST(chartdate AS TIMESTAMP) + INTERVAL 1 DAY) AS anchor
  FROM fx_notes WHERE category = 'Discharge summary')"""

_SECTIONS = f"""{_CLOSING},
l AS (SELECT id, {_LINES} FROM closing),
cut AS (SELECT id, min(i) FILTER (WHERE line LIKE 'Dictated By%') AS cut_i FROM l GROUP BY id),
kept AS (SELECT l.id, i, line FROM l JOIN cut USING (id) WHERE cut_i IS NULL OR i < cut_i),
tail AS (SELECT id, max(i) AS hi, arg_max(line, i) AS line FROM kept GROUP BY id),
signed AS (SELECT k.id, k.i, k.line FROM kept AS k JOIN tail AS t ON k.id = t.id
  AND k.i <= CASE WHEN regexp_full_match(t.line, '\\s*') THEN t.hi - 1 ELSE t.hi END),
tail2 AS (SELECT id, max(i) AS hi, regexp_full_match(replace(arg_max(line, i), ' ', ''),
  '\\[\\*\\*(.*)\\*\\*\\](.*)\\[\\*\\*(.*)\\*\\*\\](.*)\\[\\*\\*(.*)\\*\\*\\](.*)') AS named FROM signed GROUP BY id),
body AS (SELECT s.id, s.i, s.line AS raw, CASE WHEN s.line IN ('#', '.') THEN '' ELSE s.line END AS line,
  s.i = max(s.i) OVER (PARTITION BY s.id) AS final
  FROM signed AS s JOIN tail2 AS t ON s.id = t.id AND s.i <= CASE WHEN named THEN hi - 1 ELSE hi END),
lined AS (SELECT *, max(CASE WHEN final THEN line END) OVER (PARTITION BY id) AS lastval FROM body),
numbered AS (SELECT *, {_PARA} FROM lined),
paras AS (SELECT id, p, greatest(min(i) - 1, 1) AS start_i, trim(string_agg(line, ' ' ORDER BY i)) AS para,
  coalesce(string_agg(line, '' ORDER BY i) FILTER (WHERE line <> '' AND line <> lastval), '') AS tight FROM numbered GROUP BY id, p),
heads AS (SELECT *, CASE WHEN contains(para, ':') THEN split_part(para, ':', 1) END AS head,
  CASE WHEN contains(tight, ':') THEN split_part(tight, ':', 1) END AS tight_head FROM paras),
hits AS (SELECT id, count(*) AS n_hits, min(p) AS p, arg_min(head, p) AS heading, arg_min(start_i, p) AS from_i FROM heads
  WHERE contains(lower(head), '{C.HEADING_KEYWORD}') AND NOT regexp_matches(head, '[0-9]') AND left(head, 1) NOT IN ('.', '#') GROUP BY id),
nexts AS (SELECT h.id, arg_min(h.head, h.p) AS next_heading, arg_min(h.start_i, h.p) AS to_i FROM heads AS h JOIN hits ON h.id = hits.id AND h.p > hits.p
  WHERE h.head IN {_IN(C.NEXT_HEADINGS)} GROUP BY h.id),
unknowns AS (SELECT DISTINCT h.id FROM heads AS h JOIN hits ON h.id = hits.id AND h.p >= hits.p
  WHERE upper(tight_head) = tight_head AND lower(tight_head) <> tight_head AND tight_head NOT IN {_IN(C.SUBHEADINGS)}
    AND NOT regexp_matches(tight_head, '[0-9]') AND left(tight_head, 1) NOT IN ('.', '#')),
base AS (SELECT c.*, n_hits, h.heading AS found, next_heading, from_i, to_i, u.id IS NOT NULL AS unknown,
  upper(h.heading) = h.heading AND lower(h.heading) <> h.heading AS up, t.id IS NULL AS empty,
  CASE WHEN description = 'Addendum' THEN 8 WHEN t.id IS NULL OR anchor IS NULL THEN -1 WHEN n_hits > 1 THEN 0 WHEN n_hits IS NULL THEN 7
    WHEN h.heading NOT IN {_IN(C.SECTION_HEADINGS)} THEN 6 WHEN to_i IS NOT NULL THEN 1
    WHEN up AND NOT unknown THEN 2 WHEN up THEN 3 WHEN NOT unknown THEN 4 ELSE 5 END AS base_code
  FROM closing AS c LEFT JOIN tail2 AS t ON c.id = t.id LEFT JOIN hits AS h ON c.id = h.id
  LEFT JOIN nexts AS n ON c.id = n.id LEFT JOIN unknowns AS u ON c.id = u.id),
slices AS (SELECT b.id, string_agg(line, chr(10) ORDER BY i) AS text FROM base AS b JOIN lined ON b.id = lined.id
  AND i >= from_i AND (to_i IS NULL OR i < to_i) WHERE base_code IN (1, 2, 4) GROUP BY b.id),
{clean_sql("sliced", "slices")},
found_section AS (SELECT b.id, starts_with(clean, lower(found)) AS good,
  trim(substr(clean, instr(clean, ':') + 1), ' ' || chr(10)) AS summary FROM base AS b JOIN sliced AS s ON b.id = s.id),
graded AS (SELECT b.pair_id, subject_id, hadm_id, b.id, anchor,
  CASE WHEN base_code NOT IN (1, 2, 4) THEN base_code WHEN NOT good THEN -1 WHEN len(string_split(f.summary, ' ')) <= 30 THEN 9 ELSE base_code END AS code,
  found, f.summary AS section, CAST(len(string_split(f.summary, ' ')) AS INTEGER) AS section_words, n_hits, next_heading, unknown, base_code, description
  FROM base AS b LEFT JOIN found_section AS f ON b.id = f.id)"""

_OTHERS = f"""
others AS (SELECT * FROM fx_notes WHERE category IS DISTINCT FROM 'Discharge summary' AND charttime IS NOT NULL),
other_texts AS (SELECT row_id AS id, text FROM others),
{clean_sql("cleaned", "other_texts")},
blocks AS (SELECT o.*, 'chart time: ' || lower(charttime) || chr(10) || 'note category: ' || lower(category) || chr(10) ||
  CASE WHEN trim(description) = '' THEN '' ELSE 'note category description: ' || lower(description) || chr(10) END || clean AS block
  FROM others AS o JOIN cleaned AS c ON o.row_id = c.id)"""

_PRIOR = """
admitted_closing AS (SELECT c.* FROM closing AS c SEMI JOIN fx_admissions AS a ON c.subject_id = a.subject_id AND c.hadm_id = a.hadm_id),
prior AS (SELECT c.pair_id, b.row_id, b.charttime AS time, b.block FROM admitted_closing AS c JOIN blocks AS b
  ON b.subject_id = c.subject_id AND b.hadm_id = c.hadm_id AND CAST(b.charttime AS TIMESTAMP) <= c.anchor),
docs AS (SELECT pair_id, string_agg(block, ' [DOC_SEP] ' ORDER BY time, row_id) AS document FROM prior GROUP BY pair_id)"""

_HEADING_LIST = "[" + ", ".join(f"'{h}'" for h in C.SECTION_HEADINGS) + "]"
_PAIRS = f"""
pairs AS (SELECT g.pair_id, g.code, found AS heading, CAST(list_position({_HEADING_LIST}, found) - 1 AS INT) AS heading_idx,
  coalesce(document, '') AS document, section AS summary, CAST(len(string_split(coalesce(document, ''), ' ')) AS INTEGER) AS document_words,
  section_words AS summary_words FROM graded AS g SEMI JOIN fx_admissions AS a ON g.subject_id = a.subject_id AND g.hadm_id = a.hadm_id
  LEFT JOIN docs AS d ON g.pair_id = d.pair_id WHERE code IN (1, 2, 4))"""

_FROM_NOTES = with_views("fx_notes", "fx_admissions")
_WITH_PAIRS = f"{_FROM_NOTES}, {_SECTIONS}, {_OTHERS}, {_PRIOR}, {_PAIRS}"


def _quoted(template: str) -> str:
    return "'" + template.replace("'", "''") + "'"


def filled(template: str, *values: str) -> str:
    """SQL for a template with its places filled by SQL expressions."""
    pieces = template.split("{}")
    return " || ".join(
        part for i, piece in enumerate(pieces) for part in ([values[i - 1]] if i else []) + [_quoted(piece)]
    )


_TOKENS = lambda text: f"len(regexp_extract_all({text}, '\\S+'))"
_SAFE = f"{_TOKENS(filled(C.SUMMARY_TEMPLATE, 'document', 'summary'))} + 10 < {MAX_TOKENS}"
_SPLITS = f"""{with_views("fx_doc_pairs")},
shuffled AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:test:' || pair_id)) AS r, count(*) OVER () AS n FROM fx_doc_pairs),
learn AS (SELECT pair_id, document, summary FROM shuffled WHERE r <= CAST(floor(CAST(n AS DOUBLE) * CAST(0.9 AS DOUBLE)) AS BIGINT) AND {_SAFE}),
again AS (SELECT *, row_number() OVER (ORDER BY md5('{SEED}:val:' || pair_id)) AS r, count(*) OVER () AS n FROM learn),
splits AS (SELECT pair_id, document, summary, CASE WHEN r <= CAST(floor(CAST(n AS DOUBLE) * CAST(0.9 AS DOUBLE)) AS BIGINT) THEN 'train' ELSE 'val' END AS split
  FROM again UNION ALL SELECT pair_id, document, summary, 'test' FROM shuffled
  WHERE r > CAST(floor(CAST(n AS DOUBLE) * CAST(0.9 AS DOUBLE)) AS BIGINT))"""
_MARK = _quoted(C.SUMMARY_MARKER)
_DOC = "document"

_PERCENTILES = ", ".join(
    f"CAST(list_sort(list({side}_words))[greatest(CAST(ceil({p}::DOUBLE / 100 * count(*)) AS BIGINT), 1)] AS BIGINT) AS p{p}_{side}_words" for side in ("document", "summary") for p in (50, 90, 99)
)

SQL = {
    "scan_notes": f"""{with_views("fx_notes")} SELECT category, count(*) AS n, count(charttime) AS n_timed, count(hadm_id) AS n_admitted,
sum(length(text))::BIGINT AS n_chars FROM fx_notes GROUP BY category""",
    "missing_sources": f"""{with_views("fx_files")}, expected AS (SELECT unnest({list(C.EXPECTED_TABLES)}) AS name)
SELECT delivery, name AS missing FROM (SELECT DISTINCT delivery FROM fx_files) AS d, expected
WHERE NOT EXISTS (SELECT 1 FROM fx_files AS f WHERE f.delivery = d.delivery AND f.file IN (name || '.csv', name || '.csv.gz'))""",
    "patient_layout": f"""{_FROM_NOTES} SELECT subject_id, 1 AS n, 'patients' AS table_name FROM fx_notes GROUP BY subject_id
UNION ALL SELECT subject_id, count(*), 'admissions' FROM fx_admissions GROUP BY subject_id
UNION ALL SELECT subject_id, count(*), 'noteevents' FROM fx_notes GROUP BY subject_id""",
    "discharge_notes": f"{with_views('fx_notes')}, {_CLOSING} SELECT pair_id, id AS row_id, CAST(length(text) AS INTEGER) AS n_chars FROM closing",
    "anchor_time": f"{with_views('fx_notes')}, {_CLOSING} SELECT pair_id, strftime(anchor, '%Y-%m-%d %H:%M:%S') AS anchor FROM closing",
    "clean_notes": f"""{with_views("fx_notes")}, src AS (SELECT row_id AS id, text FROM fx_notes), {clean_sql("done", "src")}
SELECT id AS row_id, clean AS cleaned FROM done""",
    "note_blocks": f"{with_views('fx_notes')}, {_OTHERS} SELECT row_id, block FROM blocks",
    "admission_notes": f"""{_FROM_NOTES} SELECT n.subject_id, n.hadm_id, n.row_id FROM fx_notes AS n
SEMI JOIN fx_admissions AS a ON n.subject_id = a.subject_id AND n.hadm_id = a.hadm_id""",
    "prior_notes": f"{_FROM_NOTES}, {_CLOSING}, {_OTHERS}, {_PRIOR} SELECT pair_id, row_id, time FROM prior",
    "documents_by_admission": f"{_FROM_NOTES}, {_CLOSING}, {_OTHERS}, {_PRIOR} SELECT pair_id, document FROM docs",
    "note_positions": f"""{_FROM_NOTES}, {_CLOSING}, {_OTHERS}, {_PRIOR}
SELECT pair_id, row_id, row_number() OVER (PARTITION BY pair_id ORDER BY time, row_id) AS position FROM prior""",
    "strip_signature": f"""{with_views('fx_notes')}, {_SECTIONS}, j AS (SELECT id, string_agg(raw, chr(10) ORDER BY i) AS stripped FROM body GROUP BY id)
SELECT pair_id, coalesce(stripped, '') AS stripped FROM closing LEFT JOIN j USING (id)""",
    "heading_hits": f"""{with_views('fx_notes')}, {_SECTIONS}
SELECT pair_id, CAST(coalesce(n_hits, 0) AS INTEGER) AS n_hits, coalesce(found, '') AS first_heading, coalesce(next_heading, '') AS next_heading FROM graded""",
    "unknown_heads": f"""{with_views('fx_notes')}, {_SECTIONS}
SELECT pair_id, CAST(unknown AS INT) AS unknown FROM graded WHERE n_hits = 1 AND found IN {_IN(C.SECTION_HEADINGS)} AND next_heading IS NULL""",
    "outcome_codes": f"{with_views('fx_notes')}, {_SECTIONS} SELECT pair_id, code FROM graded",
    "sections": f"""{with_views('fx_notes')}, {_SECTIONS}
SELECT pair_id, found AS heading, section AS summary, section_words AS summary_words FROM graded WHERE code IN (1, 2, 4)""",
    "outcome_counts": f"{with_views('fx_notes')}, {_SECTIONS} SELECT code, count(*) AS n FROM graded GROUP BY code",
    "outcome_ids": f"""{_WITH_PAIRS} SELECT g.pair_id, g.code, coalesce(document_words, 0) AS document_words, coalesce(summary_words, 0) AS summary_words FROM graded AS g
SEMI JOIN fx_admissions AS a ON g.subject_id = a.subject_id AND g.hadm_id = a.hadm_id LEFT JOIN pairs AS p ON g.pair_id = p.pair_id""",
    "pairs_by_code_heading": f"""{with_views('fx_notes')}, {_SECTIONS}
SELECT code, CAST(list_position({_HEADING_LIST}, found) - 1 AS INT) AS heading_idx, count(*) AS n FROM graded WHERE code IN (1, 2, 4) GROUP BY ALL""",
    "pairs_all": f"{_WITH_PAIRS} SELECT * FROM pairs",
    "doc_stats": f"""{_WITH_PAIRS} SELECT code, count(*) AS n, min(document_words) AS min_document_words, max(document_words) AS max_document_words,
avg(document_words) AS avg_document_words, min(summary_words) AS min_summary_words, max(summary_words) AS max_summary_words,
avg(summary_words) AS avg_summary_words, {_PERCENTILES} FROM pairs GROUP BY code""",
    "length_gate": f"{with_views('fx_doc_pairs')} SELECT pair_id FROM fx_doc_pairs WHERE {_SAFE}",
    "split_sets": f"{_SPLITS} SELECT pair_id, split, document, summary FROM splits",
    "split_counts": f"{_SPLITS} SELECT split, count(*) AS n FROM splits GROUP BY split",
    "split_manifest": f"""{_SPLITS} SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'val') AS n_val,
count(*) FILTER (WHERE split = 'test') AS n_test, {_quoted(C.SUMMARY_TEMPLATE)} AS prompt, '{SEED}' AS seed, CAST(0.9 AS DOUBLE) AS train_ratio,
{MAX_TOKENS} AS max_tokens FROM splits""",
    "render_prompts": f"""{with_views('fx_pairs')} SELECT pair_id, {filled(C.SUMMARY_TEMPLATE, _DOC, 'summary')} || '</s>' AS summary_prompt,
{filled(C.SUMMARY_TEMPLATE[:-2], _DOC)} AS inference_prompt, {filled(C.PREFERENCE_TEMPLATE, _DOC)} AS preference_prompt,
{filled(C.ZERO_SHOT_USER, _DOC)} AS zero_shot_prompt, {filled(C.HALLUCINATION_USER, _DOC, 'summary')} AS hallucination_prompt,
{filled(C.CLOZE_TEMPLATE, _DOC, 'summary', "'a, b'")} || '</s>' AS cloze_prompt,
{filled(C.CLOZE_TEMPLATE[:-2], _DOC, 'summary')} AS cloze_inference_prompt, {filled(C.CLOZE_USER, "'2'", _DOC, 'summary')} AS cloze_user_prompt
FROM fx_pairs""",
    "completion_span": f"""{with_views('fx_pairs')}, t AS (SELECT pair_id, {filled(C.SUMMARY_TEMPLATE, _DOC, 'summary')} || '</s>' AS text FROM fx_pairs)
SELECT pair_id, split_part(text, {_MARK}, 1) || {_MARK} AS prompt_part, substr(text, length(split_part(text, {_MARK}, 1) || {_MARK}) + 1) AS completion_part FROM t""",
    "chat_render": f"""{with_views('fx_turns')}
SELECT pair_id, '<|system|>' || chr(10) || 'Summarise.' || chr(10) || '<|user|>' || chr(10) || summary || chr(10) AS chat FROM fx_turns""",
    "response_join": f"{with_views('fx_turns')} SELECT pair_id, concat_ws(' ', document, summary, coalesce(candidate, '')) AS response FROM fx_turns",
    "response_body": f"""{with_views('fx_responses')} SELECT conv_id, turn, text AS body,
coalesce(array_to_string(string_split(text, chr(10))[3:], chr(10)), '') AS rest FROM fx_responses""",
    "batch_infer": f"""{with_views('fx_pairs')}, p AS (SELECT pair_id, {filled(C.ZERO_SHOT_USER, _DOC)} AS text FROM fx_pairs),
l AS (SELECT pair_id, text AS prompt, {_LINES} FROM p)
SELECT pair_id, prompt, arg_max(line, length(line) * 1000000 - i) AS generated_text FROM l GROUP BY pair_id, prompt""",
    "infer_resumed_records": f"""{with_views('fx_pairs')}, p AS (SELECT substr(sha256({filled(C.ZERO_SHOT_USER, _DOC)}), 1, 1) < '8' AS bad FROM fx_pairs)
SELECT FALSE AS healthy, count(*) AS asked, count(*) FILTER (NOT bad) AS answered, count(*) FILTER (bad) AS failed FROM p
UNION ALL SELECT TRUE, count(*), count(*), 0 FROM p WHERE bad""",
}
SQL["infer_resumed"] = SQL["infer_balanced"] = SQL["batch_infer"]
SQL["merged_lengths"] = SQL["doc_stats"]
SQL["scan_large_csv"] = f"{with_views('fx_notes')} SELECT row_id, subject_id, hadm_id, chartdate, charttime, category, text FROM fx_notes"
SQL["scan_bad_rows"] = """SELECT CASE doc_id % 7 WHEN 1 THEN 'fields' WHEN 2 THEN 'type id' WHEN 3 THEN 'missing text' ELSE CASE WHEN trim(text) = '' THEN 'missing text' ELSE 'none' END END AS reason,
count(*) AS n FROM documents GROUP BY ALL"""
SQL["prior_notes_bucketed"] = SQL["prior_notes"]
SQL["split_reused"] = f"{_SPLITS} SELECT pair_id, split FROM splits"
