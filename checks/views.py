"""Views that give the test tables the shape of notes, pairs and concepts.

Each view is one SQL text over whole tables for both engines; the only swaps are
``@div@`` (integer division), ``@each@`` (array to rows) and ``@x@`` (lambda head).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notepairs.constants import EXPECTED_TABLES

_TABLES = ("documents", "conversations", "benchmark", "labels", "embeddings")
_SWAPS = {
    "spark": {"@div@": "DIV", "@each@": "explode", "@x@": "x ->"},
    "duckdb": {"@div@": "//", "@each@": "unnest", "@x@": "lambda x:"},
}

_NOTE_TEXT = """
  CASE WHEN category <> 'Discharge summary' THEN body
  WHEN k = 0 THEN hd || 'Brief Hospital Course:' || nl || body || nl || nl || 'Medications on Admission:' || nl
    || 'none listed' || nl || nl || 'Dictated By:  X' || nl || 'tail'
  WHEN k = 1 THEN hd || 'HOSPITAL COURSE:' || nl || para || nl || nl || 'Hospital Course:' || nl || 'again' || nl || nl || 'end'
  WHEN k = 2 THEN hd || 'HOSPITAL COURSE: ' || flat
  WHEN k = 3 THEN hd || 'HOSPITAL COURSE:' || nl || para || nl || nl || 'UNKNOWN HEAD: foo' || nl || nl || 'end'
  WHEN k = 4 THEN hd || 'Brief Hospital Course:' || nl || para || nl || nl || 'RENAL: stable' || nl || nl || 'final line'
  WHEN k = 5 THEN hd || 'Brief Hospital Course:' || nl || para || nl || nl || 'WEIRD SECTION: foo' || nl || nl || 'final line'
  WHEN k = 6 THEN hd || 'Hospital Course Overview:' || nl || para || nl || nl || 'end'
  WHEN k = 7 THEN hd || 'Brief narrative:' || nl || para || nl || nl || 'end'
  WHEN k = 8 THEN hd || 'Brief Hospital Course:' || nl || para || nl || nl || 'DISPOSITION: home' || nl || nl || 'end'
  WHEN k = 9 THEN hd || 'Brief Hospital Course:' || nl || 'short text' || nl || nl || 'Discharge Disposition:' || nl || 'home'
  WHEN k = 10 THEN '#' || nl || hd || 'HOSPITAL COURSE BY' || nl || 'SYSTEMS: ' || para || nl || '.' || nl
    || 'DISCHARGE CONDITION: good' || nl || nl || '[**A 1**] [**B 2**] MD [**C 3**]' || nl
  ELSE hd || 'Hospital course:' || nl || para || nl || nl || '#' || nl || 'DISPOSITION: home' || nl || nl || 'done' END
"""

# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    # Every document is a note; twelve neighbours share an admission, one source has none.
    "fx_notes": ((), f"""
SELECT row_id, subject_id, hadm_id, chartdate, charttime, category,
  CASE WHEN category = 'Discharge summary' AND k = 8 THEN 'Addendum' WHEN row_id % 7 = 0 THEN '' ELSE 'Report' END AS description,
  {_NOTE_TEXT} AS text
FROM (
  SELECT doc_id AS row_id, doc_id @div@ 36 AS subject_id,
    CASE WHEN source = 'src7' THEN NULL ELSE doc_id @div@ 12 END AS hadm_id,
    '2150-01-' || lpad(CAST((doc_id @div@ 2) * 3 % 7 + 1 AS STRING), 2, '0') AS chartdate,
    CASE WHEN doc_id % 4 = 0 THEN NULL ELSE '2150-01-' || lpad(CAST((doc_id @div@ 2) * 3 % 7 + 1 AS STRING), 2, '0')
      || ' ' || lpad(CAST((doc_id @div@ 4) % 24 AS STRING), 2, '0') || ':00:00' END AS charttime,
    CASE doc_id % 5 WHEN 0 THEN 'Discharge summary' WHEN 1 THEN 'Nursing' WHEN 2 THEN 'Radiology'
      WHEN 3 THEN 'Physician ' ELSE 'ECG' END AS category,
    (doc_id % 60) @div@ 5 AS k, chr(10) AS nl, 'Admission Date:  [**2150-1-1**]' || chr(10) || chr(10) AS hd,
    replace(text, '.' || chr(10), '.' || chr(10) || chr(10)) AS body,
    replace(text, chr(10), ' ' || chr(10)) AS para, replace(text, chr(10), ' ') AS flat
  FROM documents) AS shaped"""),
    # An admission is on record when one of its notes has a low-quality label, once for each such note.
    "fx_admissions": (("fx_notes",), """
SELECT n.subject_id, n.hadm_id FROM fx_notes AS n JOIN labels AS l ON n.row_id = l.doc_id
WHERE n.hadm_id IS NOT NULL AND l.quality = 0"""),
    # A thousand documents of one source are a delivery; text lengths pick the file names.
    "fx_files": ((), f"""
SELECT source || '_' || CAST(doc_id @div@ 1000 AS STRING) AS delivery,
  split_part('{','.join(EXPECTED_TABLES)}', ',', CAST(n_chars % 40 + 1 AS INT)) || CASE WHEN lang = 'en' THEN '.csv.gz' ELSE '.csv' END AS file
FROM documents"""),
    # A turn is a summary, the turn before it the document, the turn after it the candidate.
    "fx_turns": ((), """
SELECT t.conv_id, t.turn, t.role, t.conv_id || '_' || t.turn AS pair_id, coalesce(p.text, '') AS document,
  t.text AS summary, CASE WHEN n.text IS NULL THEN NULL WHEN length(n.text) < 60 THEN ''
    ELSE n.text || ' ' || regexp_replace(t.text, '^[^.]*[.]', '') END AS candidate
FROM conversations AS t
LEFT JOIN conversations AS p ON p.conv_id = t.conv_id AND p.turn = t.turn - 1
LEFT JOIN conversations AS n ON n.conv_id = t.conv_id AND n.turn = t.turn + 1"""),
    "fx_pairs": (("fx_turns",), "SELECT pair_id, document, summary FROM fx_turns"),
    "fx_candidates": (("fx_turns",), "SELECT pair_id, candidate FROM fx_turns WHERE candidate IS NOT NULL"),
    # Words of the benchmark and runs of two to five are concept names; names that start alike share a concept.
    "fx_names": ((), """
SELECT DISTINCT 'C' || substr(md5(substr(name, 1, 4)), 1, 7) AS cui, name FROM (
  """ + "\n  UNION ALL ".join(f"SELECT @each@(regexp_extract_all(lower(text), '[a-z]+{' [a-z]+' * more}', 0)) AS name FROM benchmark" for more in range(5)) + """) AS words
WHERE name <> ''"""),
    "fx_types": (("fx_names",), """
SELECT DISTINCT cui, CASE WHEN digit < '8' THEN 'T047' WHEN digit < 'c' THEN 'T121' WHEN digit < 'e' THEN 'T074' ELSE 'T999' END AS type_id
FROM (SELECT cui, substr(md5(cui), 8, 1) AS digit FROM fx_names UNION ALL SELECT cui, substr(md5(cui), 9, 1) FROM fx_names) AS d"""),
    "fx_codes": ((), """
SELECT 'C' || substr(md5(substr(word, 1, 4)), 1, 7) AS cui, 'I' || substr(md5(word || item_id), 1, 4) AS code, item_id AS line_no
FROM (SELECT item_id, @each@(regexp_extract_all(lower(text), '[a-z]+', 0)) AS word FROM benchmark) AS words
WHERE word <> ''"""),
    # Model answers about a rejected summary, in six shapes.
    "fx_rejected": ((), """
SELECT CAST(doc_id AS STRING) AS pair_id, CASE doc_id % 6
  WHEN 0 THEN 'Edits' || chr(10) || 'Hallucinated Summary:' || chr(10) || chr(10) || text || chr(10)
  WHEN 1 THEN 'This is the long Hallucinated Summary:' || chr(10) || text
  WHEN 2 THEN 'Hallucinated Summary:' || chr(10) || text || chr(10) || 'hallucination edits:' || chr(10) || 'more'
  WHEN 3 THEN 'HALLUCINATED SUMMARY' || chr(10) || text || chr(10) || 'Hallucinated Summary:' || chr(10) || text
  WHEN 4 THEN text || chr(10) || 'Hallucinated Summary:'
  ELSE text END AS response FROM documents"""),
    "fx_doc_pairs": ((), """
SELECT CAST(doc_id AS STRING) AS pair_id, text AS document, lang || ' ' || source AS summary FROM documents"""),
    # The vectors of a label are one pair: even ones of the reference, odd ones of the candidate.
    "fx_vectors": ((), """
SELECT CAST(label AS STRING) AS pair_id, CASE vec_id % 2 WHEN 0 THEN 'reference' ELSE 'candidate' END AS side,
  vec_id AS token, embedding AS vector FROM embeddings"""),
    "fx_type_texts": ((), """
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '"[''' || lang || ''', ''' || source || ''']"' WHEN 1 THEN '[''' || source || ''']' ELSE '[]' END AS type_ids
FROM documents"""),
    "fx_responses": ((), """
SELECT conv_id, turn, text, '<|start|>' || chr(10) || role || chr(10) || text AS response FROM conversations"""),
}


def _ordered(names: tuple[str, ...] | list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for needed in (*_ordered(VIEWS[name][0]), name):
            if needed not in out:
                out.append(needed)
    return out


def with_views(*names: str, engine: str = "duckdb") -> str:
    """``WITH`` clause (no trailing comma) that defines the views and what they read."""
    parts = []
    for name in _ordered(names):
        sql = VIEWS[name][1]
        for mark, text in _SWAPS[engine].items():
            sql = sql.replace(mark, text)
        parts.append(f"{name} AS ({sql})")
    return "WITH " + ",\n".join(parts)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables of one folder."""
    sql = with_views(name, engine="spark") + f"\nSELECT * FROM {name}"
    for table in _TABLES:
        if f" {table}" in sql:
            spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    return spark.sql(sql)
