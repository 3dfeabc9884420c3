"""SQL for stems: one common table a step over distinct tokens, by the shape of vowels and consonants."""

from __future__ import annotations

from notepairs.functions import stemming as S


def shape(word: str) -> str:
    """``V`` per vowel, ``C`` per consonant; a y follows what stands before it."""
    sql = f"regexp_replace(regexp_replace(regexp_replace({word}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g'), '^y', 'C')"
    for _ in range(4):
        sql = f"replace(replace({sql}, 'Cy', 'CV'), 'Vy', 'VC')"
    return sql


def measure(word: str) -> str:
    return f"len(regexp_extract_all({shape(word)}, 'VC'))"


def short_end(word: str) -> str:
    return f"((length({word}) > 2 AND {shape(word)} LIKE '%CVC' AND right({word}, 1) NOT IN ('w', 'x', 'y')) OR {shape(word)} = 'VC')"


def cut(word: str, n: int) -> str:
    return f"left({word}, length({word}) - {n})"


def rules(table, holds=None) -> str:
    """The first suffix that fits decides."""
    arms = []
    for suffix, new in table:
        left = cut("w", len(suffix))
        changed = f"{left} || '{new}'" if new else left
        arms.append(f"WHEN w LIKE '%{suffix}' THEN {changed if holds is None else f'CASE WHEN {holds(suffix, left)} THEN {changed} ELSE w END'}")
    return f"CASE {' '.join(arms)} ELSE w END"


def _past() -> str:
    arms = [
        f"WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {cut('w', 1)} ELSE {cut('w', 2)} END",
        f"WHEN w LIKE '%eed' THEN CASE WHEN {measure(cut('w', 3))} > 0 THEN {cut('w', 1)} ELSE w END",
    ]
    for suffix in ("ed", "ing"):
        s = cut("w", len(suffix))
        double = f"(length({s}) > 1 AND right({s}, 1) = right({cut(s, 1)}, 1) AND {shape(s)} LIKE '%C')"
        arms.append(
            f"WHEN w LIKE '%{suffix}' AND contains({shape(s)}, 'V') THEN CASE WHEN {s} LIKE '%at' OR {s} LIKE '%bl' OR {s} LIKE '%iz' THEN {s} || 'e'"
            f" WHEN {double} THEN CASE WHEN right({s}, 1) IN ('l', 's', 'z') THEN {s} ELSE {cut(s, 1)} END"
            f" WHEN {measure(s)} = 1 AND {short_end(s)} THEN {s} || 'e' ELSE {s} END"
        )
    return f"CASE {' '.join(arms)} ELSE w END"


def stems(source: str) -> str:
    """Tables up to ``stems(token, stem)`` for the tokens of a table; short and irregular ones are set last."""
    left = cut("w", 1)
    steps = [
        f"CASE WHEN w LIKE '%ies' AND length(w) = 4 THEN {left} ELSE {rules(S.PLURALS)} END",
        _past(),
        f"CASE WHEN w LIKE '%y' AND length(w) > 2 AND {shape(left)} LIKE '%C' THEN {left} || 'i' ELSE w END",
        f"CASE WHEN w LIKE '%alli' AND {measure(cut('w', 4))} > 0 THEN {cut('w', 2)} ELSE w END",
        rules(S.DERIVED, lambda suffix, s: f"{measure(f'({s} || chr(108))' if suffix == 'logi' else s)} > 0"),
        rules(S.ADJECTIVAL, lambda _, s: f"{measure(s)} > 0"),
        rules([(s, "") for s in S.RESIDUAL], lambda suffix, s: f"{measure(s)} > 1" + (f" AND right({s}, 1) IN ('s', 't')" if suffix == "ion" else "")),
        f"CASE WHEN w LIKE '%e' AND ({measure(left)} > 1 OR ({measure(left)} = 1 AND NOT {short_end(left)})) THEN {left} ELSE w END",
        f"CASE WHEN w LIKE '%ll' AND {measure(left)} > 1 THEN {left} ELSE w END",
    ]
    tables = [f"st0 AS (SELECT DISTINCT token, token AS w FROM {source})"]
    tables += [f"st{i} AS MATERIALIZED (SELECT token, {step} AS w FROM st{i - 1})" for i, step in enumerate(steps, 1)]
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in S.IRREGULAR.items())
    tables.append(f"stems AS (SELECT token, CASE WHEN length(token) <= 3 THEN token ELSE CASE token {irregular} ELSE w END END AS stem FROM st{len(steps)})")
    return ",\n".join(tables)
