"""The note rules told again in plain Python, paragraph by paragraph, for comparison."""

from __future__ import annotations

import re
from itertools import accumulate

from notepairs import constants as C


def blocks(lines):
    """(closer index or start, content lines, closed by a line that equals the last one)."""
    closers = [i for i, x in enumerate(lines) if x in ("", lines[-1])] if lines else []
    out, at = [], 0
    for prev, i in zip([0, *closers], closers):
        own = lines[at:i] + ([lines[i]] if lines[i] else [])
        out.append((prev, own, bool(lines[i])))
        at = i + 1
    return out


def cleaned(text_lines):
    solid = [i for i, x in enumerate(text_lines) if x.strip()]
    if not solid:
        return ""
    lines = ["" if x in ("#", ".") else x for x in text_lines[solid[0] : solid[-1] + 1]]
    paras = [re.sub(r"\s+", " ", " ".join(own)).strip().lower() for _, own, _ in blocks(lines)]
    return "\n".join(p for p in paras if p)


def bare(head):
    return not any(c.isdigit() for c in head) and head[:1] not in (".", "#")


def outcome(text, addendum=False, skip_own=False):
    if addendum:
        return 8, None, None
    lines = text.split("\n")
    cut = next((i for i, x in enumerate(lines) if x.startswith("Dictated By")), len(lines))
    lines = lines[:cut]
    if lines and not lines[-1].strip():
        lines = lines[:-1]
    if not lines:
        return -1, None, None
    if re.fullmatch(r"\[\*\*.*\*\*\].*\[\*\*.*\*\*\].*\[\*\*.*\*\*\].*", lines[-1].replace(" ", "")):
        lines = lines[:-1]
    lines = ["" if x in ("#", ".") else x for x in lines]
    paras = blocks(lines)
    heads = []
    for _, own, _ in paras:
        joined = " ".join(own).strip()
        heads.append(joined.split(":")[0] if ":" in joined else None)
    hits = [i for i, h in enumerate(heads) if h is not None and C.HEADING_KEYWORD in h.lower() and bare(h)]
    if len(hits) != 1:
        return (0, None, None) if hits else (7, None, None)
    first = hits[0]
    heading, start = heads[first], paras[first][0]
    if heading not in C.SECTION_HEADINGS:
        return 6, None, None
    after = [i for i in range(first + 1, len(paras)) if heads[i] in C.NEXT_HEADINGS]
    if after:
        code, part = 1, lines[start : paras[after[0]][0]]
    else:
        unknown = False
        for i in range(first + (1 if skip_own else 0), len(paras)):
            _, own, by_last = paras[i]
            tight = "".join(own[:-1] if by_last else own)
            head = tight.split(":")[0]
            if ":" in tight and head.isupper() and head not in C.SUBHEADINGS and bare(head):
                unknown = True
        code, part = (2 if heading.isupper() else 4) + unknown, lines[start:]
        if unknown:
            return code, None, None
    section = cleaned(part)
    if not section.startswith(heading.lower()):
        return -1, None, None
    summary = section.split(":", 1)[1].strip() if ":" in section else ""
    return (9, None, None) if len(summary.split(" ")) <= C.SHORT_SUMMARY_WORDS else (code, heading, summary)


def lcs(a, b):
    row = [0] * (len(a) + 1)
    for y in b:
        row = list(accumulate(
            (max(row[i], row[i - 1] + 1 if i and a[i - 1] == y else 0) for i in range(len(a) + 1)), max
        ))
    return row[-1]
