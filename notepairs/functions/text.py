"""Column functions over note texts: all JVM-side, one row in, one row out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Whitespace as Unicode text tools see it; Java's own \s covers ASCII only. Testing for
# "not a visible ASCII character" first keeps the wide classes off most characters.
_RARE = r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = rf"[[^!-~]&&[\t-\r\x1c-\x20{_RARE}]]"
ODD_SPACE = rf"[[^ -~]&&[\t-\r\x1c-\x1f{_RARE}]]"
BLANK = rf"[[^!-~]&&[\t\x0b-\r\x1c-\x20{_RARE}]]"
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Decimal digits of every script plus superscript, subscript and circled digits.
DIGIT = (
    r"[\p{Nd}\xb2\xb3\xb9\u2070\u2074-\u2079\u2080-\u2089\u2460-\u2468\u2474-\u247c\u2488-\u2490"
    r"\u24ea\u24f5-\u24fd\u24ff\u2776-\u277e\u2780-\u2788\u278a-\u2792]"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    A plain column reference inside a lambda can be inlined by the optimizer and
    then runs once per element; a lambda variable cannot.
    """
    return F.transform(F.array(value), body).getItem(0)


def settle(df: DataFrame, *names: str) -> DataFrame:
    """Fix derived columns as rows of a generator.

    Filters on them stay above it; pushed down, they would be rewritten in terms of the
    inputs, which repeats long expressions many times over.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))


def squeeze(col: Column) -> Column:
    """Collapse whitespace runs to one space and strip both ends.

    Lone spaces, the common case, are left untouched.
    """
    return F.trim(F.regexp_replace(col, rf"{ODD_SPACE}{SPACE}*| {SPACE}+", " "))


def strip(col: Column) -> Column:
    return F.trim(col, F.lit(SPACE_CHARS))


def last_line(col: Column) -> Column:
    return F.substring_index(col, "\n", -1)


def blank_marker_lines(col: Column) -> Column:
    """Empty every line that is exactly ``#`` or ``.``."""
    return F.regexp_replace(col, r"(?md)^[#.]$", "")


def trim_blank_lines(col: Column) -> Column:
    """Drop blank lines at both ends; spaces at the ends of the kept lines stay."""
    chars = F.lit(SPACE_CHARS)

    def at_start(text: Column) -> Column:
        lead = F.substring(text, F.lit(1), F.length(text) - F.length(F.ltrim(text, chars)))
        return F.concat(F.substring_index(lead, "\n", -1), F.ltrim(text, chars))

    def at_end(text: Column) -> Column:
        kept = F.rtrim(text, chars)
        tail = F.substring(text, F.length(kept) + 1, F.length(text))
        return F.concat(kept, F.substring_index(tail, "\n", 1))

    return let(let(col, at_start), at_end)


def clean_text(text: Column) -> Column:
    """Normalise a note to one lower-cased line per paragraph.

    A paragraph ends at an empty line and at every line equal to the last one.
    Each line gets a newline of its own on both sides, so two newlines join lines
    and three or more part paragraphs, whatever the neighbours are.
    """

    def paragraphs(lines: Column) -> Column:
        spread = F.concat(F.lit("\n"), F.replace(lines, F.lit("\n"), F.lit("\n\n")), F.lit("\n"))
        end = F.concat(F.lit("\n"), last_line(lines), F.lit("\n"))
        parted = F.when(last_line(lines) == "", spread).otherwise(
            F.replace(spread, end, F.concat(end, F.lit("\n\n")))
        )
        return F.split(parted, "\n{3,}")

    cleaned = let(
        blank_marker_lines(trim_blank_lines(text)),
        lambda lines: F.transform(paragraphs(lines), lambda p: F.lower(squeeze(p))),
    )
    return F.array_join(F.filter(cleaned, lambda p: p != ""), "\n")


def note_block(charttime: Column, category: Column, description: Column, cleaned: Column) -> Column:
    """Prefix a cleaned note with its header lines."""
    described = F.coalesce(description, F.lit(""))
    header = F.concat(
        F.lit("chart time: "), F.lower(charttime),
        F.lit("\nnote category: "), F.lower(F.coalesce(category, F.lit(""))), F.lit("\n"),
    )
    extra = F.when(
        described.rlike(rf"\A{SPACE}*\z"), F.lit("")
    ).otherwise(F.concat(F.lit("note category description: "), F.lower(described), F.lit("\n")))
    return F.concat(header, extra, cleaned)


def pair_key(row_id: Column, subject_id: Column, hadm_id: Column) -> Column:
    return F.concat_ws("_", row_id, subject_id, hadm_id)


def space_words(col: Column) -> Column:
    """Number of pieces between single spaces; an empty text counts one."""
    return F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit(""))) + 1


def count_tokens(col: Column) -> Column:
    """Default token counter: runs of non-space characters."""
    return F.regexp_count(col, F.lit(r"\S+"))


def one_of(col: Column, names) -> Column:
    """Membership in a fixed list of one-line names, passed as one literal."""
    return F.array_contains(F.split(F.lit("\n".join(names)), "\n"), col)


def is_upper(col: Column) -> Column:
    """At least one cased character and no lower-cased one."""
    return (F.upper(col) == col) & (F.lower(col) != col)
