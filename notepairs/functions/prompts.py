"""Prompt, chat and response texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def render(template: str, *values: Column) -> Column:
    """Fill the ``{}`` places of a template in order; values are taken literally."""
    pieces = template.split("{}")
    if len(pieces) != len(values) + 1:
        raise ValueError(f"template has {len(pieces) - 1} places, got {len(values)} values")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        parts += [F.coalesce(value.cast("string"), F.lit("")), F.lit(piece)]
    return F.concat(*parts)


def inference_template(template: str) -> str:
    """A training template without the answer place at its end."""
    if not template.endswith("{}"):
        raise ValueError("the template must end with the answer place")
    return template[:-2]


def with_eos(text: Column, eos: str) -> Column:
    return F.concat(text, F.lit(eos))


def chat(system: Column, user: Column) -> Column:
    """A system turn and a user turn."""
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(turn("system", system), turn("user", user))


def render_chat(turns: Column, *, before: str = "<|", between: str = "|>\n", after: str = "\n") -> Column:
    """One string for an array of ``role`` and ``content`` structs."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(F.lit(before), t["role"], F.lit(between), t["content"], F.lit(after)),
        ),
        "",
    )


def join_outputs(outputs: Column) -> Column:
    return F.array_join(outputs, " ")


def response_body(response: Column) -> Column:
    """A chat response without its first two lines."""
    return F.regexp_replace(response, r"\A(?:[^\n]*\n[^\n]*\n|[^\n]*(?:\n[^\n]*)?\z)", "")


def prompt_part(text: Column, marker: str) -> Column:
    """Text up to and with the response marker; all of it where there is none."""
    at = F.locate(marker, text)
    return F.when(at == 0, text).otherwise(F.substring(text, F.lit(1), at + len(marker) - 1))


def completion_part(text: Column, marker: str) -> Column:
    """Text after the response marker: the part that counts for the loss."""
    at = F.locate(marker, text)
    return F.when(at == 0, F.lit("")).otherwise(F.substring(text, at + len(marker), F.length(text)))
