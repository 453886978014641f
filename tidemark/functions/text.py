"""Prompt text, reply text and simple text checks as column expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: words that show an explanation names a consequence.
RISK_WORDS = "risk|impact|audit|report|decision"


def as_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Fill ``{name}`` places of a template from columns; NULL prints as empty text."""
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [F.lit(p) if i % 2 == 0 else as_text(values[p]) for i, p in enumerate(parts)]
    return F.concat(*pieces)


def reply_text(reply: Column) -> Column:
    """The answer inside a model reply.

    A JSON list yields its first non-blank element of type ``text``. Any other
    reply is returned with runs of white space made one blank.
    """
    blocks = F.from_json(reply, "array<string>")
    texts = F.transform(
        F.filter(blocks, lambda b: F.get_json_object(b, "$.type") == "text"),
        lambda b: _strip(F.get_json_object(b, "$.text")),
    )
    first = F.get(F.filter(texts, lambda t: F.length(t) > 0), F.lit(0))
    flat = F.trim(F.regexp_replace(reply, r"\s+", " "))
    is_list = reply.rlike(r"^\s*\[")
    return F.coalesce(F.when(is_list, first), flat, F.lit(""))


def second_block_text(reply: Column) -> Column:
    """Text of the second element of a JSON list reply."""
    return F.get_json_object(F.get_json_object(reply, "$[1]"), "$.text")


def _strip(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def names_risk(text: Column) -> Column:
    return F.lower(text).rlike(RISK_WORDS)


def mentions(text: Column, word: Column) -> Column:
    return F.instr(F.lower(text), F.lower(word)) > 0
