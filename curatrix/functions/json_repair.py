"""JSON from model output: fenced, direct, outermost braces, prefilled, and the fall-back chain of captions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _object(text: Column) -> Column:
    """Text if it parses as a JSON object, else null."""
    v = F.try_parse_json(text)
    return F.when(v.isNotNull() & F.startswith(F.trim(text), F.lit("{")), text)


def extract_object(raw: Column) -> Column:
    """The JSON object in model output as text: inside a code fence, the whole, or between the outermost braces; else null.

    Fence and braces are found by position: what stands between the first two fences, less a language
    label, and what stands from the first opening to the last closing brace.
    """
    t = F.trim(raw)
    inside = F.trim(F.ltrim(F.try_element_at(F.split(t, "```"), F.lit(2)), F.lit("jsonJSON")))
    first, back = F.instr(t, "{"), F.instr(F.reverse(t), "}")
    outer = F.when((first > 0) & (back > 0), F.substring(t, first, F.length(t) - back - first + 2))
    return F.coalesce(_object(inside), _object(t), _object(F.trim(t, F.lit("` "))), _object(outer))


def repair_prefilled(raw: Column) -> Column:
    """Output of a model prefilled with '{': the brace put back and parsed; null if it still is no object."""
    t = F.trim(raw)
    return _object(F.when(F.startswith(t, F.lit("{")), t).otherwise(F.concat(F.lit("{"), t)))


def field(json: Column, name: str) -> Column:
    """A string field of a JSON object, null if absent, null or blank."""
    return F.nullif(F.trim(F.get_json_object(json, f"$.{name}")), F.lit(""))


def caption_of_tier(raw: Column, tier: str, extracted: Column | None = None) -> Column:
    """The caption of a tier, else the dense, mid and short ones, else the description, else the raw text.

    Give extract_object of the raw text as ``extracted``, from a projection below, so that it is made once.
    """
    j = extract_object(raw) if extracted is None else extracted
    chain = [f"caption_{tier}", "caption_dense", "caption_mid", "caption_short", "description"]
    return F.coalesce(*[field(j, n) for n in dict.fromkeys(chain)], F.trim(raw))
