"""Gates that record every reason for a rejection and never drop a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(*checks: tuple[Column, str | Column]) -> Column:
    """The reasons whose condition holds, in order; a null condition doesn't hold."""
    listed = [F.when(cond, F.lit(r) if isinstance(r, str) else r) for cond, r in checks]
    return F.filter(F.array(*listed), lambda r: r.isNotNull())


def add_reasons(present: Column, new: Column) -> Column:
    """Union without repeats; a null list is empty."""
    empty = F.array().cast("array<string>")
    return F.array_union(F.coalesce(present, empty), F.coalesce(new, empty))


def clear_reasons(present: Column, prefixes: Sequence[str], exact: Sequence[str] = ()) -> Column:
    """The reasons that start with none of ``prefixes`` and equal none of ``exact``."""
    starts = lambda r: F.exists(F.array(*[F.lit(p) for p in prefixes]), lambda p: F.startswith(r, p))
    return F.filter(present, lambda r: ~starts(r) & ~r.isin(*exact) if exact else ~starts(r))


def within_vocabulary(rows: DataFrame, vocabulary: DataFrame, defaults: Mapping[str, str | None]) -> DataFrame:
    """``rows`` with each column of ``defaults`` as the term of its dimension, else its default.

    ``vocabulary`` is (dimension, term), configuration of fixed size; a column is checked against the
    dimension of its name, in lower case with blanks and hyphens as '_'. Other columns and all rows stay.
    """
    for column, default in defaults.items():
        known = f"_known_{column}"
        terms = vocabulary.where(F.col("dimension") == column).select(F.col("term").alias(known)).distinct()
        folded = F.lower(F.regexp_replace(F.trim(column), "[ _-]+", "_"))
        rows = rows.join(terms, folded == F.col(known), "left").withColumn(column, F.coalesce(known, F.lit(default))).drop(known)
    return rows


def resolution_gate(width: Column, height: Column, least_megapixels: float) -> tuple[Column, Column]:
    """(accepted, megapixels): false and 0.0 for a missing or non-positive edge."""
    valid = F.coalesce((width > 0) & (height > 0), F.lit(False))
    mp = F.when(valid, width.cast("double") * height / 1e6).otherwise(F.lit(0.0))
    return valid & (mp >= least_megapixels), mp


def quality_reasons(width: Column, height: Column, laplacian: Column, watermark: Column, least_edge: int = 512, least_laplacian: float = 100.0, watermark_detail: Column | None = None) -> Column:
    """min_edge_below_n, blurry_laplacian_low and watermark_detected_detail, all that apply (fixed values: the names)."""
    detail = F.coalesce(watermark_detail if watermark_detail is not None else F.lit(None).cast("string"), F.lit("unspecified"))
    return reasons(
        (F.least(width, height) < least_edge, f"min_edge_below_{least_edge}"),
        (laplacian < least_laplacian, "blurry_laplacian_low"),
        (watermark, F.concat(F.lit("watermark_detected_"), detail)),
    )


#: Fixed value: openings of a model's refusal.
REFUSALS = (r"(?i)\bi (?:cannot|can't|am unable to|won't)\b", r"(?i)\bas an ai\b", r"(?i)^i'?m sorry\b")


def invalid_reason(description: Column, required: dict[str, Column], least_chars: int = 25, refusals: Sequence[str] = REFUSALS) -> Column:
    """The first of: missing fields, too short a description, a refusal; null if valid."""
    missing = F.filter(F.array(*[F.when(c.isNull(), F.lit(n)) for n, c in required.items()]), lambda x: x.isNotNull())
    text = F.coalesce(F.trim(description), F.lit(""))
    refused = F.exists(F.array(*[F.regexp_like(text, F.lit(p)) for p in refusals]), lambda x: x)
    return (
        F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ",")))
        .when(F.length(text) < least_chars, F.concat(F.lit("short:"), F.length(text).cast("string")))
        .when(refused, "refusal")
    )


def screening_reasons(age: Column, uncertain: Column, watermark: Column, text: Column, quality: Column, provenance: Column, least_age: int = 25) -> Column:
    """Fail-closed screening: what is missing, not a whole number or uncertain is a reason.

    ``least_age`` may be raised, never below 25; there is no switch that turns a check off. An estimate is
    no proof of age, so rows also need a true provenance flag.
    """
    if least_age < 25:
        raise ValueError("least_age may not be below 25")
    number = F.when(F.regexp_like(F.trim(age.cast("string")), F.lit(r"^\d{1,3}$")), F.trim(age.cast("string")).cast("int"))
    return reasons(
        (number.isNull(), "screening_invalid_age_value"),
        (number < least_age, f"screening_age_under_{least_age}"),
        (F.coalesce(uncertain, F.lit(True)), "screening_uncertain_age"),
        (F.coalesce(watermark, F.lit(True)), "screening_watermark_present"),
        (F.coalesce(text, F.lit(True)), "screening_text_present"),
        (F.coalesce(F.lower(F.trim(quality)) == "low", F.lit(True)), "screening_low_quality"),
        (~F.coalesce(provenance, F.lit(False)), "screening_no_provenance"),
    )


def least_bytes(content: Column, least: int = 15 * 1024) -> Column:
    """Whether a payload is large enough; a missing one isn't."""
    return F.coalesce(F.length(content) >= least, F.lit(False))


def is_picture_url(url: Column, suffixes: Sequence[str] = (".jpg", ".jpeg", ".png", ".webp", ".bmp"), skip: str = r"(?i)avatar|banner|smil(?:ey|ies)|logo") -> Column:
    """Whether an address ends in a picture's suffix and isn't a page decoration."""
    from curatrix.functions.scalars import url_suffix

    return F.coalesce(url_suffix(url).isin(*suffixes) & ~F.regexp_like(url, F.lit(skip)), F.lit(False))
