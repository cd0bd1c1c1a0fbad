"""Distributions, dominance and balancing weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Aspect-ratio buckets, closed intervals, tried in this order.
ASPECT_BUCKETS = (
    ("1:1", ((0.95, 1.05),)),
    ("4:3", ((0.70, 0.80), (1.25, 1.40))),
    ("16:9", ((0.50, 0.65), (1.70, 1.85))),
)


def stage_status_counts(df: DataFrame, stages: str = "stages_status") -> DataFrame:
    """(stage, status, n) over all entries of a map column."""
    return df.select(F.explode(stages).alias("stage", "status")).groupBy("stage", "status").agg(F.count(F.lit(1)).alias("n"))


def reason_histogram(df: DataFrame, reasons: str = "rejection_reasons") -> DataFrame:
    """(reason, n) over all elements of an array column; null lists and elements hold none."""
    return df.select(F.explode(reasons).alias("reason")).where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def distributions(df: DataFrame, dimensions: Sequence[str], default: str = "other") -> DataFrame:
    """(dimension, value, n) of several columns in one pass by grouping sets; null counts as ``default``."""
    filled = df.select(*[F.coalesce(F.col(d), F.lit(default)).alias(d) for d in dimensions])
    sets = filled.groupingSets([[F.col(d)] for d in dimensions], *[F.col(d) for d in dimensions]).agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    full = (1 << len(dimensions)) - 1
    for i, d in enumerate(dimensions):
        here = F.col("g") == (full ^ (1 << (len(dimensions) - 1 - i)))
        name, value = F.when(here, F.lit(d)).otherwise(name), F.when(here, F.col(d)).otherwise(value)
    return sets.select(name.alias("dimension"), value.alias("value"), "n")


def cross_tab(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Counts of every combination and sub-total; a null dimension in the result is its total."""
    filled = df.select(*[F.coalesce(F.col(d), F.lit("other")).alias(d) for d in dimensions])
    return filled.cube(*dimensions).agg(F.count(F.lit(1)).alias("n"))


def aspect_bucket(ratio: Column) -> Column:
    """The bucket of a width to height ratio; null and 0 count as 1."""
    r = F.coalesce(F.nullif(ratio, F.lit(0.0)), F.lit(1.0))
    out = F.lit("other")
    for label, spans in reversed(ASPECT_BUCKETS):
        hit = F.lit(False)
        for low, high in spans:
            hit = hit | r.between(low, high)
        out = F.when(hit, label).otherwise(out)
    return out


def aspect_histogram(df: DataFrame, ratio: str = "aspect_ratio") -> DataFrame:
    """(bucket, n), every bucket present, empty ones with 0."""
    counts = [F.count_if(aspect_bucket(F.col(ratio)) == label).alias(label) for label in [*(b for b, _ in ASPECT_BUCKETS), "other"]]
    labels = [b for b, _ in ASPECT_BUCKETS] + ["other"]
    return df.agg(*counts).select(F.inline(F.array(*[F.struct(F.lit(x).alias("bucket"), F.col(f"`{x}`").alias("n")) for x in labels])))


def dominance(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """(value, n, ratio to 3 decimals) of the values whose share of all rows is above ``threshold``, strictly.

    The total is counted first (from file footers, for a plain table) and enters the plan as a number.
    """
    total = max(1, df.count())
    counts = df.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") / total > threshold).select("value", "n", F.bround(F.col("n") / total, 3).alias("ratio"))


def remaining_quota(df: DataFrame, category: str, quota: int) -> DataFrame:
    """(category, present, missing): rows of each category and how many more its quota lets in; null is 'unknown'."""
    counts = df.groupBy(F.coalesce(F.col(category), F.lit("unknown")).alias("category")).agg(F.count(F.lit(1)).alias("present"))
    return counts.withColumn("missing", F.greatest(F.lit(0), F.lit(quota) - F.col("present")))


def repeats(counts: DataFrame, n: str = "n", max_factor: float = 4.0) -> DataFrame:
    """Integer repeats that even out categories: greatest count over own, half-even, from 1 to ``max_factor``.

    ``counts`` has one row per category; effective = count * repeats.
    """
    greatest = F.max(n).over(Window.partitionBy())
    factor = F.least(F.lit(int(max_factor)), F.greatest(F.lit(1), F.bround(greatest / F.nullif(F.col(n), F.lit(0)), 0).cast("int")))
    rep = F.when(F.col(n) > 0, factor).otherwise(F.lit(1))
    return counts.withColumn("repeats", rep).withColumn("effective", F.col(n) * F.col("repeats"))


def tier_stats(df: DataFrame, tier: str, words: Column) -> DataFrame:
    """Per tier: rows, percent of all, average words and the tokens they stand for."""
    g = df.groupBy(tier).agg(F.count(F.lit(1)).alias("n"), F.sum(words).alias("w"))
    total = F.sum("n").over(Window.partitionBy())  # one row per tier
    return g.select(tier, "n", F.bround(100.0 * F.col("n") / total, 1).alias("pct"), (F.col("w") / F.col("n")).alias("avg_words"), F.floor(F.col("w") / F.col("n") * F.lit(1.35)).alias("avg_tokens"))
