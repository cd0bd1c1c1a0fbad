"""One surviving record per duplicate group, chosen field by field in a single aggregation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Attribute:
    """A value to survive: ``value`` goes with the greatest ``rank`` tuple, then the smallest ``tie``."""

    name: str
    value: Column
    rank: Sequence[Column]
    tie: Sequence[Column] = field(default_factory=tuple)


def _reversed(c: Column) -> Column:
    """A number that falls as ``c`` rises; a null (the lowest rank) comes last."""
    return -F.coalesce(F.nanvl(c, F.lit(float("-inf"))), F.lit(float("-inf")))


def survivors(df: DataFrame, group: str, attributes: Sequence[Attribute], at_least: int = 2) -> DataFrame:
    """One row per non-null ``group`` of ``at_least`` rows, each attribute from its own best member.

    One aggregation takes the extreme of a composite struct per attribute: rank columns (numbers; nulls
    and NaN lowest) negated, so that the least struct is the highest rank and ties go to the smallest
    ``tie``. Partial aggregation keeps one struct per attribute, map task and group, so a group with a
    third of all rows costs its last task no more than one row per map task. Rows without a group are in
    no result; repeated rows count as members each; an empty table gives an empty result.
    """
    best = [
        F.min(F.struct(*[_reversed(r.cast("double")) for r in a.rank], *a.tie, a.value.alias("value"))).alias(a.name) for a in attributes
    ]
    grouped = df.where(F.col(f"`{group}`").isNotNull()).groupBy(F.col(f"`{group}`")).agg(*best, F.count(F.lit(1)).alias("__members"))
    return grouped.where(F.col("__members") >= at_least).select(F.col(f"`{group}`"), *[F.col(f"{a.name}.value").alias(a.name) for a in attributes])
