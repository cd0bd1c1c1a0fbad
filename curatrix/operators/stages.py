"""Predicates on the map of stage states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_status(stages: Column, stage: str, *status: str) -> Column:
    """Whether a stage has one of the given states; an absent stage has none."""
    return F.coalesce(F.try_element_at(stages, F.lit(stage)).isin(*status), F.lit(False))


def is_rejected(stages: Column, reasons: Column, rules: dict[str, tuple[str, ...]]) -> Column:
    """Whether a stage is in a rejecting state of ``rules`` or any reason is recorded."""
    out = F.coalesce(F.size(reasons) > 0, F.lit(False))
    for stage, states in rules.items():
        out = out | has_status(stages, stage, *states)
    return out
