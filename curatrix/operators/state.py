"""Append-only item state: the current row of every key, by one partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_rows(df: DataFrame, key: str, order: Sequence[str], columns: dict[str, Column | str] | None = None) -> DataFrame:
    """One row per non-null ``key``: the one with the greatest ``order`` tuple (nulls lowest).

    Only ``columns`` (default: all) travel through the shuffle. ``max_by`` is combined map-side, so a key
    holding a third of all rows sends one row per input partition. Rows with a null key name no item and
    have no current row; an empty table gives an empty result.
    """
    picked = columns if columns is not None else {c: c for c in df.columns if c != key}
    payload = F.struct(*[(F.col(f"`{v}`") if isinstance(v, str) else v).alias(k) for k, v in picked.items()])
    rank = F.struct(*[F.col(f"`{c}`") for c in order])
    best = df.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`")).agg(F.max_by(payload, rank).alias("__row"))
    return best.select(F.col(f"`{key}`"), *[F.col(f"__row.`{k}`").alias(k) for k in picked])
