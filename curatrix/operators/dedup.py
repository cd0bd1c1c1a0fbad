"""Choosing and spreading within duplicate groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.scalars import already_updated, sign_count, word_count

_DOUBLE = r"(?i)\.(?:jpe?g|png|webp|bmp)\.(?:jpe?g|png|webp|bmp)$"


def best_of(df: DataFrame, group: Sequence[str], rank: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """One row per group, the least by ``rank``; a partial aggregation, so hot groups are combined map-side."""
    best = F.min_by(F.struct(*columns), F.struct(*[r.alias(f"r{i}") for i, r in enumerate(rank)]))
    return df.groupBy(*group).agg(best.alias("__best"), F.count(F.lit(1)).alias("members")).select(*group, "__best.*", "members")


def primary_rank(path: Column, caption: Column) -> list[Column]:
    """Visible before hidden folders, single before double extension, more words, shorter name, shorter path, path."""
    name = F.element_at(F.split(path, "/"), -1)
    hidden = F.regexp_like(path, F.lit(r"(?:^|/)\.[^/]*/"))
    return [hidden.cast("int"), F.regexp_like(name, F.lit(_DOUBLE)).cast("int"), -word_count(caption), F.length(name), F.length(path), path]


def best_updated_caption(df: DataFrame, key: str, caption: str, has_backup: Column, position: str, token_threshold: int = 400) -> DataFrame:
    """Per key the updated caption with most words, the first position on a tie; keys without one are left out.

    Words and signs are counted once a row: a filter on them would be pushed below and count again, so rows
    that aren't updated have no rank instead.
    """
    c, words, signs = F.col(caption), F.col("__words"), F.col("__signs")
    counted = df.select(key, caption, position, has_backup.alias("__backup"), word_count(c).alias("__words"), sign_count(c).alias("__signs"))
    updated = already_updated(c, F.col("__backup"), token_threshold, words=words, signs=signs)
    rank = F.when(updated, F.struct(words, -F.col(position)))
    return counted.groupBy(key).agg(F.max_by(caption, rank).alias("best_caption")).where(F.col("best_caption").isNotNull())


def fan_out(members: DataFrame, primaries: DataFrame, key: str) -> DataFrame:
    """Every member with its group's chosen columns; ``primaries`` has one row per key."""
    return members.join(primaries, key, "left")
