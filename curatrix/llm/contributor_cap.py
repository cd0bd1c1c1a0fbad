"""Capping the records of dominant contributors by bounded heaps that merge in a tree."""

from __future__ import annotations

import heapq
import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from curatrix.llm.common import fold, is_hostile

#: Titles that name no set.
NO_TITLE = {"", "untitled", "unknown", "n/a", "-"}
_PAGE = re.compile(r"[\s\-–—|,;:·•(\[{/]*\bpage\s*\d+(?:\s*(?:of|/)\s*\d+)?\s*[)\]}]*\s*$")
_ENTITY = re.compile(r"&[A-Za-z0-9#]+;?")
_JOINER = re.compile(r"[\s_-]+")


def _entity(m: re.Match) -> str:
    out = html.unescape(m.group())
    return html.unescape(m.group().lower()) if out == m.group() else out


def title_key(title: str | None) -> str | None:
    """The name of the set that a title gives, or None if it names none."""
    if title is None:
        return None
    s = fold(_ENTITY.sub(_entity, title))
    while (cut := _PAGE.sub("", s)) != s:
        s = cut
    return None if s in NO_TITLE else s


def category_key(category: str | None) -> str | None:
    """One spelling per category; None for a missing one, which counts as a category of its own."""
    s = _JOINER.sub("", fold(category)) if category is not None else ""
    return s or None


def _set_names(category: pd.Series, title: pd.Series) -> pd.Series:
    out = []
    for c, t in zip(category, title):
        t = title_key(t if isinstance(t, str) else None)
        if t is None:
            out.append(None)
        else:
            k = category_key(c if isinstance(c, str) else None)
            out.append(("0" if k is None else "1" + k) + "\x1f" + t)
    return pd.Series(out, dtype=object)


def set_name(category: str, title: str) -> Column:
    """Set within category as one string, by Arrow batches; null for rows that belong to no set."""
    # Marked so that filters on the name are not pushed below it, which would run it again for each.
    return pandas_udf(_set_names, "string").asNondeterministic()(F.col(f"`{category}`"), F.col(f"`{title}`"))


class _Worst:
    """Heap item whose smallest is the worst kept: low score first, then the greater id."""

    __slots__ = ("id", "score")

    def __init__(self, score: float | None, ident: str):
        self.score, self.id = float("-inf") if score is None else score, ident

    def __lt__(self, other: _Worst) -> bool:
        return (self.score, other.id) < (other.score, self.id)


def _heaps(cap: int, flush_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[str, list[_Worst]] = {}
        held = 0

        def emit() -> pa.RecordBatch:
            groups = [g for g, h in heaps.items() for _ in h]
            items = [x for h in heaps.values() for x in h]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(groups, pa.string()),
                    pa.array([None if x.score == float("-inf") else x.score for x in items], pa.float64()),
                    pa.array([x.id for x in items], pa.string()),
                ],
                names=["g", "score", "id"],
            )
            heaps.clear()
            return out

        for batch in batches:
            for g, score, ident in zip(*(c.to_pylist() for c in batch.columns)):
                h = heaps.setdefault(g, [])
                if len(h) < cap:
                    heapq.heappush(h, _Worst(score, ident))
                    held += 1
                elif h[0] < (x := _Worst(score, ident)):
                    heapq.heapreplace(h, x)
            if held >= flush_at:
                yield emit()
                held = 0
        if heaps:
            yield emit()

    return run


def kept_by_heap(df: DataFrame, cap: int, fan_in: int = 32, flush_at: int = 400_000) -> DataFrame:
    """The ``cap`` best (g, score, id) of each g, from rows (g, score, id) with distinct ids.

    Heaps of at most ``cap`` pairs are filled on the map side, merged once by (g, one of ``fan_in``
    hash branches) and once by g. A group with a third of all rows therefore reaches its last task as
    fan_in * cap pairs at most. A task emptying its heaps at ``flush_at`` pairs only sends pairs on that
    a later merge drops.
    """
    schema = "g string, score double, id string"
    heap = _heaps(cap, flush_at)
    branch = F.pmod(F.xxhash64("id"), F.lit(fan_in))
    first = df.select("g", "score", "id").mapInArrow(heap, schema)
    second = first.repartition(F.col("g"), branch).mapInArrow(heap, schema)
    # The last merge is exact, so it holds whole groups: a window ranks each group's few remaining pairs.
    order = Window.partitionBy("g").orderBy(F.col("score").desc_nulls_last(), F.col("id"))
    return second.withColumn("r", F.row_number().over(order)).where(F.col("r") <= cap).drop("r")


def split_by_cap(
    df: DataFrame, group: str, ident: str, score: str, cap: int | None = None, share: float | None = None, beyond: bool = False
) -> DataFrame:
    """The records of ``df`` kept under the cap, or with ``beyond`` those past it; every column stays.

    Each non-null ``group`` keeps its ``cap`` best records by ``score`` (nulls and NaN last), ties to the smaller
    ``ident``; with ``share`` instead, the cap is that share of all grouped records, rounded down, 1 at
    least. Records of a null group have no contributor: always kept, never beyond. ``ident`` must be
    unique; records with a null ident cannot be ranked and count as beyond every cap. An empty table
    gives an empty result.
    """
    if (cap is None) == (share is None):
        raise ValueError("give either cap or share")
    name = next(n for n in ("__kept", "__kept_id", "__kept_ident") if not is_hostile(n, set(df.columns)))
    grouped = df.where(F.col(f"`{group}`").isNotNull())
    if cap is None:
        cap = max(1, int(grouped.count() * share))
    number = F.col(f"`{score}`").cast("double")
    pairs = grouped.where(F.col(f"`{ident}`").isNotNull()).select(
        F.col(f"`{group}`").cast("string").alias("g"), F.when(~F.isnan(number), number).alias("score"), F.col(f"`{ident}`").cast("string").alias("id")
    )
    kept = kept_by_heap(pairs, cap).select(F.col("id").alias(name))
    on = F.col(f"`{ident}`").cast("string") == F.col(name)
    if beyond:
        return grouped.join(kept, on, "left_anti")
    free = df.where(F.col(f"`{group}`").isNull())
    return grouped.join(kept, on, "left_semi").unionByName(free)
