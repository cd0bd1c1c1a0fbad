"""Frequency of every distinct term, with marks for the too rare and the too common."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import fold

_DIVIDERS = re.compile(r"[,;|]")
_AS_BLANK = re.compile(r"[_-]+")
#: Punctuation that may close a written form without being part of the term.
CLOSING = ".,;:!?…·'\"’”»)]}"


@lru_cache(maxsize=200_000)
def element_terms(element: str) -> tuple[str, ...]:
    """The terms that one written element holds, in order, repeats kept."""
    out = []
    for part in _DIVIDERS.split(element):
        s = fold(_AS_BLANK.sub(" ", part))
        while True:
            t = s.lstrip("#").rstrip(CLOSING).strip()
            if t == s:
                break
            s = t
        if s:
            out.append(s)
    return tuple(out)


def _counted(dimensions: list[str], flush_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str | None], list[int]] = {}

        def emit() -> pa.RecordBatch:
            keys = list(held)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.string()),
                    pa.array([held[k][0] for k in keys], pa.int64()),
                    pa.array([held[k][1] for k in keys], pa.int64()),
                ],
                names=["dimension", "term", "occurrences", "records"],
            )
            held.clear()
            return out

        for batch in batches:
            for d, column in zip(dimensions, batch.columns):
                for elements in column.to_pylist():
                    if not elements:
                        continue
                    counts = Counter(t for e in elements if e is not None for t in element_terms(e))
                    if not counts:
                        continue
                    counts_of = list(counts.items())
                    counts_of.append((None, sum(counts.values())))
                    for term, n in counts_of:
                        slot = held.get((d, term))
                        if slot is None:
                            held[(d, term)] = [n, 1]
                        else:
                            slot[0] += n
                            slot[1] += 1
            if len(held) >= flush_at:
                yield emit()
        if held:
            yield emit()

    return run


def partial_counts(df: DataFrame, dimensions: dict[str, Column], flush_at: int = 100_000) -> DataFrame:
    """(dimension, term, occurrences, records) per input partition, combined by hash before any shuffle.

    ``dimensions`` maps a name to an array<string> column; a record is a row. The row with a null term
    counts the records that hold any term of the dimension. The table in memory is emptied whenever it
    passes ``flush_at`` terms, so its size does not grow with the data.
    """
    names = list(dimensions)
    arrays = df.select(*[c.alias(f"d{i}") for i, c in enumerate(dimensions.values())])
    return arrays.mapInArrow(_counted(names, flush_at), "dimension string, term string, occurrences long, records long")


def term_frequencies(parts: list[DataFrame], rare_at_most: int = 2, common_above: float = 0.3) -> DataFrame:
    """Every distinct term with occurrences, records, record_share and mark (rare, common or null).

    ``parts`` are results of partial_counts. rare: in at most ``rare_at_most`` records; common: not rare
    and in more than ``common_above`` of the dimension's records that hold any term. Null, blank and
    divider-only elements hold no term; a record repeating a term counts once as a record and each time
    as an occurrence; without records the result is empty. The joined totals have one row per dimension.
    """
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    summed = whole.groupBy("dimension", "term").agg(
        F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"), F.bool_or(F.col("term").isNull()).alias("is_total")
    )
    # Both sides filter on an aggregate and keep every column, so they read one and the same exchange.
    totals = summed.where("is_total").select("dimension", F.col("occurrences").alias("dimension_occurrences"), F.col("records").alias("dimension_records"))
    share = F.col("records") / F.col("dimension_records")
    mark = F.when(F.col("records") <= rare_at_most, "rare").when(share > common_above, "common")
    return (
        summed.where(~F.col("is_total"))
        .join(F.broadcast(totals), "dimension")
        .select("dimension", "term", "occurrences", "records", "dimension_occurrences", "dimension_records", share.alias("record_share"), mark.alias("mark"))
    )
