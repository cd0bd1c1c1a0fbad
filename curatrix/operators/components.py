"""Connected components: union-find inside every task, then star steps between tasks where many edges are left."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.session import cut_lineage


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links each vertex's neighbours to the least of them and itself; large: the greater ones only, small: the rest."""
    if large:
        spread = pairs.select(F.col("u").alias("x"), F.col("v").alias("n")).union(pairs.select(F.col("v").alias("x"), F.col("u").alias("n")))
    else:
        spread = pairs.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("n"))
    least = spread.groupBy("x").agg(F.min("n").alias("m")).select("x", F.least("x", "m").alias("m"))
    joined = spread.join(least, "x")
    kept = joined.where(F.col("n") > F.col("x")) if large else joined
    out = kept.select(F.col("n").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(least.select(F.col("x").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _forest(flush_at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Edges (u, v) of a task as stars (vertex, least vertex it is linked to), emptied at ``flush_at`` vertices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}
        schema = None

        def root(x):
            while (p := parent[x]) != x:
                parent[x] = x = parent[p]
            return x

        def emit() -> pa.RecordBatch:
            child = [x for x in parent if parent[x] != x]
            out = pa.RecordBatch.from_arrays([pa.array(child, schema.field(0).type), pa.array([root(x) for x in child], schema.field(1).type)], names=["u", "v"])
            parent.clear()
            return out

        for batch in batches:
            schema = batch.schema
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parent.setdefault(u, u)
                parent.setdefault(v, v)
                a, b = root(u), root(v)
                if a < b:
                    parent[b] = a
                elif b < a:
                    parent[a] = b
            if len(parent) >= flush_at:
                yield emit()
        if parent:
            yield emit()

    return run


def connected_components(pairs: DataFrame, a: str = "a", b: str = "b", at_once: int = 500_000, max_rounds: int = 50) -> DataFrame:
    """(id, component) of every id in ``pairs``; component is the least id. Nulls and self-pairs link nothing.

    Every input partition is first reduced to a forest by union-find, before any shuffle. If no more than
    ``at_once`` edges are left, which bounds the task, one more union-find ends it; else large-star and
    small-star steps go on until the edges no longer change. Running out of rounds is an error, never a
    silent stop. Every round is cut off by a reliable checkpoint. Hot vertices: the least neighbour is found
    by a partial aggregation and the join is left to adaptive skew splitting.
    """
    links = pairs.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    kind = f"u {links.schema['u'].dataType.simpleString()}, v {links.schema['v'].dataType.simpleString()}"
    edges = cut_lineage(links.mapInArrow(_forest(at_once), kind))
    if edges.count() <= at_once:
        stars = cut_lineage(edges.coalesce(1).mapInArrow(_forest(1 << 62), kind))
        return _labelled(stars)
    edges = cut_lineage(edges.distinct())
    signature = None
    for _ in range(max_rounds):
        edges = cut_lineage(_star(_star(edges, True), False))
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == signature:
            return _labelled(edges)
        signature = tuple(row)
    raise RuntimeError(f"components still changed after {max_rounds} rounds")


def _labelled(stars: DataFrame) -> DataFrame:
    """(id, component) of star edges and their centres."""
    centres = stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).union(centres)


def display_label(rank: Column) -> Column:
    """cluster_0001 and so on from a rank."""
    return F.format_string("cluster_%04d", rank)
