"""Consolidating pairwise matches into groups: union-find on a two-dimensional grid of edge blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.session import cut_lineage

#: A vertex on the wire: its hash decides the order, so that chains shrink whatever their ids look like.
_VERTEX = "struct<h:bigint,id:string>"
#: Most rows of block sizes that are broadcast, about 30 MB; a larger grid joins them by a shuffle.
BROADCAST_BLOCKS = 1_000_000


def union_find(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least vertex number linked to each of 0..n-1 by the edges (a, b), with path halving."""
    parent = list(range(n))
    for x, y in zip(a.tolist(), b.tolist()):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x < y:
            parent[y] = x
        elif y < x:
            parent[x] = y
    out = np.array(parent)
    while True:
        up = out[out]
        if (up == out).all():
            return out
        out = up


def _block(table: pa.Table) -> pa.Table:
    """Star edges (vertex, representative) of one grid block."""
    h = np.concatenate([table["uh"].to_numpy(), table["vh"].to_numpy()])
    ids = np.concatenate([np.asarray(table["u"].to_pylist(), dtype=object), np.asarray(table["v"].to_pylist(), dtype=object)])
    order = sorted(set(zip(h.tolist(), ids.tolist())))
    number = {v: i for i, v in enumerate(order)}
    ends = np.fromiter((number[v] for v in zip(h.tolist(), ids.tolist())), dtype=np.int64, count=len(h))
    root = union_find(ends[: table.num_rows], ends[table.num_rows :], len(order))
    child = np.nonzero(root != np.arange(len(order)))[0]
    return pa.table(
        {
            "uh": pa.array([order[i][0] for i in child], pa.int64()),
            "u": pa.array([order[i][1] for i in child], pa.string()),
            "vh": pa.array([order[i][0] for i in root[child]], pa.int64()),
            "v": pa.array([order[i][1] for i in root[child]], pa.string()),
        }
    )


def _in_grid(edges: DataFrame, blocks: int, per_block: int) -> DataFrame:
    """Edges with their block: (row, column) of the end points' hashes, hot blocks split by a salt.

    The block sizes brought along are at most blocks² rows; they are broadcast up to BROADCAST_BLOCKS.
    """
    row, column = F.pmod("uh", F.lit(blocks)), F.pmod("vh", F.lit(blocks))
    placed = edges.withColumns({"i": F.least(row, column), "j": F.greatest(row, column)})
    sizes = placed.groupBy("i", "j").agg(F.ceil(F.count(F.lit(1)) / F.lit(per_block)).alias("parts"))
    salt = F.pmod(F.xxhash64("u", "v"), F.col("parts"))
    sizes = F.broadcast(sizes) if blocks * blocks <= BROADCAST_BLOCKS else sizes
    return placed.join(sizes, ["i", "j"]).select("uh", "u", "vh", "v", "i", "j", salt.alias("s"))


def connected_groups(pairs: DataFrame, a: str = "a", b: str = "b", edges_per_block: int = 50_000, max_rounds: int = 60) -> DataFrame:
    """(id, group_id) of every id that ``pairs`` link to another; group_id is the group's smallest id.

    Ids are strings; pairs with a null end or both ends equal link nothing; turned and repeated pairs
    count once; no pair gives no row. Each round lays the edges on a grid of vertex blocks (side
    sqrt(edges / edges_per_block)), runs union-find inside every block and exchanges representatives: the
    least representative that a vertex has in its row and column becomes its parent. A vertex whose
    parent is represented by nobody leaves, its edges passing to the parent; the rest stays for the next
    round until no edge is left. Vertices are ordered by hash, so that even a chain of rising ids or a
    dense graph loses a constant fraction per round. A vertex in a third of all pairs is spread over its row and column, and
    a block with more edges than planned is split by a salt. Nothing is collected to the driver but the
    number of edges; every round is cut off by a reliable checkpoint.
    """
    ends = pairs.select(F.col(f"`{a}`").cast("string").alias("u"), F.col(f"`{b}`").cast("string").alias("v")).where(F.col("u") != F.col("v"))
    hashed = ends.select(F.xxhash64("u").alias("uh"), "u", F.xxhash64("v").alias("vh"), "v")
    turned = F.struct("uh", "u") > F.struct("vh", "v")
    edges = cut_lineage(
        hashed.select(
            *[F.when(turned, F.col(x)).otherwise(F.col(y)).alias(n) for x, y, n in (("vh", "uh", "uh"), ("v", "u", "u"), ("uh", "vh", "vh"), ("u", "v", "v"))]
        ).distinct()
    )
    forests: list[DataFrame] = []
    for _ in range(max_rounds):
        n = edges.count()
        if n == 0:
            break
        blocks = max(1, math.ceil(math.sqrt(n / edges_per_block)))
        stars = _in_grid(edges, blocks, edges_per_block).groupBy("i", "j", "s").applyInArrow(_block, "uh long, u string, vh long, v string")
        stars = cut_lineage(stars if n <= edges_per_block else stars.distinct())
        if n <= edges_per_block:  # one block: its representatives are final
            forests.append(stars.select("u", F.col("v").alias("parent")))
            break
        parents = stars.groupBy("uh", "u").agg(F.min(F.struct("vh", "v")).alias("p")).select("uh", "u", F.col("p.vh").alias("ph"), F.col("p.v").alias("p"))
        children = stars.select(F.col("uh").alias("ch"), F.col("u").alias("c")).distinct()
        leaving = cut_lineage(parents.join(children, (F.col("ph") == F.col("ch")) & (F.col("p") == F.col("c")), "left_anti"))
        forests.append(leaving.select("u", F.col("p").alias("parent")))
        moved = leaving.select(F.col("u").alias("c"), "ph", "p")
        for h, x in (("uh", "u"), ("vh", "v")):
            joined = stars.join(moved, F.col(x) == F.col("c"), "left")
            stars = joined.withColumns({h: F.coalesce("ph", h), x: F.coalesce("p", x)}).drop("c", "ph", "p")
        edges = cut_lineage(stars.where(F.col("u") != F.col("v")).distinct())
    else:
        if edges.count():
            raise RuntimeError(f"groups still changed after {max_rounds} rounds")
    if not forests:
        return pairs.sparkSession.createDataFrame([], "id string, group_id string")
    # Parents of a later round are nearer the root: labels are handed down from the last round to the first.
    labels = forests[-1].select(F.col("u").alias("id"), F.col("parent").alias("root"))
    for forest in reversed(forests[:-1]):
        down = forest.join(labels, forest.u == labels.id, "left_anti")
        above = labels.select(F.col("id").alias("parent"), "root")
        labels = labels.unionByName(down.join(above, "parent", "left").select(F.col("u").alias("id"), F.coalesce("root", "parent").alias("root")))
    labels = cut_lineage(labels)
    roots = labels.groupBy("root").agg(F.min("id").alias("least")).select("root", F.least("least", "root").alias("group_id"))
    members = labels.unionByName(roots.select(F.col("root").alias("id"), "root"))
    return members.join(roots, "root").select("id", "group_id")
