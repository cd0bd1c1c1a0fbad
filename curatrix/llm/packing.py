"""Filling fixed-capacity containers: first-fit decreasing in randomised groups of items."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_OUT = "container_kind string, capacity long, grp long, bin long, item_id long, copy_no long, piece_no long, token_start long, n_tokens long"


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin number per item for sizes already falling, each at most ``capacity``.

    The bins' free room sits in the leaves of a tournament tree whose inner nodes hold the greater of
    their children, so the leftmost bin with enough room is found on one path from the root.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        out.append(node - leaves)
        tree[node] -= size
        node //= 2
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            top = left if left > right else right
            if tree[node] == top:
                break
            tree[node] = top
            node //= 2
    return out


def _pack_group(table: pa.Table) -> pa.Table:
    kind, capacity, group = table["container_kind"][0].as_py(), table["capacity"][0].as_py(), table["grp"][0].as_py()
    items, whole = [], []
    for ident, copy, size in zip(table["item_id"].to_pylist(), table["copy_no"].to_pylist(), table["size"].to_pylist()):
        full = size // capacity if size > capacity else 0
        for piece in range(full):
            whole.append((ident, copy, piece, piece * capacity, capacity))
        if not full or size % capacity:
            items.append((ident, copy, full, full * capacity, size - full * capacity))
    order = lambda x: (-x[4], x[0] is None, x[0] or 0, x[1], x[2])
    items.sort(key=order)
    whole.sort(key=order)
    bins = first_fit_decreasing([x[4] for x in items], capacity)
    rows = list(zip(bins, items)) + list(zip(range(max(bins, default=-1) + 1, len(whole) + max(bins, default=-1) + 1), whole))
    column = lambda i: pa.array([r[1][i] for r in rows], pa.int64())
    same = lambda v, t: pa.array([v] * len(rows), t)
    arrays = [same(kind, pa.string()), same(capacity, pa.int64()), same(group, pa.int64()), pa.array([r[0] for r in rows], pa.int64())]
    names = ["container_kind", "capacity", "grp", "bin", "item_id", "copy_no", "piece_no", "token_start", "n_tokens"]
    return pa.Table.from_arrays([*arrays, *(column(i) for i in range(5))], names=names)


def pack(items: DataFrame, kinds: DataFrame, n_items: int, group_items: int = 5_000, seed: int = 17, max_kinds: int = 1_000) -> DataFrame:
    """Every item (item_id, size) placed in containers of each kind (container_kind, capacity_tokens).

    Columns: container_kind, container_id, capacity, item_id, copy_no, piece_no, token_start, n_tokens. An
    item is split only if it alone exceeds the capacity: full pieces take containers of their own, the
    rest is packed like an item. Items are hashed into groups of about ``group_items`` (``n_items`` is the
    number of rows, which sets the number of groups), each packed by itself; a group wastes at most one
    partly filled container more than packing all at once. Rows equal in id and size are counted before
    the shuffle and numbered as copies, so that repeated rows spread over the groups. Groups come from a
    hash of id, copy and seed alone: a task run again packs the same. A null size is no item; a size of 0
    is placed like any; kinds with a null or non-positive capacity hold nothing; an empty table gives an
    empty result. ``kinds`` is configuration and may have ``max_kinds`` rows at most.
    """
    listed = [(r[0], int(r[1])) for r in kinds.select("container_kind", "capacity_tokens").distinct().limit(max_kinds + 1).collect() if r[1] is not None and r[1] > 0]
    if len(listed) > max_kinds:
        raise ValueError(f"more than {max_kinds} kinds of containers")
    spark = items.sparkSession
    if not listed:
        return spark.createDataFrame([], "container_kind string, container_id string, capacity long, item_id long, copy_no long, piece_no long, token_start long, n_tokens long")
    groups = max(1, -(-n_items // group_items))
    counted = items.where(F.col("size").isNotNull()).groupBy("item_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    copies = counted.select("item_id", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy_no"))
    choice = F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).cast("long").alias("capacity")) for k, c in sorted(listed, key=str)])
    placed = copies.select(
        "item_id", "size", "copy_no", F.pmod(F.xxhash64("item_id", "copy_no", F.lit(seed)), F.lit(groups)).alias("grp"), F.explode(choice).alias("k")
    ).select("item_id", "size", "copy_no", "grp", "k.container_kind", "k.capacity")
    packed = placed.groupBy("container_kind", "capacity", "grp").applyInArrow(_pack_group, _OUT)
    name = F.concat_ws("-", F.coalesce("container_kind", F.lit("none")), "capacity", "grp", "bin")
    return packed.select("container_kind", name.alias("container_id"), "capacity", "item_id", "copy_no", "piece_no", "token_start", "n_tokens")


def fill_report(packed: DataFrame) -> DataFrame:
    """Per kind: items, containers, tokens, the least possible number of containers and the filled share."""
    bins = packed.groupBy("container_kind", "capacity", "container_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    tokens, n = F.sum("used"), F.count(F.lit(1))
    return bins.groupBy("container_kind", "capacity").agg(
        F.sum("pieces").alias("pieces"),
        n.alias("containers"),
        tokens.alias("tokens"),
        F.ceil(tokens / F.first("capacity")).alias("least_containers"),
        (tokens / (n * F.first("capacity"))).alias("filled_share"),
        F.max("used").alias("fullest"),
    )
