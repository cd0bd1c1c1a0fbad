"""Selection: top-n, quotas, even and hashed samples, tiers, batches and grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.session import cut_lineage


def top_n(df: DataFrame, score: Column, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the highest score, ties by the ``ties`` columns; a distributed top-k, no full sort."""
    return df.orderBy(score.desc_nulls_last(), *[F.col(t) for t in ties]).limit(n)


def quota(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group; the limit is applied before the shuffle as well."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")


def even_sample(df: DataFrame, group: str, order: Sequence[Column], most: int = 7) -> DataFrame:
    """Without the first and last row of each group, at most ``most`` of the rest, evenly spaced.

    ``order`` must be unique within a group; a null group is one group. Groups of two or fewer give
    nothing. Positions are round-half-even of i * (m - 1) / (most - 1). Rows are numbered by a range
    partitioning, so a group with a third of all rows is ranked by several tasks.
    """
    keys = [f"__o{i}" for i in range(len(order))]
    placed = dense_positions(df.withColumns({"__group": F.col(group), **dict(zip(keys, order))}), ["__group", *keys], "__at")
    sizes = placed.groupBy(F.col("__group").alias("__g")).agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    i, pool = F.col("__at") - F.col("__first") + 1, F.col("__n") - 2
    spaced = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda x: F.bround(x * (pool - 1) / (most - 1), 0).cast("long") + 2)
    picked = F.when(pool <= most, (i > 1) & (i < F.col("__n"))).otherwise(F.array_contains(spaced, i))
    joined = placed.join(sizes.where(F.col("__n") > 2), F.col("__group").eqNullSafe(F.col("__g")))
    return joined.where(picked).drop("__group", *keys, "__at", "__g", "__n", "__first")


def hashed_sample(df: DataFrame, ident: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows drawn by a hash of seed and id: the same rows on every run and on any engine that has MD5."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(ident).cast("string"))), ident).limit(n)


def tier(position: Column, weights: tuple[int, int, int] = (30, 40, 30), names: tuple[str, str, str] = ("tags", "short", "dense"), forced: str | None = None) -> Column:
    """The tier of a 0-based position by (7 * position) mod total against cumulative weights, or ``forced``."""
    if forced:
        return F.lit(forced)
    m = F.pmod(position * 7, F.lit(sum(weights)))
    return F.when(m < weights[0], names[0]).when(m < weights[0] + weights[1], names[1]).otherwise(names[2])


def dense_positions(df: DataFrame, order: str | Sequence[str], name: str = "position") -> DataFrame:
    """0-based positions in the order of columns that are unique together, without one task seeing all rows.

    Rows are range-partitioned, stored and numbered within their partition; each partition adds the count
    of those before it, which is one number per partition.
    """
    order = [order] if isinstance(order, str) else list(order)
    parts = cut_lineage(df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()))
    sizes = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    local = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1
    return parts.withColumn("__l", local).join(F.broadcast(before), "__p").withColumn(name, (F.col("__before") + F.col("__l")).cast("long")).drop("__p", "__l", "__before")


def unique_names(df: DataFrame, folder: str, name: str, ident: str, out: str = "unique_name") -> DataFrame:
    """Names made unique per folder, ignoring case.

    The first row by ``ident`` (unique) of every name keeps it. The others get _1, _2 and so on before the
    extension, in the order of ``ident``, passing over numbers that would be another row's own name; a null
    name counts as empty, a null folder as ''. No two results of a folder are equal: suffixed names of
    different stems differ, and those of one stem have different numbers. Positions come from a range
    partitioning, so one name in a third of all rows is numbered by several tasks.
    """
    keyed = df.withColumn("__f", F.coalesce(F.col(folder), F.lit(""))).withColumn("__s", F.coalesce(F.col(name), F.lit("")))
    placed = dense_positions(keyed.withColumn("__b", F.lower("__s")), ["__f", "__b", ident], "__at")
    own = cut_lineage(placed.groupBy("__f", "__b").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")))
    numbered = placed.join(own.drop("__n"), ["__f", "__b"]).withColumn("__k", F.col("__at") - F.col("__first")).drop("__first")
    # Own names that look like a suffixed one of a name that has more than one row.
    stem, ext = _stem_and_extension(F.col("__b"))
    number, start = F.regexp_extract(stem, r"_([1-9]\d{0,17})$", 1), F.regexp_replace(stem, r"_[1-9]\d{0,17}$", "")
    # What would be left as a bare extension is a name of its own kind: its suffix comes last.
    alike = own.where((number != "") & ((start != "") | (ext == ""))).select("__f", F.concat(start, ext).alias("__b"), number.alias("__t"))
    alike = alike.withColumn("__t", F.col("__t").cast("long")).join(own.where(F.col("__n") > 1).select("__f", "__b"), ["__f", "__b"], "left_semi")
    ranked = dense_positions(alike, ["__f", "__b", "__t"], "__i")
    least = ranked.groupBy("__f", "__b").agg(F.min("__i").alias("__i0"))
    # The i-th taken number t is passed over by all rows from the (t - i)-th on, so merged in that order a row's place is its number.
    taken = ranked.join(least, ["__f", "__b"]).select("__f", "__b", (F.col("__t") - (F.col("__i") - F.col("__i0"))).alias("__k"), F.lit(0).alias("__row"), F.col("__t").alias("__tie"))
    wanted = numbered.where(F.col("__k") > 0).select("__f", "__b", "__k", F.lit(1).alias("__row"), F.lit(0).cast("long").alias("__tie"))
    merged = dense_positions(wanted.unionByName(taken), ["__f", "__b", "__k", "__row", "__tie"], "__m")
    base = merged.groupBy("__f", "__b").agg(F.min("__m").alias("__m0"))
    given = merged.where(F.col("__row") == 1).join(base, ["__f", "__b"]).select("__f", "__b", "__k", (F.col("__m") - F.col("__m0") + 1).alias("__number"))
    stem, ext = _stem_and_extension(F.col("__s"))
    result = F.when(F.col("__k") == 0, F.col("__s")).otherwise(F.concat(stem, F.lit("_"), F.col("__number").cast("string"), ext))
    return numbered.join(given, ["__f", "__b", "__k"], "left").withColumn(out, result).drop("__f", "__s", "__b", "__at", "__k", "__number")


def _stem_and_extension(name: Column) -> tuple[Column, Column]:
    ext = F.regexp_extract(name, r"[^.](\.[^.]*)$", 1)
    return F.substring(name, F.lit(1), F.length(name) - F.length(ext)), ext


def batches(position: Column, size: int) -> Column:
    """The batch that a 0-based position falls into."""
    return F.floor(position / size).cast("long")


def grid(dimensions: dict[str, Sequence], spark) -> DataFrame:
    """Every combination of short lists given by the caller, as exploded literals."""
    df = spark.range(1)
    for name, values in dimensions.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df.drop("id")


def prompt_grid(vocabulary: DataFrame, most: dict[str, int], trigger: str) -> DataFrame:
    """The trigger alone and with each combination of the first terms of every dimension.

    ``vocabulary`` is (dimension, term), configuration; each list is cut at ``most`` terms, in order.
    """
    lists = vocabulary.where(F.col("dimension").isin(*most) & (F.col("term") != "other")).groupBy().pivot("dimension", list(most)).agg(F.array_sort(F.collect_set("term")))
    rows = lists
    for d, n in most.items():
        rows = rows.withColumn(d, F.explode(F.slice(F.col(d), 1, n)))
    text = F.concat_ws(", ", F.lit(trigger), *[F.replace(F.col(d), F.lit("_"), F.lit(" ")) for d in most])
    alone = rows.sparkSession.range(1).select(*[F.lit(None).cast("string").alias(d) for d in most], F.lit(trigger).alias("prompt"))
    return alone.unionByName(rows.select(*most, text.alias("prompt")))
