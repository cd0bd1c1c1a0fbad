"""Fingerprints of vectors, exact Hamming joins by banding and cosine joins by blocks."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.scalars import hamming
from curatrix.session import cut_lineage


def median_bits(vector: Column, dims: int = 64) -> tuple[Column, Column]:
    """64 bits of a vector as two 32-bit halves: a bit is set where the coefficient is above the median."""
    s = F.array_sort(F.transform(vector, lambda x: x.cast("double")))
    median = (F.element_at(s, dims // 2) + F.element_at(s, dims // 2 + 1)) / 2
    half = lambda at: F.aggregate(
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.when(F.get(vector, i + at).cast("double") > median, F.expr("1L")).otherwise(F.expr("0L"))),
        F.expr("0L"),
        lambda acc, bit: acc * 2 + bit,
    )
    return half(0), half(32)


def _bands(hi: Column, lo: Column, n: int) -> Column:
    """The values of ``n`` bands that together hold all 64 bits."""
    edges = [round(i * 64 / n) for i in range(n + 1)]
    out = []
    for b in range(n):
        value = F.expr("0L")
        for bit in range(edges[b], edges[b + 1]):
            half, shift = (hi, 31 - bit) if bit < 32 else (lo, 63 - bit)
            value = F.shiftleft(value, 1).bitwiseOR(F.shiftright(half, shift).bitwiseAND(1))
        out.append(value)
    return F.array(*out)


def band_count(rows: int, at_most: int, most_keys: int = 1_000) -> int:
    """How many bands cost least for so many hashes: keys per hash against expected false candidates.

    With m bands, two hashes within t bits agree in m - t of them at least, so every choice of m - t bands
    is a key of about 64 * (m - t) / m bits. More bands mean more keys and longer, hence rarer, ones.
    """

    def cost(m: int) -> float:
        return math.comb(m, at_most) * (rows + rows * rows / 2 ** (64 * (m - at_most) / m))

    return min((m for m in range(at_most + 1, at_most + 9) if math.comb(m, at_most) <= most_keys), key=cost)


def hamming_pairs(df: DataFrame, ident: str, hi: str, lo: str, at_most: int) -> DataFrame:
    """(a, b, distance) of every pair of different hashes at most ``at_most`` bits apart, a < b; exact.

    Hashes are split into bands by ``band_count`` and joined on every choice of bands that a near pair
    must share; the distance of each candidate is then computed. Rows with equal hashes are one class
    first, so identical copies are never multiplied out: the result pairs class representatives (the least
    id of each hash), and ``class_links`` ties the members to them. Null hashes are in no pair.
    """
    if not 0 <= at_most <= 20:
        raise ValueError("banding is useful up to 20 bits")
    classes = df.where(F.col(hi).isNotNull() & F.col(lo).isNotNull()).groupBy(F.col(hi).alias("hi"), F.col(lo).alias("lo")).agg(F.min(ident).alias("id"))
    classes = cut_lineage(classes)
    bands = band_count(classes.count(), at_most)
    choices = F.array(*[F.array(*[F.lit(i) for i in c]) for c in itertools.combinations(range(bands), bands - at_most)])
    spread = classes.withColumn("b", _bands(F.col("hi"), F.col("lo"), bands)).select("id", "hi", "lo", "b", F.posexplode(choices).alias("n", "c"))
    # A hash of the chosen bands suffices as the key: a collision is one candidate more, not a pair.
    keyed = spread.select("id", "hi", "lo", F.xxhash64("n", F.transform("c", lambda i: F.get("b", i))).alias("key"))
    a = keyed.select("key", F.col("id").alias("a"), F.col("hi").alias("ah"), F.col("lo").alias("al"))
    b = keyed.select("key", F.col("id").alias("b"), F.col("hi").alias("bh"), F.col("lo").alias("bl"))
    distance = hamming((F.col("ah"), F.col("al")), (F.col("bh"), F.col("bl")))
    near = a.join(b, "key").where((F.col("a") < F.col("b")) & (distance <= at_most))
    return near.select("a", "b", distance.alias("distance")).distinct()


def class_links(df: DataFrame, ident: str, hi: str, lo: str) -> DataFrame:
    """(a, b) from every id to the least id with the same hash, where the two differ."""
    least = df.groupBy(F.col(hi).alias("__hi"), F.col(lo).alias("__lo")).agg(F.min(ident).alias("a"))
    joined = df.join(least, (F.col(hi) == F.col("__hi")) & (F.col(lo) == F.col("__lo")))
    return joined.where(F.col("a") < F.col(ident)).select("a", F.col(ident).alias("b"))


def cosine_pairs(df: DataFrame, ident: str, vector: str, at_least: float, dims: int, block: int = 512) -> DataFrame:
    """(a, b, cosine) of all pairs with a cosine of ``at_least``, a < b; exact, in blocks of ``block`` rows.

    Rows are hashed into g groups; every pair of groups is one task's matrix product, to which each row is
    sent g times. Exact all-pairs work is quadratic by nature; use banded fingerprints to prefilter beyond
    a few million rows. Null vectors and zero vectors have no cosine.
    """
    import numpy as np
    import pandas as pd

    rows = df.select(F.col(ident).cast("long").alias("id"), F.transform(F.col(vector), lambda x: x.cast("double")).alias("v")).where(F.size("v") == dims)
    groups = max(1, -(-rows.count() // block))
    g = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    sent = rows.withColumn("g", g).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    sent = sent.select("id", "v", "g", F.least("g", "o").alias("i"), F.greatest("g", "o").alias("j"))

    def product(part: pd.DataFrame) -> pd.DataFrame:
        i, j = part["i"].iloc[0], part["j"].iloc[0]
        sides = []
        for s in (part[part["g"] == i], part[part["g"] == j]):
            s = s.drop_duplicates("id")
            m = np.array(s["v"].tolist(), dtype=float).reshape(len(s), dims)
            norm = np.linalg.norm(m, axis=1)
            keep = norm > 0
            sides.append((s["id"].to_numpy()[keep], m[keep] / norm[keep, None]))
        c = sides[0][1] @ sides[1][1].T
        x, y = np.nonzero(c >= at_least)
        a, b = sides[0][0][x], sides[1][0][y]
        out = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "cosine": c[x, y]})
        return (out[a < b] if i == j else out[a != b]).drop_duplicates(["a", "b"])

    return sent.groupBy("i", "j").applyInPandas(product, "a long, b long, cosine double")
