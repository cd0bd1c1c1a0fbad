import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix.llm.grouping import connected_groups
from curatrix.llm.mixing import mix, mixing_rates, share_report
from curatrix.llm.packing import fill_report, first_fit_decreasing, pack
from curatrix.llm.tokens import token_count


def truth(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in parent}


def cases():
    rng = random.Random(3)
    yield [(f"{i:04d}", f"{i + 1:04d}") for i in range(400)]
    yield [(str(rng.randrange(600)), str(rng.randrange(600))) for _ in range(900)]
    yield [("hub", str(i)) for i in range(500)] + [(str(i), "hub") for i in range(100)] + [(None, "x"), ("q", "q"), ("y", None)]


@pytest.mark.parametrize("pairs", list(cases()))
@pytest.mark.parametrize("per_block", [60, 100_000])
def test_groups(spark, pairs, per_block):
    got = [tuple(r) for r in connected_groups(spark.createDataFrame(pairs, "a string, b string"), edges_per_block=per_block).collect()]
    assert len(got) == len(set(got)) and set(got) == truth(pairs)


def test_no_groups(spark):
    df = spark.createDataFrame([("a", "a"), (None, None)], "a string, b string")
    assert connected_groups(df).count() == 0 and connected_groups(df.limit(0)).columns == ["id", "group_id"]


@given(st.lists(st.integers(0, 50), max_size=60))
@settings(max_examples=60, deadline=None)
def test_first_fit(sizes):
    sizes = sorted(sizes, reverse=True)
    bins, free = [], []
    for s in sizes:
        k = next((i for i, f in enumerate(free) if f >= s), len(free))
        if k == len(free):
            free.append(50)
        free[k] -= s
        bins.append(k)
    assert first_fit_decreasing(sizes, 50) == bins


def test_pack(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 3, 40, 99, 100, 101, 250, 300])) for i in range(700)] + [(7, 30)] * 300 + [(900, None), (None, 12), (None, 12)]
    df = spark.createDataFrame(rows, "item_id long, size long")
    kinds = spark.createDataFrame([("s", 100), ("l", 250), ("bad", 0), ("none", None)], "container_kind string, capacity_tokens int")
    out = pack(df, kinds, len(rows), group_items=100)
    got = out.collect()
    for kind, cap in (("s", 100), ("l", 250)):
        mine = [r for r in got if r.container_kind == kind]
        fill, per = Counter(), {}
        for r in mine:
            fill[r.container_id] += r.n_tokens
            per.setdefault((r.item_id, r.copy_no, None), []).append(r)
        assert max(fill.values()) <= cap
        assert sum(fill.values()) == sum(s for _, s in rows if s is not None)
        whole = Counter((i, s) for i, s in rows if s is not None)
        sizes = Counter()
        seen = Counter()
        for r in mine:
            seen[r.item_id] += r.piece_no == 0
            sizes[r.item_id] += r.n_tokens
        assert seen == Counter(i for i, s in rows if s is not None) and len(whole) > 0
        assert all(r.n_tokens == cap or r.token_start + r.n_tokens for r in mine if r.piece_no)
    report = {r.container_kind: r for r in fill_report(out).collect()}
    assert report["l"].filled_share > 0.9 and report["s"].fullest == 100
    again = pack(df.repartition(7), kinds, len(rows), group_items=100)
    assert sorted(map(str, again.collect())) == sorted(map(str, got))
    assert pack(df.limit(0), kinds, 0).count() == 0 and pack(df, kinds.limit(0), 3).count() == 0


def test_token_count(spark):
    df = spark.createDataFrame([("hello world",), ("",), (None,), ("a" * 50_000,), ("<|endoftext|>",)], "text string")
    got = [r[0] for r in df.select(token_count(F.col("text"))).collect()]
    assert got[:3] == [2, 0, None] and got[3] > 1000 and got[4] > 1


def test_mix(spark):
    docs = [(i, "big", 10) for i in range(4000)] + [(10_000 + i, "small", 10) for i in range(100)] + [(20_000, None, 5), (20_001, "other", 5), (20_002, "big", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("Big ", 0.7, 2), ("small", 0.2, 3), ("absent", 0.5, 1), ("SMALL", 0.1, None), (None, 0.1, 1)], "source string, target_weight double, max_repeats int")
    rates = {r["source"]: r for r in mixing_rates(df, targets)}
    assert rates["small"]["rate"] == 3.0 and rates["absent"]["rate"] == 0.0
    assert abs(rates["big"]["rate"] - 0.7 * 41_000 / 40_000) < 1e-9
    out = mix(df, list(rates.values()))
    per = Counter(r.doc_id for r in out.collect())
    assert all(per[10_000 + i] == 3 for i in range(100)) and max(per.values()) <= 3 and 20_001 not in per and 20_002 not in per
    report = {r.source: r for r in share_report(spark, out, list(rates.values())).collect()}
    assert abs(report["big"].mixed_tokens / 10 / 4000 - rates["big"]["rate"]) < 0.02 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-9
    assert mix(df, []).count() == 0
    alone = mixing_rates(df, spark.createDataFrame([("small", 1.0, None)], targets.schema))
    assert alone[0]["rate"] == 1.0  # a missing cap allows no repetition


def test_packing_invariants_on_whole_tables(spark):
    import os

    from curatrix.llm.queries import QUERIES
    from curatrix.llm.tokens import token_count

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    sizes = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", token_count(F.col("text")).alias("n")).where(F.col("n").isNotNull())
    packed = QUERIES["p6_packing"](spark, d)
    assert packed.groupBy("container_id").agg(F.sum("n_tokens").alias("u"), F.first("capacity").alias("c")).where("u > c").count() == 0
    whole = packed.groupBy("container_kind", "capacity", "doc_id").agg(F.sum("n_tokens").alias("got"), F.count(F.lit(1)).alias("pieces")).join(sizes, "doc_id", "full")
    assert whole.where("got is null or n is null or got <> n").count() == 0  # every text whole, in every kind
    assert whole.where("pieces > 1 and n <= capacity").count() == 0  # split only if it alone exceeds the capacity
    assert packed.select("container_kind").distinct().count() == 3
