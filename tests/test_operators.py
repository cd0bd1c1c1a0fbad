import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from curatrix.functions.scalars import hash_halves
from curatrix.operators import balance, components, dedup, fingerprint, gates, select
from curatrix.operators.state import latest_rows


def test_latest_rows(spark):
    rows = [("a", 1, 1, "old"), ("a", 2, 2, "new"), ("a", 2, 1, "same time"), ("b", None, 1, "only"), (None, 9, 9, "no key")]
    df = spark.createDataFrame(rows, "k string, t int, n int, v string")
    assert sorted(tuple(r) for r in latest_rows(df, "k", ["t", "n"], {"v": "v"}).collect()) == [("a", "new"), ("b", "only")]
    assert latest_rows(df.limit(0), "k", ["t"]).count() == 0


def test_gates(spark):
    df = spark.createDataFrame([(800, 600, 50.0, True), (4000, 3000, 500.0, False), (None, None, None, None)], "w int, h int, l double, m boolean")
    got = [r[0] for r in df.select(gates.quality_reasons(F.col("w"), F.col("h"), F.col("l"), F.col("m"), 700)).collect()]
    assert got == [["min_edge_below_700", "blurry_laplacian_low", "watermark_detected_unspecified"], [], []]
    ok, mp = gates.resolution_gate(F.col("w"), F.col("h"), 0.7)
    assert [tuple(r) for r in df.select(ok, mp).collect()] == [(False, 0.48), (True, 12.0), (False, 0.0)]


def test_screening_fails_closed(spark):
    ok = ("29", False, False, False, "high", True)
    bad = [("22", *ok[1:]), (None, *ok[1:]), ("22.5", *ok[1:]), (ok[0], None, *ok[2:]), (*ok[:4], "low", True), (*ok[:5], None)]
    df = spark.createDataFrame([ok, *bad], "a string, u boolean, w boolean, t boolean, q string, p boolean")
    got = [r[0] for r in df.select(gates.screening_reasons(*[F.col(c) for c in "auwtqp"])).collect()]
    assert got[0] == [] and all(got[1:])
    with pytest.raises(ValueError):
        gates.screening_reasons(*[F.col(c) for c in "auwtqp"], least_age=18)


def test_reason_lists(spark):
    df = spark.createDataFrame([(["min_edge_below_9", "x"], ["x", "y"]), (None, ["z"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(gates.add_reasons(F.col("a"), F.col("b"))).collect()] == [["min_edge_below_9", "x", "y"], ["z"]]
    assert df.select(gates.clear_reasons(F.col("a"), ["min_edge_"])).first()[0] == ["x"]


@pytest.mark.parametrize("t", [0, 3, 6])
def test_hamming_pairs_are_exact(spark, t):
    rng = random.Random(t)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = [b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for b in base for _ in range(6)]
    rows = [(i, f"{v & (2**64 - 1):016x}") for i, v in enumerate(values)]
    hi, lo = hash_halves(F.col("h"))
    df = spark.createDataFrame(rows, "i long, h string").select("i", hi.alias("hi"), lo.alias("lo"))
    got = {(r.a, r.b) for r in fingerprint.hamming_pairs(df, "i", "hi", "lo", t).collect()}
    first = {}
    for i, h in rows:
        first.setdefault(h, i)
    want = {(a, b) for (x, a), (y, b) in itertools.permutations(first.items(), 2) if a < b and (int(x, 16) ^ int(y, 16)).bit_count() <= t}
    assert got == want


def test_cosine_pairs(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [0.0, 3.0])]
    df = spark.createDataFrame(rows, "i long, v array<float>")
    assert sorted((r.a, r.b) for r in fingerprint.cosine_pairs(df, "i", "v", 0.9, 2, block=2).collect()) == [(1, 2), (3, 6)]


def test_components(spark):
    pairs = [("a", "b"), ("b", "c"), ("x", "y"), ("q", "q"), (None, "a"), ("c", "a")] + [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    got = {tuple(r) for r in components.connected_components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    want = {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")} | {(f"n{i:03d}", "n000") for i in range(61)}
    assert got == want
    df = spark.createDataFrame(pairs, "a string, b string").repartition(5)
    assert {tuple(r) for r in components.connected_components(df, at_once=3).collect()} == want  # by star steps
    with pytest.raises(RuntimeError):
        components.connected_components(df, at_once=3, max_rounds=1)
    assert components.connected_components(df.limit(0)).count() == 0


def test_unique_names_against_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["f", "g", None]), rng.choice(["a.jpg", "A.jpg", "a_1.jpg", "a_2.JPG", "a_1_1.jpg", "b", "b_1", "b_3", ".x", ".x_1", "_1.x", "a_01.jpg", None, ""])) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, folder string, name string").repartition(4)
    got = {r.i: r.unique_name for r in select.unique_names(df, "folder", "name", "i").collect()}
    assert len(got) == 300
    seen = {((f or ""), got[i].lower()) for i, f, _ in rows}
    assert len(seen) == 300
    taken = {(f or "", (n or "").lower()) for _, f, n in rows}
    first, last = set(), {}
    for i, f, n in rows:
        f, n = f or "", n or ""
        if (f, n.lower()) not in first:
            first.add((f, n.lower()))
            assert got[i] == n
            continue
        ext = re.search(r"[^.](\.[^.]*)$", n)
        ext = ext.group(1) if ext else ""
        k = last.get((f, n.lower()), 0) + 1
        while (f, f"{n[: len(n) - len(ext)]}_{k}{ext}".lower()) in taken:
            k += 1
        last[f, n.lower()] = k
        assert got[i] == f"{n[: len(n) - len(ext)]}_{k}{ext}", (i, n, got[i])
    few = spark.createDataFrame([(1, "f", "a.jpg"), (2, "f", "a.jpg"), (3, "f", "a_1.jpg")], "i long, folder string, name string")
    assert {r.i: r.unique_name for r in select.unique_names(few, "folder", "name", "i").collect()} == {1: "a.jpg", 2: "a_2.jpg", 3: "a_1.jpg"}
    assert select.unique_names(df.limit(0), "folder", "name", "i").count() == 0


def test_primary_ranking(spark):
    rows = [("k", ".thumbs/a.jpg", "w w w"), ("k", "a.jpg.jpg", "w w w w"), ("k", "d/a.jpg", "one"), ("k", "d/a2.jpg", "one two")]
    df = spark.createDataFrame(rows, "k string, p string, c string")
    assert dedup.best_of(df, ["k"], dedup.primary_rank(F.col("p"), F.col("c")), ["p"]).first().p == "d/a2.jpg"


def test_balance(spark):
    df = spark.createDataFrame([("a", 100), ("b", 25), ("c", 10), ("d", 40)], "k string, n long")
    got = {r.k: (r.repeats, r.effective) for r in balance.repeats(df).collect()}
    assert got == {"a": (1, 100), "b": (4, 100), "c": (4, 40), "d": (2, 80)}  # 2.5 goes to the even 2
    rows = [("A", "s1", 1.0)] * 5 + [("B", "s2", 1.333)] * 3 + [("C", "s1", 1.0)] * 2
    df = spark.createDataFrame(rows, "scene string, style string, aspect_ratio double")
    assert [(r.value, r.ratio) for r in balance.dominance(df, "scene", 0.35).collect()] == [("A", 0.5)]
    assert balance.dominance(df, "scene", 0.5).count() == 0
    assert {r.bucket: r.n for r in balance.aspect_histogram(df).collect()} == {"1:1": 7, "4:3": 3, "16:9": 0, "other": 0}
    assert {(r.dimension, r.value): r.n for r in balance.distributions(df, ["scene", "style"]).collect()}[("style", "s1")] == 7


def test_select(spark):
    df = spark.createDataFrame([("g", i) for i in range(1, 16)] + [("h", 1), ("h", 2)], "g string, i int")
    got = [r.i for r in select.even_sample(df, "g", [F.col("i")]).orderBy("i").collect()]
    assert len(got) == 7 and 1 not in got and 15 not in got
    rows = spark.createDataFrame([(i, 1 + 0.2 * i, 50.0 + 20 * i) for i in range(10)], "i int, mp double, lap double")
    assert [r.i for r in select.top_n(rows, F.col("mp") * F.col("lap"), 3, ["i"]).collect()] == [9, 8, 7]
    sample = lambda: [r.i for r in select.hashed_sample(rows, "i", 4, 3).collect()]
    assert sample() == sample()
    assert select.grid({"a": [1, 2, 3], "b": [1, 2]}, spark).count() == 6
    pos = select.dense_positions(rows, "i").orderBy("i")
    assert [r.position for r in pos.collect()] == list(range(10))
    tiers = [r[0] for r in pos.select(select.tier(F.col("position"))).collect()]
    assert [t for t in tiers] == [("tags" if (7 * i) % 100 < 30 else "short" if (7 * i) % 100 < 70 else "dense") for i in range(10)]


def test_every_dimension_is_held_to_the_vocabulary(spark, tmp_path):
    from curatrix.plans import catalogue

    terms = [("style", "film"), ("style", "film"), ("location", "brick_loft"), ("pose", "film"), ("quality", "high")]
    spark.createDataFrame(terms, "dimension string, term string").write.parquet(str(tmp_path / "vocabulary.parquet"))
    rows = [(1, "Film", " Brick loft", "film", "HIGH"), (2, "brick_loft", "film", "x", "best"), (3, None, None, None, None)]
    spark.createDataFrame(rows, "caption_id long, style string, location string, pose string, quality string").write.parquet(str(tmp_path / "captions.parquet"))
    got = sorted(tuple(r) for r in catalogue.QUERIES["q_vocabulary_dimensions"](spark, str(tmp_path)).collect())
    none = ("other", "other", "other", None)
    assert got == [(1, "film", "brick_loft", "film", "high"), (2, *none), (3, *none)]


def test_titles_and_tags_of_all_rows(spark, tmp_path):
    import re
    from urllib.parse import unquote

    from curatrix.plans import catalogue

    titles = [None, "", "Winter\u00a0set\u00a0| Some site", "Winter set - Page\u00a03 of 9", "Salt\u00a0&\u00a0Linen,\u2003page\u20032", "a%20b%2Fc", "50% off", "100%25\u00a0x"]
    tags = [None, [], [None], ["A", None, " a", "B"], [None, "b ", "B", ""], ["c"], ["C", "c", None], ["x"]]
    rows = list(zip(range(len(titles)), titles, tags))
    spark.createDataFrame(rows, "line_no long, context_title string, context_tags array<string>").withColumn("category", F.lit("c")).write.parquet(str(tmp_path / "manifest_entries.parquet"))

    def clean(t):
        t = re.sub(r"(?i)\s*[-–|,]?\s*[\(\[]?\bpage\s+\d+.*$", "", re.sub(r"\s+\|[^|]*$", "", t))
        return " ".join(t.split())

    def name(t):
        t = unquote(t) if not re.search("%(?![0-9A-Fa-f]{2})", t) else t
        return re.sub(r"\s+", " ", re.sub(r'[\\/*?:"<>|]', "_", t)).strip(". ")[:40] or "item"

    def distinct(xs):
        return list({x.strip().lower(): x.strip() for x in reversed(xs) if x is not None and x.strip()}.values())[::-1]

    got = lambda q: {r[0]: r[1] for r in catalogue.QUERIES[q](spark, str(tmp_path)).collect()}
    assert got("q_clean_title") == {i: None if t is None else clean(t) for i, t, _ in rows}
    assert got("q_sanitize_name") == {i: "item" if t is None else name(t) for i, t, _ in rows}
    found = got("q_distinct_tags")
    assert {i: x and sorted(x) for i, x in found.items()} == {i: x and sorted(distinct(x)) for i, _, x in rows}
    assert found[3] == ["A", "B"] and found[4] == ["b"]
