import random

import pytest
from pyspark.sql import functions as F

from curatrix.llm.common import quality_score
from curatrix.llm.contributor_cap import category_key, kept_by_heap, set_name, split_by_cap, title_key
from curatrix.llm.survivorship import Attribute, survivors
from curatrix.llm.term_frequency import element_terms, partial_counts, term_frequencies


@pytest.mark.parametrize(
    "element,terms",
    [
        ("Soft_Light", ("soft light",)),
        (" soft   light. ", ("soft light",)),
        ("#Café,", ("café",)),
        ("a, b;c|  |a", ("a", "b", "c", "a")),
        ("black-and--white", ("black and white",)),
        ("", ()),
        (" ,;| # .", ()),
    ],
)
def test_element_terms(element, terms):
    assert element_terms(element) == terms


def test_term_frequencies(spark):
    rows = [(["A", "a.", "b"], "x"), (["a", None, ""], None), (None, "X,y"), ([], " "), (["c"], "x")] * 2
    df = spark.createDataFrame(rows, "dimension array<string>, term string")
    parts = [partial_counts(df, {"tags": F.col("dimension"), "style": F.array("term")}, flush_at=1)]
    got = {(r.dimension, r.term): (r.occurrences, r.records, r.mark) for r in term_frequencies(parts, 2, 0.5).collect()}
    assert got == {
        ("tags", "a"): (6, 4, "common"),
        ("tags", "b"): (2, 2, "rare"),
        ("tags", "c"): (2, 2, "rare"),
        ("style", "x"): (6, 6, "common"),
        ("style", "y"): (2, 2, "rare"),
    }
    assert term_frequencies([partial_counts(df.limit(0), {"tags": F.col("dimension")})]).count() == 0


def test_titles_and_categories():
    same = ["Clay &amp; Brass", "clay & brass - Page 3", "CLAY &  BRASS (page 2 of 9)", "Clay &#38; Brass [page 2/9]", "CLAY &AMP; BRASS – Page 1 of 2", "clay & brass, page 4", "Clay & Brass | page 7"]
    assert {title_key(t) for t in same} == {"clay & brass"}
    assert {title_key(t) for t in (None, "", "  ", "N/A", "Untitled", "unknown", "-", "Page 3")} == {None}
    assert title_key("Frontpage 3") == "frontpage 3"
    assert {category_key(c) for c in ("tin_roof", "Tin-Roof ", "TIN ROOF")} == {"tinroof"} and category_key(" _ ") is None and category_key(None) is None


def test_sets(spark):
    df = spark.createDataFrame([("a_b", "T"), ("A B", "t - page 2"), (None, "T"), ("", "T"), ("a", None)], "c string, t string")
    names = [r[0] for r in df.select(set_name("c", "t")).collect()]
    assert names[0] == names[1] != names[2] == names[3] and names[4] is None


def test_cap_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 5 + [f"s{i}" for i in range(30)] + [None]), f"i{i:04d}", rng.choice([None, float("nan"), 1.0, 2.0, rng.random()])) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, id string, score double").repartition(5).withColumn("__kept", F.lit("clash"))
    by = {}
    for g, i, s in rows:
        by.setdefault(g, []).append((s is None or s != s, -(s or 0) if s == s else 0, i))
    beyond = {i for g, m in by.items() if g is not None for _, _, i in sorted(m)[7:]}
    out = split_by_cap(df, "g", "id", "score", cap=7, beyond=True)
    assert {r.id for r in out.collect()} == beyond and out.columns == df.columns
    assert {r.id for r in split_by_cap(df, "g", "id", "score", cap=7).collect()} == {i for _, i, _ in rows} - beyond
    small = df.select("g", "score", "id").where("g is not null")
    assert kept_by_heap(small, 7, fan_in=3, flush_at=11).count() == kept_by_heap(small, 7).count()
    assert split_by_cap(df.limit(0), "g", "id", "score", cap=7, beyond=True).count() == 0
    shared = split_by_cap(df, "g", "id", "score", share=0.01).where("g = 'hot'").count()
    assert shared == int(sum(g is not None for g, _, _ in rows) * 0.01)
    with pytest.raises(ValueError):
        split_by_cap(df, "g", "id", "score")


def test_cap_with_missing_ids_and_equal_scores(spark):
    rows = [("g", None, 9.0), ("g", "b", 1.0), ("g", "a", 1.0), ("g", "c", 1.0), (None, None, None)]
    df = spark.createDataFrame(rows, "g string, id string, score double")
    assert {r.id for r in split_by_cap(df, "g", "id", "score", cap=2, beyond=True).collect()} == {None, "c"}
    assert [r.id for r in split_by_cap(df, "g", "id", "score", cap=2).orderBy("id").collect()] == [None, "a", "b"]


def test_very_long_element(spark):
    df = spark.createDataFrame([(["a b " * 50_000 + ", x"],)], "t array<string>")
    got = term_frequencies([partial_counts(df, {"t": F.col("t")})]).collect()
    assert {len(r.term) for r in got} == {199_999, 1}


def test_survivors(spark):
    rows = [
        ("c", "b", 1.0, 5, "x"), ("c", "a", 1.0, 5, "y"), ("c", "z", None, 9, None), ("c", "n", float("nan"), 9, None),
        ("lone", "q", 1.0, 1, "x"), (None, "r", 1.0, 1, "x"), (None, "s", 1.0, 1, "x"),
        ("d", "k", None, None, None), ("d", "j", None, None, None),
    ]
    df = spark.createDataFrame(rows, "g string, id string, s double, t long, members string")
    picks = [Attribute("best", F.col("id"), [F.col("s"), F.col("t")], [F.col("id")]), Attribute("latest", F.col("id"), [F.col("t")], [F.col("id")])]
    assert {tuple(r) for r in survivors(df, "g", picks).collect()} == {("c", "a", "n"), ("d", "j", "j")}
    assert survivors(df.limit(0), "g", picks).count() == 0


def test_quality_score(spark):
    rows = [(1000, 1000, None, 50.0), (0, 10, 2.0, 100.0), (None, None, float("nan"), 100.0), (1, 1, 1.0, float("nan")), (1, 1, 1.0, -1.0), (100000, 100000, None, 100.0)]
    df = spark.createDataFrame(rows, "w int, h int, m double, l double")
    assert [r[0] for r in df.select(quality_score(*[F.col(c) for c in "whml"])).collect()] == [0.5, 2.0, None, None, None, 10000.0]
