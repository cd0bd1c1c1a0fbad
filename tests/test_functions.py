import pytest
from pyspark.sql import functions as F

from curatrix.functions import compliance, json_repair, scalars
from curatrix.functions import html as pages


def one(spark, schema, values, *exprs):
    return [tuple(r) for r in spark.createDataFrame(values, schema).select(*exprs).collect()]


def test_sanitize_names(spark):
    got = one(
        spark, "s string", [("a%20b/c:d",), (" .. ",), ("x" * 100,), ("50% off",), (None,)], scalars.sanitize_name(F.col("s")), F.length(scalars.sanitize_filename(F.concat("s", F.lit(".jpeg")), 30))
    )
    assert [g[0] for g in got] == ["a b_c_d", "item", "x" * 80, "50% off", "item"]
    assert all(g[1] is None or g[1] <= 30 for g in got)


def test_page_numbers_and_urls(spark):
    got = one(spark, "s string", [("3-1, 7",), ("all",), ("x",), ("1,,1",)], scalars.page_numbers(F.col("s"), F.lit(3)))
    assert [g[0] for g in got] == [[1, 2, 3, 7], [1, 2, 3], None, [1]]
    got = one(spark, "u string, n int", [("http://h/a", 1), ("http://h/a", 3), ("http://h/a?x=1", 2), ("http://h/a?page=9&x", 4)], scalars.page_url(F.col("u"), F.col("n")))
    assert [g[0] for g in got] == ["http://h/a", "http://h/a?page=3", "http://h/a?x=1&page=2", "http://h/a?page=4&x"]


def test_url_parts(spark):
    got = one(spark, "u string", [("HTTPS://u:p@Host.org:8/p/x.JPG?q#f",), ("nonsense",), ("http://h",)], scalars.url_host(F.col("u")), scalars.url_suffix(F.col("u")))
    assert got == [("host.org", ".jpg"), (None, ""), ("h", "")]


def test_assemble_caption(spark):
    rows = [
        ("tw", "a lamp, a chair", None, None, None, None),
        ("tw", "Photograph of a lamp, lit", None, None, None, None),
        ("tw, ", "TW stands here", None, None, None, None),
        ("tw", "  ", "soft_light", "brick_loft", "A chair. ", "Side light"),
        (None, None, "other", "other", None, None),
    ]
    cols = [F.col(c) for c in "tdslxy"]
    schema = ", ".join(f"{c} string" for c in "tdslxy")
    assert [g[0] for g in one(spark, schema, rows, scalars.assemble_caption(*cols))] == [
        "tw, a lamp, a chair",
        "tw Photograph of a lamp, lit",
        "TW stands here",
        "tw Set in a brick loft. A chair. Side light.",
        "",
    ]
    assert one(spark, schema, rows[3:4], scalars.assemble_caption(*cols, with_style=True))[0][0] == "tw soft light aesthetic. Set in a brick loft. A chair. Side light."


def test_hash_key(spark):
    rows = [("068e12987d7b5ee9.jpg",), ("068e12987d7b5ee9.jpg.jpg",), (".thumbs/068e12987d7b5ee9.jpg.jpg",), ("068E12987d7b5ee9_1.jpg",), ("068e12987d7b5ee9 (1).jpg",), ("image_001.jpg",), ("notes.txt",)]
    assert [g[0] for g in one(spark, "p string", rows, scalars.hash_key(F.col("p")))] == ["068e12987d7b5ee9"] * 5 + ["image_001", "notes.txt"]


def test_downscale_and_geometry(spark):
    w, h = scalars.downscaled(F.col("w"), F.col("h"))
    rows = [(4000, 3000), (1024, 768), (1500, 999), (1000, 1000)]
    got = one(spark, "w int, h int", rows, w, h)
    assert got[:2] == [(2048, 1536), (1024, 768)] and got[3] == (992, 992)  # 62.5 goes to the even 62
    assert all(x % 16 == 0 for x in got[2])
    got = one(spark, "w int, h int", [(803, 400), (1, 3), (5, 0)], scalars.aspect_ratio(F.col("w"), F.col("h")))
    assert [g[0] for g in got] == [2.008, 0.333, None]


def test_tokens_and_updates(spark):
    rows = [(None,), ("",), ("a b c",), ("w, " * 10,), ("word " * 280,)]
    got = one(spark, "t string", rows, scalars.estimate_tokens(F.col("t")), scalars.already_updated(F.col("t"), F.lit(False)))
    assert got == [(0, False), (0, False), (4, False), (20, False), (378, True)]


def test_json_repair(spark):
    rows = [('```json\n{"style":"a"}\n```',), ('{"style":"b"}',), ('noise {"style":"c"} tail',), ("plain",), ('"style":"d"}',), (None,)]
    got = one(spark, "t string", rows, json_repair.field(json_repair.extract_object(F.col("t")), "style"), json_repair.field(json_repair.repair_prefilled(F.col("t")), "style"), json_repair.caption_of_tier(F.col("t"), "short"))
    assert [g[0] for g in got] == ["a", "b", "c", None, None, None]
    assert got[4][1] == "d" and got[3][2] == "plain"


def test_post_metadata(spark):
    text = "A winter set\nGenres: a, b,\nTags: c\nFormat: jpg\nNumber of photos: 12\nhttp://x\nResolution: 4k"
    m = one(spark, "t string", [(text,), ("",)], scalars.post_metadata(F.col("t")))
    assert m[0][0].title == "A winter set" and m[0][0].genres == ["c"]
    assert m[0][0].metadata == {"format": "jpg", "photos_count": "12", "resolution": "4k", "genres_raw": "c"}
    assert m[1][0].title is None and m[1][0].genres == []


def test_page_count_title_and_variants(spark):
    got = one(spark, "h string", [('<a href="?page=3"><a href="/page-12">',), ("none",), (None,)], scalars.page_count(F.col("h")))
    assert [g[0] for g in got] == [12, 1, None]
    got = one(spark, "t string", [("Winter set - Page 3 of 9 | Some site",), ("Plain",)], scalars.clean_title(F.col("t")))
    assert [g[0] for g in got] == ["Winter set", "Plain"]


def test_hamming(spark):
    a, b = scalars.hash_halves(F.col("a")), scalars.hash_halves(F.col("b"))
    rows = [("ffffffffffffffff", "0000000000000000"), ("00000000000000ff", "00000000000000FF"), ("zz", "00000000000000ff")]
    assert [g[0] for g in one(spark, "a string, b string", rows, scalars.hamming(a, b))] == [64, 0, None]


def test_reservation_and_robots(spark):
    df = spark.createDataFrame([("http://a/x", "a"), ("http://a/private/x", "a"), ("http://b/x", "b")], "url string, host string")
    robots = spark.createDataFrame([("a", "User-agent: *\nDisallow: /private")], "host string, robots_txt string")
    got = {r.url: r.robots_allowed for r in compliance.robots_allowed(df, robots, "url", "host").collect()}
    assert got == {"http://a/x": True, "http://a/private/x": False, "http://b/x": False}


def test_links(spark):
    df = spark.createDataFrame([(1, '<a href="/x">t</a><img data-src="y.jpg">', "http://h/d/"), (2, None, None), (3, "<a href='", None)], "i int, h string, b string")
    got = [tuple(r) for r in pages.extract_links(df, "i", "h", "b").collect()]
    assert got == [(1, 0, "a", "http://h/x"), (1, 1, "img", "http://h/d/y.jpg")]


def test_best_variant_and_distinct(spark):
    df = spark.createDataFrame([(["A", " a", "", "B", "b "],), ([],), (None,)], "x array<string>")
    assert [r[0] for r in df.select(scalars.distinct_ignoring_case(F.col("x"))).collect()] == [["A", "B"], [], None]


@pytest.mark.parametrize("own,category,want", [("x", "c", "x"), (None, "c", "c look"), ("", None, "{category} look")])
def test_trigger(spark, own, category, want):
    df = spark.createDataFrame([(own, category)], "o string, c string")
    assert df.select(scalars.resolve_trigger(F.col("o"), F.lit("{category} look"), F.col("c"), "set", "d")).first()[0] == want


def test_map_with_fallback(spark):
    from curatrix.functions.guarded import map_with_fallback

    def batch(values):
        if any(v == "bad" for v in values):
            raise ValueError("no")
        return [v.upper() for v in values]

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c"), (4, None)], "i long, v string").coalesce(1)
    got = {r.i: (r.result, r.error) for r in map_with_fallback(df, "i", "v", batch, rows_at_once=4).collect()}
    assert got[1] == ("A", None) and got[2] == (None, "ValueError: no") and got[3] == ("C", None) and got[4][0] is None
