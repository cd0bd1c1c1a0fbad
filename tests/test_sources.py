import json

import pytest
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from curatrix.plans import reports
from curatrix.sources import config, images, manifest
from curatrix.streaming import state_stream


def png(grey):
    h, w = grey.shape
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    raw = b"".join(b"\0" + row.astype(np.uint8).tobytes() for row in grey)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def test_dimensions():
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 1200, 1600) + b"\0" * 10
    cases = {
        png(np.zeros((1080, 1920))): (1920, 1080),
        jpeg: (1600, 1200),
        b"GIF89a" + struct.pack("<HH", 7, 9) + b"\0" * 10: (7, 9),
        b"RIFF0000WEBPVP8X" + b"\0" * 8 + (99).to_bytes(3, "little") + (49).to_bytes(3, "little"): (100, 50),
        b"RIFF0000WEBPVP8L" + b"\0" * 4 + b"\x2f" + (9 | 19 << 14).to_bytes(4, "little"): (10, 20),
        b"short": None,
        b"\xff\xd8" + b"\xff\xe0\x00\x04" * 5: None,
        b"unknown magic bytes": None,
    }
    for head, want in cases.items():
        assert images.dimensions(head) == want
    assert images.dimensions(None) is None


def test_pixels(spark, tmp_path):
    grid = np.zeros((300, 300))
    grid[::10] = 255
    grid[:, ::10] = 255
    blurred = sum(np.roll(np.roll(grid, i, 0), j, 1) for i in range(-10, 10) for j in range(-10, 10)) / 20**2
    assert images.laplacian_variance(grid) > 100 > 50 > images.laplacian_variance(blurred)
    assert images.perceptual_hash(grid) == images.perceptual_hash(grid)
    rng = np.random.default_rng(1)
    other = rng.integers(0, 255, (300, 300)).astype(float)
    assert (int(images.perceptual_hash(grid), 16) ^ int(images.perceptual_hash(other), 16)).bit_count() > 10
    (tmp_path / "a.png").write_bytes(png(grid))
    (tmp_path / "a.txt").write_text("a caption")
    got = images.measure(spark.read.format("image").load(str(tmp_path / "a.png"))).first()
    assert (got.width, got.height) == (300, 300) and abs(got.laplacian_variance - images.laplacian_variance(grid)) < 1
    files = images.scan_folder(spark, str(tmp_path))
    assert files.select(images.sniff(F.col("content"))["width"]).first()[0] == 300
    assert images.pair_sidecars(files, images.sidecars(spark, str(tmp_path))).first().caption == "a caption"
    mark = np.zeros((200, 200))
    mark[:16, :20] = 255
    assert images.corner_mark(mark) == "high_contrast_corner_0" and images.corner_mark(np.zeros((200, 200))) is None


def jpeg_head(width, height, how, order):
    e = "<" if order == b"II" else ">"
    tiff = order + struct.pack(e + "HI", 42, 8) + struct.pack(e + "H", 2) + struct.pack(e + "HHII", 0x0100, 4, 1, 7) + struct.pack(e + "HHIHH", 0x0112, 3, 1, how, 0) + b"\0" * 4
    exif = b"Exif\0\0" + tiff
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(exif) + 2) + exif + b"\xff\xc0" + struct.pack(">HBHH", 17, 8, height, width) + b"\0" * 12


def test_orientation(spark):
    for order in (b"II", b"MM"):
        assert [images.orientation(jpeg_head(30, 20, k, order)) for k in range(1, 9)] == list(range(1, 9))
    assert images.orientation(jpeg_head(30, 20, 9, b"II")) == images.orientation(b"\xff\xd8\xff\xe1\0") == images.orientation(None) == images.orientation(b"\x89PNG") == 1
    seen = np.arange(6).reshape(2, 3)
    # What is stored for a picture to be seen so, by the meaning of each value.
    stored = {1: seen, 2: seen[:, ::-1], 3: seen[::-1, ::-1], 4: seen[::-1], 5: seen.T, 6: np.rot90(seen, 1), 7: seen[::-1, ::-1].T, 8: np.rot90(seen, -1)}
    for how, pixels in stored.items():
        assert (images.upright(pixels, how) == seen).all(), how
    df = spark.createDataFrame([(1, jpeg_head(30, 20, 6, b"MM")), (2, jpeg_head(30, 20, 3, b"II")), (3, None), (4, b"no picture at all")], "i int, c binary")
    got = {r.i: (r.s.width, r.s.height) for r in df.select("i", images.sniff_upright(F.col("c")).alias("s")).collect()}
    assert got == {1: (20, 30), 2: (30, 20), 3: (None, None), 4: (None, None)}


def test_manifest_round_trip(spark, tmp_path):
    p = tmp_path / "m.jsonl"
    p.write_text(json.dumps({"image_id": "a", "width": 3, "updated_at": "2024-01-01T00:00:00Z"}) + "\n\n{bad\n")
    rows, corrupt = manifest.read_jsonl(spark, str(p))
    assert [r.image_id for r in rows.collect()] == ["a"] and corrupt.count() == 1
    root = str(tmp_path / "state")
    manifest.publish(rows, root)
    changes = rows.withColumn("width", F.lit(1920)).withColumn("updated_at", F.expr("updated_at + interval 1 day"))
    manifest.publish(manifest.upsert(manifest.read_snapshot(spark, root), changes), root)
    got = manifest.read_snapshot(spark, root).collect()
    assert [(r.image_id, r.width) for r in got] == [("a", 1920)]
    assert manifest.insert_absent(rows, rows.union(changes.withColumn("image_id", F.lit("b"))), "image_id").count() == 2


def test_last_line_wins(spark, tmp_path):
    lines = [{"image_id": f"i{k % 50}", "width": k} for k in range(5000)]
    (tmp_path / "a.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n")
    (tmp_path / "b.jsonl").write_text(json.dumps({"image_id": "i7", "width": -1}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # one file in several tasks
    try:
        rows, corrupt = manifest.read_jsonl(spark, str(tmp_path / "*.jsonl"), last_wins=True)
        got = {r.image_id: r.width for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"i{k}": -1 if k == 7 else 4950 + k for k in range(50)} and corrupt.count() == 0


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    import os

    root = str(tmp_path / "state")
    rows = lambda ids, v, t: spark.createDataFrame([(i, v, t) for i in ids], "image_id string, v int, updated_at int")
    ids = [f"i{k}" for k in range(100)]
    assert len(manifest.merge_buckets(rows(ids, 1, 1), root, buckets=8)) == 8
    touched = manifest.merge_buckets(rows(["i3"], 2, 2), root, buckets=99)
    assert len(touched) == 1  # the number of parts stays
    manifest.merge_buckets(rows(["i4"], 0, 0), root)  # older: the state stays
    manifest.merge_buckets(rows(["i3", None], 2, 2), root)  # again: the same state
    got = {r.image_id: r.v for r in manifest.read_snapshot(spark, root).collect()}
    assert got == {i: 2 if i == "i3" else 1 for i in ids}
    assert manifest.merge_buckets(rows([], 1, 1), root) == []
    assert len(os.listdir(f"{root}/buckets")) <= 5
    with pytest.raises(FileNotFoundError):
        manifest.read_snapshot(spark, str(tmp_path / "none"))


def test_write_missing_keeps_what_is_there(spark, tmp_path):
    at = str(tmp_path / "subset")
    reports.write_missing(spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 1)], "k string, v int"), at, "k")
    reports.write_missing(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), at, "k")
    assert sorted(tuple(r) for r in spark.read.parquet(at).collect()) == [("a", 1), ("b", 1), ("c", 2)]


def test_config(spark, tmp_path):
    (tmp_path / "c.yaml").write_text("a: 1")
    assert config.load_yaml(str(tmp_path / "c.yaml")) == {"a": 1} and config.load_yaml(str(tmp_path / "no.yaml")) == {}
    assert config.vocabulary(spark, {"style": ["x", "other"]}).count() == 2
    assert config.resolve_path(str(tmp_path / "c.yaml")) and config.resolve_path("nowhere") is None
    (tmp_path / "set").mkdir()
    (tmp_path / "genres.txt").write_text("Title: t\nGenres: a, b\n")
    g = config.genre_sidecars(spark, str(tmp_path))
    assert g.first().genres == "a, b"
    pictures = g.select(F.concat("folder", F.lit("/set/x.jpg")).alias("path"))
    assert config.folder_genres(pictures, g).first().genres == "a, b"


def test_reports(spark):
    d = spark.createDataFrame([("style", "a", 3), ("style", "<b>", 1)], "dimension string, value string, n long")
    assert "| a | 3 | 75.0 % |" in reports.distribution_markdown(d, 4) and "0.0 %" in reports.distribution_markdown(d, 0)
    assert "&lt;b&gt;" in reports.sample_html(d, ["value"])
    cfg = reports.dataset_config(spark.createDataFrame([("a", 2)], "c string, repeats int"), "c", "data")
    assert "repeats: 2" in reports.as_yaml(cfg) and 'path = "data/a"' in reports.as_toml(cfg)
    assert len(cfg["buckets"]) == 7 and cfg["resolutions"] == [1024, 1536, 2048] and cfg["caption_ext"] == "txt"
    with pytest.raises(ValueError):
        reports.distribution_markdown(d, 4, most_rows=1)
    hist = spark.createDataFrame([("i", 1, "x"), ("j", 1, "y")], "item_id string, version int, text string")
    new = spark.createDataFrame([("i", "z"), ("j", "y"), ("k", "n")], "item_id string, text string")
    assert sorted(tuple(r) for r in reports.caption_versions(hist, new).collect()) == [("i", 1, "x"), ("i", 2, "z"), ("j", 1, "y"), ("k", 1, "n")]
    assert "<td>p</td>" in reports.contact_sheet_html(spark.createDataFrame([("p",)], "prompt string"), [0.4, 1.0])


def test_streaming_upsert(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "state")
    df = spark.createDataFrame([("a", 1), ("b", 1)], "image_id string, v int").withColumn("updated_at", F.timestamp_seconds(F.lit(10)))
    df.write.parquet(str(src))
    run = lambda: state_stream.upsert_stream(spark.readStream.schema(df.schema).parquet(str(src)), root, str(tmp_path / "cp")).awaitTermination(60)
    assert run()
    df.limit(1).withColumn("v", F.lit(2)).withColumn("updated_at", F.timestamp_seconds(F.lit(20))).write.mode("append").parquet(str(src))
    assert run()
    assert sorted((r.image_id, r.v) for r in manifest.read_snapshot(spark, root).collect()) == [("a", 2), ("b", 1)]


def test_streaming_windows(spark, tmp_path):
    df = spark.createDataFrame([("x", 0, 1.0), ("x", 0, 1.0), ("y", 700, 2.0), ("x", 5000, 1.0)], "k string, s long, value double").select("k", F.timestamp_seconds("s").alias("ts"), "value")
    df.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "e"))
    for name, plan in (("seen", state_stream.first_sightings(stream, "k", "ts")), ("win", state_stream.windowed_counts(stream, "ts", "k"))):
        q = plan.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert q.awaitTermination(60)
    assert spark.table("seen").count() == 2
    assert {(r.k, r.n) for r in spark.table("win").collect()} == {("x", 2), ("y", 1)}
