"""The pN_ queries: each problem's operator over its whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.llm.common import current_captions, current_manifest, quality_score, row_score, table, usable
from curatrix.llm.contributor_cap import set_name, split_by_cap
from curatrix.llm.grouping import connected_groups
from curatrix.llm.mixing import counted_documents, mix, mixing_rates, share_report, source_name
from curatrix.llm.packing import fill_report, pack
from curatrix.llm.stuffing import page_scores, stuffed_pages
from curatrix.llm.survivorship import Attribute, survivors
from curatrix.llm.term_frequency import partial_counts, term_frequencies
from curatrix.llm.tokens import token_count
from curatrix.llm.truncation import source_shares, truncated
from curatrix.operators.state import latest_rows


def _terms(spark: SparkSession, d: str) -> DataFrame:
    tags = partial_counts(current_manifest(spark, d, {"context_tags": "context_tags"}), {"context_tags": F.col("context_tags")})
    dims = ("style", "location", "pose")
    rows = current_captions(spark, d, {c: c for c in dims})
    return term_frequencies([tags, partial_counts(rows, {c: F.array(c) for c in dims})])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).where(F.col("mark").isNotNull()).select("dimension", "term", "mark")


def p1_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return _terms(spark, d).select("dimension", "term", "occurrences", "records", "mark")


def _sets(spark: SparkSession, d: str) -> DataFrame:
    # Named before the current rows are taken, so that both uses of them share the shuffle behind the names.
    named = table(spark, d, "manifest_entries").withColumn("set_name", set_name("category", "context_title"))
    return latest_rows(named, "image_id", ["updated_at", "line_no"], {"set_name": "set_name", "score": row_score()})


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return split_by_cap(_sets(spark, d), "set_name", "image_id", "score", cap=20, beyond=True).select("image_id")


def p2_capped(spark: SparkSession, d: str) -> DataFrame:
    """The rows that stay: at most 20 a set, and all rows of no set."""
    return split_by_cap(_sets(spark, d), "set_name", "image_id", "score", cap=20).select("image_id")


def _links(spark: SparkSession, d: str) -> DataFrame:
    """The pairs of p3: near by hamming, or by the current phashes where that is null, of known images."""
    clean = lambda c: F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    images = (
        current_manifest(spark, d, {"phash": "phash", "updated_at": "updated_at", "line_no": "line_no"})
        .groupBy(clean("image_id").alias("image"))
        .agg(F.max_by("phash", F.struct("updated_at", "line_no")).alias("phash"))
        .select("image", *[F.conv(F.substring("phash", at, 8), 16, 10).cast("long").alias(n) for n, at in (("hi", 1), ("lo", 9))])
    )
    raw = table(spark, d, "match_pairs").where(F.col("hamming").isNull() | (F.col("hamming") <= 6))
    a, b = clean("image_id_a"), clean("image_id_b")
    pairs = (
        raw.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "hamming", a.alias("x"), b.alias("y"))
        .where(F.col("x") != F.col("y"))
        .groupBy("a", "b")
        .agg(F.bool_or(F.col("hamming").isNotNull()).alias("measured"))
    )
    joined = pairs
    for end in ("a", "b"):
        side = images.select(F.col("image").alias(f"{end}_image"), F.col("hi").alias(f"{end}_hi"), F.col("lo").alias(f"{end}_lo"))
        joined = joined.join(side, F.col(end) == F.col(f"{end}_image"))
    apart = F.bit_count(F.col("a_hi").bitwiseXOR(F.col("b_hi"))) + F.bit_count(F.col("a_lo").bitwiseXOR(F.col("b_lo")))
    return joined.where(F.col("measured") | (apart <= 6)).select("a", "b")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return connected_groups(_links(spark, d)).select(F.col("id").alias("image_id"), "group_id")


def p3_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The groups of p3_found by a grid of small blocks, so that many rounds and blocks run on small tables too."""
    return connected_groups(_links(spark, d), edges_per_block=300).select(F.col("id").alias("image_id"), "group_id")


def _clusters(spark: SparkSession, d: str, *columns: str) -> tuple[DataFrame, list[Attribute]]:
    qc = F.col("qc_metrics")
    score = quality_score(F.col("width"), F.col("height"), F.col("megapixels"), qc.laplacian_variance)
    present = [usable(qc.laplacian_variance).isNotNull(), qc.has_watermark.isNotNull(), qc.watermark_confidence.isNotNull()]
    complete = sum((F.coalesce(p, F.lit(False)).cast("int") for p in present), F.lit(0))
    rows = current_manifest(
        spark, d, {"phash_cluster_id": "phash_cluster_id", "score": score, "complete": complete, "source": "source", "updated_at": "updated_at", **{c: c for c in columns}}
    )
    name = lambda c: F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    # A fixed table (one row per trusted source); a sort-merge join takes over where it has grown.
    trust = table(spark, d, "source_trust").groupBy(name("source").alias("trusted")).agg(F.max("trust").alias("trust"))
    rows = rows.where(F.col("phash_cluster_id").isNotNull()).join(trust, name("source") == F.col("trusted"), "left")
    at = F.unix_micros("updated_at")
    ranks = {"image_id": [F.col("score"), at], "qc_image_id": [F.col("complete"), F.col("trust"), at]}
    return rows, [Attribute(name, F.col("image_id"), rank, [F.col("image_id")]) for name, rank in ranks.items()]


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    rows, attributes = _clusters(spark, d)
    return survivors(rows, "phash_cluster_id", attributes)


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each cluster: image_id and megapixels of the best image, qc_metrics of the best measured one."""
    rows, (image, qc) = _clusters(spark, d, "megapixels", "qc_metrics")
    metrics = F.col("qc_metrics")
    values = [
        image,
        Attribute("megapixels", F.col("megapixels"), image.rank, image.tie),
        *[Attribute(name, metrics[name], qc.rank, qc.tie) for name in ("laplacian_variance", "has_watermark", "watermark_confidence")],
    ]
    return survivors(rows, "phash_cluster_id", values)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """Every text of both columns; an even uid is a caption's, an odd one a manifest row's."""
    dense = table(spark, d, "captions").select((F.col("caption_id") * 2).alias("uid"), F.col("caption_dense").alias("text"), F.col("engine").alias("source"))
    plain = table(spark, d, "manifest_entries").select((F.col("line_no") * 2 + 1).alias("uid"), F.col("caption_text").alias("text"), F.col("source"))
    return dense.unionByName(plain).where(F.col("uid").isNotNull())


def _text_column() -> Column:
    return F.when(F.pmod("uid", F.lit(2)) == 0, "caption_dense").otherwise("caption_text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return truncated(_texts(spark, d)).where("cut").select(_text_column().alias("text_column"), F.expr("uid div 2").alias("row_id"))


def p5_source_shares(spark: SparkSession, d: str) -> DataFrame:
    """Share of cut texts per engine and manifest source, over the rows with a text that isn't blank, refusals included."""
    texts = _texts(spark, d).where(F.regexp_like("text", F.lit(r"(?U)\S")))
    judged = texts.select("uid", source_name(F.col("source")).alias("source")).join(truncated(texts), "uid").withColumn("text_column", _text_column())
    return source_shares(judged, F.col("source"))


def p6_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    items = docs.select(F.col("doc_id").alias("item_id"), token_count(F.col("text")).alias("size"))
    return pack(items, table(spark, d, "containers"), docs.count()).withColumnRenamed("item_id", "doc_id")


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return fill_report(p6_packing(spark, d))


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, list[dict]]:
    docs = counted_documents(table(spark, d, "documents"), token_count(F.col("text")))
    rates = mixing_rates(docs, table(spark, d, "mix_targets"))
    return mix(docs, rates), rates


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    mixed, rates = _mix(spark, d)
    return share_report(spark, mixed, rates)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return stuffed_pages(table(spark, d, "documents"), "doc_id", "text").select("doc_id")


def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return page_scores(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_frequencies, p2_found, p2_capped, p3_found, p3_blocks, p4_found, p4_records, p5_found, p5_source_shares, p6_packing, p6_report, p7_mix, p7_report, p8_found, p8_scores)
}
