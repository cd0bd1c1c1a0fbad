"""Mixing sources to target weights, small sources repeated a capped number of times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curatrix.session import cut_lineage


#: Most sources a mix may name; their rates, one row each, are broadcast.
MAX_SOURCES = 10_000


def source_name(c: Column) -> Column:
    """One spelling per source: lower case, outer white space off, '_' and blanks as '-'; blank is null."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)^\s+|\s+$", ""), r"(?U)[\s_-]+", "-")
    return F.when(s != "", s)


def mixing_rates(tokens: DataFrame, targets: DataFrame, total_tokens: int | None = None, default_max_repeats: int = 1, max_sources: int = MAX_SOURCES) -> list[dict]:
    """Target share, available tokens and repetition rate of each source of ``targets``.

    ``tokens`` is (source, n_tokens) per document, ``targets`` (source, target_weight, max_repeats).
    Spellings of one source are joined (weights add up, the greater cap holds); a null or non-positive
    weight takes part with 0; a null cap means ``default_max_repeats``: no source is repeated without
    leave. Weights are scaled to add up to one over the sources that have tokens. The mix aims at
    ``total_tokens`` (default: all tokens of the sources taking part): a source's rate is its share of
    them over its own tokens, at most its cap, so an uncapped source meets its share of the aim and a
    capped one stays below it. The result is configuration, one row per target source, at most
    ``max_sources``.
    """
    named = targets.groupBy(source_name(F.col("source")).alias("source")).agg(
        F.sum(F.when(F.col("target_weight") > 0, F.nanvl("target_weight", F.lit(0.0)))).alias("weight"), F.max("max_repeats").alias("cap")
    )
    sums = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    rows = named.where(F.col("source").isNotNull()).join(sums, "source", "left").limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} target sources")
    live = [r for r in rows if r["tokens"] and r["weight"]]
    aim = total_tokens if total_tokens is not None else sum(r["tokens"] for r in live)
    weights = sum(r["weight"] for r in live)
    out = []
    for r in sorted(rows, key=lambda r: r["source"]):
        share = r["weight"] / weights if r["tokens"] and r["weight"] else 0.0
        cap = default_max_repeats if r["cap"] is None else max(0, r["cap"])
        rate = min(float(cap), share * aim / r["tokens"]) if share else 0.0
        out.append(
            {"source": r["source"], "target_share": share, "available_tokens": r["tokens"] or 0, "documents": r["documents"] or 0, "max_repeats": cap, "rate": rate}
        )
    return out


def mix(documents: DataFrame, rates: list[dict], seed: int = 29) -> DataFrame:
    """(doc_id, source, n_tokens, copy_no): floor(rate) copies of each document and one more by hash.

    The extra copy is drawn by a hash of the id and the seed against the rate's fraction, so a task run
    again draws the same. Documents of sources without a rate are not in the mix; a null n_tokens (null
    text) has nothing to supply and isn't either. A rate never exceeds its whole cap, so no document has
    more copies than the cap.
    """
    given = [(r["source"], float(r["rate"])) for r in rates if r["rate"] > 0]
    if not given:
        return documents.select("doc_id", "source", "n_tokens", F.lit(1).alias("copy_no")).limit(0)
    if len(given) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    rated = documents.sparkSession.createDataFrame(given, "source string, rate double")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor("rate").cast("int") + (draw < F.col("rate") - F.floor("rate")).cast("int")
    mixed = documents.where(F.col("n_tokens").isNotNull()).join(F.broadcast(rated), "source")
    return mixed.withColumn("copies", copies).where(F.col("copies") > 0).select(
        "doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no")
    )


def share_report(spark: SparkSession, mixed: DataFrame, rates: list[dict]) -> DataFrame:
    """Per target source: target and actual share of tokens, tokens emitted, documents, most copies."""
    asked = spark.createDataFrame(
        [(r["source"], r["target_share"], r["available_tokens"], r["documents"], r["max_repeats"], r["rate"]) for r in rates],
        "source string, target_share double, available_tokens long, documents long, max_repeats int, rate double",
    )
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count(F.lit(1)).alias("copies"), F.max("copy_no").alias("most_copies"))
    joined = asked.join(got, "source", "left").fillna(0, ["mixed_tokens", "copies", "most_copies"])
    # One row per target source, so the window over all of them is small.
    return joined.withColumn("actual_share", F.col("mixed_tokens") / F.nullif(F.sum("mixed_tokens").over(Window.partitionBy(F.lit(1))), F.lit(0)))


def counted_documents(documents: DataFrame, n_tokens: Column) -> DataFrame:
    """(doc_id, source, n_tokens) with one spelling per source, stored: token counts are made only once."""
    return cut_lineage(documents.select("doc_id", source_name(F.col("source")).alias("source"), n_tokens.alias("n_tokens")))
