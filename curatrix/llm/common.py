"""What several operators of this subpackage share: current rows, the quality score, table access."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators.state import latest_rows

_BLANKS = re.compile("[\\s\u200b\u2060\ufeff]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def current_manifest(spark: SparkSession, sf_dir: str, columns: dict[str, Column | str]) -> DataFrame:
    """The row of each image_id with the greatest updated_at, then line_no; only ``columns`` are shuffled."""
    return latest_rows(table(spark, sf_dir, "manifest_entries"), "image_id", ["updated_at", "line_no"], columns)


def current_captions(spark: SparkSession, sf_dir: str, columns: dict[str, Column | str]) -> DataFrame:
    """The row of each image_id with the greatest created_at, then caption_id."""
    return latest_rows(table(spark, sf_dir, "captions"), "image_id", ["created_at", "caption_id"], columns)


def usable(c: Column) -> Column:
    """``c`` where it is above 0 and not NaN, else null (Spark orders NaN above every number)."""
    return F.when((c > 0) & ~F.isnan(c), c)


def quality_score(width: Column, height: Column, megapixels: Column, laplacian: Column) -> Column:
    """mp * (laplacian / 100) in doubles; null without usable values."""
    w, h = width.cast("double"), height.cast("double")
    mp = F.coalesce(F.when((w > 0) & (h > 0), w * h / 1000000), usable(megapixels.cast("double")))
    return mp * (usable(laplacian.cast("double")) / 100)


def row_score() -> Column:
    """quality_score over the manifest's own columns."""
    return quality_score(F.col("width"), F.col("height"), F.col("megapixels"), F.col("qc_metrics.laplacian_variance"))


def fold(s: str) -> str:
    """Lower case, NFC, single blanks, none at the ends."""
    s = unicodedata.normalize("NFC", unicodedata.normalize("NFC", s).lower())
    return _BLANKS.sub(" ", s).strip()


def is_hostile(name: str, taken: set[str]) -> bool:
    """Whether a working column ``name`` would clash with a caller's column."""
    return name.lower() in {t.lower() for t in taken}
