"""Driver-side configuration: YAML files, vocabularies, paths and genre sidecars."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_yaml(path: str) -> dict:
    """A YAML mapping; {} for an absent or empty file."""
    import yaml

    p = Path(path)
    return (yaml.safe_load(p.read_text(encoding="utf-8")) or {}) if p.exists() else {}


def vocabulary(spark: SparkSession, terms: dict[str, list[str]], other: str = "other") -> DataFrame:
    """(dimension, term) of a mapping of lists, each with the catch-all term."""
    rows = [(d, t) for d, ts in terms.items() for t in dict.fromkeys([*ts, other])]
    return spark.createDataFrame(rows, "dimension string, term string")


def resolve_path(path: str | None, data_dir: str = "data") -> str | None:
    """The path as given, below the data folder, or without that folder's prefix: the first that exists."""
    if not path:
        return None
    options = [path, f"{data_dir}/{path}", path.removeprefix(f"{data_dir}/")]
    return next((p for p in options if Path(p).exists()), None)


def genre_sidecars(spark: SparkSession, path: str, name: str = "genres.txt") -> DataFrame:
    """(folder, genres) from the 'Genres:' line of the sidecar files below a folder."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(path, wholetext=True)
    line = F.trim(F.regexp_extract("value", r"(?im)^(?:genres?|tags?)[ \t]*:[ \t]*(.+)$", 1))
    return files.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("folder"), F.nullif(line, F.lit("")).alias("genres"))


def folder_genres(pictures: DataFrame, genres: DataFrame) -> DataFrame:
    """Pictures with the genres of their folder, else of its parent."""
    at = pictures.withColumn("__f", F.regexp_replace("path", "/[^/]*$", "")).withColumn("__p", F.regexp_replace("__f", "/[^/]*$", ""))
    own = genres.select(F.col("folder").alias("__f"), F.col("genres").alias("__own"))
    above = genres.select(F.col("folder").alias("__p"), F.col("genres").alias("__above"))
    return at.join(own, "__f", "left").join(above, "__p", "left").withColumn("genres", F.coalesce("__own", "__above")).drop("__f", "__p", "__own", "__above")
