"""Item state on disk: JSON lines in, versioned Parquet snapshots out."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatrix.operators.state import latest_rows

ENTRY_SCHEMA = """image_id string, source string, source_url string, page_url string, context_title string, context_tags array<string>, category string,
 trigger_word string, raw_path string, processed_path string, sha256 string, phash string, phash_cluster_id string, width int, height int, aspect_ratio double,
 megapixels double, stages_status map<string,string>, rejection_reasons array<string>,
 qc_metrics struct<laplacian_variance:double,has_watermark:boolean,watermark_confidence:double>, caption_data string, caption_text string, created_at timestamp, updated_at timestamp"""


def read_jsonl(spark: SparkSession, path: str, last_wins: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, corrupt lines) of a JSON-lines log; blank lines are in neither, lines without an id are corrupt.

    With ``last_wins`` there is one row per id, the one that stands last: by file name, then by place in the
    file. The place is the block's offset and the line's number in it, so no task reads a whole file.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", at.alias("_at")).where(F.trim("value") != "")
    parsed = lines.select("value", "_at", F.from_json("value", ENTRY_SCHEMA + ", _corrupt string", options).alias("e"))
    bad = F.col("e").isNull() | F.col("e._corrupt").isNotNull() | F.col("e.image_id").isNull()
    rows, corrupt = parsed.where(~bad).select("e.*", "_at").drop("_corrupt"), parsed.where(bad).select(F.col("value").alias("_corrupt"))
    if last_wins:
        rows = latest_rows(rows, "image_id", ["_at"], {c: c for c in rows.columns if c not in ("image_id", "_at")})
    return rows.drop("_at"), corrupt


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, named = _fs(spark, path)
    return fs.exists(named(path))


def _pointer(spark: SparkSession, root: str) -> dict | None:
    """What the pointer of ``root`` says, None where there is none yet."""
    return json.loads(spark.read.text(f"{root}/CURRENT").first()[0]) if exists(spark, f"{root}/CURRENT") else None


def _swap(spark: SparkSession, root: str, content: dict) -> None:
    """Replaces the pointer by a rename; a reader sees the old or the new one."""
    fs, path = _fs(spark, root)
    staged, pointer = path(f"{root}/CURRENT.{uuid.uuid4().hex}"), path(f"{root}/CURRENT")
    out = fs.create(staged, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    # rename doesn't overwrite everywhere: the file context's rename with OVERWRITE does, atomically.
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(staged), fs.makeQualified(pointer), options)


def _drop_versions(spark: SparkSession, folder: str, kept: set[str]) -> None:
    """Removes the versions below ``folder`` that are not in ``kept``."""
    fs, path = _fs(spark, folder)
    for status in fs.listStatus(path(folder)):
        if status.getPath().getName() not in kept:
            fs.delete(status.getPath(), True)


def publish(df: DataFrame, root: str) -> str:
    """Writes a new snapshot folder, then swaps the pointer; the snapshot before it stays for readers, older ones go."""
    spark = df.sparkSession
    version = uuid.uuid4().hex
    before = _pointer(spark, root)
    df.write.parquet(f"{root}/snapshots/{version}")
    _swap(spark, root, {"version": version})
    _drop_versions(spark, f"{root}/snapshots", {version, *([before["version"]] if before else [])})
    return version


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The state that the pointer of ``root`` names: one snapshot, or the current version of every bucket."""
    named = _pointer(spark, root)
    if named is None:
        raise FileNotFoundError(f"no snapshot below {root}")
    if "buckets" in named:
        return spark.read.parquet(*_bucket_paths(root, named["buckets"]))
    return spark.read.parquet(f"{root}/snapshots/{named['version']}")


def _bucket_paths(root: str, versions: dict[str, str]) -> list[str]:
    return [f"{root}/buckets/{v}/__bucket={b}" for b, v in versions.items()]


def merge_buckets(changes: DataFrame, root: str, key: str = "image_id", order: str = "updated_at", buckets: int = 256) -> list[int]:
    """Changes merged into a state kept in ``buckets`` parts by a hash of the key; returns the parts rewritten.

    Only the parts that the changes touch are read and written, then one pointer swap makes them current;
    the versions before stay for readers, older ones go. The number of parts is fixed by the first merge.
    Merging the same changes again gives the same state. Rows with a null key name no item.
    """
    spark = changes.sparkSession
    named = _pointer(spark, root) or {"n": buckets, "buckets": {}, "before": []}
    part = F.pmod(F.xxhash64(key), F.lit(named["n"])).cast("int")
    placed = changes.where(F.col(key).isNotNull())
    touched = sorted(r[0] for r in placed.select(part.alias("b")).distinct().collect())  # at most one row per part
    if not touched:
        return []
    held = {b: v for b, v in named["buckets"].items() if int(b) in touched}
    state = spark.read.parquet(*_bucket_paths(root, held)) if held else placed.limit(0)
    version = uuid.uuid4().hex
    upsert(state, placed, key, order).withColumn("__bucket", part).repartition("__bucket").write.partitionBy("__bucket").parquet(f"{root}/buckets/{version}")
    current = {**named["buckets"], **{str(b): version for b in touched}}
    _swap(spark, root, {"n": named["n"], "buckets": current, "before": sorted(set(named["buckets"].values()))})
    _drop_versions(spark, f"{root}/buckets", {*current.values(), *named["buckets"].values()})
    return touched


def upsert(state: DataFrame, changes: DataFrame, key: str = "image_id", order: str = "updated_at") -> DataFrame:
    """State rows replaced by changes of the same key that are not older; new keys added.

    On equal times the change wins. One shuffle on the key, combined map-side.
    """
    both = state.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    columns = {c: c for c in both.columns if c not in (key, "__new")}
    return latest_rows(both, key, [order, "__new"], columns)


def insert_absent(state: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """State and the candidates whose key it lacks, one per key."""
    fresh = candidates.where(F.col(key).isNotNull()).join(state.select(key), key, "left_anti").dropDuplicates([key])
    return state.unionByName(fresh, allowMissingColumns=True)
