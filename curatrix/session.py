"""Session helpers: builder with the settings the plans rely on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings the plans rely on; a caller's own session may override any of them.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "curatrix", **conf: str) -> SparkSession:
    """A session with DEFAULTS; keyword arguments add settings (dots written as double underscores)."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; in local mode without that setting a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="curatrix_checkpoint_")
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are in shared storage, so a lost executor costs only re-reading."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
