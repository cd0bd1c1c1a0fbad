"""Item state from a stream: late duplicates dropped, micro-batches upserted into snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def first_sightings(events: DataFrame, key: str, time: str, delay: str = "10 minutes") -> DataFrame:
    """The first event of each key within the watermark; state is dropped as the watermark passes."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "5 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """(start, end, by, n, total) per window, final once the watermark has passed it."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    g = events.withWatermark(time, delay).groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def upsert_stream(changes: DataFrame, root: str, checkpoint: str, key: str = "image_id", order: str = "updated_at", buckets: int = 256) -> StreamingQuery:
    """Every micro-batch merged into the state below ``root``, of which only the parts it touches are rewritten.

    A batch run again merges to the same state.
    """
    from curatrix.sources.manifest import merge_buckets

    def merge(batch: DataFrame, _: int) -> None:
        held = batch.persist()  # read once to find the parts and once to merge
        try:
            merge_buckets(held, root, key, order, buckets)
        finally:
            held.unpersist()

    return changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
