"""Late rows as rows of their own.

Spark drops a row behind the watermark and counts it. ``split_late`` is a job in front
of a windowed one: it tells for every row of a micro-batch, by the watermark of
the batches before, whether its window has closed, and writes the rows to two parts
of one folder, ``on_time`` and ``late``. The newest event time of each
batch is a published record, so a batch that runs again is split as before. A
windowed job on the first part has nothing to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.streaming.manifest import Manifest
from strata.streaming.topics import topic_path

ON_TIME, LATE = "on_time", "late"


def is_late(ts: str | Column, newest_ms: int | None, delay_ms: int, window_ms: int) -> Column:
    """The row's tumbling window has ended at or before the watermark, as Spark's windowed aggregation tests it."""
    t = F.col(ts) if isinstance(ts, str) else ts
    if newest_ms is None:
        return F.lit(False)
    return F.coalesce(t - F.pmod(t, F.lit(window_ms)) + window_ms <= F.lit(newest_ms - delay_ms), F.lit(False))


def split_late(raw: DataFrame, root: str, topic: str, checkpoint: str, ts: Column, delay_ms: int, window_ms: int,
               trigger: dict | None = None):
    """Start the job on a frame with ``value``; ``ts`` is the event time in epoch millis (rows without one are on time)."""
    spark: SparkSession = raw.sparkSession
    seen = Manifest(spark, topic_path(root, f"_{topic}_newest"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        before = seen.latest(batch_id)
        newest = before[1]["newest"] if before else None
        rows = batch.select("value", ts.alias("_ts")).withColumn("batch_id", F.lit(batch_id))
        split = F.when(is_late("_ts", newest, delay_ms, window_ms), LATE).otherwise(ON_TIME)
        rows.withColumn("part", split).drop("_ts").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("part", "batch_id").parquet(topic_path(root, f"{topic}_split"))
        here = rows.agg(F.max("_ts")).first()[0]
        known = [t for t in (newest, here) if t is not None]
        seen.publish(batch_id, {"newest": max(known) if known else None})

    return (raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_split(spark: SparkSession, root: str, topic: str, part: str) -> DataFrame:
    """``value`` of the rows on time or late, read as a table."""
    return spark.read.schema("value STRING, part STRING, batch_id INT").parquet(topic_path(root, f"{topic}_split")) \
        .filter(F.col("part") == part).select("value")
