"""A keyed table that takes each micro-batch once, whatever is retried.

An epoch is staged in its own folder and counts only when its commit record is
published; a retry before that overwrites the folder, one after it is skipped. A row of
a later epoch replaces the one with the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.streaming.manifest import Manifest

STATS_KEY = ("stt", "ar", "ch", "vc", "is_new")


class EpochTable:
    def __init__(self, spark: SparkSession, path: str, key: tuple[str, ...] = STATS_KEY):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.commits = Manifest(spark, f"{self.path}/commits")

    def stage(self, rows: DataFrame, epoch: int) -> dict:
        """Write an epoch's rows where no reader looks; returns the record to commit."""
        rows.write.mode("overwrite").parquet(f"{self.path}/data/epoch={epoch}")
        return {"epoch": epoch, "schema": rows.schema.simpleString()}

    def commit(self, epoch: int, record: dict) -> bool:
        return self.commits.publish(epoch, record)

    def upsert(self, rows: DataFrame, epoch: int) -> bool:
        """Stage and commit; False if the epoch was committed before."""
        if self.commits.get(epoch) is not None:
            return False
        return self.commit(epoch, self.stage(rows, epoch))

    def read(self) -> DataFrame:
        """The newest committed row of each key."""
        done = self.commits.numbers()
        if not done:
            raise ValueError(f"no epoch has been committed to {self.path}")
        rows = self.spark.read.option("basePath", f"{self.path}/data") \
            .parquet(*[f"{self.path}/data/epoch={n}" for n in done])
        cols = [c for c in rows.columns if c != "epoch"]
        newest = rows.groupBy(*self.key).agg(F.max_by(F.struct(*cols), "epoch").alias("r"))
        return newest.select("r.*")
