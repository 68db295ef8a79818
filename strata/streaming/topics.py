"""Layer topics for the streaming jobs.

A topic is either a Kafka topic or a folder of parquet files holding one
``value STRING`` column (JSON text) — the same shape Kafka yields after
``CAST(value AS STRING)``. Fan-out writes carry a ``topic`` column: Kafka's sink
routes each row by it, the file sink partitions by it.

Rows come with ``pos``, their order in the topic: records need no sequence
number of their own. It is a struct (at, source, row) that sorts as one value and
has no bounds on rows, partitions or times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOPIC_SCHEMA = "value STRING"
#: Compression of file topics and of the tables beside them: JSON text takes a fraction of what it takes in Spark's default.
CODEC = "zstd"


def file_position() -> Column:
    """Order of a file topic's rows: the file's time, its path, the row's place in it.
    Files written in the same millisecond are ordered by their paths."""
    return F.struct(F.unix_millis("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("source"),
                    F.col("_metadata.row_index").cast("bigint").alias("row"))


def kafka_position() -> Column:
    """Order of a Kafka topic's rows: the offset, then the partition (a key stays in one partition)."""
    return F.struct(F.col("offset").alias("at"), F.lpad(F.col("partition").cast("string"), 10, "0").alias("source"),
                    F.lit(0).cast("bigint").alias("row"))


def topic_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/{topic}"


def read_topic(spark: SparkSession, root: str, topic: str, fmt: str = "parquet",
               max_files_per_trigger: int | None = None, kafka_options: dict | None = None) -> DataFrame:
    """A streaming frame with a ``value`` text column and its position ``pos``.

    Offsets live in the query's checkpoint (Kafka) or its file-source log.
    """
    if fmt == "kafka":
        r = spark.readStream.format("kafka").option("subscribe", topic)
        for k, v in (kafka_options or {}).items():
            r = r.option(k, v)
        return r.load().select(F.col("value").cast("string").alias("value"), kafka_position().alias("pos"))
    r = spark.readStream.schema(TOPIC_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(topic_path(root, topic)).select("value", file_position().alias("pos"))


def read_layer(spark: SparkSession, root: str, topic: str, folder: str, fmt: str = "parquet",
               kafka_options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 for a topic that a fan-out writes: by name in Kafka, by partition of ``folder`` in files."""
    if fmt == "kafka":
        return read_topic(spark, root, topic, fmt, None, kafka_options)
    return read_fanout(spark, root, topic, folder, max_files_per_trigger=max_files_per_trigger)


def read_topic_batch(spark: SparkSession, root: str, topic: str) -> DataFrame:
    return spark.read.schema(TOPIC_SCHEMA).parquet(topic_path(root, topic))


def publish(df: DataFrame, root: str, topic: str, as_json: bool = True) -> None:
    """Batch append into a file topic (backfills, tests): rows become JSON text
    unless the frame already is a ``value`` column."""
    out = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value")) if as_json else df
    out.write.mode("append").option("compression", CODEC).parquet(topic_path(root, topic))


def write_topic(df: DataFrame, root: str, topic: str, checkpoint: str, fmt: str = "parquet",
                trigger: dict | None = None, kafka_options: dict | None = None, query_name: str | None = None):
    """Fixed-topic sink; the file sink is exactly-once through its metadata log."""
    w = df.select("value").writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if fmt == "kafka":
        w = w.format("kafka").option("topic", topic)
        for k, v in (kafka_options or {}).items():
            w = w.option(k, v)
        return w.start()
    return w.format("parquet").start(topic_path(root, topic))


def write_batch(df: DataFrame, root: str, folder: str, batch_id: int, fmt: str = "parquet",
                kafka_options: dict | None = None) -> None:
    """S2/S3 for one micro-batch of (topic, value) rows: a retried batch overwrites
    its own file partitions; Kafka gets it at least once."""
    if fmt == "kafka":
        df.select("topic", "value").write.format("kafka").options(**(kafka_options or {})).save()
        return
    df.select("topic", "value", F.lit(batch_id).alias("batch_id")).write.mode("overwrite").option("compression", CODEC) \
        .option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch_id").parquet(topic_path(root, folder))


def write_rows(df: DataFrame, root: str, topic: str, checkpoint: str, fmt: str = "parquet",
               trigger: dict | None = None, kafka_options: dict | None = None):
    """S2 for rows of an update-mode query: each is written once, a retried batch overwrites its own files."""
    w = df.select("value").writeStream.option("checkpointLocation", checkpoint).outputMode("update")
    w = w.trigger(**(trigger or {"availableNow": True}))
    if fmt == "kafka":
        return w.format("kafka").option("topic", topic).options(**(kafka_options or {})).start()

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(topic_path(root, topic))

    return w.foreachBatch(per_batch).start()


def read_fanout(spark: SparkSession, root: str, topic: str, folder: str = "fanout", stream: bool = True,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """One topic out of a file fan-out (partition pruned on ``topic``)."""
    schema = "value STRING, topic STRING"
    if stream:
        r = spark.readStream.schema(schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.parquet(topic_path(root, folder))
    else:
        df = spark.read.schema(schema).parquet(topic_path(root, folder))
    return df.filter(F.col("topic") == topic).select("value", file_position().alias("pos"))
