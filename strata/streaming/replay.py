"""Drive a streaming job over a closed table, as a backfill or a check.

The table is published into a file topic and the job runs with
``availableNow`` from its checkpoint. Event-time operators only emit once the
watermark has passed their deadline, and a drained source stops advancing it,
so ``flush`` appends two marker rows far past the data, each in its own
micro-batch, under a marker key that the caller filters out. Runs share one
checkpoint, so each replay round is also a restart.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import checkpoint_dir, gone_on_exit
from strata.streaming import topics

MARKER = "__flush__"
FLUSH_GAP_MS = 10 ** 9
#: Rows that a state partition takes in per micro-batch: a join's state over a whole table gets slow.
SLICE_ROWS = 1 << 20


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for the topics and checkpoints of one replay; it goes when the session ends."""
    root = f"{checkpoint_dir(spark)}/strata-streams/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)  # only an existing path can be marked
    return gone_on_exit(spark, root)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over as many files as the cluster has cores: a topic's files are read by a task each, and a
    table's row groups may be few."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def flush_rows(log: DataFrame, max_ts: int, step: int, field: str = "mid") -> DataFrame:
    """One marker log row ``step`` gaps after ``max_ts``, keyed ``MARKER`` in ``common.<field>``."""
    return (log.limit(1).withColumn("ts", F.lit(max_ts + step * FLUSH_GAP_MS))
            .withColumn("common", F.col("common").withField(field, F.lit(MARKER))))


@contextlib.contextmanager
def state_partitions(spark: SparkSession, n: int | None = None) -> Iterator[None]:
    """Pin the shuffle/state partition count while a stateful query first starts
    (it is then fixed in the checkpoint); the session setting is restored after."""
    with _settings(spark, {"spark.sql.shuffle.partitions": str(n or spark.sparkContext.defaultParallelism)}):
        yield


@contextlib.contextmanager
def short_history(spark: SparkSession) -> Iterator[None]:
    """Let a query that is only ever restarted from its newest batch keep no older ones: Spark's maintenance may
    replace its state's changes by a snapshot from the second on and remove older ones, so that the checkpoint needn't grow with the slices.
    A micro-batch's files are read by more tasks than there are cores, largest first, so that none waits for a last one."""
    with _settings(spark, {"spark.sql.files.minPartitionNum": str(4 * spark.sparkContext.defaultParallelism),
                           "spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "1",
                           "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
                           "spark.sql.streaming.stateStore.compression.codec": "zstd"}):
        yield


@contextlib.contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def replay_logs(spark: SparkSession, inputs: dict[str, DataFrame], run: Callable[[str], object],
                root: str, flush: bool = False, field: str = "mid", partitions: int | None = None) -> None:
    """Publish ``inputs`` (topic → log frame), run the job, then flush if asked."""
    for topic, df in inputs.items():
        topics.publish(df, root, topic)
    with state_partitions(spark, partitions):
        q = run(root)
        q.awaitTermination()
    if not flush:
        return
    max_ts = max((df.agg(F.max("ts")).first()[0] or 0) for df in inputs.values())
    for step in (1, 2):
        for topic, df in inputs.items():
            topics.publish(flush_rows(df, max_ts, step, field), root, topic)
        q = run(root)
        q.awaitTermination()


def time_bounds(times: DataFrame, partitions: int | None = None, rows: int = SLICE_ROWS) -> list[int]:
    """Event times (whole seconds, in millis) that cut the rows of ``times``, whose one column holds millis, into slices of
    about ``rows`` for each state partition; empty where one slice takes them all. Times that many rows share are not cut."""
    ts = times.columns[0]
    per = rows * (partitions or times.sparkSession.sparkContext.defaultParallelism)
    n = -(-times.count() // per)
    if n <= 1:
        return []
    cuts = times.agg(F.percentile_approx(ts, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    return sorted({int(t) // 1000 * 1000 for t in cuts})


def publish_slices(inputs: dict[str, list[tuple[DataFrame, Column]]], root: str, bounds: list[int],
                   keep: bool = True) -> Iterator[int]:
    """Publish ``inputs`` (topic → frames, each with its event time) in order of time, a slice before each step:
    the caller runs its jobs there, so that the watermark lets their state go from slice to slice. A slice's rows
    are no earlier than its bound, so none is late. Rows without a time come in the first slice.
    Every frame is computed and written once; a slice's files are moved to the topic. Without ``keep`` they are removed
    after its step, when the jobs have read them."""
    for topic, frames in inputs.items():
        for df, ts in frames:
            if not bounds:
                topics.publish(df, root, topic)
                continue
            after = F.size(F.filter(F.array(*[F.lit(b).cast("bigint") for b in bounds]), lambda b: b <= ts))
            df.select(F.to_json(F.struct(*df.columns)).alias("value"), after.alias("slice")) \
                .write.mode("append").option("compression", topics.CODEC).partitionBy("slice").parquet(_feed(root, topic))
    spark = next(df.sparkSession for frames in inputs.values() for df, _ in frames)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for i in range(len(bounds) + 1):
        for topic in inputs if bounds else ():
            to, fed = topics.topic_path(root, topic), path(f"{_feed(root, topic)}/slice={i}")
            fs.mkdirs(path(to))
            for f in fs.listStatus(fed) if fs.exists(fed) else ():
                if not fs.rename(f.getPath(), path(f"{to}/{i}-{f.getPath().getName()}")):
                    raise OSError(f"slice {i} of {topic} can't be moved to its topic")
        yield i
        for topic in () if keep else inputs:
            for f in fs.listStatus(path(topics.topic_path(root, topic))):
                fs.delete(f.getPath(), False)


def _feed(root: str, topic: str) -> str:
    return topics.topic_path(root, f"_feed_{topic}")
