"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import checkpoint_dir

#: ASCII white space that separates words; everything else is part of a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

#: Bytes of one Arrow batch sent to a Python worker (a longer text makes a batch of its own),
#: and rows of it turned into Python objects at a time.
BATCH_BYTES, SLICE = 4 << 20, 256
#: Spark's setting that removes the shuffle files of an execution as soon as it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What this Python worker keeps from task to task.
_KEPT: dict[Hashable, Any] = {}


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, not only by rows, unless the session has its own bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Later steps then start from files that any executor can read, so a lost
    executor costs a re-read and no step upstream runs twice. The shuffle files
    behind it go once it is written; the table goes when the session ends, or
    by ``forget``.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{checkpoint_dir(spark)}/strata-llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        df.write.mode("error").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables written by ``cut`` that nothing reads any more."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).getParent() for f in t.inputFiles()[:1]]
        for path in paths:
            path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True where crc32(doc_id as text) leaves ``remainder``; a null id is held out."""
    c = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))
    return F.coalesce(c == remainder, F.lit(True))


def words(text: str | Column) -> Column:
    """The words of a text as an array (null and blank texts: empty)."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.coalesce(c, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def byte_words(text: bytes | str | None) -> list[bytes]:
    """The same words in Python: ``bytes.split`` knows exactly the six ASCII spaces."""
    if not text:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).split()


def rows_of(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples; only ``SLICE`` rows at a time are Python objects."""
    for b in slices(batches):
        yield from zip(*[b.column(b.schema.get_field_index(c)).to_pylist() for c in columns])


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gave this Python worker, kept from task to task until one with another key, or without, reads rows.

    Spark hands a worker from operator to operator, so its memory would else be the sum of all that they keep.
    """
    _let_go(key)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def _let_go(key: Hashable) -> None:
    if key not in _KEPT:
        _KEPT.clear()


def slices(batches: Iterator[pa.RecordBatch], key: Hashable = None) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``SLICE`` rows, without a copy. ``key``: of what the reader has ``kept``."""
    _let_go(key)
    for b in batches:
        for at in range(0, b.num_rows, SLICE):
            yield b.slice(at, SLICE)


class Buffer:
    """Collects output columns and hands out bounded Arrow batches."""

    def __init__(self, schema: pa.Schema, limit: int = 2048):
        self.schema, self.limit, self.cols = schema, limit, [[] for _ in schema]

    def add(self, *row) -> None:
        for c, v in zip(self.cols, row):
            c.append(v)

    def full(self) -> bool:
        return len(self.cols[0]) >= self.limit

    def flush(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.cols, self.schema)],
                                         schema=self.schema)
        self.cols = [[] for _ in self.schema]
        return out
