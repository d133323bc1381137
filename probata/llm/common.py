"""Shared plumbing: reading tables, staging in the shared folder, Arrow batches."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probata.operators.staging import cut as staged  # noqa: F401
from probata.operators.staging import dropped  # noqa: F401

#: Bytes of an Arrow batch that goes to a Python worker; both sides hold a few of them. The setting's value in a session that does not set it is 64 MB.
ARROW_BYTES = 4 << 20
ARROW_SETTING, ARROW_UNSET = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def released(spark: SparkSession) -> None:
    """Lets go of the shuffle files of finished stages, which Spark frees when the driver's collector meets their plans."""
    gc.collect()
    spark._jvm.System.gc()


def collected(spark: SparkSession) -> None:
    """Has the collectors of all executors run, which gives what is free in their heaps back to the machine; else a heap stays as large as a stage before had it."""
    n = spark.sparkContext.defaultParallelism
    # A task for each core, so that each executor has some; of calls at the same time in one executor, the collector runs one.
    spark.range(0, n, 1, n).selectExpr("java_method('java.lang.System', 'gc')").collect()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_bits(docs: DataFrame, bucket_bytes: int, least: int) -> int:
    """log2 of the number of buckets for the texts of docs: four for each shuffle partition, and one for so many bytes at least."""
    size = 4 * int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())  # files are packed
    if size >= 1 << 60:  # not known
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, int(np.ceil(np.log2(max(4 * shuffle_partitions(docs.sparkSession), size / bucket_bytes)))))


def text_buffers(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column, without a copy where possible."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.large_binary() if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else pa.large_string()
    col = col.cast(wide)
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64)[col.offset : col.offset + n + 1]
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return b, o - o[0]


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())


def in_batches(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema), whose batches hold about ARROW_BYTES instead of 10,000 rows of any length; a session's own setting stands."""
    conf = df.sparkSession.conf
    if conf.get(ARROW_SETTING, None) == ARROW_UNSET:
        conf.set(ARROW_SETTING, str(ARROW_BYTES))
    return df.mapInArrow(run, schema)


def let_go() -> None:
    """Gives memory that is free within this Python worker back to the machine; workers outlive tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def gathered(batches, max_bytes: int, column: str):
    """Deals the rows of Arrow batches into tables that hold about max_bytes in a column; rows are never split. At the end, free memory goes back."""
    yield from _gathered(batches, max_bytes, column)
    let_go()


def _gathered(batches, max_bytes: int, column: str):
    held, size = [], 0
    for b in batches:
        if b.num_rows == 0:
            continue
        _, offs = text_buffers(b.column(b.schema.get_field_index(column)))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(offs, offs[at] + max_bytes - size, side="right")) - 1)
            held.append(b.slice(at, to - at))
            size += int(offs[to] - offs[at])
            at = to
            if size >= max_bytes or at < b.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def with_text(docs: DataFrame, *cols: str) -> DataFrame:
    """The named columns and text, in which a null is the empty text."""
    return docs.select(*cols, F.coalesce(F.col("text"), F.lit("")).alias("text"))
