"""Receipts as they come: each batch of gate rows is reduced to statuses, the latest receipt of a subject winning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from probata.operators.checks import gate_status

GATE_SCHEMA = "subject string, ts timestamp, id string, required boolean, result string, cites_engine boolean"


def gate_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(GATE_SCHEMA).json(path)


def reduced(gates: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Hands (subject, status) of each micro-batch to the sink."""

    def batch(df: DataFrame, epoch: int) -> None:
        sink(gate_status(df, "subject"), epoch)

    writer = gates.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def failures_by_window(gates: DataFrame, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """(start, failures): failed gates in windows of event time; rows later than the watermark are left out."""
    w = gates.withWatermark("ts", late).groupBy(F.window("ts", width))
    return w.agg(F.count_if(F.col("result") == "fail").alias("failures")).select(F.col("window.start").alias("start"), "failures")
