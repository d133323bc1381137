"""Comparing two snapshots of the same subjects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flattened(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    """(key, path, value): the named numbers of each row, one to a row."""
    pairs = F.array(*(F.struct(F.lit(path).alias("path"), c.cast("double").alias("value")) for path, c in columns.items()))
    return df.select(key, F.explode(pairs).alias("p")).select(key, "p.path", "p.value")


def within_tolerance(source: DataFrame, imported: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """(keys, source, imported, verdict) of every value on either side: both must be there and differ by no more than tolerance, or both be null."""
    a, b = source.select(*keys, F.col("value").alias("source"), F.lit(True).alias("_a")), imported.select(*keys, F.col("value").alias("imported"), F.lit(True).alias("_b"))
    both = a.join(b, keys, "full_outer")
    there = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    same = F.col("source").eqNullSafe(F.col("imported")) | F.coalesce(F.abs(F.col("source") - F.col("imported")) <= tolerance, F.lit(False))
    return both.select(*keys, "source", "imported", F.when(there & same, "pass").otherwise("fail").alias("verdict"))


def equal_rows(source: DataFrame, imported: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """(keys, verdict) of every key on either side: the values of both must be equal, nulls included."""
    a = source.select(*keys, F.struct(*values).alias("_a"))
    b = imported.select(*keys, F.struct(*values).alias("_b"))
    return a.join(b, keys, "full_outer").select(*keys, F.when(F.col("_a").eqNullSafe(F.col("_b")), "pass").otherwise("fail").alias("verdict"))


def recomputed_differs(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows, with repeats, that only the stored (side 'stored') or only the recomputed table (side 'fresh') has."""
    return stored.exceptAll(fresh).withColumn("side", F.lit("stored")).union(fresh.exceptAll(stored).withColumn("side", F.lit("fresh")))


def motion_deltas(source: DataFrame, imported: DataFrame, key: str, vector: str, tolerance: float = 1e-6) -> DataFrame:
    """(key, delta, verdict): the largest difference of two samples' vectors, by place; fails if their lengths differ."""
    from probata.functions.numeric import max_abs_delta

    both = source.select(key, F.col(vector).alias("_a")).join(imported.select(key, F.col(vector).alias("_b")), key)
    delta = max_abs_delta(F.col("_a"), F.col("_b"))
    return both.select(key, delta.alias("delta"), F.when(delta <= max(tolerance, 1e-6), "pass").otherwise("fail").alias("verdict"))


def loop_seams(samples: DataFrame, by: list[str], order: str, value: str, tolerance: float) -> DataFrame:
    """(by, first, middle, last, loops): whether a series ends where it began and moves in between."""
    # Three rows of each series count: found by rank, so that no series is held as one.
    place = F.row_number().over(Window.partitionBy(*by).orderBy(order, value))
    ranked = samples.select(*by, value, place.alias("_k")).join(samples.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), by)
    at = lambda k: F.max(F.when(F.col("_k") == k, F.col(value)))
    ends = ranked.groupBy(*by).agg(at(F.lit(1)).alias("first"), at(F.expr("_n div 2 + 1")).alias("middle"), at(F.col("_n")).alias("last"))
    first, middle, last = F.col("first"), F.col("middle"), F.col("last")
    return ends.withColumn("loops", (F.abs(first - last) <= tolerance) & (F.abs(first - middle) > tolerance))


def run_order(df: DataFrame, before: str, after: str) -> Column:
    """Whether one time is known, and not later than the other."""
    return F.coalesce(df[before] <= df[after], F.lit(False))
