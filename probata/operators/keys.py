"""Operators on keys and inventories: duplicates, differences, references, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_report(df: DataFrame, key: str, item: str) -> DataFrame:
    """(key, n, items): keys that occur more than once, with their items in order."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(item)).alias("items")).filter("n > 1")


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """The rows whose key no other row has; the others drop out."""
    single = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(key)
    return df.join(single, key, "left_semi")


def inventory_diff(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, state): keys expected but not there (missing), and there but not expected (unexpected)."""
    a, e = actual.select(key).distinct().withColumn("_a", F.lit(1)), expected.select(key).distinct().withColumn("_e", F.lit(1))
    both = a.join(e, key, "full_outer").filter("_a is null or _e is null")
    return both.select(key, F.when(F.col("_a").isNull(), "missing").otherwise("unexpected").alias("state"))


def dangling(refs: DataFrame, targets: DataFrame, ref: str, target: str) -> DataFrame:
    """The references that name no target."""
    return refs.join(targets.select(F.col(target).alias(ref)).distinct(), ref, "left_anti")


def exactly_one(df: DataFrame, by: list[str], roles: dict[str, Column]) -> DataFrame:
    """(by, one boolean for each role): whether exactly one row has the role."""
    return df.groupBy(*by).agg(*((F.count_if(cond) == 1).alias(name) for name, cond in roles.items()))


def keep_first(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key; by aggregation, as no row but the first is needed."""
    rest = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_r"))
    return first.select(*key, *(F.col("_r")[c].alias(c) for c in rest))


def adjacent_equal(df: DataFrame, by: list[str], order: Column, key: Column) -> DataFrame:
    """The rows whose key equals that of the row before them in order."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("_k", key).withColumn("_b", F.lag("_k").over(w)).filter(F.col("_k") == F.col("_b")).drop("_k", "_b")


def distinct_in_order(df: DataFrame, by: list[str], value: str, position: str) -> DataFrame:
    """(by, value, first): each value once, with where it came first."""
    return df.groupBy(*by, value).agg(F.min(position).alias("first"))


def numbered_names(df: DataFrame, name: str, position: str) -> DataFrame:
    """df with out_name: the second and later of a name get -1, -2 and so on, by position."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(position)) - 1
    return df.withColumn("out_name", F.when(n == 0, F.col(name)).otherwise(F.concat(name, F.lit("-"), n.cast("string"))))


def link_states(desired: DataFrame, recorded: DataFrame, key: str, target: str) -> DataFrame:
    """(key, state): keep, changed, new or stale, of wanted links against recorded ones."""
    d, r = desired.select(key, F.col(target).alias("_d"), F.lit(True).alias("_in_d")), recorded.select(key, F.col(target).alias("_r"), F.lit(True).alias("_in_r"))
    state = F.when(F.col("_in_r").isNull(), "new").when(F.col("_in_d").isNull(), "stale").when(F.col("_d").eqNullSafe(F.col("_r")), "keep").otherwise("changed")
    return d.join(r, key, "full_outer").select(key, state.alias("state"))


def parent_pairs(chain: list[str]) -> list[tuple[str, str]]:
    """Adjacent (parent, child) of an expected chain from the root on."""
    return list(zip(chain[:-1], chain[1:], strict=True))


def chain_links(links: DataFrame, chain: list[str], child: str, parent: str) -> DataFrame:
    """(parent, child, there): each adjacent pair of an expected chain, and whether a row links the two."""
    spark = links.sparkSession
    want = spark.createDataFrame(parent_pairs(chain), f"`{parent}` string, `{child}` string")
    have = links.select(parent, child).distinct().withColumn("_there", F.lit(True))
    return want.join(have, [parent, child], "left").select(parent, child, F.coalesce("_there", F.lit(False)).alias("there"))


def mode(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, n): the most frequent value of each group, the least of equals."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("less"), F.col(value).alias("value"))).alias("_b"))
    return best.select(*by, F.col("_b.value").alias(value), (-F.col("_b.less")).alias("n"))


def set_digest(df: DataFrame, by: list[str], item: Column) -> DataFrame:
    """(by, digest): the SHA-256 of each group's items, sorted, so that order does not count."""
    return df.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(item)), ";").cast("binary"), 256).alias("digest"))
