"""Operators on pixels: a table (asset, x, y, r, g, b, a), one row for each pixel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probata.functions.numeric import oklab, rgb_of_oklab

from .graph import connected_components

CHANNELS = ("r", "g", "b")


def alpha_histogram(pixels: DataFrame, by: str = "asset") -> DataFrame:
    """(asset, opaque, clear, partial)."""
    a = F.col("a")
    return pixels.groupBy(by).agg(F.count_if(a == 255).alias("opaque"), F.count_if(a == 0).alias("clear"), F.count_if((a > 0) & (a < 255)).alias("partial"))


def visible_colours(pixels: DataFrame, by: str = "asset") -> DataFrame:
    """(asset, colours): how many colours the pixels that can be seen have, exactly."""
    return pixels.filter("a > 0").select(by, *CHANNELS).distinct().groupBy(by).agg(F.count(F.lit(1)).alias("colours"))


def alpha_threshold(pixels: DataFrame, least: int) -> DataFrame:
    """Pixels below the threshold become clear, and clear ones black."""
    a = F.when(F.col("a") < least, 0).otherwise(F.col("a"))
    return pixels.withColumn("a", a).withColumns({c: F.when(F.col("a") == 0, 0).otherwise(F.col(c)) for c in CHANNELS})


def without_background(pixels: DataFrame, tolerance: int, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Clears what is connected to a corner: clear pixels, and those within tolerance of a corner's colour in each channel.

    A clear corner is no start. All assets at once, by components of neighbouring pixels that pass.
    """
    size = pixels.groupBy("asset").agg(F.max("x").alias("_w"), F.max("y").alias("_h"))
    at = pixels.join(size, "asset")
    corner = ((F.col("x") == 0) | (F.col("x") == F.col("_w"))) & ((F.col("y") == 0) | (F.col("y") == F.col("_h")))
    seeds = at.filter(corner & (F.col("a") > 0))
    colours = seeds.groupBy("asset").agg(F.collect_set(F.struct(*CHANNELS)).alias("_ref"))  # four at most
    near = F.exists("_ref", lambda c: F.greatest(*(F.abs(F.col(k) - c[k]) for k in CHANNELS)) <= tolerance)
    passing = cut(pixels.join(colours, "asset").filter((F.col("a") == 0) | near).select("asset", "x", "y"))
    links = passing.select(F.struct("asset", "x", "y").alias("u"), "asset", F.explode(F.array(F.struct((F.col("x") + 1).alias("x"), "y"), F.struct("x", (F.col("y") + 1).alias("y")))).alias("n"))
    links = links.select("u", F.struct("asset", F.col("n.x").alias("x"), F.col("n.y").alias("y")).alias("v"))
    links = links.join(passing.select(F.struct("asset", "x", "y").alias("v")), "v", "left_semi").select("u", "v")
    parts = cut(connected_components(links))
    rooted = passing.select(F.struct("asset", "x", "y").alias("node")).join(parts, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    hit = rooted.join(seeds.select(F.struct("asset", "x", "y").alias("node")), "node", "left_semi").select("root").distinct()
    gone = rooted.join(hit, "root", "left_semi").select(F.col("node.asset").alias("asset"), F.col("node.x").alias("x"), F.col("node.y").alias("y"), F.lit(True).alias("_gone"))
    out = pixels.join(gone, ["asset", "x", "y"], "left")
    clear = {c: F.when(F.col("_gone"), 0).otherwise(F.col(c)) for c in (*CHANNELS, "a")}
    return out.withColumns(clear).drop("_gone")


def colour_counts(pixels: DataFrame) -> DataFrame:
    """(asset, r, g, b, n) of the pixels that can be seen."""
    return pixels.filter("a > 0").groupBy("asset", *CHANNELS).agg(F.count(F.lit(1)).alias("n"))


def nearest(points: DataFrame, centroids: DataFrame, by: list[str], axes: list[str]) -> DataFrame:
    """points with cluster and distance (squared) of the nearest centroid (by, cluster, axes), the lowest cluster of equals.

    The centroids of a group are few: they travel as one array to its points.
    """
    packed = centroids.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("cluster", *axes))).alias("_c")) if by else centroids.agg(F.array_sort(F.collect_list(F.struct("cluster", *axes))).alias("_c"))
    both = points.join(packed, by) if by else points.crossJoin(F.broadcast(packed))
    squares = lambda c: sum(((F.col(a) - c[a]) * (F.col(a) - c[a]) for a in axes), F.lit(0.0))
    best = F.array_min(F.transform("_c", lambda c: F.struct(squares(c).alias("distance"), c["cluster"].alias("cluster"))))
    return both.withColumn("_b", best).withColumns({"cluster": F.col("_b.cluster"), "distance": F.col("_b.distance")}).drop("_b", "_c")


def weighted_means(points: DataFrame, by: list[str], axes: list[str], weight: str) -> DataFrame:
    return points.groupBy(*by).agg(*((F.sum(F.col(a) * F.col(weight)) / F.sum(weight)).alias(a) for a in axes), F.sum(weight).alias(weight))


def palette(pixels: DataFrame, colours: int, cut: Callable[[DataFrame], DataFrame], rounds: int = 30, limit: int = 100_000_000) -> DataFrame:
    """(asset, r, g, b, pr, pg, pb): each visible colour and the palette colour it becomes, by weighted clustering in OKLab.

    The first centroid is the most frequent colour; the next is always the colour with the largest distance times count, so that
    the result does not hang on random numbers. Assets with no more colours than asked for stay as they are.
    """
    axes = ["lab_l", "lab_a", "lab_b"]
    counts = colour_counts(pixels)
    lab = oklab(*(F.col(c) / 255 for c in CHANNELS))
    points = cut(counts.withColumns(dict(zip(axes, lab, strict=True))))
    sizes = points.groupBy("asset").agg(F.count(F.lit(1)).alias("_n"))
    most = sizes.agg(F.max("_n")).first()[0] or 0
    if most * colours * (rounds + 1) > limit:
        raise ValueError("too many colours for so many centroids")
    rank = F.struct((-F.col("n")).alias("k"), *CHANNELS)
    first = points.groupBy("asset").agg(F.min_by(F.struct(*axes), rank).alias("c")).select("asset", F.lit(0).alias("cluster"), "c.*")
    centroids = cut(first)
    for k in range(1, min(colours, most)):
        far = nearest(points, centroids, ["asset"], axes).withColumn("_w", F.col("distance") * F.col("n")).filter("_w > 0")
        new = far.groupBy("asset").agg(F.min_by(F.struct(*axes), F.struct((-F.col("_w")).alias("k"), *CHANNELS)).alias("c")).select("asset", F.lit(k).alias("cluster"), "c.*")
        centroids = cut(centroids.union(new))
    for _ in range(rounds):
        moved = weighted_means(nearest(points, centroids, ["asset"], axes), ["asset", "cluster"], axes, "n").drop("n")
        moved = cut(moved)
        shift = centroids.alias("a").join(moved.alias("b"), ["asset", "cluster"]).agg(F.max(F.greatest(*(F.abs(F.col(f"a.{x}") - F.col(f"b.{x}")) for x in axes)))).first()[0]
        centroids = moved
        if shift is None or shift <= 1e-10:
            break
    rgb = [F.rint(c * 255).cast("int") for c in rgb_of_oklab(*(F.col(a) for a in axes))]
    fixed = cut(centroids.select("asset", "cluster", *(c.alias(f"p{k}") for c, k in zip(rgb, CHANNELS, strict=True))))
    rounded = fixed.withColumns(dict(zip(axes, oklab(*(F.col(f"p{c}") / 255 for c in CHANNELS)), strict=True))).drop("pr", "pg", "pb")
    mapped = nearest(points, rounded, ["asset"], axes).join(fixed, ["asset", "cluster"]).join(sizes, "asset")
    few = F.col("_n") <= colours
    return mapped.select("asset", *CHANNELS, *(F.when(few, F.col(c)).otherwise(F.col(f"p{c}")).alias(f"p{c}") for c in CHANNELS))


def fitted(width: int, height: int, box_width: int, box_height: int, how: str) -> tuple[int, int]:
    """The size at which an image fits a box: contain, cover or stretch."""
    if how == "stretch":
        return box_width, box_height
    pick = min if how == "contain" else max
    scale = pick(box_width / width, box_height / height)
    return max(1, round(width * scale)), max(1, round(height * scale))


def resized(pixels: DataFrame, width: int, height: int, to_width: int, to_height: int) -> DataFrame:
    """Pixels of images of one size, resized by the nearest pixel."""
    spans = pixels.withColumns({"_x": _targets("x", width, to_width), "_y": _targets("y", height, to_height)})
    out = spans.withColumn("_nx", F.explode("_x")).withColumn("_ny", F.explode("_y"))
    return out.select("asset", F.col("_nx").alias("x"), F.col("_ny").alias("y"), *CHANNELS, "a")


def _targets(at: str, size: int, new: int):
    """The target places whose centre falls in a source place."""
    every = F.sequence(F.lit(0), F.lit(new - 1))
    if new <= 4096:
        return F.filter(F.transform(every, lambda i: F.when(F.floor((i + 0.5) * size / new) == F.col(at), i)), lambda i: i.isNotNull())
    raise ValueError("larger than 4096")


def composed(pixels: DataFrame, places: DataFrame) -> DataFrame:
    """Frames put on their sheets: pixels (asset) moved by places (asset, sheet, x, y)."""
    p = places.select("asset", "sheet", F.col("x").alias("_x"), F.col("y").alias("_y"))
    return pixels.join(p, "asset").select(F.col("sheet").alias("asset"), (F.col("x") + F.col("_x")).alias("x"), (F.col("y") + F.col("_y")).alias("y"), *CHANNELS, "a")


def checkerboard(width: int, height: int, square: int = 4):
    """The light and dark squares behind a preview, as (x, y, light)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    x, y = spark.range(width).toDF("x"), spark.range(height).toDF("y")
    return x.join(y, F.lit(True)).select("x", "y", ((F.expr(f"x div {square}") + F.expr(f"y div {square}")) % 2 == 0).alias("light"))
