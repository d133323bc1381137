"""Operators on meshes: vertices (mesh, v, x, y, z), triangles (mesh, face, a, b, c), weights and texture coordinates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import connected_components


def bounds(points: DataFrame, by: list[str], axes: list[str]) -> DataFrame:
    """(by, min and max of each axis); partial bounds are merged as they are."""
    return points.groupBy(*by).agg(*(f(a).alias(f"{n}_{a}") for a in axes for n, f in (("min", F.min), ("max", F.max))))


def welded(vertices: DataFrame, distance: float) -> DataFrame:
    """vertices with weld: the least vertex of those in the same cell of a grid of the given distance."""
    cell = [F.round(F.col(a) / distance).cast("long") for a in ("x", "y", "z")]
    keyed = vertices.withColumn("_cell", F.struct(*(c.alias(f"k{i}") for i, c in enumerate(cell))))
    least = keyed.groupBy("mesh", "_cell").agg(F.min("v").alias("weld"))
    return keyed.join(least, ["mesh", "_cell"]).drop("_cell")


def edges(triangles: DataFrame) -> DataFrame:
    """(mesh, face, u, v, forward): the three edges of each triangle, ends in order, with the direction it runs in."""
    pairs = F.array(*(F.struct(F.col(p).alias("p"), F.col(q).alias("q")) for p, q in (("a", "b"), ("b", "c"), ("c", "a"))))
    e = triangles.select("mesh", "face", F.explode(pairs).alias("e"))
    return e.select("mesh", "face", F.least("e.p", "e.q").alias("u"), F.greatest("e.p", "e.q").alias("v"), (F.col("e.p") < F.col("e.q")).alias("forward"))


def face_components(triangles: DataFrame) -> DataFrame:
    """(mesh, face, component): triangles that share an edge; a component is named by its least face."""
    e = edges(triangles)
    star = e.groupBy("mesh", "u", "v").agg(F.min("face").alias("first"))
    node = lambda c: F.struct("mesh", F.col(c).alias("face"))
    links = e.join(star, ["mesh", "u", "v"]).filter("face <> first").select(node("first").alias("p"), node("face").alias("q"))
    parts = connected_components(links)
    return triangles.select("mesh", "face", node("face").alias("node")).join(parts, "node", "left").select("mesh", "face", F.coalesce(F.col("root.face"), F.col("face")).alias("component"))


def component_facts(triangles: DataFrame, vertices: DataFrame, components: DataFrame) -> DataFrame:
    """(mesh, component, faces, vertices, closed, consistent, volume, orientation) of each component, in order of the reference report.

    closed: every edge has two faces; consistent: they run through it in opposite directions; orientation is the sign of the
    volume beyond an epsilon that follows the extent.
    """
    t = triangles.join(components, ["mesh", "face"])
    per_edge = edges(triangles).join(components, ["mesh", "face"]).groupBy("mesh", "component", "u", "v").agg(F.count(F.lit(1)).alias("n"), F.count_if("forward").alias("f"))
    closed = per_edge.groupBy("mesh", "component").agg(F.bool_and(F.col("n") == 2).alias("closed"), F.bool_and((F.col("n") == 2) & (F.col("f") == 1)).alias("consistent"))
    out = t
    for c in "abc":
        out = out.join(vertices.select("mesh", F.col("v").alias(c), *(F.col(x).alias(f"{c}{x}") for x in "xyz")), ["mesh", c])
    cross = F.col("ax") * (F.col("by") * F.col("cz") - F.col("bz") * F.col("cy")) - F.col("ay") * (F.col("bx") * F.col("cz") - F.col("bz") * F.col("cx")) + F.col("az") * (F.col("bx") * F.col("cy") - F.col("by") * F.col("cx"))
    reach = lambda f, x: f(F.greatest(*(F.col(c + x) for c in "abc")) if f is F.max else F.least(*(F.col(c + x) for c in "abc")))
    sums = out.groupBy("mesh", "component").agg(F.count(F.lit(1)).alias("faces"), (F.sum(cross) / 6).alias("volume"), F.greatest(*(reach(F.max, x) - reach(F.min, x) for x in "xyz")).alias("extent"))
    corners = t.select("mesh", "component", F.explode(F.array("a", "b", "c")).alias("v")).distinct().groupBy("mesh", "component").agg(F.count(F.lit(1)).alias("vertices"))
    eps = F.greatest(F.lit(1e-18), F.pow("extent", F.lit(3)) * 1e-12)
    sign = F.when(F.col("volume") > eps, "outward").when(F.col("volume") < -eps, "inward").otherwise("flat")
    return sums.join(corners, ["mesh", "component"]).join(closed, ["mesh", "component"]).select("mesh", "component", "faces", "vertices", "closed", "consistent", "volume", sign.alias("orientation"))


def triangle_digests(triangles: DataFrame, vertices: DataFrame, tolerance: float) -> DataFrame:
    """(mesh, digest): of the triangles' quantised corners, so that neither face nor vertex order counts, but winding up to rotation does."""
    step = tolerance or 1e-9
    corner = vertices.select("mesh", "v", F.concat_ws(",", *(F.round(F.col(a) / step).cast("long").cast("string") for a in "xyz")).alias("p"))
    t = triangles
    for c in "abc":
        t = t.join(corner.select("mesh", F.col("v").alias(c), F.col("p").alias(f"p{c}")), ["mesh", c])
    turn = F.array_min(F.array(*(F.concat_ws("|", *(f"p{x}" for x in o)) for o in ("abc", "bca", "cab"))))
    return t.groupBy("mesh").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(turn)), ";").cast("binary"), 256).alias("digest"))


def shoelace(df: DataFrame, by: list[str], order: str, x: str, y: str) -> DataFrame:
    """(by, twice_area): of polygons whose corners come in order and wrap around."""
    w = Window.partitionBy(*by).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(whole))
    cross = df.select(*by, (F.col(x) * nxt(y) - nxt(x) * F.col(y)).alias("_c"))
    return cross.groupBy(*by).agg(F.sum("_c").alias("twice_area"))


def texture_facts(coordinates: DataFrame) -> DataFrame:
    """(mesh, finite, distinct, collapsed) of (mesh, face, corner, u, v): whether all are finite, how many differ at nine digits, and how many faces have no area."""
    fine = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    area = shoelace(coordinates, ["mesh", "face"], "corner", "u", "v").groupBy("mesh").agg(F.count_if(F.abs("twice_area") <= 1e-12).alias("collapsed"))
    distinct = coordinates.select("mesh", F.round("u", 9), F.round("v", 9)).distinct().groupBy("mesh").agg(F.count(F.lit(1)).alias("distinct"))
    return coordinates.groupBy("mesh").agg(F.bool_and(fine("u") & fine("v")).alias("finite")).join(distinct, "mesh").join(area, "mesh")


def weight_facts(weights: DataFrame, vertices: DataFrame, by: str, key: str, weight: str, tolerance: float = 1e-4) -> DataFrame:
    """(by, weighted, unweighted, non_normalised, max_influences): a vertex's weights (positive ones count) must add up to 1."""
    each = weights.filter(F.col(weight) > 0).groupBy(by, key).agg(F.sum(weight).alias("_s"), F.count(F.lit(1)).alias("_n"))
    both = vertices.select(by, key).distinct().join(each, [by, key], "left")
    off = F.count_if(F.abs(F.col("_s") - 1) > tolerance)
    return both.groupBy(by).agg(F.count("_s").alias("weighted"), F.count_if(F.col("_s").isNull()).alias("unweighted"), off.alias("non_normalised"), F.coalesce(F.max("_n"), F.lit(0)).alias("max_influences"))


def transform_issues(matrix: Column, tolerance: float = 1e-9) -> Column:
    """negative, singular or null for a 3 x 3 matrix of nine numbers."""
    from probata.functions.numeric import determinant3

    d = determinant3(matrix)
    return F.when(F.abs(d) <= tolerance, "singular").when(d < 0, "negative")
