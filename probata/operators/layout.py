"""Frames on a sheet: places on a grid, overlaps, and pixels outside all frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def default_columns(n: Column) -> Column:
    return F.least(F.lit(8), n)


def grid_places(frames: DataFrame, order: list, width: int, height: int, columns: int, padding: int = 0, by: list[str] | None = None) -> DataFrame:
    """frames with ordinal, col, row, x and y on a grid of equal cells, in order within each sheet (by)."""
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)
    out = frames.withColumn("ordinal", F.row_number().over(w).cast("long") - 1)
    out = out.withColumns({"col": F.col("ordinal") % columns, "row": F.expr(f"ordinal div {columns}")})
    return out.withColumns({"x": F.lit(padding) + F.col("col") * (width + padding), "y": F.lit(padding) + F.col("row") * (height + padding)})


def overlaps(rects: DataFrame, sheet: str, key: str, cell: int = 64) -> DataFrame:
    """(sheet, a, b): pairs of rects (sheet, key, x, y, w, h) of a sheet that overlap; touching edges do not.

    Rects are dealt into grid cells, so that only those that share a cell meet; each pair is judged in the first cell that both cover.
    """
    span = lambda at, size: F.sequence(F.floor(F.col(at) / cell), F.floor((F.col(at) + F.col(size) - 1) / cell))
    some = rects.filter("w > 0 and h > 0")
    cells = some.withColumn("cx", F.explode(span("x", "w"))).withColumn("cy", F.explode(span("y", "h")))
    a, b = cells.alias("a"), cells.alias("b")
    same = (F.col(f"a.{sheet}") == F.col(f"b.{sheet}")) & (F.col("a.cx") == F.col("b.cx")) & (F.col("a.cy") == F.col("b.cy")) & (F.col(f"a.{key}") < F.col(f"b.{key}"))
    meet = (F.col("a.x") < F.col("b.x") + F.col("b.w")) & (F.col("b.x") < F.col("a.x") + F.col("a.w")) & (F.col("a.y") < F.col("b.y") + F.col("b.h")) & (F.col("b.y") < F.col("a.y") + F.col("a.h"))
    first = (F.col("a.cx") == F.floor(F.greatest("a.x", "b.x") / cell)) & (F.col("a.cy") == F.floor(F.greatest("a.y", "b.y") / cell))
    return a.join(b, same & meet & first).select(F.col(f"a.{sheet}").alias(sheet), F.col(f"a.{key}").alias("a"), F.col(f"b.{key}").alias("b"))


def outside(points: DataFrame, rects: DataFrame, sheet: str, cell: int = 64) -> DataFrame:
    """The points (sheet, x, y) that lie in no rect of their sheet; rects are looked up by grid cell."""
    span = lambda at, size: F.sequence(F.floor(F.col(at) / cell), F.floor((F.col(at) + F.col(size) - 1) / cell))
    r = rects.filter("w > 0 and h > 0").select(F.col(sheet).alias("_s"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("w").alias("_w"), F.col("h").alias("_h"), F.explode(span("x", "w")).alias("_cx"), "y", "h")
    r = r.withColumn("_cy", F.explode(span("y", "h"))).drop("y", "h")
    inside = (
        (F.col(sheet) == F.col("_s")) & (F.floor(F.col("x") / cell) == F.col("_cx")) & (F.floor(F.col("y") / cell) == F.col("_cy"))
        & (F.col("x") >= F.col("_x")) & (F.col("x") < F.col("_x") + F.col("_w")) & (F.col("y") >= F.col("_y")) & (F.col("y") < F.col("_y") + F.col("_h"))
    )
    return points.join(r, inside, "left_anti")


def contained(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """Whether a rect is valid and lies within a sheet."""
    return F.coalesce((x >= 0) & (y >= 0) & (w > 0) & (h > 0) & (x + w <= width) & (y + h <= height), F.lit(False))


def pivot(where: str, width: Column, height: Column) -> list[Column]:
    """A named pivot, from the bottom left."""
    half = lambda v: F.floor(v / 2)
    return {"bottom-center": [half(width), F.lit(0)], "center": [half(width), half(height)], "bottom-left": [F.lit(0), F.lit(0)]}[where]
