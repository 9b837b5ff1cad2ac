"""Rasters as rows (row, column, value) on a grid: clip to polygons by scanlines, bilinear resampling onto another grid."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Rows go down from the corner (x0, y0); pixels are ``pixel`` wide and high; with a size it has that many rows and columns."""

    x0: float
    y0: float
    pixel: float
    height: int = 0
    width: int = 0

    def x(self, column: Column) -> Column:
        """The x of the pixels' centres."""
        return F.lit(self.x0) + (column + F.lit(0.5)) * F.lit(self.pixel)

    def y(self, row: Column) -> Column:
        return F.lit(self.y0) - (row + F.lit(0.5)) * F.lit(self.pixel)


def spans(regions: DataFrame, keep: list[str], grid: Grid) -> DataFrame:
    """(keep, row, from_x, to_x): on each row of the grid the parts of its centre line that are inside a region's ring, by the line's crossings with the ring's edges, sorted. A notch or a
    second part makes several spans. Each edge only meets the rows that it spans, and a row's crossings are as few as the edges there."""
    ring, n = F.col("ring"), F.size("ring")
    edge = F.transform(ring, lambda p, i: F.struct(p["x"].alias("xa"), p["y"].alias("ya"), F.get(ring, (i + 1) % n)["x"].alias("xb"), F.get(ring, (i + 1) % n)["y"].alias("yb")))
    edges = regions.filter("ring is not null").select(*keep, F.explode(edge).alias("e")).select(*keep, "e.*").filter("ya <> yb")
    at = lambda y: F.floor((F.lit(grid.y0) - y) / grid.pixel - 0.5).cast("int")
    rows = edges.withColumn("row", F.explode(F.sequence(at(F.greatest("ya", "yb")), at(F.least("ya", "yb")) + 1)))  # one more on either side, for the last bits
    if grid.height:
        rows = rows.filter(F.col("row").between(0, grid.height - 1))
    y = grid.y(F.col("row"))
    crossed = rows.filter((F.col("ya") > y) != (F.col("yb") > y)).withColumn("x", (F.col("xb") - F.col("xa")) * (y - F.col("ya")) / (F.col("yb") - F.col("ya")) + F.col("xa"))
    sorted_ = crossed.groupBy(*keep, "row").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)), lambda i: F.struct(F.get("xs", i).alias("from_x"), F.get("xs", i + 1).alias("to_x")))
    return sorted_.filter("size(xs) > 1").select(*keep, "row", F.inline(pairs))


def clip(pixels: DataFrame, regions: DataFrame, keep: list[str], grid: Grid, row: str = "row", column: str = "column") -> DataFrame:
    """The pixels whose centre is inside a region, with the region's ``keep`` columns: they meet the spans of their row, and no pixel is tested against a ring."""
    s = spans(regions, keep, grid).withColumnRenamed("row", row)
    x = grid.x(F.col(column))
    return pixels.join(s, row).filter((F.col("from_x") <= x) & (x < F.col("to_x"))).drop("from_x", "to_x").select(*keep, *pixels.columns)


def cells(spark, grid: Grid) -> DataFrame:
    """(row, column) of a whole grid."""
    n = grid.height * grid.width
    return spark.range(n).select(F.expr(f"cast(id div {grid.width} as int)").alias("row"), (F.col("id") % grid.width).cast("int").alias("column"))


def resample(source: DataFrame, source_grid: Grid, target: DataFrame, target_grid: Grid, to_source: Callable[[Column, Column], tuple[Column, Column]], keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, row, column, value) of the ``target`` cells (row, column): their centres are taken to the source's coordinates, and each gets the mean of the source pixels around that point,
    weighted by how near they are in either direction. Pixels without data have no weight; a cell without any is left out.

    Four rows a cell meet the source by (row, column): an equi-join, and a sum by cell. With ``keys`` the source is one raster for each of them.
    """
    x, y = to_source(target_grid.x(F.col("column")), target_grid.y(F.col("row")))
    at = target.select("row", "column", ((x - source_grid.x0) / source_grid.pixel - 0.5).alias("fx"), ((F.lit(source_grid.y0) - y) / source_grid.pixel - 0.5).alias("fy"))
    at = at.withColumns({"j": F.floor("fx").cast("int"), "i": F.floor("fy").cast("int")}).withColumns({"wx": F.col("fx") - F.col("j"), "wy": F.col("fy") - F.col("i")})
    corner = lambda di, dj: F.struct((F.col("i") + di).alias("si"), (F.col("j") + dj).alias("sj"), ((F.col("wy") if di else 1 - F.col("wy")) * (F.col("wx") if dj else 1 - F.col("wx"))).alias("w"))
    four = at.select("row", "column", F.inline(F.array(*(corner(di, dj) for di in (0, 1) for dj in (0, 1)))))
    known = source.filter("value is not null").select(*keys, F.col("row").alias("si"), F.col("column").alias("sj"), "value")
    met = four.filter("w > 0").join(known, ["si", "sj"])
    return met.groupBy(*keys, "row", "column").agg((F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value"))
