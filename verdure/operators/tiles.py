"""Grids, colour ramps and web tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.functions import geo, overlay
from verdure.session import written

#: (value, red, green, blue): a ramp from bare to dense.
RAMP = [(0, 255, 255, 229), (25, 217, 240, 163), (50, 120, 198, 121), (75, 35, 132, 67), (100, 0, 69, 41)]


def aoi_grid(regions: DataFrame, size: float, buffer: float = 1e-4) -> DataFrame:
    """(code, i, j, share): cells of each region's box of ``size`` degrees, widened by ``buffer``, that touch the region, and the share of the cell inside it. Only cells that a side touches are
    clipped; of the others their centre says whether they are inside."""
    r = regions.filter("ring is not null").select("code", "ring", geo.edges(F.col("ring")).alias("all"), *geo.box(F.col("ring")))
    count = lambda a, b: F.explode(F.sequence(F.lit(0), F.ceil((F.col(b) - F.col(a)) / size).cast("int") - 1))
    edge = lambda a, n, d: F.col(a) + (F.col(n) + d) * size + (buffer if d else -buffer)
    x0, x1, y0, y1, far = edge("bx0", "i", 0), edge("bx0", "i", 1), edge("by0", "j", 0), edge("by0", "j", 1), F.lit(float("inf"))
    rows = r.withColumn("j", count("by0", "by1")).withColumn("row", F.filter("all", lambda e: geo._meets(e, -far, y0, far, y1))).drop("all")
    cells = rows.withColumn("i", count("bx0", "bx1")).withColumn("border", F.exists("row", lambda e: geo._meets(e, x0, y0, x1, y1)))
    cells = cells.filter(F.col("border") | geo.odd_crossings((x0 + x1) / 2, (y0 + y1) / 2, F.col("row"))).drop("row")
    clipped = geo.box_coverage(F.when(F.col("border"), F.col("ring")), x0, y0, x1, y1)
    return cells.withColumn("share", F.when(F.col("border"), clipped).otherwise(1.0)).filter("share > 0").select("code", "i", "j", "share")


def cut_cells(regions: DataFrame, size: float, keep: list[str]) -> DataFrame:
    """(keep, gx, gy, part, holes, area, ring, inner): the parts of each region in the cells of a grid of ``size``, as polygons. Cells inside a region are boxes; only those that a side touches
    are cut, by the sides at their height and to their right alone, which is all that decides what is inside there. A cell may hold several parts."""
    cells = geo.squares(regions.withColumn("ring", overlay.oriented(F.col("ring"))), keep, size).select(*keep, F.col("sx").alias("gx"), F.col("sy").alias("gy"), F.when(F.col("border"), F.col("sides")).alias("sides"), "border")
    x0, y0, x1, y1 = F.col("gx") * size, F.col("gy") * size, (F.col("gx") + 1) * size, (F.col("gy") + 1) * size
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    cells = written(cells, "cells").withColumn("box", F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)))
    whole = cells.filter("not border").select(*keep, "gx", "gy", F.lit(1).alias("part"), F.lit(0).cast("long").alias("holes"), F.lit(size * size).alias("area"), F.col("box").alias("ring"), F.array().cast("array<array<struct<x:double,y:double>>>").alias("inner"))
    by = [*keep, "gx", "gy"]
    border = cells.filter("border")
    rows = overlay.directed(border.select(*by, F.inline("sides")), by, "a").unionByName(overlay.sides(border, by, "b", ring="box"))
    return whole.unionByName(overlay.parts(overlay.rings(overlay.overlay(rows, by, "intersection", size), by), by))


def colour(layer: DataFrame, value: str = "value", ramp=RAMP) -> DataFrame:
    """red, green, blue on the line between the ramp's entries; alpha 0 for no data (0)."""
    v = F.col(value).cast("double")
    out = {}
    for n, band in enumerate(("red", "green", "blue"), start=1):
        expr = F.when(v <= ramp[0][0], float(ramp[0][n]))
        for a, b in zip(ramp, ramp[1:]):
            expr = expr.when(v <= b[0], a[n] + (v - a[0]) / (b[0] - a[0]) * (b[n] - a[n]))
        out[band] = F.floor(expr.otherwise(float(ramp[-1][n])) + 0.5).cast("int")
    return layer.withColumns(out).withColumn("alpha", F.when(v == 0, 0).otherwise(255))


def web_tiles(points: DataFrame, zooms: tuple[int, ...]) -> DataFrame:
    """(z, tx, ty, n, value): points and their highest value in each web tile of each zoom."""
    rows = None
    for z in zooms:
        one = points.select(F.lit(z).alias("z"), *geo.tile_key(F.col("lon"), F.col("lat"), z), "value")
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy("z", "tx", "ty").agg(F.count("*").alias("n"), F.max("value").alias("value"))


def pyramid(points: DataFrame, zoom: int, bits: int = 8) -> DataFrame:
    """(z, tx, ty, tile_id, y, x, n, value): the pixels of every web tile from ``zoom`` down to 0, tiles being 2^bits pixels wide: how many points a pixel has and their highest value.

    Points are placed once; each overview is made from the four children of its pixels, so a level reads what the one below it left, a quarter of it or less where points are dense. Levels are
    written as they are made. Points without coordinates or value are left out; latitudes beyond the map are at its edge.
    """
    px, py = (c.alias(n) for c, n in zip(geo.tile_key(F.col("lon"), F.col("lat"), zoom + bits), ("px", "py")))
    level = points.filter("lon is not null and lat is not null and value is not null").select(px, py, "value").groupBy("px", "py").agg(F.count("*").alias("n"), F.max("value").alias("value"))
    rows = None
    for z in range(zoom, -1, -1):
        level = written(level, f"zoom_{z}")
        one = level.select(F.lit(z).alias("z"), F.shiftright("px", bits).alias("tx"), F.shiftright("py", bits).alias("ty"), F.col("py").bitwiseAND((1 << bits) - 1).alias("y"), F.col("px").bitwiseAND((1 << bits) - 1).alias("x"), "n", "value")
        rows = one if rows is None else rows.unionByName(one)
        level = level.groupBy(F.shiftright("px", 1).alias("px"), F.shiftright("py", 1).alias("py")).agg(F.sum("n").alias("n"), F.max("value").alias("value"))
    return rows.select("z", "tx", "ty", geo.tile_id(F.col("z"), F.col("tx"), F.col("ty")).alias("tile_id"), "y", "x", "n", "value")
