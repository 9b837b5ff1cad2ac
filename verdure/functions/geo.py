"""Geometry on rings, arrays of struct<x, y>, without a geometry library."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd ray casting, half open: a shared edge belongs to one side. The ring need not repeat its first point."""
    n = F.size(ring)

    def edge(inside: Column, i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        crosses = (a["y"] > y) != (b["y"] > y)
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.when(crosses, b["y"] - a["y"]) + a["x"]
        return inside != F.coalesce(crosses & (x < at), F.lit(False))

    return F.coalesce(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(False), edge), F.lit(False))


def box(ring: Column) -> list[Column]:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return [F.array_min(xs).alias("bx0"), F.array_min(ys).alias("by0"), F.array_max(xs).alias("bx1"), F.array_max(ys).alias("by1")]


def edges(ring: Column) -> Column:
    """The ring's sides, array of struct<ax, ay, bx, by>."""
    side = lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1)), side)


def odd_crossings(x: Column, y: Column, sides: Column) -> Column:
    """Even-odd rule over sides, half open as in ``in_ring``: of a ring all that reach the height of the point, and lie right of it, must be among them."""
    crosses = lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0)) + e["ax"])
    return F.size(F.filter(sides, lambda e: F.coalesce(crosses(e), F.lit(False)))) % 2 == 1


def _meets(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether a side's box touches a box."""
    return (F.least(e["ax"], e["bx"]) <= x1) & (F.greatest(e["ax"], e["bx"]) >= x0) & (F.least(e["ay"], e["by"]) <= y1) & (F.greatest(e["ay"], e["by"]) >= y0)


def squares(regions: DataFrame, keep: list[str], size: float) -> DataFrame:
    """(keep, sx, sy, ring, sides, border, inside): the squares of ``size`` of each region's box. A square that no side touches is inside as a whole or outside as a whole, which its
    centre decides once; a border square keeps the ring and the sides at its height and right of its left edge, the only ones that a point in it has to be held against."""
    r = regions.filter("ring is not null").select(*keep, "ring", edges(F.col("ring")).alias("all"), *box(F.col("ring")))
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    far = F.lit(float("inf"))
    r = r.withColumn("sy", cells("by0", "by1"))
    y0, y1 = F.col("sy") * size, (F.col("sy") + 1) * size
    r = r.withColumn("row", F.filter("all", lambda e: _meets(e, -far, y0, far, y1)))  # of the height first, so that squares look at short lists
    r = r.drop("all").withColumn("sx", cells("bx0", "bx1"))
    x0, x1 = F.col("sx") * size, (F.col("sx") + 1) * size
    r = r.withColumn("border", F.exists("row", lambda e: _meets(e, x0, y0, x1, y1)))
    r = r.withColumn("inside", odd_crossings(x0 + size / 2, y0 + size / 2, F.col("row")))
    right = F.filter("row", lambda e: F.greatest(e["ax"], e["bx"]) >= x0)
    return r.filter("border or inside").select(*keep, "sx", "sy", F.when(F.col("border"), F.col("ring")).alias("ring"), F.when(F.col("border"), right).alias("sides"), "border", "inside")


def within(points: DataFrame, regions: DataFrame, x: str, y: str, keep: list[str], size: float = 0.5) -> DataFrame:
    """Points with the columns ``keep`` of each region whose ``ring`` holds them. Both sides meet on squares of ``size``, so this is an equi-join. Points of squares inside need no test;
    those of border squares are held against the sides of that square."""
    s = squares(regions, keep, size).drop("ring")
    p = points.withColumns({"sx": F.floor(F.col(x) / size), "sy": F.floor(F.col(y) / size)})
    hit = ~F.col("border") | odd_crossings(F.col(x), F.col(y), F.col("sides"))
    return p.join(s, ["sx", "sy"]).filter(hit).drop("sx", "sy", "sides", "border", "inside")


def clip_to_box(ring: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Sutherland-Hodgman: the part of a ring inside a box, a half plane at a time over all sides together."""
    for axis, bound, keep_low in ((0, x0, False), (0, x1, True), (1, y0, False), (1, y1, True)):
        if not len(ring):
            return np.zeros((0, 2))
        nxt = np.roll(ring, -1, axis=0)
        here, there = ((v <= bound) if keep_low else (v >= bound) for v in (ring[:, axis], nxt[:, axis]))
        with np.errstate(divide="ignore", invalid="ignore"):
            at = ring + (nxt - ring) * ((bound - ring[:, axis]) / (nxt[:, axis] - ring[:, axis]))[:, None]
        both = np.stack([ring, at], axis=1).reshape(-1, 2)
        ring = both[np.stack([here, here != there], axis=1).ravel()]
    return ring


def ring_area(ring: np.ndarray) -> float:
    if len(ring) < 3:
        return 0.0
    x, y = ring[:, 0], ring[:, 1]
    return abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1)))) / 2


@F.pandas_udf(DoubleType())
def _clipped_share(xs: pd.Series, ys: pd.Series, x0: pd.Series, y0: pd.Series, x1: pd.Series, y1: pd.Series) -> pd.Series:
    out = np.full(len(xs), np.nan)
    for i, (x, y, *b) in enumerate(zip(xs, ys, x0, y0, x1, y1)):
        if x is not None:
            out[i] = ring_area(clip_to_box(np.column_stack([x, y]), *b)) / ((b[2] - b[0]) * (b[3] - b[1]))
    return pd.Series(out)


def box_coverage(ring: Column | str, *bounds: Column | str) -> Column:
    """The share of the box (x0, y0, x1, y1) that the ring covers; exact for simple polygons."""
    return _clipped_share(F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"]), *bounds)


def coverage_weights(regions: DataFrame, step: float, keep: list[str]) -> DataFrame:
    """(keep, gx, gy, c): for each region the cells of a grid of ``step`` that it covers, and how much of each. Computed once for a region set and grid; only border cells are clipped."""
    cells = squares(regions, keep, step).withColumnsRenamed({"sx": "gx", "sy": "gy"})
    whole = cells.filter("not border").select(*keep, "gx", "gy", F.lit(1.0).alias("c"))
    gx, gy = F.col("gx"), F.col("gy")
    part = cells.filter("border").select(*keep, "gx", "gy", box_coverage("ring", gx * step, gy * step, (gx + 1) * step, (gy + 1) * step).alias("c"))
    return whole.unionByName(part.filter("c > 0"))


def overlap(a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Length that two intervals share."""
    return F.greatest(F.lit(0.0), F.least(F.col(a[1]), F.col(b[1])) - F.greatest(F.col(a[0]), F.col(b[0])))


def grid_cells(x0: float, y0: float, x1: float, y1: float, size: float, buffer: float) -> list[tuple[float, float, float, float]]:
    """Cells of a box's grid, widened by ``buffer`` and cut to the box; corners come from whole steps."""
    nx, ny = math.ceil((x1 - x0) / size), math.ceil((y1 - y0) / size)
    out = [(x0 + i * size - buffer, y0 + j * size - buffer, x0 + (i + 1) * size + buffer, y0 + (j + 1) * size + buffer) for i in range(nx) for j in range(ny)]
    return [(max(a, x0), max(b, y0), min(c, x1), min(d, y1)) for a, b, c, d in out]


def utm_epsg(lon: Column, lat: Column) -> Column:
    zone = F.floor((lon + 180) / 6).cast("int") + 1
    return F.when(lat >= 0, 32600 + zone).otherwise(32700 + zone)


#: Fixed values of the WGS 84 ellipsoid and of the UTM grid.
_A, _F, _K0, _EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
_N = _F / (2 - _F)
_R = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)


def to_utm(lon: Column, lat: Column, zone: Column | None = None, south: Column | None = None) -> list[Column]:
    """Easting and northing in the point's own UTM zone or in the one given, by Krueger's series to third order (under a millimetre inside a zone)."""
    zone = F.floor((lon + 180) / 6) + 1 if zone is None else zone
    south = lat < 0 if south is None else south
    dl, phi = F.radians(lon - (zone * 6 - 183)), F.radians(lat)
    e = 2 * math.sqrt(_N) / (1 + _N)
    t = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    east = eta + sum((a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, start=1)), F.lit(0.0))
    north = xi + sum((a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, start=1)), F.lit(0.0))
    return [(F.lit(_EAST) + _K0 * _R * east).alias("easting"), (_K0 * _R * north + F.when(south, 10_000_000.0).otherwise(0.0)).alias("northing")]


_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def from_utm(east: Column, north: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Longitude and latitude of a point of a UTM zone: the inverse of ``to_utm`` by the same series' inverse."""
    xi, eta = (north - (10_000_000.0 if south else 0.0)) / (_K0 * _R), (east - _EAST) / (_K0 * _R)
    x = xi - sum((b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(_BETA, start=1)), F.lit(0.0))
    e = eta - sum((b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(_BETA, start=1)), F.lit(0.0))
    chi = F.asin(F.sin(x) / F.cosh(e))
    lat = chi + sum((d * F.sin(2 * j * chi) for j, d in enumerate(_DELTA, start=1)), F.lit(0.0))
    return F.degrees(F.atan2(F.sinh(e), F.cos(x))) + (zone * 6 - 183), F.degrees(lat)


def to_grid(east: Column, north: Column, x0: float, y0: float, pixel: float) -> list[Column]:
    """Row and column of the pixel whose centre is nearest, on a grid with its corner at (x0, y0) and rows going down: resampling by nearest neighbour."""
    return [F.floor((y0 - north) / pixel).cast("int").alias("row"), F.floor((east - x0) / pixel).cast("int").alias("column")]


def tile_key(lon: Column, lat: Column, zoom: int) -> list[Column]:
    """Web Mercator tile column and row."""
    n = float(1 << zoom)
    rad = F.radians(lat)
    tx = F.floor((lon + 180) / 360 * n)
    ty = F.floor((1 - F.log(F.tan(rad) + 1 / F.cos(rad)) / math.pi) / 2 * n)
    clamp = lambda t: F.least(F.lit(int(n) - 1), F.greatest(F.lit(0), t.cast("int")))
    return [clamp(tx).alias("tx"), clamp(ty).alias("ty")]


def curve_place(x: Column, y: Column, level: Column) -> Column:
    """The place of cell (x, y) of a grid of 2^level by 2^level along the Hilbert curve: places next to each other are cells next to each other, and a cell's four children follow one another."""
    long = lambda c: c.cast("long")
    full = long(F.pow(F.lit(2.0), level)) - 1

    def step(at: Column, half: Column) -> Column:
        right, low = at["x"].bitwiseAND(half) > 0, at["y"].bitwiseAND(half) > 0
        quarter = F.when(right, F.when(low, 2).otherwise(3)).otherwise(F.when(low, 1).otherwise(0))
        flip = lambda c: F.when(right, full - c).otherwise(c)
        turned = lambda own, other: long(F.when(low, own).otherwise(flip(other)))
        return F.struct(turned(at["x"], at["y"]).alias("x"), turned(at["y"], at["x"]).alias("y"), long(at["d"] + half * half * quarter).alias("d"))

    halves = F.when(level > 0, F.transform(F.sequence(level - 1, F.lit(0)), lambda n: long(F.pow(F.lit(2.0), n)))).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(long(x).alias("x"), long(y).alias("y"), F.lit(0).cast("long").alias("d"))
    return F.aggregate(halves, start, step, lambda at: at["d"])


def tile_id(z: Column, tx: Column, ty: Column) -> Column:
    """A web tile's number over all zooms: those of lower zooms first, those of a zoom along the curve."""
    return ((F.pow(F.lit(4.0), z).cast("long") - 1) / 3).cast("long") + curve_place(tx, ty, z.cast("int"))


def place_of(x: int, y: int, level: int) -> int:
    """``curve_place`` of one cell."""
    d = 0
    for n in range(level - 1, -1, -1):
        right, low = x >> n & 1, y >> n & 1
        d = d << 2 | (3 * right ^ low)
        if not low:
            full = (1 << level) - 1
            x, y = (full - y, full - x) if right else (y, x)
    return d


def cell_at(place: int, level: int) -> tuple[int, int]:
    """The cell (x, y) at a place of the curve."""
    x = y = 0
    for n in range(level):
        right = place >> 1 & 1
        low = (place ^ right) & 1
        if not low:
            side = (1 << n) - 1
            x, y = (side - y, side - x) if right else (y, x)
        x, y, place = x | right << n, y | low << n, place >> 2
    return x, y


def rings_meet(a: Column, b: Column) -> Column:
    """Whether the areas of two rings have a point in common, borders included: two sides cross or touch, or one ring lies in the other. Null where a ring is."""
    turn = lambda p, q, x, y: (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])

    def cross(e: Column, f: Column) -> Column:
        spans = lambda c: (F.greatest(e[f"a{c}"], e[f"b{c}"]) >= F.least(f[f"a{c}"], f[f"b{c}"])) & (F.greatest(f[f"a{c}"], f[f"b{c}"]) >= F.least(e[f"a{c}"], e[f"b{c}"]))
        ends = lambda s: ({"x": s["ax"], "y": s["ay"]}, {"x": s["bx"], "y": s["by"]})
        apart = lambda s, o: F.signum(turn(*ends(s), o["ax"], o["ay"])) * F.signum(turn(*ends(s), o["bx"], o["by"])) <= 0
        return spans("x") & spans("y") & apart(e, f) & apart(f, e)

    touch = F.exists(edges(a), lambda e: F.exists(edges(b), lambda f: cross(e, f)))
    first = lambda r: (F.get(r, F.lit(0))["x"], F.get(r, F.lit(0))["y"])
    return touch | in_ring(*first(a), b) | in_ring(*first(b), a)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for each row, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shared_area(a: Column, b: Column) -> Column:
    """The area that two simple counterclockwise rings have in common. A ring's area is what lies below its sides, down to a common level, those that go left added and those that go right taken
    off; so the common area is the sum over pairs of sides, one of each ring, of what lies below both. Null where a ring is."""

    def slopes(ring: Column, x: Column, y: Column) -> Column:
        n = F.size(ring)

        def side(p: Column, i: Column) -> Column:
            q = F.get(ring, (i + 1) % n)
            left = p["x"] > q["x"]
            end = lambda u, v: (F.when(left, v["x"]).otherwise(u["x"]) - x, F.when(left, v["y"]).otherwise(u["y"]) - y)
            (x0, y0), (x1, y1) = end(p, q), end(q, p)
            return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), ((y1 - y0) / F.nullif(x1 - x0, F.lit(0.0))).alias("k"), F.when(left, 1.0).otherwise(-1.0).alias("s"))

        return F.filter(F.transform(ring, side), lambda e: e["k"].isNotNull())

    def below(e: Column, f: Column) -> Column:
        lo, hi = F.greatest(e["x0"], f["x0"]), F.least(e["x1"], f["x1"])
        on = lambda s, v: s["y0"] + s["k"] * (v - s["x0"])
        u, v = on(e, lo) - on(f, lo), on(e, hi) - on(f, hi)  # the lower of the two, in one piece or two
        one = (F.least(on(e, lo), on(f, lo)) + F.least(on(e, hi), on(f, hi))) / 2 * (hi - lo)
        m = lo + (hi - lo) * u / F.nullif(u - v, F.lit(0.0))
        two = (F.least(on(e, lo), on(f, lo)) + on(e, m)) / 2 * (m - lo) + (on(e, m) + F.least(on(e, hi), on(f, hi))) / 2 * (hi - m)
        return F.when(lo < hi, e["s"] * f["s"] * F.when(F.signum(u) * F.signum(v) < 0, two).otherwise(one)).otherwise(F.lit(0.0))

    def common(r: Column) -> Column:
        own = lambda c: slopes(r[c], r["b"][0]["x"], r["y"])
        total = lambda v: F.aggregate(v["a"], F.lit(0.0), lambda s, e: s + F.aggregate(v["b"], F.lit(0.0), lambda t, f: t + below(e, f)))
        return bound(F.struct(own("a").alias("a"), own("b").alias("b")), total)

    # relative to b's first point and the lowest one, so that large coordinates lose nothing
    lowest = lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"), F.array_min(F.transform(F.concat(r["a"], r["b"]), lambda p: p["y"])).alias("y"))
    area = bound(F.struct(a.alias("a"), b.alias("b")), lambda r: bound(lowest(r), common))
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(F.lit(0.0), area))


def to_wkt(ring: Column) -> Column:
    """POLYGON text of a ring, closed."""
    point = lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    return F.when(ring.isNotNull(), F.concat(F.lit("POLYGON (("), F.array_join(F.transform(F.concat(ring, F.slice(ring, 1, 1)), point), ", "), F.lit("))")))


def centroid(ring: Column) -> Column:
    """struct<x, y> of a ring's area."""
    n = F.size(ring)

    def step(acc: Column, i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        cross = a["x"] * b["y"] - b["x"] * a["y"]
        return F.struct((acc["w"] + cross).alias("w"), (acc["x"] + (a["x"] + b["x"]) * cross).alias("x"), (acc["y"] + (a["y"] + b["y"]) * cross).alias("y"))

    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return F.aggregate(F.sequence(F.lit(0), n - 1), zero, step, lambda s: F.struct((s["x"] / (3 * F.nullif(s["w"], F.lit(0.0)))).alias("x"), (s["y"] / (3 * F.nullif(s["w"], F.lit(0.0)))).alias("y")))


def box_tiles(regions: DataFrame, tiles: DataFrame, keep: list[str], size: float = 2.0) -> DataFrame:
    """(keep, tile, share): tile boxes (tile, tx0, ty0, tx1, ty1) that a region touches, and the share of the tile inside it. Boxes meet on squares, then rings are clipped."""
    r = regions.filter("ring is not null").select(*keep, "ring", *box(F.col("ring")))
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)))
    r = r.withColumn("sx", cells("bx0", "bx1")).withColumn("sy", cells("by0", "by1"))
    t = tiles.withColumn("sx", cells("tx0", "tx1")).withColumn("sy", cells("ty0", "ty1"))
    meet = (F.col("bx0") < F.col("tx1")) & (F.col("bx1") > F.col("tx0")) & (F.col("by0") < F.col("ty1")) & (F.col("by1") > F.col("ty0"))
    pairs = r.join(t, ["sx", "sy"]).filter(meet).drop("sx", "sy").dropDuplicates([*keep, "tile"])
    return pairs.withColumn("share", box_coverage("ring", "tx0", "ty0", "tx1", "ty1")).filter("share > 0").select(*keep, "tile", "share")
