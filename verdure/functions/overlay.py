"""Set operations on polygons as rows of sides: union, intersection and difference of any number of polygons in each group of keys.

A polygon is its directed sides, outer rings counterclockwise and holes clockwise, so holes and several parts need no case of their own. Sides meet on squares (an equi-join), are cut where
they cross or touch, and equal pieces become one row with the sum of their directions for layer a and for layer b. How often each layer winds around the two sides of a piece comes from the
pieces to the right of its middle, met by bands of height, so a piece is on the result's border exactly if one of its sides is inside and the other isn't. Areas are sums over those pieces;
only ``rings``, for which a result polygon is one row anyway, takes a group's border to one task.

Coordinates are rounded to ``1 / scale``; crossings too, so borders may move by that much, and parts thinner than that can vanish.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdure.session import written

PIECE = ["px", "py", "qx", "qy"]
RULES = {"union": lambda a, b: (a > 0) | (b > 0), "intersection": lambda a, b: (a > 0) & (b > 0), "difference": lambda a, b: (a > 0) & (b <= 0), "symmetric": lambda a, b: (a > 0) != (b > 0)}


def _signed(ring: Column) -> Column:
    """Twice the area, negative if clockwise; relative to the first point, so that large coordinates lose nothing."""
    n, o = F.size(ring), F.get(ring, F.lit(0))
    at = lambda i: F.get(ring, i % n)
    cross = lambda s, i: s + (at(i)["x"] - o["x"]) * (at(i + 1)["y"] - o["y"]) - (at(i + 1)["x"] - o["x"]) * (at(i)["y"] - o["y"])
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), cross)


def oriented(ring: Column, hole: Column | bool = False) -> Column:
    """The ring counterclockwise, or clockwise as a hole."""
    hole = F.lit(hole) if isinstance(hole, bool) else hole
    return F.when((_signed(ring) < 0) != hole, F.reverse(ring)).otherwise(ring)


def sides(polygons: DataFrame, keys: list[str], layer: str = "a", ring: str = "ring", hole: Column | bool = False, scale: float = 1e9) -> DataFrame:
    """(keys, px, py, qx, qy, a, b): the sides of rings, array of struct<x, y>, as unit steps of one layer. A side goes up, or right if level; its direction is the sign of a or b. Null rings
    and rings of fewer than three points have no sides. A polygon with holes is a row for each ring."""
    rows = polygons.filter(F.size(ring) > 2).select(*keys, oriented(F.col(ring), hole).alias("_r"))
    n = F.size("_r")
    pair = F.transform(F.col("_r"), lambda p, i: F.struct(p["x"].alias("ax"), p["y"].alias("ay"), F.get("_r", (i + 1) % n)["x"].alias("bx"), F.get("_r", (i + 1) % n)["y"].alias("by")))
    return directed(rows.select(*keys, F.inline(pair)), keys, layer, scale)


def directed(steps: DataFrame, keys: list[str], layer: str = "a", scale: float = 1e9) -> DataFrame:
    """(keys, px, py, qx, qy, a, b) of steps (keys, ax, ay, bx, by) that have the inside at their left, as ``sides``."""
    snapped = (((F.rint(F.col(c) * scale) / scale).alias(c)) for c in ("ax", "ay", "bx", "by"))
    return _upward(steps.select(*keys, *snapped, *(F.lit(int(layer == c)).cast("long").alias(c) for c in "ab")), keys)


def _upward(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Steps (ax, ay) to (bx, by) as upward pieces; steps of no length go."""
    up = (F.col("ay") < F.col("by")) | ((F.col("ay") == F.col("by")) & (F.col("ax") < F.col("bx")))
    ends = (("px", "ax", "bx"), ("py", "ay", "by"), ("qx", "bx", "ax"), ("qy", "by", "ay"))
    rows = rows.filter("ax <> bx or ay <> by")
    return rows.select(*keys, *(F.when(up, F.col(x)).otherwise(F.col(y)).alias(n) for n, x, y in ends), *(F.when(up, F.col(n)).otherwise(-F.col(n)).alias(n) for n in "ab"))


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Equal pieces as one; borders that two polygons of a layer share dissolve here."""
    return rows.groupBy(*keys, *PIECE).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).filter("a <> 0 or b <> 0")


def _pieces(rows: DataFrame, keys: list[str], size: float, scale: float) -> DataFrame:
    """Sides cut wherever they cross or touch another of their group."""
    whole = written(_summed(rows, keys), "sides")
    # a side lies in the squares of each band that it passes, one more on either side for the last bits
    f = lambda v: F.floor(v / size)
    near = whole.withColumn("sy", F.explode(F.sequence(f(F.col("py")), f(F.col("qy")))))
    slope = (F.col("qx") - F.col("px")) / F.nullif(F.col("qy") - F.col("py"), F.lit(0.0))
    at = lambda y: F.coalesce(F.col("px") + slope * (F.least(F.greatest(y, F.col("py")), F.col("qy")) - F.col("py")), F.col("px"))
    low, high = at(F.col("sy") * size), F.when(slope.isNull(), F.col("qx")).otherwise(at((F.col("sy") + 1) * size))
    margin = 2 / scale
    near = near.withColumn("sx", F.explode(F.sequence(f(F.least(low, high) - margin), f(F.greatest(low, high) + margin))))
    s = F.struct(*PIECE)
    left = near.select(*keys, "sx", "sy", s.alias("l"))
    right = near.select(*keys, "sx", "sy", s.alias("r"))
    met = left.join(right, [*keys, "sx", "sy"]).filter("l < r").drop("sx", "sy")
    x0, x1 = (lambda c: F.least(c["px"], c["qx"])), (lambda c: F.greatest(c["px"], c["qx"]))
    l, r = F.col("l"), F.col("r")  # noqa: E741
    met = met.filter((x0(l) <= x1(r) + margin) & (x0(r) <= x1(l) + margin) & (l["py"] <= r["qy"] + margin) & (r["py"] <= l["qy"] + margin))
    tol = 1.5 / scale
    cross = lambda c, x, y: (c["qx"] - c["px"]) * (y - c["py"]) - (c["qy"] - c["py"]) * (x - c["px"])
    dot = lambda c, x, y: (c["qx"] - c["px"]) * (x - c["px"]) + (c["qy"] - c["py"]) * (y - c["py"])
    length = lambda c: F.hypot(c["qx"] - c["px"], c["qy"] - c["py"])
    on = lambda c, o, e: (F.abs(cross(c, o[e + "x"], o[e + "y"])) <= tol * length(c)) & dot(c, o[e + "x"], o[e + "y"]).between(F.lit(0.0), length(c) * length(c))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ends = lambda c, o: F.array(*(F.when(on(c, o, e), point(o[e + "x"], o[e + "y"])) for e in "pq"))
    met = met.withColumns({"cut_l": ends(l, r), "cut_r": ends(r, l)})
    touch = F.exists(F.concat("cut_l", "cut_r"), lambda p: p.isNotNull())
    c1, c2 = cross(r, l["px"], l["py"]), cross(r, l["qx"], l["qy"])
    through = (F.signum(c1) * F.signum(c2) < 0) & (F.signum(cross(l, r["px"], r["py"])) * F.signum(cross(l, r["qx"], r["qy"])) < 0)
    t = c1 / F.nullif(c1 - c2, F.lit(0.0))
    snap = lambda v: F.rint(v * scale) / scale
    x = F.when(~touch & through, point(snap(l["px"] + t * (l["qx"] - l["px"])), snap(l["py"] + t * (l["qy"] - l["py"]))))
    met = met.withColumn("x", x).select(*keys, F.inline(F.array(*(F.struct(F.col(c).alias("s"), F.array_append(F.col("cut_" + c), F.col("x")).alias("cut")) for c in "lr"))))
    cuts = met.select(*keys, "s.*", F.explode("cut").alias("cut")).filter("cut is not null")
    cuts = cuts.select(*keys, *PIECE, "cut", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    every = whole.select(*keys, *PIECE, F.lit(None).cast("struct<x:double,y:double>").alias("cut"), "a", "b").unionByName(cuts)
    every = every.groupBy(*keys, *PIECE).agg(F.collect_set("cut").alias("cuts"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    along = lambda x, y: (F.col("qx") - F.col("px")) * (x - F.col("px")) + (F.col("qy") - F.col("py")) * (y - F.col("py"))
    stop = lambda x, y: F.struct(along(x, y).alias("t"), x.alias("x"), y.alias("y"))
    stops = F.array_distinct(F.concat(F.array(stop(F.col("px"), F.col("py"))), F.array_sort(F.transform("cuts", lambda p: stop(p["x"], p["y"]))), F.array(stop(F.col("qx"), F.col("qy")))))
    every = every.select(*keys, "a", "b", stops.alias("p"))
    steps = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p") - 1), lambda u, v: F.struct(u["x"].alias("ax"), u["y"].alias("ay"), v["x"].alias("bx"), v["y"].alias("by")))
    return _summed(_upward(every.select(*keys, "a", "b", F.inline(steps)), keys), keys)


def overlay(rows: DataFrame, keys: list[str], how: str, size: float, scale: float = 1e9) -> DataFrame:
    """(keys, ax, ay, bx, by): the border of ``how`` (union, intersection, difference, symmetric) of layers a and b, each the union of its polygons, directed with the inside at its left.

    ``rows`` are ``sides``; they and their pieces are written once to the session's shared folder, since both are read several times. Squares and bands have ``size``: about the length of a usual side. A group with n pieces in a band does n times n comparisons there.
    """
    pieces = written(_pieces(rows, keys, size, scale), "pieces")
    middle = pieces.withColumns({"mx": (F.col("px") + F.col("qx")) / 2, "my": (F.col("py") + F.col("qy")) / 2}).withColumn("band", F.floor(F.col("my") / size))
    other = pieces.filter("py < qy").withColumn("band", F.explode(F.sequence(F.floor(F.col("py") / size), F.floor(F.col("qy") / size))))
    other = other.select(*keys, "band", *(F.col(c).alias("o" + c) for c in (*PIECE, "a", "b")))
    met = middle.join(other, [*keys, "band"], "left")
    at = F.col("opx") + (F.col("oqx") - F.col("opx")) * ((F.col("my") - F.col("opy")) / (F.col("oqy") - F.col("opy")))
    own = (F.col("opx") == F.col("px")) & (F.col("opy") == F.col("py")) & (F.col("oqx") == F.col("qx")) & (F.col("oqy") == F.col("qy"))
    right_of = (F.col("opy") <= F.col("my")) & (F.col("my") < F.col("oqy")) & (at > F.col("mx")) & ~own
    wound = lambda c: F.coalesce(F.sum(F.when(right_of, F.col("o" + c))), F.lit(0))
    seen = met.groupBy(*keys, *PIECE, "a", "b").agg(wound("a").alias("wa"), wound("b").alias("wb"))
    # the ray starts at the right of a piece that goes up, and above a level one, which is its left
    level = F.col("py") == F.col("qy")
    left = [F.col("w" + c) + F.when(level, 0).otherwise(F.col(c)) for c in "ab"]
    right = [F.col("w" + c) - F.when(level, F.col(c)).otherwise(0) for c in "ab"]
    border = seen.withColumns({"in_left": RULES[how](*left), "in_right": RULES[how](*right)}).filter("in_left <> in_right")
    ends = (("ax", "px", "qx"), ("ay", "py", "qy"), ("bx", "qx", "px"), ("by", "qy", "py"))
    return border.select(*keys, *(F.when(F.col("in_left"), F.col(x)).otherwise(F.col(y)).alias(n) for n, x, y in ends))


def area(border: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, area) of what a border encloses; groups that enclose nothing have no row."""
    return border.groupBy(*keys).agg(F.sum((F.col("ax") - F.col("bx")) * (F.col("ay") + F.col("by")) / 2).alias("area"))


def _chained(steps: list[tuple[float, float, float, float]]) -> list[list[tuple[float, float]]]:
    """Directed steps as closed rings; where several leave a point, the one farthest to the left, so that parts that touch in a point stay apart."""
    leaving: dict[tuple[float, float], list[tuple[float, float]]] = {}
    for ax, ay, bx, by in sorted(steps):
        leaving.setdefault((ax, ay), []).append((bx, by))
    out = []
    for start in sorted(leaving):
        while leaving[start]:
            ring, here = [start], leaving[start].pop(0)
            while here != start:
                (ux, uy), (vx, vy) = ring[-1], here
                turn = lambda w: math.atan2((vx - ux) * (w[1] - vy) - (vy - uy) * (w[0] - vx), (vx - ux) * (w[0] - vx) + (vy - uy) * (w[1] - vy))
                ring.append(here)
                here = max(leaving[here], key=turn)
                leaving[ring[-1]].remove(here)
            out.append(_without_straight(ring))
    return out


def _without_straight(ring: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The ring without points on the line between their neighbours: cuts of one side."""
    keep = [b for a, b, c in zip(ring[-1:] + ring[:-1], ring, ring[1:] + ring[:1]) if abs((b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])) > 1e-9 * math.hypot(b[0] - a[0], b[1] - a[1]) * math.hypot(c[0] - b[0], c[1] - b[1])]
    return keep if len(keep) > 2 else ring


def _holds(ring: list[tuple[float, float]], x: float, y: float) -> bool:
    return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1])) % 2 == 1


def rings(border: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, hole, area, ring): a border's rings. A part is an outer ring with its holes, numbered from 1 by their least point; ``area`` is the ring's own."""

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        for r in _chained(list(pdf[["ax", "ay", "bx", "by"]].itertuples(index=False, name=None))):
            ox, oy = r[0]
            found.append((sum((ax - ox) * (by - oy) - (bx - ox) * (ay - oy) for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1])) / 2, r))
        outer = sorted((min(r), a, r) for a, r in found if a > 0)
        rows = [(n, False, a, r) for n, (_, a, r) in enumerate(outer, start=1)]
        for a, r in found:
            if a < 0:
                x, y = (r[0][0] + r[1][0]) / 2, (r[0][1] + r[1][1]) / 2  # a hole may touch its outer ring in a corner
                rows.append((min((o, n) for n, (_, o, q) in enumerate(outer, start=1) if _holds(q, x, y))[1], True, -a, r))
        out = pd.DataFrame({"part": [r[0] for r in rows], "hole": [r[1] for r in rows], "area": [r[2] for r in rows], "ring": [[{"x": x, "y": y} for x, y in r[3]] for r in rows]})
        for k in reversed(keys):
            out.insert(0, k, [pdf[k].iloc[0]] * len(out))
        return out

    types = ", ".join(f"`{k}` {border.schema[k].dataType.simpleString()}" for k in keys)
    return border.groupBy(*keys).applyInPandas(link, f"{types}, part int, hole boolean, area double, ring array<struct<x:double,y:double>>")


def parts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, part, holes, area, ring, inner): ``rings`` as polygons: the area without the holes, the outer ring, and the rings of the holes."""
    hole = F.col("hole")
    return rows.groupBy(*keys, "part").agg(
        F.count(F.when(hole, 1)).alias("holes"), F.sum(F.when(hole, -F.col("area")).otherwise(F.col("area"))).alias("area"), F.first(F.when(~hole, F.col("ring")), ignorenulls=True).alias("ring"), F.array_sort(F.collect_list(F.when(hole, F.col("ring")))).alias("inner")
    )


def widened(polygons: DataFrame, keys: list[str], distance: float, layer: str = "a", ring: str = "ring", quarter: int = 16, scale: float = 1e9) -> DataFrame:
    """``sides`` of polygons widened by ``distance``, corners rounded by ``quarter`` chords a right angle: the ring, a strip along each side, and a wedge at each convex corner. Their union is
    the widened polygon; inner borders between them dissolve or are inside."""
    rows = polygons.filter(F.size(ring) > 2).select(*keys, oriented(F.col(ring)).alias("ring"))
    n, at = F.size("ring"), lambda i: F.get("ring", i % F.size("ring"))
    corner = rows.select(*keys, "ring", F.explode(F.sequence(F.lit(0), n - 1)).alias("i")).select(*keys, at(F.col("i") + n - 1).alias("u"), at(F.col("i")).alias("v"), at(F.col("i") + 1).alias("w"))
    corner = corner.filter("u <> v and v <> w")
    length = lambda p, q: F.hypot(q["x"] - p["x"], q["y"] - p["y"])
    normal = lambda p, q: (distance * (q["y"] - p["y"]) / length(p, q), distance * (p["x"] - q["x"]) / length(p, q))
    u, v, w = F.col("u"), F.col("v"), F.col("w")
    names = ("ax", "ay", "bx", "by")
    corner = corner.withColumns(dict(zip(names, (*normal(u, v), *normal(v, w)))))
    ax, ay, bx, by = map(F.col, names)
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    off = lambda p, x, y: point(p["x"] + x, p["y"] + y)
    turn = F.atan2(ax * by - ay * bx, ax * bx + ay * by)
    chords = F.greatest(F.lit(1), F.ceil(turn / (math.pi / 2 / quarter) - 1e-9).cast("int"))
    corner = corner.withColumns({"turn": turn, "chords": chords, "start": F.atan2(ay, ax)})
    angle = lambda k: F.col("start") + F.col("turn") * k / F.col("chords")
    arc = F.when(F.col("chords") > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.col("chords") - 1, F.lit(1))), lambda k: off(v, distance * F.cos(angle(k)), distance * F.sin(angle(k))))).otherwise(F.array().cast("array<struct<x:double,y:double>>"))
    strip = F.array(point(v["x"], v["y"]), off(v, bx, by), off(w, bx, by), point(w["x"], w["y"]))
    wedge = F.when(F.col("turn") > 1e-12, F.concat(F.array(point(v["x"], v["y"]), off(v, ax, ay)), arc, F.array(off(v, bx, by))))
    bits = corner.select(*keys, F.explode(F.array(strip, wedge)).alias("ring")).filter("ring is not null")
    return sides(rows.unionByName(bits), keys, layer, scale=scale)
