"""Set operations on polygons: areas, holes, parts, shared borders, widening, cut cells, footprints and scene selection."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.functions import geo, overlay
from verdure.operators import scenes, tiles

RING = "k int, ring array<struct<x:double,y:double>>"


def box(a, b, c, d):
    return [(a, b), (c, b), (c, d), (a, d)]


def table(spark, *rows, schema=RING):
    return spark.createDataFrame([(k, r if r is None else [{"x": float(x), "y": float(y)} for x, y in r]) for k, r in rows], schema)


def layers(spark, a, b):
    return overlay.sides(table(spark, *a), ["k"]).unionByName(overlay.sides(table(spark, *b), ["k"], "b"))


#: 1 overlap in a corner, 2 one inside the other, 3 a shared border, 4 parts that touch in a point, 5 many crossings, clockwise, 6 equal, 7 no ring on one side.
A = [(1, box(0, 0, 4, 4)), (2, box(0, 0, 4, 4)), (3, box(0, 0, 4, 4)), (4, box(0, 0, 1, 1)), (4, box(1, 1, 2, 2)), (5, box(0, 0, 4, 4)[::-1]), (6, box(0, 0, 2, 2)), (7, box(0, 0, 1, 1))]
B = [(1, box(2, 2, 6, 6)), (2, box(1, 1, 2, 3)), (3, box(4, 0, 8, 4)), (4, box(0, 1, 1, 2)), (5, [(-1, 2), (2, -1), (5, 2), (2, 5)]), (6, box(0, 0, 2, 2)[::-1]), (7, None)]
EXPECTED = {
    "union": {1: [(28, 0)], 2: [(16, 0)], 3: [(32, 0)], 4: [(3, 0)], 5: [(20, 0)], 6: [(4, 0)], 7: [(1, 0)]},
    "intersection": {1: [(4, 0)], 2: [(2, 0)], 5: [(14, 0)], 6: [(4, 0)]},
    "difference": {1: [(12, 0)], 2: [(14, 1)], 3: [(16, 0)], 4: [(1, 0)] * 2, 5: [(0.5, 0)] * 4, 7: [(1, 0)]},
}


@pytest.mark.parametrize("how", sorted(EXPECTED))
def test_parts_and_holes(spark, how):
    border = overlay.overlay(layers(spark, A, B), ["k"], how, 1.0)
    got = {}
    for r in overlay.parts(overlay.rings(border, ["k"]), ["k"]).collect():
        got.setdefault(r.k, []).append((round(r.area, 6), r.holes))
    assert {k: sorted(v) for k, v in got.items()} == EXPECTED[how]
    assert {r.k: round(r.area, 6) for r in overlay.area(border, ["k"]).collect()} == {k: sum(a for a, _ in v) for k, v in EXPECTED[how].items()}


def test_random_stars_against_points(spark):
    """Areas of concave polygons, whose sides cross at any angle, against counts of points; and what they must add up to."""
    rnd = random.Random(5)

    def star(cx, cy):
        return [(cx + r * math.cos(2 * math.pi * i / 11), cy + r * math.sin(2 * math.pi * i / 11)) for i in range(11) for r in [rnd.uniform(1, 4)]]

    a, b = [(k, star(0, 0)) for k in range(4)], [(k, star(1.3, 0.4)) for k in range(4)]
    rows = layers(spark, a, b)
    areas = {h: {r.k: r.area for r in overlay.area(overlay.overlay(rows, ["k"], h, 0.7), ["k"]).collect()} for h in ("union", "intersection", "difference")}
    xs = np.arange(-6, 6, 0.02) + 0.0101
    x, y = np.meshgrid(xs, xs)

    def inside(ring):
        out = np.zeros_like(x, dtype=bool)
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            out ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
        return out

    for k in range(4):
        p, q = inside(a[k][1]), inside(b[k][1])
        for how, mask in (("union", p | q), ("intersection", p & q), ("difference", p & ~q)):
            assert areas[how][k] == pytest.approx(mask.sum() * 0.02**2, rel=0.01)
        assert areas["union"][k] == pytest.approx(areas["intersection"][k] + areas["difference"][k] + geo.ring_area(np.array(b[k][1])) - areas["intersection"][k], abs=1e-6)


def test_widened(spark):
    """A box has the closed form; of a concave one all points within the distance are inside, and none farther."""
    concave = [(0, 0), (6, 0), (6, 6), (3, 1), (0, 6)]
    rows = overlay.widened(table(spark, (1, box(0, 0, 10, 5)), (2, concave), (3, None)), ["k"], 1.0, quarter=32)
    got = {r.k: r.area for r in overlay.area(overlay.overlay(rows, ["k"], "union", 1.0), ["k"]).collect()}
    assert got[1] == pytest.approx(50 + 30 + 64 * math.sin(math.pi / 64), abs=1e-6) and set(got) == {1, 2}
    xs = np.arange(-2, 8, 0.02) + 0.01
    x, y = np.meshgrid(xs, xs)
    near, inside = np.zeros_like(x, dtype=bool), np.zeros_like(x, dtype=bool)
    for (ax, ay), (bx, by) in zip(concave, concave[1:] + concave[:1]):
        t = np.clip(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2), 0, 1)
        near |= np.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay)) <= 1
        if ay != by:
            inside ^= ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    assert got[2] == pytest.approx((near | inside).sum() * 0.02**2, rel=0.003)


def test_a_cell_with_two_parts(spark):
    """A notch that goes through a cell leaves a part on either side of it."""
    rows = tiles.cut_cells(table(spark, (1, [(0, 0), (4, 0), (4, 4), (2, 0.5), (0, 4)])), 2.0, ["k"])
    got = {(r.gx, r.gy): sorted(x.area for x in rows.filter(f"gx = {r.gx} and gy = {r.gy}").collect()) for r in rows.select("gx", "gy").distinct().collect()}
    assert sum(map(sum, got.values())) == pytest.approx(16 - 7) and len(got) == 4
    wide = tiles.cut_cells(table(spark, (1, [(0, 0), (4, 0), (4, 4), (2, 0.5), (0, 4)])), 4.0, ["k"]).collect()
    assert [round(r.area, 6) for r in wide] == [9.0] and len(wide[0].ring) == 5


def test_small_parts_are_no_gaps(spark):
    """A sliver of 20 m by 40 m beside a footprint goes, a strip of 20 km stays; a tile without footprints is left as a whole."""
    metres = lambda a, b, c, d: F.array(*(F.struct(*(v.alias(n) for v, n in zip(geo.from_utm(F.lit(float(x)), F.lit(float(y)), 43), "xy"))) for x, y in box(a, b, c, d)))
    one = spark.range(1)
    whole = one.select(F.lit("t").alias("tile"), metres(400_000, 2_200_000, 500_000, 2_200_040).alias("ring")).unionByName(one.select(F.lit("u").alias("tile"), metres(400_000, 2_200_000, 410_000, 2_210_000).alias("ring")))
    seen = one.select(F.lit("t").alias("tile"), metres(401_020, 2_190_000, 479_000, 2_210_000).alias("ring"))
    got = {(r.tile, round(r.area)) for r in scenes.uncovered_parts(whole, seen).collect()}
    assert got == {("t", 20_000 * 40), ("u", 100_000_000)}
    assert scenes.uncovered_parts(whole, seen, least=100.0).filter("tile = 't'").count() == 2


def test_selection_against_plain_loops(spark):
    rnd = random.Random(3)
    rows = []
    for seq in range(400):
        x, y = rnd.choice([0.0, 0.1, 0.3]), rnd.choice([0.0, 0.2])
        rows.append((seq, f"S_T{seq % 9}_{seq}", rnd.uniform(0, 100), rnd.choice([0.0, 4.0, 6.0]), x, x + rnd.choice([0.3, 0.7, 0.9, 1.2]), y, y + rnd.choice([0.5, 0.8, 1.0])))
    items = spark.createDataFrame(rows, "seq long, id string, cloud double, degraded double, fx0 double, fx1 double, fy0 double, fy1 double")
    want = []
    meet = lambda a, b, i: max(0.0, min(a[i + 1], b[i + 1], 1.0) - max(a[i], b[i], 0.0))
    area = lambda a, b: meet(a, b, 4) * meet(a, b, 6)
    for t in range(9):
        mine = [r for r in rows if r[0] % 9 == t]
        best, pick = 0.0, None
        for limit in (20, 40, 60, 80, 100):
            for r in mine:
                if r[2] < limit and r[3] < 5 and best <= 0.6 and area(r, r) > best:
                    best, pick = area(r, r), r
        if pick is None:
            continue
        want.append((f"T{t}", pick[0], 0, round(best, 6)))
        had, place = best, 0
        if 0.6 < best <= 0.95:
            for r in mine:
                reach = best + area(r, r) - area(pick, r)
                if reach > had + 0.05:
                    had, place = reach, place + 1
                    want.append((f"T{t}", r[0], place, round(had, 6)))
                if had > 0.95:
                    break
    got = scenes.selection(items)
    assert sorted((r.tile, r.seq, r.place, round(r.coverage, 6)) for r in got.collect()) == sorted(want)
    summary = scenes.selection_summary(got).collect()
    assert sum(r.scenes for r in summary) == len(want) and sum(r.tiles for r in summary) == 9 and sum(r.several for r in summary) == len({w[0] for w in want if w[2]})


def test_footprint_coverage_settles_simple_rings_in_their_rows(spark):
    ring = lambda *p: [{"x": x, "y": y} for x, y in p]
    notched = ring((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (1.0, 0.5), (0.0, 2.0))
    simple = [(1, "t", ring((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0))), (2, "t", ring((3.0, 3.0), (4.0, 3.0), (4.0, 4.0))), (3, "t", ring((-1.0, 0.7), (3.0, 0.9), (3.0, 1.4), (-1.0, 1.2))), (4, "t", list(reversed(notched))), (5, "t", None), (6, "none", notched), (7, "none", None)]
    crossed = [(8, "t", ring((0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 1.0)))]
    schema = "seq int, tile string, ring array<struct<x:double,y:double>>"
    tiles = spark.createDataFrame([("t", notched), ("none", None)], schema.split(", ", 1)[1])

    def by_overlay(items):
        rows = overlay.sides(items, ["seq"], "a").unionByName(overlay.sides(items.select("seq", "tile").join(tiles, "tile"), ["seq"], "b"))
        return {r.seq: r.area / 2.5 for r in overlay.area(overlay.overlay(rows, ["seq"], "intersection", 1.0), ["seq"]).collect()}

    items = spark.createDataFrame(simple, schema)
    got = scenes.footprint_coverage(items, tiles, ["seq"], 1.0)
    assert got._jdf.queryExecution().executedPlan().toString().count("sides") == 0 and "hashpartitioning(seq" not in got._jdf.queryExecution().executedPlan().toString()
    every = {r.seq: r.coverage for r in scenes.footprint_coverage(spark.createDataFrame(simple + crossed, schema), tiles, ["seq"], 1.0).collect()}
    want = by_overlay(spark.createDataFrame(simple + crossed, schema))
    assert every[6] is None and every[7] is None and every[5] == 0 == every[2]
    assert all(abs(every[i] - want.get(i, 0.0)) < 1e-9 for i in (1, 2, 3, 4, 5, 8)) and every[4] == pytest.approx(1.0)
    assert {r.seq: r.coverage for r in got.collect()} == {k: v for k, v in every.items() if k != 8}
