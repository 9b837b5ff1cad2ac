import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.functions import calendar, formula, geo, indices
from verdure.operators import incidents


@pytest.mark.parametrize(
    "text,d,want",
    [("0.5 * D + 1", 4.0, 3.0), ("D ** 2 / 4", 6.0, 9.0), ("-D**2", 3.0, -9.0), ("2 ** 3 ** 2", 0.0, 512.0), ("Math.pow(D, 0.5) * (1 + .5)", 9.0, 4.5), ("Math.max(D, 10) - Math.min(D, 2, 1)", 5.0, 9.0), ("Math.log(Math.exp(D))", 2.0, 2.0), ("1 / (D - D)", 1.0, None), ("1e-3*D", 2.0, 0.002)],
)
def test_formula(spark, text, d, want):
    got = spark.range(1).select(formula.parse(text, F.lit(d)).alias("v")).first()["v"]
    assert got == want if want is None else abs(got - want) < 1e-12


@pytest.mark.parametrize("text", ["D ^ 2", "alert(1)", "Math.random()", "D +", "(D", "D D", "x", "", "__import__('os')", "Math.pow D"])
def test_formula_refused(text):
    with pytest.raises(formula.FormulaError):
        formula.parse(text, _AnyColumn())


class _AnyColumn:
    def _same(self, *_):
        return self

    __add__ = __sub__ = __mul__ = __truediv__ = __neg__ = _same


def test_fortnights(spark):
    days = ["2024-02-15", "2024-02-16", "2024-02-29", "2023-02-28", "2024-12-31", "2024-01-01"]
    d = F.to_date("s")
    rows = spark.createDataFrame([(x,) for x in days], "s string").select(calendar.fortnight(d).alias("fn"), calendar.fortnight_start(d).alias("a"), calendar.fortnight_end(d).alias("b"), calendar.dated_label("x", d, long=True).alias("l")).collect()
    assert [r["fn"] for r in rows] == [1, 2, 2, 2, 2, 1]
    assert [(str(r["a"]), str(r["b"])) for r in rows] == [("2024-02-01", "2024-02-15"), ("2024-02-16", "2024-02-29"), ("2024-02-16", "2024-02-29"), ("2023-02-16", "2023-02-28"), ("2024-12-16", "2024-12-31"), ("2024-01-01", "2024-01-15")]
    assert rows[0]["l"] == "x_2024_february_fn1"


def test_rescue_dates(spark):
    texts = {"05-Jan-24": dt.date(2024, 1, 5), "5-Jan-2024": dt.date(2024, 1, 5), "05-jan-24": None, "31-Feb-2024": None, "29-Feb-2024": dt.date(2024, 2, 29), "29-Feb-23": None, "x": None, None: None, "0-Jan-24": None, "05-Jan-024": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", incidents.rescue_date(F.col("t")).alias("d"))
    assert {r["t"]: r["d"] for r in df.collect()} == texts


def test_ring_and_coverage(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    rnd = np.random.default_rng(1)
    pts = rnd.uniform(-1, 5, (300, 2))

    def inside(x, y):
        out = False
        for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1]):
            if (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa:
                out = not out
        return out

    regions = spark.createDataFrame([("r", [{"x": x, "y": y} for x, y in ring]), ("none", None)], "code string, ring array<struct<x:double,y:double>>")
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id int, px double, py double")
    got = {r["id"] for r in geo.within(points, regions, "px", "py", ["code"], size=0.7).collect()}
    assert got == {i for i, (x, y) in enumerate(pts) if inside(x, y)} and len(got) > 50
    w = geo.coverage_weights(regions, 0.5, ["code"]).collect()
    assert abs(sum(r["c"] for r in w) * 0.25 - geo.ring_area(np.array(ring))) < 1e-9
    assert all(0 < r["c"] <= 1 + 1e-12 for r in w)


def test_thresholds_and_classes(spark):
    with pytest.raises(ValueError):
        indices.thresholds("XX")
    values = [0, 1, 25, 26, 50, 51, 75, 76, 100]
    df = spark.createDataFrame([(v,) for v in values], "v int").select(indices.density_class(F.col("v"), indices.thresholds("RJ")).alias("c"))
    assert [r["c"] for r in df.collect()] == [0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_ndvi_encoding(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (1.0,), (0.126,), (None,)], "v double").select(indices.encode_ndvi(F.col("v")).alias("e"))
    assert [r["e"] for r in df.collect()][:4] == [0, 100, 200, 112]


def test_utm(spark):
    """Known coordinates: the equator at a central meridian, and points published with their UTM coordinates."""
    known = [(75.0, 0.0, 500000.0, 0.0), (2.294497, 48.858222, 448251.9, 5411932.7), (-43.210487, -22.951916, 683466.3, 7460689.2)]
    df = spark.createDataFrame([k[:2] for k in known], "lon double, lat double").select(*geo.to_utm(F.col("lon"), F.col("lat")), geo.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))
    rows = df.collect()
    assert [r["epsg"] for r in rows] == [32643, 32631, 32723]
    for r, k in zip(rows[:2], known):
        assert abs(r["easting"] - k[2]) < 30 and abs(r["northing"] - k[3]) < 30
    # a metre north is a metre, but for the grid's scale
    a, b = spark.createDataFrame([(75.5, 26.0), (75.5, 26.0 + 1 / 111_000)], "lon double, lat double").select(*geo.to_utm(F.col("lon"), F.col("lat"))).collect()
    assert abs(((a["easting"] - b["easting"]) ** 2 + (a["northing"] - b["northing"]) ** 2) ** 0.5 - 1) < 0.01


def test_exact_sums_and_halves(spark):
    """Sums don't depend on order, NaN counts for nothing, and noise in the last bits doesn't move a half."""
    from verdure.functions import exact

    rnd = np.random.default_rng(5)
    v = np.round(rnd.uniform(-1, 1, 3000) * 10.0 ** rnd.integers(-3, 6, 3000), 6)
    for seed in range(3):
        df = spark.createDataFrame([(float(x),) for x in np.random.default_rng(seed).permutation(v)] + [(float("nan"),), (None,)], "v double").repartition(1 + 3 * seed)
        got = df.select(exact.total(F.col("v")).alias("s"), exact.mean(F.col("v")).alias("m")).first()
        want = sum(round(x * 10**6) for x in v) / 10**6
        assert got["s"] == want and got["m"] == want / 3000
    halves = spark.createDataFrame([(8.825,), (8.825 - 2e-15,), (-0.125,), (2.675,), (None,), (-0.0001,)], "v double").select(exact.half_up(F.col("v"), 2).alias("r"))
    assert [r["r"] for r in halves.collect()] == [8.83, 8.83, -0.13, 2.68, None, 0.0]


def test_star_ring_within_and_coverage(spark):
    """A ring of many sides on small squares: points of inner, border and outer squares, and areas, against plain loops."""
    rnd = np.random.default_rng(8)
    angle = np.sort(rnd.uniform(0, 2 * np.pi, 300))
    ring = [(3 + r * np.cos(a), -2 + r * np.sin(a)) for a, r in zip(angle, rnd.uniform(1.0, 4.0, 300))]
    regions = spark.createDataFrame([("s", [{"x": float(x), "y": float(y)} for x, y in ring])], "code string, ring array<struct<x:double,y:double>>")
    pts = rnd.uniform(-8, 8, (1500, 2))
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id int, px double, py double")
    plain = {r["id"] for r in points.join(regions).filter(geo.in_ring(F.col("px"), F.col("py"), F.col("ring"))).collect()}
    for size in (0.1, 0.5, 3.0):
        assert {r["id"] for r in geo.within(points, regions, "px", "py", ["code"], size=size).collect()} == plain
    w = geo.coverage_weights(regions, 0.25, ["code"]).collect()
    assert abs(sum(r["c"] for r in w) * 0.0625 - geo.ring_area(np.array(ring))) < 1e-9 and {r["c"] for r in w} >= {1.0}
