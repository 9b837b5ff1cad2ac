"""Pixel time series as arrays, one row for each pixel, and the forest mask made from them. No shuffle after the rows of a pixel are gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions import indices
from verdure.operators import composite

#: Fixed values of the forest rule: steps are ten days, and season bounds are places from the series' end (both ends included).
GREEN, DIP, FLOOR = 0.25, 0.32, 0.123
LEFT, CENTRE, RIGHT = (19, 11), (24, 20), (30, 25)
FOREST_STEPS, OVERRIDE_STEPS, OVERRIDE_CLASSES = 18, 35, (5, 6, 7, 8, 1)


def gather(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Long rows (keys, step, ndvi) to ``a``, the values in order of step, missing ones null."""
    ordered = F.array_sort(F.collect_list(F.struct("step", "ndvi")))
    return rows.groupBy(*keys).agg(F.transform(ordered, lambda x: x["ndvi"]).alias("a"))


def spread(rows: DataFrame, keys: list[str], column: str = "a") -> DataFrame:
    return rows.select(*keys, F.posexplode(column).alias("step", "value"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda a column's expression would be computed for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def interpolate(a: Column) -> Column:
    """Missing values on the line between their neighbours, constant before the first and after the last known one; all missing stays missing.

    A value knows the last known one before it and the next after it from one pass in each direction.
    """
    none = F.lit(None).cast("struct<i:int,v:double>")
    empty = F.array().cast("array<struct<i:int,v:double>>")
    scan = lambda arr: F.aggregate(arr, F.struct(none.alias("last"), empty.alias("out")), lambda acc, x: F.struct(F.coalesce(x, acc["last"]).alias("last"), F.concat(acc["out"], F.array(F.coalesce(x, acc["last"]))).alias("out")), lambda acc: acc["out"])

    def value(x: Column, i: Column) -> Column:
        p, q = x["p"], x["q"]
        line = p["v"] + (q["v"] - p["v"]) * (i - p["i"]) / F.nullif(q["i"] - p["i"], F.lit(0))
        return F.when(p["i"] == q["i"], p["v"]).otherwise(F.coalesce(line, p["v"], q["v"]))

    known = F.transform(a, lambda v, i: F.when(v.isNotNull(), F.struct(i.cast("int").alias("i"), v.cast("double").alias("v"))))
    both = lambda idx: F.zip_with(scan(idx), F.reverse(scan(F.reverse(idx))), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    return let(known, lambda idx: F.transform(both(idx), value))


def rolling(a: Column, width: int, how: str) -> Column:
    """Trailing maximum or mean; the first width - 1 values are the first full window's."""
    one = (lambda w: F.array_max(w)) if how == "max" else (lambda w: F.aggregate(w, F.lit(0.0), lambda s, v: s + v) / width)
    return let(a, lambda arr: F.transform(F.sequence(F.lit(0), F.size(arr) - 1), lambda i: one(F.slice(arr, F.greatest(i - width + 1, F.lit(0)) + 1, width))))


def median(a: Column, bounds: tuple[int, int]) -> Column:
    """Median of the known values from the ``bounds[0]``-th to the ``bounds[1]``-th from the end; a shorter series has fewer."""
    first, n = F.greatest(F.size(a) - bounds[0], F.lit(0)), F.least(F.lit(bounds[0]), F.size(a)) - bounds[1] + 1
    known = F.array_sort(F.filter(F.slice(a, first + 1, F.greatest(n, F.lit(0))), lambda v: v.isNotNull()))
    middle = lambda s, n: F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2)
    return let(known, lambda s: middle(s, F.size(s)))


def longest_run(a: Column, above: float) -> Column:
    """Most values above the threshold in a row."""
    step = lambda acc, v: F.struct(F.when(v > above, acc["run"] + 1).otherwise(0).alias("run"), F.greatest(acc["best"], F.when(v > above, acc["run"] + 1).otherwise(0)).alias("best"))
    return F.aggregate(a, F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")), step, lambda acc: acc["best"])


def green_stages(rows: DataFrame) -> DataFrame:
    """``a`` to filled, high (rolling maximum), smooth (its rolling mean), the three season medians and green_steps.

    Few values above 0.20 make a pixel 0. A dip in the middle season under both others, and under 0.32, makes it 0: crops, not forest.
    """
    rows = rows.withColumn("filled", interpolate(F.col("a")))
    rows = rows.withColumn("high", rolling(F.transform("filled", lambda v: F.greatest(v, F.lit(FLOOR))), 3, "max"))
    rows = rows.withColumn("smooth", rolling(F.col("high"), 3, "mean"))
    rows = rows.withColumns({n: median(F.col("smooth"), b) for n, b in (("left_med", LEFT), ("centre_med", CENTRE), ("right_med", RIGHT))})
    some = F.size(F.filter("filled", lambda v: v > 0.20)) > 3
    dip = (F.col("centre_med") <= F.col("left_med")) & (F.col("centre_med") <= F.col("right_med")) & (F.col("centre_med") <= DIP)
    return rows.withColumn("green_steps", F.when(some & ~dip, longest_run(F.col("smooth"), GREEN)).otherwise(0))


def forest_mask(rows: DataFrame) -> DataFrame:
    """``forest`` from green_steps and lulc: cropland, built-up, bare, snow and water need more steps."""
    steps = F.when(F.col("lulc").isin(*OVERRIDE_CLASSES) & (F.col("green_steps") <= OVERRIDE_STEPS), 0).otherwise(F.col("green_steps"))
    return rows.withColumn("forest", F.when(steps >= FOREST_STEPS, 1).otherwise(0))


def nearest_in_time(scenes: DataFrame, keys: list[str], steps: int, every: int) -> DataFrame:
    """(keys, step, ndvi): of each step of a regular grid the scene nearest in days, the earlier of two as near. A pixel's scenes are one array,
    which is looked through for each step where it is; only what is found becomes rows."""
    own = scenes.groupBy(*keys).agg(F.collect_list(F.struct("day", "ndvi")).alias("scenes"))
    near = lambda step: F.array_min(F.transform("scenes", lambda s: F.struct(F.abs(s["day"] - step * every).alias("away"), s["day"].alias("day"), s["ndvi"].alias("ndvi"))))
    found = own.select(*keys, F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), near)).alias("step", "near"))
    return found.select(*keys, "step", F.col("near.ndvi").alias("ndvi"))


def fill_gaps(rows: DataFrame) -> DataFrame:
    """``a`` (array of struct<day, ndvi> in order of day) to ``filled``: a gap takes the nearer neighbour in days, the next one of two as near; what was filled counts as known for
    the gap after it. The first step takes the next; the last stays as it is."""
    empty = F.array().cast("array<double>")

    def step(acc: Column, i: Column) -> Column:
        a = F.col("a")
        here, prev, nxt = F.get(a, i), F.get(a, i - 1), F.get(a, i + 1)
        nearer_prev = (i > 0) & (here["day"] - prev["day"] < nxt["day"] - here["day"])
        fill = F.when(i == F.size(a) - 1, F.lit(None)).when(nearer_prev, F.get(acc, i - 1)).otherwise(nxt["ndvi"])
        return F.concat(acc, F.array(F.coalesce(here["ndvi"], fill)))

    return rows.withColumn("filled", F.aggregate(F.sequence(F.lit(0), F.size("a") - 1), empty, step))


def align_nearest(fine: DataFrame, coarse: DataFrame, ratio: float) -> DataFrame:
    """Rows of a fine grid (y, x) with the value of the nearest node of a grid ``ratio`` times as coarse: an equi-join on rounded indices."""
    return fine.withColumns({"cy": F.floor(F.col("y") / ratio + 0.5).cast("int"), "cx": F.floor(F.col("x") / ratio + 0.5).cast("int")}).join(coarse.withColumnsRenamed({"y": "cy", "x": "cx"}), ["cy", "cx"]).drop("cy", "cx")


def rolling_long(rows: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Rolling maximum and mean on long rows by window frames; null before the first full window."""
    w = Window.partitionBy(*keys).orderBy("step").rowsBetween(-(width - 1), 0)
    full = F.count("*").over(w) == width
    return rows.select(*keys, "step", F.when(full, F.max("ndvi").over(w)).alias("high"), F.when(full, F.avg("ndvi").over(w)).alias("mean"))


def forest_product(scenes: DataFrame, cover: DataFrame, corners: DataFrame, first_day: str, steps: int, every: int) -> DataFrame:
    """(y, x, forest): the forest mask from scene pixels (chunk, y, x, day, seq, scl, red, nir) to the mosaic: scenes of a day as one, the index where they are clear, the scene nearest to each
    step of ``every`` days from ``first_day`` on, gaps filled, green steps counted, land cover (chunk, y, x, lulc) taken into account, chunks placed at their ``corners`` (chunk, y0, x0).

    A pixel's values are one row from the resampling on; pixels without land cover are judged by their series alone.
    """
    keys = ["chunk", "y", "x"]
    days = composite.by_solar_day(scenes, keys, ["red", "nir", "scl"])
    index = indices.masked_series(F.col("scl"), indices.ndvi_series(F.col("red"), F.col("nir")))
    rows = nearest_in_time(days.select(*keys, F.date_diff("day", F.lit(first_day).cast("date")).alias("day"), index.alias("ndvi")), keys, steps, every)
    green = green_stages(gather(rows, keys)).join(cover.select(*keys, "lulc"), keys, "left")
    layer = forest_mask(green).select(*keys, F.col("forest").alias("value"))
    return composite.ordered_mosaic(composite.placed(layer, corners)).withColumnRenamed("value", "forest")
