"""Composites, mosaics and canopy density from scene pixels."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.functions import calendar, indices


def max_composite(pixels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, ndvi, value, valid): highest index of the clear scenes of a pixel, encoded; 0 where none is clear."""
    clear = F.col("scl").isin(*indices.CLEAR_MOSAIC)
    best = F.max(F.when(clear, indices.ndvi(F.col("red"), F.col("nir"))))
    return pixels.groupBy(*keys).agg(best.alias("ndvi")).withColumns({"valid": F.col("ndvi").isNotNull(), "value": F.coalesce(indices.encode_ndvi(F.col("ndvi")), F.lit(0))})


def season_mosaic(pixels: DataFrame) -> DataFrame:
    """(season, y, x, value): highest encoded composite over tiles."""
    dated = pixels.withColumn("season", calendar.season(F.col("day"))).filter("season is not null")
    return max_composite(dated, ["season", "tile", "y", "x"]).groupBy("season", "y", "x").agg(F.max("value").alias("value"))


def first_valid(pixels: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """The bands of the first usable scene of each pixel in order of ``seq``."""
    usable = pixels.filter(~F.col("scl").isin(*indices.CLOUDY_COMPOSITE))
    return usable.groupBy(*keys).agg(F.min_by(F.struct(*bands), F.struct("day", "seq")).alias("b")).select(*keys, "b.*")


def ordered_mosaic(layers: DataFrame) -> DataFrame:
    """(y, x, value): of overlapping chunks the lowest chunk's value that isn't no data."""
    return layers.groupBy("y", "x").agg(F.coalesce(F.min_by("value", F.when(F.col("value") != 0, F.col("chunk"))), F.lit(0)).alias("value"))


def class_counts(pixels: DataFrame) -> DataFrame:
    """Scene pixels that each of the three rules keeps, by tile."""
    scl, red, nir = F.col("scl"), F.col("red"), F.col("nir")
    series = indices.masked_series(scl, indices.ndvi_series(red, nir)).isNotNull()
    mosaic = scl.isin(*indices.CLEAR_MOSAIC) & (red + nir > 0)
    return pixels.groupBy("tile").agg(F.count(F.when(series, 1)).alias("in_series"), F.count(F.when(~scl.isin(*indices.CLOUDY_COMPOSITE), 1)).alias("in_composite"), F.count(F.when(mosaic, 1)).alias("in_mosaic"))


def canopy_density(composite: DataFrame) -> DataFrame:
    """``fcd`` 0 to 255 of composite pixels (chunk, y, x, bands). Greenest, reddest and index range are the chunk's: chunk_id is part of the meaning, not of how Spark deals rows."""
    c = {b: F.col(b).cast("double") / 10000 for b in ("red", "green", "blue", "nir", "swir")}
    rows = composite.select("chunk", "y", "x", *(v.alias(b) for b, v in c.items()))
    rows = rows.withColumns({"ndvi": indices.ndvi_composite(F.col("red"), F.col("nir")), "bsi": indices.bare_soil(F.col("red"), F.col("blue"), F.col("nir"), F.col("swir"))})
    chunk = rows.groupBy("chunk").agg(F.max("green").alias("mg"), F.max("red").alias("mr"), F.max("ndvi").alias("mx"), F.min("ndvi").alias("mn"))
    rows = rows.join(chunk, "chunk")
    shadow = F.sqrt((F.col("mg") - F.col("green")) * (F.col("mr") - F.col("red")))
    density = (F.col("ndvi") - F.col("mn")) / (F.col("mx") - F.col("mn") + F.lit(1e-8))
    scaled = F.sqrt(shadow * F.abs("bsi"))
    fcd = F.floor(F.least(F.lit(255.0), 100 * F.sqrt(density * scaled)))
    return rows.select("chunk", "y", "x", F.coalesce(fcd.cast("int"), F.lit(0)).alias("fcd"))


def classify(layer: DataFrame, state: str, value: str = "value") -> DataFrame:
    return layer.withColumn("class", indices.density_class(F.col(value), indices.thresholds(state)))


def masked(classes: DataFrame, mask: DataFrame) -> DataFrame:
    """(y, x, class): classes where the mask is 1, else 0, joined on whole pixel indices."""
    return classes.join(mask, ["y", "x"]).select("y", "x", F.when(F.col("forest") == 1, F.col("class")).otherwise(0).alias("class"))


def covering_scenes(pixels: DataFrame) -> DataFrame:
    """(chunk, scene, covers): few scenes of which one is clear at every pixel that any is clear at. Greedy: the scene that is clear at most uncovered pixels, the lowest number of equals.

    Pixels that are clear in the same scenes count as one kind, so Spark counts kinds first. Each step needs the one before, so the kinds of a chunk are one group: not more than the
    different sets of clear scenes, and no pixels.
    """

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        out, chunk = [], pdf["chunk"].iloc[0]
        kinds = [(set(s), int(n)) for s, n in zip(pdf["scenes"], pdf["n"])]
        while kinds:
            gain: Counter[int] = Counter()
            for scenes, n in kinds:
                for s in scenes:
                    gain[s] += n
            best = min(gain, key=lambda s: (-gain[s], s))
            out.append((chunk, best, gain[best]))
            kinds = [k for k in kinds if best not in k[0]]
        return pd.DataFrame(out, columns=["chunk", "scene", "covers"])

    sets = pixels.groupBy("chunk", "pixel").agg(F.array_sort(F.collect_set("scene")).alias("scenes"))
    return sets.groupBy("chunk", "scenes").agg(F.count("*").alias("n")).groupBy("chunk").applyInPandas(pick, "chunk long, scene long, covers long")


def by_solar_day(pixels: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """Scenes of one day of a pixel as one: each band's first value that isn't null, in order of ``seq``."""
    first = [F.min_by(b, F.when(F.col(b).isNotNull(), F.col("seq"))).alias(b) for b in bands]
    return pixels.groupBy(*keys, "day").agg(*first)


def annual_cover(slices: DataFrame, year: int, keys: list[str]) -> DataFrame:
    """Land cover of a year that begins in May: the first slice from 1 May on and before the next."""
    own = slices.filter(F.col("day").between(F.make_date(F.lit(year), F.lit(5), F.lit(1)), F.date_sub(F.make_date(F.lit(year + 1), F.lit(5), F.lit(1)), 1)))
    return own.groupBy(*keys).agg(F.min_by("value", "day").alias("value"))


def cloud_free(pixels: DataFrame, bands: list[str]) -> DataFrame:
    """(chunk, pixel, scene, bands): each pixel from the covering scenes that are clear at it, the highest scene number first."""
    clear = pixels.filter(~F.col("scl").isin(*indices.CLOUDY_COMPOSITE))
    chosen = covering_scenes(clear).select("chunk", "scene")
    return clear.join(chosen, ["chunk", "scene"]).groupBy("chunk", "pixel").agg(F.max(F.struct("scene", *bands)).alias("b")).select("chunk", "pixel", "b.*")


def placed(layers: DataFrame, corners: DataFrame) -> DataFrame:
    """(chunk, y, x, value): layers' own rows and columns counted from their chunk's corner (chunk, y0, x0) in the mosaic. Chunks without a corner are an error in the data and leave."""
    return layers.join(corners, "chunk").select("chunk", (F.col("y") + F.col("y0")).cast("int").alias("y"), (F.col("x") + F.col("x0")).cast("int").alias("x"), "value")


def density_product(scenes: DataFrame, forest: DataFrame, corners: DataFrame, width: int, state: str) -> DataFrame:
    """(y, x, class): canopy density from scene pixels (chunk, scene, y, x, scl, bands) to the masked mosaic: the cloud-free composite of each chunk's covering scenes, density by the chunk's
    extrema, chunks placed at their ``corners`` and the lowest chunk first where they overlap, classes by the state's thresholds, 0 where ``forest`` (y, x, forest) isn't 1. Chunks have
    ``width`` columns."""
    bands = ["red", "green", "blue", "nir", "swir"]
    pixels = scenes.select("chunk", "scene", (F.col("y") * width + F.col("x")).cast("long").alias("pixel"), "scl", *bands)
    clear = cloud_free(pixels, bands).select("chunk", F.floor(F.col("pixel") / width).alias("y"), (F.col("pixel") % width).alias("x"), *bands)
    density = canopy_density(clear).withColumnRenamed("fcd", "value")
    return masked(classify(ordered_mosaic(placed(density, corners)), state), forest)
