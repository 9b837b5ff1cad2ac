"""Vegetation indices and their encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scene classes of each rule.
CLOUDY_SERIES = (8, 9, 10)  # scene classes left out of pixel series
CLOUDY_COMPOSITE = (0, 3, 8, 9, 10)  # and of composites
CLEAR_MOSAIC = (4, 5, 6)  # those that count in mosaics


def ndvi(red: Column, nir: Column) -> Column:
    """Null where red and nir add up to nothing."""
    red, nir = red.cast("double"), nir.cast("double")
    return F.when(red + nir > 0, (nir - red) / (nir + red))


def ndvi_series(red: Column, nir: Column) -> Column:
    return (nir.cast("double") - red) / (nir.cast("double") + red + F.lit(1e-3))


def ndvi_composite(red: Column, nir: Column) -> Column:
    return (nir.cast("double") - red) / (nir.cast("double") + red + F.lit(1e-8))


def masked_series(scl: Column, value: Column) -> Column:
    return F.when(~scl.isin(*CLOUDY_SERIES) & (value != 0), value)


def bare_soil(red: Column, blue: Column, nir: Column, swir: Column) -> Column:
    return ((swir + blue) - (nir + red)) / ((swir + blue) + (nir + red) + F.lit(1e-8))


def encode_ndvi(value: Column) -> Column:
    """0 to 200 in whole numbers; 0 is also no data."""
    return F.floor(F.least(F.lit(200.0), F.greatest(F.lit(0.0), (value + 1) * 100))).cast("int")


def density_class(fcd: Column, thresholds: dict[str, tuple[int, int]]) -> Column:
    """0 to 4 by (lower, upper] thresholds."""
    t = thresholds
    return (
        F.when(fcd > t["high_density"][0], 4)
        .when((fcd > t["medium_density"][0]) & (fcd <= t["medium_density"][1]), 3)
        .when((fcd > t["low_density"][0]) & (fcd <= t["low_density"][1]), 2)
        .when((fcd > 0) & (fcd <= t["open_forest"][1]), 1)
        .otherwise(0)
    )


#: Lower and upper threshold of each class by state.
THRESHOLDS = {"RJ": {"open_forest": (0, 25), "low_density": (25, 50), "medium_density": (50, 75), "high_density": (75, 100)}}


def thresholds(state: str) -> dict[str, tuple[int, int]]:
    if state not in THRESHOLDS:
        raise ValueError(f"no density thresholds for state {state!r}")
    return THRESHOLDS[state]
