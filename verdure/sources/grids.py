"""Gridded files as rows: binary grids, long cubes, GeoJSON and tile lists."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the rainfall grid: 129 latitudes from 6.5, 135 longitudes from 66.5, 0.25 degrees apart.
ROWS, COLUMNS, SOUTH, WEST, STEP = 129, 135, 6.5, 66.5, 0.25


def read_grd(spark: SparkSession, path: str, date_pattern: str = r"(\d{8})") -> DataFrame:
    """(time, iy, ix, lat, lon, rainfall) of binary grids of little-endian 32-bit floats, a file for each day; the date is in the file name. Coordinates come from the index;
    negative values and NaN are null. A file of another size is an error."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        iy, ix = (a.ravel().astype(np.int32) for a in np.indices((ROWS, COLUMNS)))
        for b in batches:
            for day, content in zip(b["day"], b["content"]):
                v = np.frombuffer(content, "<f4")
                if len(v) != ROWS * COLUMNS:
                    raise ValueError(f"grid of {day} holds {len(v)} values, not {ROWS * COLUMNS}")
                v = v.astype(np.float64)
                yield pd.DataFrame({"day": day, "iy": iy, "ix": ix, "rainfall": np.where(v >= 0, v, np.nan)})

    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", date_pattern + r"[^/]*$", 1).alias("day"), "content")
    rows = files.mapInPandas(decode, "day string, iy int, ix int, rainfall double")
    return rows.select(F.to_date("day", "yyyyMMdd").alias("time"), "iy", "ix", (F.lit(SOUTH) + F.col("iy") * STEP).alias("lat"), (F.lit(WEST) + F.col("ix") * STEP).alias("lon"), F.nullif(F.col("rainfall"), F.lit(float("nan"))).alias("rainfall"))


def prefer(*sources: DataFrame, key: str = "time") -> DataFrame:
    """Rows of the first source that has any for a key: of a day the one file format that comes first."""
    ranked = None
    for n, s in enumerate(sources):
        one = s.withColumn("source_rank", F.lit(n))
        ranked = one if ranked is None else ranked.unionByName(one)
    best = ranked.groupBy(key).agg(F.min("source_rank").alias("best"))
    return ranked.join(best, key).filter("source_rank = best").drop("source_rank", "best")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties, ring): the outer ring of each polygon feature, and of a MultiPolygon its largest part's."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.option("multiLine", True).schema(schema).json(path).select(F.explode("features").alias("f")).select("f.*")
    return rows.select("properties", _ring(F.col("geometry")).alias("ring"))


def read_tiles(spark: SparkSession, path: str) -> DataFrame:
    """(name, ring) of newline-delimited features; blank lines are skipped."""
    schema = "properties map<string,string>, geometry struct<type:string,coordinates:string>"
    return spark.read.schema(schema).json(path).filter("geometry is not null").select(F.col("properties")["Name"].alias("name"), _ring(F.col("geometry")).alias("ring"))


def area(ring: Column) -> Column:
    """Twice the area that a ring encloses."""
    n = F.size(ring)
    cross = lambda s, i: s + F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"]
    return F.abs(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), cross))


def _ring(geometry: Column) -> Column:
    polygon = F.array(F.from_json(geometry["coordinates"], "array<array<array<double>>>"))
    parts = F.when(geometry["type"] == "MultiPolygon", F.from_json(geometry["coordinates"], "array<array<array<array<double>>>>")).otherwise(polygon)
    rings = F.transform(parts, lambda p: F.transform(F.get(p, F.lit(0)), lambda c: F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y"))))
    return F.array_max(F.transform(rings, lambda r: F.struct(area(r).alias("a"), r.alias("r"))))["r"]


def dated_files(spark: SparkSession, path: str, pattern: str, date_format: str = "yyyyMMdd", since: str | None = None) -> DataFrame:
    """(path, date, length) of files whose name holds a date, from ``since`` on, by date and path; contents aren't read."""
    files = spark.read.format("binaryFile").load(path).select("path", F.to_date(F.nullif(F.regexp_extract("path", pattern, 1), F.lit("")), date_format).alias("date"), "length")
    files = files.filter("date is not null")
    files = files if since is None else files.filter(F.col("date") >= F.to_date(F.lit(since)))
    return files.orderBy("date", "path")


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that a manifest of earlier loads doesn't have: loading again does nothing."""
    return files.join(manifest.select("path"), "path", "left_anti")


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns text, names in lower case with runs of anything but letters and digits as one underscore."""
    df = spark.read.option("header", True).csv(path)
    clean = [re.sub(r"[^0-9a-z]+", "_", c.strip().lower()).strip("_") for c in df.columns]
    return df.toDF(*(c if clean[:n].count(c) == 0 else f"{c}_{clean[:n].count(c)}" for n, c in enumerate(clean)))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha1): names for cached results by the content that they were made from."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha1("content").alias("sha1"))


def georeferenced(layers: DataFrame) -> DataFrame:
    """Layers whose metadata has a reference system and a transform with pixels of some size."""
    return layers.filter("crs is not null and crs <> '' and pixel_width <> 0 and pixel_height <> 0")
