"""Rainfall, groundwater and soil moisture by region and fortnight."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.fixtures import PERIODS
from verdure.functions import calendar, exact, geo


def valid_rain(rain: DataFrame) -> DataFrame:
    """Negative rainfall and NaN are missing."""
    return rain.withColumn("rainfall", F.when((F.col("rainfall") >= 0) & ~F.isnan("rainfall"), F.col("rainfall")))


def grid_regions(rain: DataFrame, regions: DataFrame) -> DataFrame:
    """(iy, ix, region): the grid nodes in each range; the grid doesn't move, so nodes are placed once and rainfall follows by an equi-join."""
    nodes = rain.select("iy", "ix", "lat", "lon").distinct()
    ranges = regions.filter("type = 'range'").select(F.col("code").alias("region"), "ring")
    return geo.within(nodes, ranges, "lon", "lat", ["region"]).select("iy", "ix", "region")


def rain_by_region_day(rain: DataFrame, regions: DataFrame) -> DataFrame:
    """(region, time, rainfall, n): mean of the nodes in a region, missing ones left out, and the number of all."""
    rows = valid_rain(rain).join(grid_regions(rain, regions), ["iy", "ix"])
    return rows.groupBy("region", "time").agg(exact.mean(F.col("rainfall")).alias("rainfall"), F.count("*").alias("n"), F.count(F.when(F.col("rainfall").isNull(), 1)).alias("missing"))


def rain_by_fortnight(daily: DataFrame) -> DataFrame:
    """(region, label, total): daily means added up over a fortnight."""
    label = calendar.dated_label("average_rainfall", F.col("time"))
    return daily.groupBy("region", label.alias("label")).agg(exact.half_up(exact.total(F.col("rainfall")), 2).alias("total"))


def missing_days(daily: DataFrame) -> DataFrame:
    return daily.filter("missing > 0").select("region", "time", "n", "missing")


def anomalies(rain: DataFrame) -> DataFrame:
    return rain.filter("rainfall < 0 or rainfall > 1000")


def rain_summary(daily: DataFrame) -> DataFrame:
    return daily.agg(F.countDistinct("region").alias("regions"), F.count("*").alias("n_rows"), F.min("time").alias("first_day"), F.max("time").alias("last_day"))


def daily_normals(daily: DataFrame, as_of: str, years: int = 30) -> DataFrame:
    """(code, month, day, normal): mean over the years before ``as_of`` by day of the year; 29 February is a day of its own."""
    recent = daily.filter((F.col("date") >= F.date_sub(F.to_date(F.lit(as_of)), years * 365)) & F.col("value").isNotNull())
    return recent.groupBy("code", F.month("date").alias("month"), F.dayofmonth("date").alias("day")).agg(exact.mean(F.col("value")).alias("normal"))


def fortnight_normals(normals: DataFrame, codes: DataFrame) -> DataFrame:
    """(code, label, total, n_days) for every code, month and fortnight; fortnights without days have total 0."""
    grid = codes.select("code", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("fn"))
    sums = normals.groupBy("code", "month", F.when(F.col("day") <= 15, 1).otherwise(2).alias("fn")).agg(exact.total(F.col("normal")).alias("s"), F.count("*").alias("d"))
    label = F.format_string("normal_rainfall_%s_fn%d", calendar.month_name(F.col("month")), F.col("fn"))
    return grid.join(sums, ["code", "month", "fn"], "left").select("code", label.alias("label"), exact.half_up(F.coalesce("s", F.lit(0.0)), 2).alias("total"), F.coalesce("d", F.lit(0)).cast("long").alias("n_days"))


def well_depths(wells: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(well_id, longitude, latitude, keep, year, period, depth) of the state's wells: 'dry' is 0, 'na' and what isn't a number is null."""
    ids = ["well_id", "longitude", "latitude", *keep]
    state = wells.filter(F.col("state_name_with_lgd_code").ilike("rajasthan%"))
    long = state.unpivot(ids, PERIODS, "column_name", "raw").filter("raw is not null")
    raw = F.lower(F.trim("raw"))
    depth = F.when(raw == "dry", 0.0).when(raw == "na", None).otherwise(F.expr("try_cast(raw as double)"))
    return long.select(*ids, F.regexp_extract("column_name", r"\d{4}", 0).cast("int").alias("year"), F.when(F.col("column_name").ilike("premonsoon_%"), "pre").otherwise("post").alias("period"), depth.alias("depth"))


def depth_by_region(wells: DataFrame, regions: DataFrame) -> DataFrame:
    """(name, year, period, depth, n): mean depth of the wells in ranges of one name. Each well is placed once, then its periods become rows."""
    ranges = regions.filter("type = 'range'").select("name", "ring")
    placed = geo.within(wells, ranges, "longitude", "latitude", ["name"])
    return well_depths(placed, ("name",)).filter("depth is not null").groupBy("name", "year", "period").agg(exact.mean(F.col("depth")).alias("depth"), F.count("*").alias("n"))


def groundwater_fortnights(daily: DataFrame, scale: float = 0.1) -> DataFrame:
    """(code, year, month, fn, label, value, start_date, end_date)."""
    d = F.col("date")
    keys = [F.year(d).alias("year"), F.month(d).alias("month"), calendar.fortnight(d).alias("fn"), calendar.dated_label("groundwater_trend", d, long=True).alias("label")]
    dated = daily.withColumns({"s": calendar.fortnight_start(d), "e": calendar.fortnight_end(d)})
    return dated.groupBy("code", *keys).agg(exact.mean(F.col("value") * scale).alias("value"), F.min("s").alias("start_date"), F.max("e").alias("end_date"))


def _known(values: DataFrame, weights: DataFrame) -> DataFrame:
    return weights.join(values.filter("value is not null and not isnan(value)"), "cell")


def zonal_mean(values: DataFrame, weights: DataFrame, by: list[str]) -> DataFrame:
    """(code, by, mean): coverage-weighted mean of the cells that have a value (not null, not NaN)."""
    c = F.col("c")
    return _known(values, weights).groupBy("code", *by).agg((exact.total(c * F.col("value")) / F.nullif(exact.total(c), F.lit(0.0))).alias("mean"))


def self_weighted_mean(values: DataFrame, weights: DataFrame, by: list[str]) -> DataFrame:
    """The same with each value as a further weight."""
    v, c = F.col("value"), F.col("c")
    return _known(values, weights).groupBy("code", *by).agg((exact.total(c * v * v) / F.nullif(exact.total(c * v), F.lit(0.0))).alias("mean"))


def soil_moisture(values: DataFrame, weights: DataFrame) -> DataFrame:
    """(code, label, value): percent by region and fortnight band."""
    b = F.col("band")
    label = F.format_string("soil_moisture_%d_%s_fn%d", F.col("year"), calendar.month_name(calendar.band_month(b), long=True), calendar.band_fortnight(b))
    return zonal_mean(values, weights, ["year", "band"]).filter("mean is not null").select("code", label.alias("label"), exact.half_up(F.col("mean") * 100, 2).alias("value"))
