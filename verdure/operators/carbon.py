"""Plantation carbon: stocks under growth, survival and harvest, by period."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions import calendar, exact, formula

#: Fixed default of a blank CO2 factor.
CO2_FACTOR = 3.67
PREFIX = r"^\s*[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"


def number(c: Column, default: float = 0.0) -> Column:
    """The number a text begins with, or the default."""
    return F.coalesce(F.trim(F.regexp_extract(c, PREFIX, 0)).try_cast("double"), F.lit(default))


def tree_volume(d: Column, volume: str | None) -> Column:
    """Volume at a diameter by one formula for all, or, without one, by each row's ``formula``; 0 without growth."""
    return F.when(d > 0, formula.parse(volume, d) if volume else formula.evaluate(F.col("formula"), d)).otherwise(F.lit(0.0))


#: A species' factors, which come as texts, and what a blank one stands for.
FACTORS = {"increment": 0.0, "wood_density": 0.0, "root_shoot": 0.0, "bef": 0.0, "carbon_fraction": 0.0, "co2_factor": CO2_FACTOR}


def stock_per_tree(months: Column, survival: Column, volume: str | None) -> Column:
    """kg of CO2 in a tree of this age: diameter, volume, biomass above and below ground and in branches, carbon, CO2."""
    return _stock(months, survival, volume, lambda c: number(F.col(c), FACTORS[c]))


def _stock(months: Column, survival: Column, volume: str | None, factor: Callable[[str], Column]) -> Column:
    above = tree_volume(factor("increment") * months / 12, volume) * factor("wood_density")
    biomass = above + above * factor("root_shoot") + above * factor("bef")
    return biomass * factor("carbon_fraction") * survival / 100 * factor("co2_factor")


def at_year(species: DataFrame, year: int, survival: float, volume: str | None = None) -> DataFrame:
    """(id, co2): kg for all trees."""
    return species.select("id", (stock_per_tree(F.lit(12.0 * year), F.lit(survival), volume) * F.col("num_trees")).alias("co2"))


def per_hectare(species: DataFrame, area: float, year: int, survival: float, volume: str | None = None) -> DataFrame:
    """(id, tonnes_per_ha)."""
    return at_year(species, year, survival, volume).select("id", (F.col("co2") / 1000 / area).alias("tonnes_per_ha"))


def periods(species: DataFrame, horizon: int = 30) -> DataFrame:
    """(no, start, end, label): from the month after the earliest planting to the year's end, whole years, and the part that completes the horizon. End is exclusive."""
    first = species.agg(F.min(F.make_date("plant_year", "plant_month", F.lit(1))).alias("p"))
    first = first.select(F.add_months("p", 1).alias("begin"), F.add_months("p", 12 * horizon + 1).alias("finish"))
    years = F.sequence(F.year("begin"), F.year("finish"))
    rows = first.select("*", F.explode(years).alias("y")).select(
        F.greatest("begin", F.make_date("y", F.lit(1), F.lit(1))).alias("start"), F.least("finish", F.make_date(F.col("y") + 1, F.lit(1), F.lit(1))).alias("end")
    )
    name = lambda d: F.concat(F.initcap(calendar.month_name(F.month(d))), F.lit(" "), F.year(d).cast("string"))
    return rows.filter("start < end").select(
        F.row_number().over(Window.orderBy("start")).alias("no"), "start", "end", F.concat(name(F.col("start")), F.lit("-"), name(F.date_sub("end", 1))).alias("label")
    )


def deltas(species: DataFrame, horizon: int = 30, survival: tuple[int, ...] = (60,), volume: str | None = None) -> DataFrame:
    """(id, name, survival, no, label, months, stock, delta, harvested): kg of CO2 gained in each period, to the first harvest. Species without a planting date have no rows.

    All dates are firsts of months, so a row's months, those before it, and whether it is harvested or comes after a harvest follow from its own period. Species are dealt over the tasks before
    they get a row for each period; those rows are neither sorted nor shuffled. Each row of ``species`` counts by itself, whatever its id.
    """
    planted = species.filter("plant_year is not null and plant_month is not null").withColumn("grown_from", F.add_months(F.make_date("plant_year", "plant_month", F.lit(1)), 1))
    own = ["id", "name", "num_trees", "harvest_cycle", "retention", "grown_from", *([] if volume else ["formula"])]
    dealt = planted.select(*own, *(number(F.col(c), d).alias(c) for c, d in FACTORS.items())).repartition(int(species.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    rows = dealt.join(F.broadcast(periods(planted, horizon)), F.col("end") > F.col("grown_from"))  # horizon + 1 periods
    since = lambda d: F.months_between(d, "grown_from").cast("long")
    rows = rows.withColumn("months", since(F.col("end"))).withColumn("before", since(F.greatest("start", "grown_from")))
    cycle = F.col("harvest_cycle")
    cycles = lambda m: F.floor(F.col(m) / 12 / cycle)
    rows = rows.filter(~F.coalesce((cycle > 0) & (cycles("before") > 0), F.lit(False)))  # a harvest in an earlier period
    rows = rows.withColumn("harvested", F.coalesce((cycle > 0) & (cycles("months") > 0), F.lit(False)))
    age = F.when(F.col("harvested"), cycle * 12).otherwise(F.col("months"))
    left = F.when(F.col("harvested"), F.coalesce("retention", F.lit(0.0)) / 100).otherwise(1.0)
    full = lambda m: _stock(m.cast("double"), F.lit(100.0), volume, lambda c: F.col(c)) * F.col("num_trees")
    rows = rows.withColumn("full", full(age) * left).withColumn("gained", F.col("full") - F.coalesce(full(F.col("before")), F.lit(0.0)))
    rows = rows.withColumn("survival", F.explode(F.array(*map(F.lit, survival))))  # stocks are in proportion to the rate
    part = lambda c: (F.col(c) * F.col("survival") / 100).alias({"full": "stock", "gained": "delta"}[c])
    return rows.select("id", "name", "survival", "no", "label", "months", part("full"), part("gained"), "harvested")


TOTAL = "Total"


def annual(delta: DataFrame) -> DataFrame:
    """(name, no, label, annual) in millions of kg of each species and of all as ``Total``, in one pass."""
    rows = delta.select(F.explode(F.array("name", F.lit(TOTAL))).alias("name"), "no", "label", "delta")
    return rows.groupBy("name", "no", "label").agg((exact.total(F.col("delta")) / 1e6).alias("annual"))


def cumulative(delta: DataFrame) -> DataFrame:
    """(name, no, annual, running) in millions of kg, with the series ``Total``; a species that ended keeps its sum in later periods."""
    sums = annual(delta).drop("label")
    names = sums.groupBy("name").agg(F.max("no").alias("own")).withColumn("last", F.max("own").over(Window.partitionBy(F.lit(1))))  # a row for each species
    grid = names.select("name", F.explode(F.sequence(F.lit(1), F.col("last"))).alias("no"))
    rows = grid.join(sums, ["name", "no"], "left").withColumn("annual", F.coalesce("annual", F.lit(0.0)))
    return rows.withColumn("running", F.sum("annual").over(Window.partitionBy("name").orderBy("no")))


def pivot_total(delta: DataFrame, names: list[str]) -> DataFrame:
    """(no, label, a column for each name, total): total is that of all species, named or not."""
    wide = annual(delta).groupBy("no", "label").pivot("name", [*names, TOTAL]).agg(F.sum("annual"))
    return wide.select("no", "label", *(F.coalesce(F.col(f"`{n}`"), F.lit(0.0)).alias(n) for n in names), F.coalesce(F.col(TOTAL), F.lit(0.0)).alias("total"))


def survival_chart(delta: DataFrame) -> DataFrame:
    """(survival, year, label, co2): running total in kg over all species."""
    sums = delta.groupBy("survival", "no", "label").agg(exact.total(F.col("delta")).alias("d"))
    return sums.select("survival", F.col("no").alias("year"), "label", F.sum("d").over(Window.partitionBy("survival").orderBy("no")).alias("co2"))


def of_years(chart: DataFrame, years: list[int]) -> DataFrame:
    """The chart's rows for the asked years; years past the end get the last one."""
    last = chart.agg(F.max("year").alias("last"))
    asked = last.select(F.explode(F.array(*map(F.lit, years))).alias("asked"), "last").select("asked", F.least("asked", "last").alias("year"))
    return chart.join(asked, "year").select("survival", "asked", "year", "label", "co2")


def species_breakdown(delta: DataFrame) -> DataFrame:
    """(species_index, name, year, label, co2, last_period_co2) in millions of kg: each species' own sum in every period, 0 where it has none; species are numbered from 0 in the order of their
    first id. ``last_period_co2`` is the sum over all species in the last period, the figure of the current year. No name means anything here, ``Total`` neither."""
    sums = delta.groupBy("name", "no").agg((exact.total(F.col("delta")) / 1e6).alias("own"))
    names = delta.groupBy("name").agg(F.min("id").alias("first")).select("name", (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("first")) - 1).alias("species_index"))  # a row for each species
    periods_ = delta.groupBy("no", "label").agg((exact.total(F.col("delta")) / 1e6).alias("all"))
    last = periods_.agg(F.max_by("all", "no").alias("last_period_co2"), F.collect_list(F.struct("no", "label")).alias("periods"))  # one row, as many entries as periods
    grid = names.join(F.broadcast(last)).select("species_index", "name", "last_period_co2", F.inline("periods"))
    return grid.join(sums, ["name", "no"], "left").select("species_index", "name", F.col("no").alias("year"), "label", F.coalesce("own", F.lit(0.0)).alias("co2"), "last_period_co2")
