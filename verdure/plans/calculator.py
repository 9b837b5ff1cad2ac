"""Carbon of a set of species, kept as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from verdure.operators import carbon


class Calculator:
    """Species rows in the shape that ``carbon`` reads; each change gives a new calculator. Without ``volume`` each species has its own formula."""

    def __init__(self, species: DataFrame, volume: str | None = None):
        self.species, self.volume = species, volume

    def add(self, more: DataFrame) -> Calculator:
        return Calculator(self.species.unionByName(more), self.volume)

    def remove(self, name: str) -> Calculator:
        return Calculator(self.species.filter(~self.species["name"].eqNullSafe(name)), self.volume)

    def sequestration(self, survival: tuple[int, ...] = (60,), horizon: int = 30) -> DataFrame:
        return carbon.deltas(self.species, horizon, survival, self.volume)

    def cumulative(self, survival: int = 60) -> DataFrame:
        return carbon.cumulative(self.sequestration((survival,)))

    def chart(self, survival: tuple[int, ...] = (40, 60, 80, 100), years: list[int] | None = None) -> DataFrame:
        rows = carbon.survival_chart(self.sequestration(survival))
        return rows if years is None else carbon.of_years(rows, years)

    def co2(self, name: str, year: int, survival: float) -> DataFrame:
        return carbon.at_year(self.species.filter(self.species["name"] == name), year, survival, self.volume)

    def co2_per_hectare(self, name: str, area: float, year: int, survival: float) -> DataFrame:
        return carbon.per_hectare(self.species.filter(self.species["name"] == name), area, year, survival, self.volume)
