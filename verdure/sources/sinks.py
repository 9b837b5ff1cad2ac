"""Writing results: layers by tile, CSV and GeoJSON by period, script files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_layer(layer: DataFrame, path: str, by: list[str]) -> None:
    """A raster layer as Parquet, partitioned by tile or season, sorted by row and column inside."""
    layer.repartition(*by).sortWithinPartitions(*by, "y", "x").write.mode("overwrite").partitionBy(*by).parquet(path)


def write_periods(rows: DataFrame, path: str, kind: str = "csv") -> None:
    """One folder for each year and period, as CSV with a header, as JSON lines, or, of rows with a ring, as GeoJSON features, one a line."""
    if kind == "geojson":
        rows = features(rows.withColumns({"_year": F.col("year"), "_period": F.col("period")}), keep={"_year": "year", "_period": "period"})
        rows.repartition("year", "period").write.mode("overwrite").partitionBy("year", "period").text(path)
        return
    w = rows.repartition("year", "period").write.mode("overwrite").partitionBy("year", "period")
    w.option("header", True).csv(path) if kind == "csv" else w.json(path)


def features(rows: DataFrame, ring: str = "ring", keep: dict[str, str] | None = None) -> DataFrame:
    """(feature): each row as a GeoJSON feature with its other columns as properties; the ring is closed. Columns in ``keep`` are no properties; they stay as columns of these names."""
    keep = keep or {}
    point = lambda p: F.array(p["x"], p["y"])
    coords = F.array(F.concat(F.transform(ring, point), F.array(point(F.get(F.col(ring), F.lit(0))))))
    geometry = F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates"))
    others = F.struct(*(F.col(f"`{c}`") for c in rows.columns if c != ring and c not in keep))
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), others.alias("properties"), F.when(F.col(ring).isNotNull(), geometry).alias("geometry")), {"ignoreNullFields": "false"}).alias("feature"), *(F.col(c).alias(n) for c, n in keep.items()))


def replace_table(rows: DataFrame, table: str) -> None:
    """The table's rows are these, whatever was there."""
    rows.write.mode("overwrite").saveAsTable(table)


def write_script(statements: DataFrame, path: str) -> None:
    statements.select("statement").write.mode("overwrite").text(path)


def write_ordered(rows: DataFrame, path: str, by: list[str], kind: str = "csv") -> None:
    """Rows in order: files in the order of their names are ranges of ``by``, and each is sorted. Rows of equal ``by`` are together, in any order."""
    w = rows.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite")
    w.option("header", True).csv(path) if kind == "csv" else w.format(kind).save(path)
