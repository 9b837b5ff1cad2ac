"""A catalog of scenes as files that are pruned by place and time, searched by geometry, time and property ranges.

Writing: an item is one row, whatever its size. Its class is the finest grid over the earth on which its footprint's box is no larger than a cell, and its place the cell of the box's lower left
corner. Files are by year and block (class and a cell of a coarse grid), in the order of the cells along the Hilbert curve, then of days. In each class a search turns its outline, widened down and
left by a cell of the class, into a few ranges of the curve: no other corner can have a box that meets the outline. Blocks and years prune folders, ranges and days prune row groups of files, and
property ranges reach the scan as well. Nothing is shuffled; footprints are then held against the outline exactly.

Items without a footprint or day can't be found and aren't stored; a footprint beyond the earth's box belongs to the cells at its edge. Equal items are all kept. Property columns are kept as they are;
names that clash with those added here (``verdure_*``) are an error.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.functions import geo

#: Levels of the grids: 2^9 by 2^9 cells of 0.7 by 0.35 degrees, 2^4 by 2^4 blocks.
LEVEL, BLOCK = 9, 4
#: A search asks for at most this many cells of a class, of a coarser grid if need be.
ASKED = 64


def _column_row(x: Column, y: Column, level: int) -> tuple[Column, Column]:
    side = 1 << level
    at = lambda v, low, width: F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor((v - low) / width * side))).cast("int")
    return at(x, -180.0, 360.0), at(y, -90.0, 180.0)


def write_catalog(items: DataFrame, path: str, ring: str = "ring", day: str = "day", level: int = LEVEL, block: int = BLOCK) -> None:
    """The items' files. Ranges of (year, block, cell) are dealt to tasks, so a block with most of the items is many files. ``level`` and ``block`` are parameters of the search as well."""
    if taken := [c for c in items.columns if c.lower().startswith("verdure_")]:
        raise ValueError(f"columns {taken} clash with those of the catalog")
    own = items.columns
    rows = items.filter(F.col(f"`{ring}`").isNotNull() & F.col(f"`{day}`").isNotNull()).select(*(F.col(f"`{c}`") for c in own), *(c.alias(f"verdure_{n}") for n, c in zip(("x0", "y0", "x1", "y1"), geo.box(F.col(f"`{ring}`")))))
    x, y = _column_row(F.col("verdure_x0"), F.col("verdure_y0"), level)
    # held into the earth's box, as corners are; what is larger than a finer grid's cell belongs to a coarser class
    held = lambda c, most: F.least(F.lit(most), F.greatest(F.lit(-most), F.col(c)))
    wide, high = held("verdure_x1", 180.0) - held("verdure_x0", 180.0), held("verdure_y1", 90.0) - held("verdure_y0", 90.0)
    size = sum((F.when((wide <= 360.0 / (1 << n)) & (high <= 180.0 / (1 << n)), 1).otherwise(0) for n in range(1, level + 1)), F.lit(0))
    rows = rows.withColumn("verdure_cell", size.cast("long") * F.lit(1 << 2 * level) + geo.curve_place(x, y, F.lit(level)))
    rows = rows.withColumns({"verdure_year": F.year(F.col(f"`{day}`")), "verdure_block": F.shiftright("verdure_cell", 2 * (level - block))})
    by = ["verdure_year", "verdure_block", "verdure_cell"]
    rows.repartitionByRange(*by).sortWithinPartitions(*by, F.col(f"`{day}`")).write.mode("overwrite").partitionBy(*by[:2]).parquet(path)


def ranges_of(outline: list[tuple[float, float]], level: int = LEVEL, asked: int = ASKED) -> list[tuple[int, int]]:
    """Ranges of places, first and last of each, whose items' boxes may touch the outline's box. A class has at most ``asked`` cells: of its own grid, or of the finest coarser one on which they
    are so few."""
    xs, ys = [min(180.0, max(-180.0, p[0])) for p in outline], [min(90.0, max(-90.0, p[1])) for p in outline]
    out: list[tuple[int, int]] = []
    for size in range(level + 1):
        # a billionth of a degree for the last bits of a box's sides
        low, left = min(ys) - 180 / (1 << size) - 1e-9, min(xs) - 360 / (1 << size) - 1e-9
        for own in range(min(level, size + 1), -1, -1):
            side = 1 << own
            at = lambda v, low, width: min(side - 1, max(0, int((v - low) / width * side // 1)))  # noqa: E731, B023
            a, b, c, d = at(left, -180, 360), at(max(xs), -180, 360), at(low, -90, 180), at(max(ys), -90, 180)
            if (b - a + 1) * (d - c + 1) <= asked or own == 0:
                break
        finer, base = 2 * (level - own), size << 2 * level
        for p in sorted(geo.place_of(x, y, own) for x in range(a, b + 1) for y in range(c, d + 1)):
            first, last = base + (p << finer), base + (p + 1 << finer) - 1
            if out and out[-1][1] + 1 == first:
                out[-1] = (out[-1][0], last)
            else:
                out.append((first, last))
    return out


def search(spark: SparkSession, path: str, outline: list[tuple[float, float]], days: tuple[date, date], limits: dict[str, tuple[float | None, float | None]] | None = None, ring: str = "ring", day: str = "day", level: int = LEVEL, block: int = BLOCK, asked: int = ASKED) -> DataFrame:
    """The items, as they were stored, whose footprint has a point in common with the outline, of a day from the first to the last, and with ``limits`` (column: from, below), either end open as
    None; a null property is in no range."""
    rows = spark.read.parquet(path)
    own = [c for c in rows.columns if not c.startswith("verdure_")]
    spans = ranges_of(outline, level, asked)
    blocks = sorted({b for a, e in spans for b in range(a >> 2 * (level - block), (e >> 2 * (level - block)) + 1)})
    inside = lambda c: _any([c.between(a, e) for a, e in spans])
    rows = rows.filter(F.col("verdure_year").between(days[0].year, days[1].year) & F.col("verdure_block").isin(blocks))
    rows = rows.filter(inside(F.col("verdure_cell"))).filter(F.col(f"`{day}`").between(F.lit(days[0]), F.lit(days[1])))
    for c, (low, below) in (limits or {}).items():
        rows = rows if low is None else rows.filter(F.col(f"`{c}`") >= low)
        rows = rows if below is None else rows.filter(F.col(f"`{c}`") < below)
    xs, ys = [p[0] for p in outline], [p[1] for p in outline]
    rows = rows.filter((F.col("verdure_x0") <= max(xs)) & (F.col("verdure_x1") >= min(xs)) & (F.col("verdure_y0") <= max(ys)) & (F.col("verdure_y1") >= min(ys)))
    shape = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in outline))
    return rows.filter(geo.rings_meet(F.col(f"`{ring}`"), shape)).select(*(F.col(f"`{c}`") for c in own))


def _any(tests: list[Column]) -> Column:
    """Whether one of the tests holds, as a balanced tree."""
    while len(tests) > 1:
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]
