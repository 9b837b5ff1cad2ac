"""Choosing satellite scenes by footprint coverage."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdure.functions import geo, overlay
from verdure.session import written

#: Cloud limits in the order they are tried; the coverage that is accepted, that is good, and that another scene has to add.
LADDER = (20, 40, 60, 80, 100)
ACCEPT, GOOD, GAIN = 0.60, 0.95, 0.05


def tile_of(items: DataFrame) -> DataFrame:
    return items.withColumn("tile", F.split("id", "_").getItem(1))


def with_coverage(items: DataFrame, x0: float = 0.0, y0: float = 0.0, x1: float = 1.0, y1: float = 1.0) -> DataFrame:
    """The share of the tile (a unit box unless given) that the footprint box covers."""
    rows = tile_of(items).withColumns({"tx0": F.lit(x0), "tx1": F.lit(x1), "ty0": F.lit(y0), "ty1": F.lit(y1)})
    area = geo.overlap(("fx0", "fx1"), ("tx0", "tx1")) * geo.overlap(("fy0", "fy1"), ("ty0", "ty1"))
    return rows.withColumn("coverage", area / ((x1 - x0) * (y1 - y0))).drop("tx0", "tx1", "ty0", "ty1")


def primary(items: DataFrame, degraded: float = 5.0) -> DataFrame:
    """(tile, seq, coverage): with growing cloud limits, in catalog order, the scene that first covers over 60 %, or else the first of the best coverage."""
    rungs = F.explode(F.filter(F.array(*map(F.lit, LADDER)), lambda t: F.col("cloud") < t))
    rows = with_coverage(items).filter(F.col("degraded") < degraded).filter("coverage > 0").withColumn("rung", rungs)
    at = F.struct("rung", "seq")
    passing = F.min(F.when(F.col("coverage") > ACCEPT, F.struct(at.alias("at"), F.col("seq").alias("seq"), F.col("coverage").alias("coverage"))))
    # the best so far is replaced by strictly more only: of equal coverage the first
    best = F.min(F.struct((-F.col("coverage")).alias("less"), at.alias("at"), F.col("seq").alias("seq"), F.col("coverage").alias("coverage")))
    picked = rows.groupBy("tile").agg(passing.alias("p"), best.alias("b"))
    return picked.select("tile", F.coalesce(F.col("p.seq"), F.col("b.seq")).alias("seq"), F.coalesce(F.col("p.coverage"), F.col("b.coverage")).alias("coverage"))


def complement(items: DataFrame, chosen: DataFrame, cumulative: bool = False, grid: int = 50) -> DataFrame:
    """(tile, seq, place, coverage): scenes added to tiles between 60 and 95 %: in catalog order each that raises the coverage by over 5 points, until 95 % is passed.

    Coverage of several footprints is counted on a grid of ``grid`` by ``grid`` points. Each scene is measured against the first one alone, or, ``cumulative``, against all chosen. The order
    matters, so a tile's scenes are one group. Of equal footprints of a tile only the first in the order can raise the coverage, so the others leave before: a group has a row for each different footprint.
    """
    first = with_coverage(items).join(chosen.select("tile", F.col("seq").alias("first"), F.col("coverage").alias("start")), "tile").filter((F.col("start") > ACCEPT) & (F.col("start") <= GOOD))

    first = first.groupBy("tile", "fx0", "fx1", "fy0", "fy1").agg(F.min("seq").alias("seq"), F.max(F.col("seq") == F.col("first")).alias("is_first"))

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        centres = [(i + 0.5) / grid for i in range(grid)]
        points = lambda r: {(x, y) for x in centres if r.fx0 <= x < r.fx1 for y in centres if r.fy0 <= y < r.fy1}
        rows = sorted(pdf.itertuples(), key=lambda r: r.seq)
        covered = points(next(r for r in rows if r.is_first))
        best, out = len(covered) / grid**2, []
        for r in rows:
            union = covered | points(r)
            share = len(union) / grid**2
            if share > best + GAIN:
                out.append((r.tile, r.seq, len(out) + 1, share))
                best = share
                covered = union if cumulative else covered
            if best > GOOD:
                break
        return pd.DataFrame(out, columns=["tile", "seq", "place", "coverage"])

    return first.groupBy("tile").applyInPandas(pick, "tile string, seq long, place long, coverage double")


def best_candidate(items: DataFrame, chosen: DataFrame, limits: tuple[float, ...] = (20.0, 50.0)) -> DataFrame:
    """(tile, seq, coverage, cloud): the best further scene for what each tile's chosen scene leaves uncovered: of the scenes with at least nine tenths of the best coverage of that area the
    least cloudy. ``chosen`` has one scene (tile, seq) for each tile, which is no candidate. The second cloud limit is tried where the first gives no candidate."""
    rows = with_coverage(items)
    first = rows.join(chosen.select("tile", "seq"), ["tile", "seq"]).select("tile", F.col("seq").alias("own"), *(F.col(c).alias(f"c{c}") for c in ("fx0", "fx1", "fy0", "fy1")), F.col("coverage").alias("had"))
    side = lambda a: F.greatest(F.lit(0.0), F.least(F.col(f"f{a}1"), F.col(f"cf{a}1"), F.lit(1.0)) - F.greatest(F.col(f"f{a}0"), F.col(f"cf{a}0"), F.lit(0.0)))
    gain = (F.col("coverage") - side("x") * side("y")) / (1 - F.col("had"))
    rows = rows.join(first.filter("had < 1"), "tile").filter((F.col("seq") != F.col("own")) & (F.col("cloud") < limits[-1])).withColumn("gain", gain).filter("gain > 1e-9")
    tier = sum((F.when(F.col("cloud") >= x, 1).otherwise(0) for x in limits[:-1]), F.lit(0))
    tile = Window.partitionBy("tile")
    rows = rows.withColumn("tier", tier).withColumn("lowest", F.min("tier").over(tile)).filter("tier = lowest").withColumn("most", F.max("gain").over(tile))
    best = F.min_by(F.struct("seq", F.col("gain").alias("coverage"), "cloud"), F.struct("cloud", "seq"))
    return rows.filter("gain >= 0.9 * most").groupBy("tile").agg(best.alias("b")).select("tile", "b.*")


def two_tier(items: DataFrame, limits: tuple[float, ...] = (20.0, 50.0), degraded: float = 2.0) -> DataFrame:
    """Scenes under the first cloud limit of each tile that has any."""
    rows = tile_of(items).filter((F.col("degraded") < degraded) & (F.col("cloud") < limits[-1]))
    tier = F.when(F.col("cloud") < limits[0], 0).otherwise(1)
    return rows.withColumn("tier", tier).withColumn("first_tier", F.min("tier").over(Window.partitionBy("tile"))).filter("tier = first_tier").drop("first_tier")


def coverage_buckets(chosen: DataFrame) -> DataFrame:
    c = F.col("coverage")
    bucket = F.when(c >= 0.95, "95-100%").when(c >= 0.80, "80-95%").when(c >= 0.60, "60-80%").otherwise("<60%")
    return chosen.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("tiles"))


def complete_pairs(files: DataFrame) -> DataFrame:
    """(tile, date, bands, complete): whether red and nir of a tile and date are both there."""
    p = F.split("file", "-")
    rows = files.select(p.getItem(1).alias("tile"), p.getItem(2).alias("date"), p.getItem(3).alias("band"))
    bands = F.collect_set("band")
    return rows.groupBy("tile", "date").agg(F.size(bands).alias("bands"), (F.array_contains(bands, "red") & F.array_contains(bands, "nir")).alias("complete"))


def tiles_left(wanted: DataFrame, found: DataFrame) -> DataFrame:
    return wanted.select("tile").distinct().join(found.select("tile"), "tile", "left_anti")


def accepted(items: DataFrame, best_available: bool = False, least: float = ACCEPT) -> DataFrame:
    """``accepted``: whether a scene covers enough of its tile; with ``best_available`` each tile's best scene is, whatever it covers."""
    rows = with_coverage(items)
    if not best_available:
        return rows.withColumn("accepted", F.col("coverage") >= least)
    first = F.row_number().over(Window.partitionBy("tile").orderBy(F.desc("coverage"), "seq"))
    return rows.withColumn("accepted", (F.col("coverage") >= least) | (first == 1))


def uncovered(items: DataFrame, grid: int = 50, buffer: float = 0.01, least: int = 3) -> DataFrame:
    """(tile, points, share): how many of a grid of points over each tile are outside every chosen footprint widened by ``buffer``; tiles with fewer than ``least`` such points are covered.

    Each different footprint of a tile becomes the grid points inside it, and a tile's different points are counted: no tile's footprints are gathered anywhere.
    """
    boxes = tile_of(items).select("tile", "fx0", "fx1", "fy0", "fy1").distinct()

    def inside(rows: DataFrame, n: str, lo: str, hi: str) -> DataFrame:
        a = F.greatest(F.floor((F.col(lo) - buffer) * grid) - 1, F.lit(0))
        b = F.least(F.floor((F.col(hi) + buffer) * grid) + 1, F.lit(grid - 1))
        at = (F.col(n) + 0.5) / grid
        return rows.withColumn(n, F.explode(F.when(a <= b, F.sequence(a, b)))).filter((at >= F.col(lo) - buffer) & (at < F.col(hi) + buffer))

    points = inside(inside(boxes, "i", "fx0", "fx1"), "j", "fy0", "fy1").select("tile", "i", "j").distinct()
    seen = points.groupBy("tile").agg(F.count("*").alias("seen"))
    left = F.lit(grid * grid).cast("long") - F.coalesce("seen", F.lit(0))
    rows = boxes.select("tile").distinct().join(seen, "tile", "left").select("tile", left.alias("points"))
    return rows.filter(F.col("points") >= least).select("tile", "points", (F.col("points") / float(grid * grid)).alias("share"))


def footprint_coverage(items: DataFrame, tiles: DataFrame, keys: list[str], size: float, scale: float = 1e9, most: int = 32) -> DataFrame:
    """``items`` (keys, tile, ring) with ``coverage``: the share of their tile's ring (tile, ring) that the footprint covers, whatever the shapes of both; 0 where they don't meet. Keys and tile
    name an item. A footprint or tile without a ring covers nothing or has null.

    Where both rings are simple (no two sides meet but neighbours at their corner) and have ``most`` sides or fewer, an item is settled in its row (``geo.shared_area``), and only the tiles are
    joined. The others go through ``overlay``, whose rows are shuffled by item.
    """
    whole = F.abs(overlay._signed(F.col("ring"))) / 2
    known = written(tiles.select("tile", F.col("ring").alias("_tile"), F.when(F.size("ring") > 2, whole).alias("_whole"), _plain("ring", most, scale).alias("_plain")), "tiles")
    rows = items.join(known, "tile", "left")
    plain = F.coalesce(F.col("_plain") & _plain("ring", most, scale), F.col("ring").isNull() | F.col("_tile").isNull())
    share = lambda area: (F.coalesce(area, F.lit(0.0)) / F.nullif("_whole", F.lit(0.0))).alias("coverage")
    snapped = lambda c: F.transform(geo.bound(F.col(c), lambda r: overlay.oriented(r)), lambda p: F.struct(*((F.rint(p[d] * scale) / scale).alias(d) for d in "xy")))
    other = rows.filter(~plain)
    if other.isEmpty():
        return rows.select(*items.columns, share(geo.shared_area(snapped("ring"), snapped("_tile"))))
    by = [*keys, "tile"]
    sides = lambda ring, layer: overlay.sides(other, by, layer, ring, scale=scale)
    met = overlay.area(overlay.overlay(sides("ring", "a").unionByName(sides("_tile", "b")), by, "intersection", size, scale), by)
    here = rows.filter(plain).select(*items.columns, share(geo.shared_area(snapped("ring"), snapped("_tile"))))
    return here.unionByName(other.join(met, by, "left").select(*items.columns, share(F.col("area"))))


def _plain(ring: str, most: int, scale: float) -> Column:
    """Whether a ring has from 3 to ``most`` sides and is simple: no side meets another, neighbours at their corner apart, nor runs back along its neighbour. Null for no ring."""
    r, n = F.transform(ring, lambda p: F.struct(*((F.rint(p[d] * scale) / scale).alias(d) for d in "xy"))), F.size(ring)
    turn = lambda p, q, o: (q["x"] - p["x"]) * (o["y"] - p["y"]) - (q["y"] - p["y"]) * (o["x"] - p["x"])
    spans = lambda p, q, u, v, d: (F.greatest(p[d], q[d]) >= F.least(u[d], v[d])) & (F.greatest(u[d], v[d]) >= F.least(p[d], q[d]))
    apart = lambda p, q, u, v: F.signum(turn(p, q, u)) * F.signum(turn(p, q, v)) > 0
    clear = lambda p, q, u, v: ~spans(p, q, u, v, "x") | ~spans(p, q, u, v, "y") | apart(p, q, u, v) | apart(u, v, p, q)
    bent = lambda p, q, u: (turn(p, q, u) != 0) | ((q["x"] - p["x"]) * (u["x"] - q["x"]) + (q["y"] - p["y"]) * (u["y"] - q["y"]) > 0)

    def every(r: Column) -> Column:
        at = lambda i: F.get(r, i % n)
        places = F.sequence(F.lit(0), n - 1)
        return F.forall(places, lambda i: bent(at(i), at(i + 1), at(i + 2)) & F.forall(places, lambda j: (j <= i + 1) | ((i == 0) & (j == n - 1)) | clear(at(i), at(i + 1), at(j), at(j + 1))))

    return F.when(F.col(ring).isNull(), F.lit(None)).when((n > 2) & (n <= most), geo.bound(r, every)).otherwise(F.lit(False))


def uncovered_parts(tiles: DataFrame, footprints: DataFrame, buffer: float = 1000.0, least: float = 1000.0, size: float = 10_000.0) -> DataFrame:
    """(tile, part, holes, area, ring, inner): what the footprints of a tile, widened by ``buffer`` metres, leave of its ring, in parts of ``least`` square metres or more.

    Rings of ``tiles`` (tile, ring) and ``footprints`` (tile, ring, several for each tile) are degrees; they are compared in the UTM zone of the centre of the tile's footprints, or of the tile
    where it has none, and the parts' rings and areas are in its metres. Widening and difference are ``overlay``'s, so no tile's footprints are gathered anywhere; only what is left is.
    """
    centre = lambda rows, n: rows.filter("ring is not null").select("tile", geo.centroid(F.col("ring")).alias("c")).groupBy("tile").agg(F.avg("c.x").alias(n + "x"), F.avg("c.y").alias(n + "y"))
    at = centre(tiles, "t").join(centre(footprints, "f"), "tile", "left").select("tile", F.coalesce("fx", "tx").alias("lon"), F.coalesce("fy", "ty").alias("lat"))
    zones = at.select("tile", (F.floor((F.col("lon") + 180) / 6) + 1).alias("zone"), (F.col("lat") < 0).alias("south"))

    def metres(rows: DataFrame) -> DataFrame:
        east_north = lambda p: geo.to_utm(p["x"], p["y"], F.col("zone"), F.col("south"))
        return rows.join(zones, "tile").select("tile", F.transform("ring", lambda p: F.struct(east_north(p)[0].alias("x"), east_north(p)[1].alias("y"))).alias("ring"))

    scale = 1e6
    rows = overlay.sides(metres(tiles), ["tile"], "a", scale=scale).unionByName(overlay.widened(metres(footprints), ["tile"], buffer, "b", scale=scale))
    return overlay.parts(overlay.rings(overlay.overlay(rows, ["tile"], "difference", size, scale), ["tile"]), ["tile"]).filter(F.col("area") >= least)


def selection(items: DataFrame, by: tuple[str, ...] = ("tile",)) -> DataFrame:
    """(by, seq, place, coverage): the scenes chosen for each tile, or for each tile and period: the primary one (place 0), then, where it covers over 60 and up to 95 %, in catalog order each
    that brings it and the primary to over 5 points more than what is reached, until that is over 95 %. ``coverage`` is what is reached with the scene; footprints are boxes in the unit tile.

    A scene is measured against the primary alone, so what it reaches doesn't depend on the others, and it can only be taken if it reaches more than every one before it. Those few, found by a
    running maximum, are all that a tile's choice looks at.
    """
    rows = with_coverage(items)
    rungs = F.explode(F.filter(F.array(*map(F.lit, LADDER)), lambda t: F.col("cloud") < t))
    tried = rows.filter("degraded < 5 and coverage > 0").withColumn("rung", rungs)
    kept = F.struct("rung", "seq", "coverage", "fx0", "fx1", "fy0", "fy1")
    passing = F.min(F.when(F.col("coverage") > ACCEPT, kept))
    best = F.min_by(kept, F.struct(-F.col("coverage"), F.col("rung"), F.col("seq")))
    first = tried.groupBy(*by).agg(F.coalesce(passing, best).alias("p"))
    lone = first.select(*by, F.col("p.seq").alias("seq"), F.lit(0).cast("long").alias("place"), F.col("p.coverage").alias("coverage"))
    some = rows.join(first.filter((F.col("p.coverage") > ACCEPT) & (F.col("p.coverage") <= GOOD)), list(by))
    side = lambda a: F.greatest(F.lit(0.0), F.least(F.col(f"f{a}1"), F.col(f"p.f{a}1"), F.lit(1.0)) - F.greatest(F.col(f"f{a}0"), F.col(f"p.f{a}0"), F.lit(0.0)))
    some = some.withColumn("reach", F.col("p.coverage") + F.col("coverage") - side("x") * side("y")).filter(F.col("reach") > F.col("p.coverage") + GAIN)
    before = Window.partitionBy(*by).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    records = some.withColumn("before", F.max("reach").over(before)).filter("before is null or reach > before")
    taken = F.aggregate(
        F.array_sort(F.collect_list(F.struct("seq", "reach"))),
        F.struct(F.first("p.coverage").alias("had"), F.array().cast("array<struct<seq:bigint,reach:double>>").alias("t")),
        lambda s, r: F.when((s["had"] <= GOOD) & (r["reach"] > s["had"] + GAIN), F.struct(r["reach"].alias("had"), F.array_append(s["t"], F.struct(r["seq"].cast("long").alias("seq"), r["reach"].alias("reach"))).alias("t"))).otherwise(s),
        lambda s: s["t"],
    )
    more = records.groupBy(*by).agg(taken.alias("t")).select(*by, F.posexplode("t").alias("n", "t"))
    return lone.unionByName(more.select(*by, "t.seq", (F.col("n") + 1).cast("long").alias("place"), F.col("t.reach").alias("coverage")))


def selection_summary(chosen: DataFrame, by: tuple[str, ...] = ("tile",), within: tuple[str, ...] = ()) -> DataFrame:
    """(within, bucket, tiles, several, scenes): tiles by what their chosen scenes cover together, how many of them have more than one, and all scenes."""
    tiles = chosen.groupBy(*by).agg(F.max_by("coverage", "place").alias("coverage"), F.count("*").alias("n"))
    c = F.col("coverage")
    bucket = F.when(c >= 0.95, "95-100%").when(c >= 0.80, "80-95%").when(c >= 0.60, "60-80%").otherwise("<60%")
    return tiles.groupBy(*within, bucket.alias("bucket")).agg(F.count("*").alias("tiles"), F.count(F.when(F.col("n") > 1, 1)).alias("several"), F.sum("n").alias("scenes"))


def band_rows(files: DataFrame) -> DataFrame:
    """(tile, date, red, nir, scl): the band files of one tile and date in a row, the first by name of each band; tiles and dates without red or without nir have none."""
    p = F.split("file", "-")
    rows = files.select("file", p.getItem(1).alias("tile"), p.getItem(2).alias("date"), p.getItem(3).alias("band"))
    wide = rows.groupBy("tile", "date").agg(*(F.min(F.when(F.col("band") == b, F.col("file"))).alias(b) for b in ("red", "nir", "scl")))
    return wide.filter("red is not null and nir is not null")


def search_key(*columns: str):
    """A name for a search by its parameters: the same parameters give the same name."""
    return F.md5(F.concat_ws("|", *columns))
