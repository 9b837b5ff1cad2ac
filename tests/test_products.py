"""Products as chains, against plain loops over the same pixels."""

import math

from pyspark.sql import functions as F

from verdure.fixtures import load
from verdure.operators import composite
from verdure.plans import catalogue

SF = "/root/testdata/sf0.001"
BANDS = ("red", "green", "blue", "nir", "swir")


def test_canopy_density_from_scenes(spark):
    rows = load(spark, SF, "pixels").filter("tile < 12").withColumn("scene", F.col("seq") % 23).withColumnRenamed("tile", "chunk")
    corners = rows.select("chunk").distinct().selectExpr("chunk", "chunk * 4 as y0", "chunk % 3 as x0")
    forest = spark.range(64 * 14).selectExpr("cast(id div 14 as int) as y", "cast(id % 14 as int) as x", "cast(id % 7 <> 3 as int) as forest")
    got = {(r.y, r.x): r["class"] for r in composite.density_product(rows, forest, corners, 10, "RJ").collect()}

    clear = {}
    for r in rows.filter("scl not in (0, 3, 8, 9, 10)").collect():
        clear.setdefault(r.chunk, {}).setdefault((r.y, r.x), []).append(r)
    mosaic = {}
    for chunk, pixels in sorted(clear.items()):
        left, chosen = dict(pixels), set()
        while left:
            counts = {}
            for p in left.values():
                for s in {r.scene for r in p}:
                    counts[s] = counts.get(s, 0) + 1
            best = min(counts, key=lambda s: (-counts[s], s))
            chosen.add(best)
            left = {k: p for k, p in left.items() if best not in {r.scene for r in p}}
        values = {k: [v / 10000 for v in max((r.scene, *(r[b] for b in BANDS)) for r in p if r.scene in chosen)[1:]] for k, p in pixels.items()}
        index = {k: (n - r) / (n + r + 1e-8) for k, (r, g, b, n, s) in values.items()}
        mg, mr, mx, mn = max(v[1] for v in values.values()), max(v[0] for v in values.values()), max(index.values()), min(index.values())
        for (y, x), (r, g, b, n, s) in values.items():
            bare = ((s + b) - (n + r)) / ((s + b) + (n + r) + 1e-8)
            fcd = math.floor(min(255, 100 * math.sqrt((index[y, x] - mn) / (mx - mn + 1e-8) * math.sqrt(math.sqrt((mg - g) * (mr - r)) * abs(bare)))))
            mosaic.setdefault((y + chunk * 4, x + chunk % 3), []).append(fcd)
    want = {}
    for (y, x), v in mosaic.items():
        first = next((f for f in v if f), 0)
        level = 4 if first > 75 else 3 if first > 50 else 2 if first > 25 else 1 if first > 0 else 0
        if y < 64 and x < 14:
            want[y, x] = level if (y * 14 + x) % 7 != 3 else 0
    assert got == want and len(set(got.values())) > 2


def test_products_share_their_grid(spark):
    """Density is 0 outside the mask, and every pixel of it is one of the mask's."""
    forest = {(r.y, r.x): r.forest for r in catalogue.forest_mask_product(spark, SF).collect()}
    density = {(r.y, r.x): r["class"] for r in catalogue.canopy_density_product(spark, SF).collect()}
    assert set(density) <= set(forest) and all(forest[k] for k, v in density.items() if v) and set(forest.values()) == {0, 1}
