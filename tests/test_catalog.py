import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from verdure.functions import geo
from verdure.sources import catalog

SCHEMA = "id long, day date, cloud double, ring array<struct<x:double,y:double>>"


def triangle(rng, size=3.0):
    x, y = rng.uniform(-178, 178), rng.uniform(-88, 88)
    return [{"x": min(180.0, x + rng.uniform(0, size)), "y": min(90.0, y + rng.uniform(0, size))} for _ in range(3)]


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(3)
    rows = [(i, date(2019, 11, 1) + timedelta(days=rng.randrange(500)), rng.uniform(0, 100), triangle(rng, 40.0 if i % 9 == 0 else 3.0)) for i in range(800)]
    rows += [(900, None, 1.0, triangle(rng)), (901, date(2020, 1, 1), 1.0, None), (902, date(2020, 2, 2), None, triangle(rng)), rows[0], rows[0]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("level,block,asked", [(9, 3, 64), (4, 2, 4)])
def test_search_equals_a_full_scan(spark, items, tmp_path, level, block, asked):
    path = str(tmp_path / "catalog")
    catalog.write_catalog(items, path, level=level, block=block)
    sizes = []
    for outline in ([(-10.0, 5.0), (30.0, -8.0), (44.0, 35.0)], [(100.0, -80.0), (101.0, -80.0), (101.0, -79.0), (100.0, -79.0)], [(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0)]):
        shape = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in outline))
        days = (date(2019, 12, 15), date(2020, 12, 31))
        want = items.filter(F.col("day").between(*map(F.lit, days)) & (F.col("cloud") < 60.0)).filter(geo.rings_meet(F.col("ring"), shape))
        got = catalog.search(spark, path, outline, days, {"cloud": (None, 60.0)}, level=level, block=block, asked=asked)
        assert got.columns == items.columns
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())
        sizes.append(got.count())
    assert sizes[0] > 0 and sizes[2] > sizes[0]  # repeated items are there as often as stored


def test_an_item_is_stored_once_whatever_its_size(spark, tmp_path):
    box = lambda x, y, w, h: [{"x": x, "y": y}, {"x": x + w, "y": y}, {"x": x + w, "y": y + h}, {"x": x, "y": y + h}]
    shapes = [box(0.0, 0.0, 0.1, 0.1), box(-180.0, -90.0, 360.0, 180.0), box(-40.0, -20.0, 50.0, 25.0), box(9.5, 5.0, 360 / 512, 180 / 512), box(-200.0, -95.0, 400.0, 190.0), box(190.0, 3.0, 5.0, 5.0), box(170.0, 3.0, 30.0, 5.0)]
    rows = spark.createDataFrame([(i, date(2020, 5, 5), 1.0, s) for i, s in enumerate(shapes)], SCHEMA)
    path = str(tmp_path / "catalog")
    catalog.write_catalog(rows, path)
    assert spark.read.parquet(path).count() == len(shapes)
    days = (date(2020, 1, 1), date(2020, 12, 31))
    found = lambda outline: sorted(r.id for r in catalog.search(spark, path, outline, days).collect())
    assert found([(10.0, 5.0), (10.1, 5.0), (10.1, 5.2)]) == [1, 2, 3, 4]
    assert found([(-0.05, -0.05), (0.0, -0.05), (0.0, 0.0)]) == [0, 1, 2, 4]  # a corner that only touches
    assert found([(191.0, 4.0), (192.0, 4.0), (192.0, 5.0)]) == [4, 5, 6]  # beyond the earth's box


def test_folders_and_row_groups_are_pruned(spark, items, tmp_path):
    path = str(tmp_path / "catalog")
    catalog.write_catalog(items, path)
    found = catalog.search(spark, path, [(10.0, 5.0), (11.0, 5.0), (11.0, 6.0)], (date(2020, 3, 1), date(2020, 5, 1)), {"cloud": (5.0, 60.0)})
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    partitions, pushed = scan.split("PartitionFilters")[1].split("PushedFilters")
    assert "verdure_year" in partitions and "verdure_block" in partitions
    assert all(c in pushed for c in ("verdure_cell", "day", "cloud")) and "Exchange" not in plan
    files = len(spark.read.parquet(path).inputFiles())
    found.collect()
    metrics = found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    assert metrics.apply("numFiles").value() < files / 10


def test_rings_meet(spark):
    square = lambda x, y, a: [{"x": x, "y": y}, {"x": x + a, "y": y}, {"x": x + a, "y": y + a}, {"x": x, "y": y + a}]
    cases = [
        (square(0.0, 0.0, 1.0), square(2.0, 0.0, 1.0), False),
        (square(0.0, 0.0, 1.0), square(1.0, 1.0, 1.0), True),  # a corner
        (square(0.0, 0.0, 1.0), square(1.0, 0.25, 0.5), True),  # a side
        (square(0.0, 0.0, 9.0), square(3.0, 3.0, 1.0), True),  # one in the other
        (square(3.0, 3.0, 1.0), square(0.0, 0.0, 9.0), True),
        ([{"x": 0.0, "y": 2.0}, {"x": 9.0, "y": 2.0}, {"x": 9.0, "y": 3.0}, {"x": 0.0, "y": 3.0}], [{"x": 4.0, "y": 0.0}, {"x": 5.0, "y": 0.0}, {"x": 5.0, "y": 9.0}, {"x": 4.0, "y": 9.0}], True),  # a cross without corners inside
        ([{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}], square(0.0, 3.0, 0.9), False),  # boxes meet, areas don't
    ]
    df = spark.createDataFrame(cases, "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>, want boolean")
    assert all(r.got == r.want for r in df.select("want", geo.rings_meet(F.col("a"), F.col("b")).alias("got")).collect())


def test_clashing_columns_and_empty_tables(spark, items, tmp_path):
    with pytest.raises(ValueError):
        catalog.write_catalog(items.withColumn("VERDURE_cell", F.lit(1)), str(tmp_path / "x"))
    more = items.withColumns({"year": F.lit(7), "block": F.lit("b"), "a.b": F.lit(1)})
    catalog.write_catalog(more, str(tmp_path / "y"))
    got = catalog.search(spark, str(tmp_path / "y"), [(-180.0, -90.0), (180.0, -90.0), (180.0, 90.0), (-180.0, 90.0)], (date(2019, 1, 1), date(2021, 12, 31)))
    assert got.columns == more.columns and got.count() == items.filter("ring is not null and day is not null").count()
