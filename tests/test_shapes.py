"""Shapefiles and well-known binary."""

import struct

import pytest
from pyspark.sql import functions as F

from verdure.functions import wkb
from verdure.sources import shapefile

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]


def regions(spark, rows):
    return spark.createDataFrame([(c, n, r and [{"x": x, "y": y} for x, y in r]) for c, n, r in rows], "code string, name string, ring array<struct<x:double,y:double>>")


def far(i):
    return [(x + 10.0 * i, y) for x, y in SQUARE]


def test_round_trip_by_runs_and_box(spark, tmp_path):
    """Null rings and texts, text that isn't ASCII, either direction of rings; small blocks make several partitions, and a box reads only what it meets."""
    rows = [(f"c{i}", None if i % 3 == 0 else f"Fôret {i}", None if i == 5 else far(i) if i % 2 else far(i)[::-1]) for i in range(20)]
    path = str(tmp_path / "s")
    shapefile.write_shapefile(regions(spark, rows).coalesce(1), path, ["code", "name"])
    df = shapefile.read_shapefile(spark, path)
    got = {r.properties["code"]: (r.properties["name"], r.ring and sorted((p.x, p.y) for p in r.ring)) for r in df.withColumn("ring", shapefile.largest_ring(F.col("rings"))).collect()}
    assert got == {c: (n, r and sorted(r)) for c, n, r in rows}
    small = spark.read.format("shapefile").option("block_mb", "0.0005").load(path)
    assert small.rdd.getNumPartitions() > 4 and small.count() == 20
    assert [r.record for r in small.orderBy("record").collect()] == list(range(20))
    assert {r.properties["code"] for r in shapefile.read_shapefile(spark, path, (9.0, 1.0, 21.0, 2.0)).collect()} == {"c1", "c2"}
    shapefile.write_shapefile(regions(spark, [("more", "", far(50))]), path, ["code", "name"])
    assert shapefile.read_shapefile(spark, path).count() == 21 and not [f for f in (tmp_path / "s").iterdir() if f.name.startswith(".") and not f.name.endswith(".crc")]


def test_parts_holes_points_and_deleted_records(spark, tmp_path):
    """Shapes made by hand: a polygon with a hole, one with heights, a point, a deleted record."""
    ring = lambda *p: b"".join(struct.pack("<2d", *q) for q in p)
    outer, hole = [(0, 0), (0, 9), (9, 9), (9, 0), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 1)]
    holed = struct.pack("<i4d4i", 5, 0, 0, 9, 9, 2, 9, 0, 5) + ring(*outer, *hole)
    high = struct.pack("<i4d3i", 15, 0, 0, 9, 9, 1, 5, 0) + ring(*outer) + bytes(16 + 5 * 8)
    shapes = [holed, high, struct.pack("<i2d", 1, 3, 4), struct.pack("<i2d", 1, 5, 6)]
    shp, shx = bytes(100), bytes(100)
    for i, s in enumerate(shapes, start=1):
        shx += struct.pack(">2i", len(shp) // 2, len(s) // 2)
        shp += struct.pack(">2i", i, len(s) // 2) + s
    dbf = struct.pack("<4BIHH20x", 3, 1, 1, 1, 4, 65, 4) + b"n".ljust(11, b"\0") + b"N" + bytes(4) + bytes([3]) + bytes(15) + b"\r" + b"   1   2*  3    \x1a"
    for ending, data in (("shp", shp), ("shx", shx), ("dbf", dbf)):
        (tmp_path / f"a.{ending}").write_bytes(data)
    got = shapefile.read_shapefile(spark, str(tmp_path / "a.shp")).withColumn("ring", shapefile.largest_ring(F.col("rings"))).orderBy("record").collect()
    assert [(r.record, r.kind, r.properties["n"], [len(x) for x in r.rings]) for r in got] == [(0, 5, "1", [4, 3]), (1, 5, "2", [4]), (3, 1, None, [1])]
    assert len(got[0].ring) == 4 and (got[2].rings[0][0].x, got[2].rings[0][0].y) == (5.0, 6.0)


def test_names_must_differ(spark, tmp_path):
    with pytest.raises(Exception, match="first 10"):
        shapefile.write_shapefile(regions(spark, [("a", "b", SQUARE)]).withColumn("a_long_name_1", F.lit("x")).withColumn("a_long_name_2", F.lit("y")), str(tmp_path / "n"), ["a_long_name_1", "a_long_name_2"])


def test_wkb_kinds_and_orders(spark):
    """Both byte orders mixed in a collection, heights in either style, a reference system, holes, points, empty and null."""
    ring = lambda o, p, n=2: struct.pack(f"{o}I", len(p)) + b"".join(struct.pack(f"{o}{n}d", *q, *[7.0] * (n - 2)) for q in p)
    sq = [*SQUARE, SQUARE[0]]
    hole = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]
    cases = {
        "holed": struct.pack("<BII", 1, 3, 2) + ring("<", sq) + ring("<", hole),
        "big": struct.pack(">BII", 0, 3, 1) + ring(">", sq),
        "z": struct.pack("<BII", 1, 1003, 1) + ring("<", sq, 3),
        "ez": struct.pack(">BIII", 0, 3 | 0x80000000 | 0x20000000, 4326, 1) + ring(">", sq, 3),
        "multi": struct.pack(">BII", 0, 6, 2) + struct.pack("<BII", 1, 3, 1) + ring("<", sq) + struct.pack(">BII", 0, 3, 1) + ring(">", hole),
        "point": struct.pack("<BI2d", 1, 1, 3.0, 4.0),
        "none": struct.pack("<BII", 1, 3, 0),
        "null": None,
    }
    df = spark.createDataFrame([(k, v and bytearray(v)) for k, v in cases.items()], "k string, w binary")
    got = {r.k: r.p and [[len(x) for x in q] for q in r.p] for r in df.select("k", wkb.from_wkb("w").alias("p")).collect()}
    assert got == {"holed": [[4, 3]], "big": [[4]], "z": [[4]], "ez": [[4]], "multi": [[4], [3]], "point": [[1]], "none": [], "null": None}
    back = regions(spark, [("a", "", SQUARE), ("b", "", None)]).select("code", wkb.to_wkb(F.col("ring")).alias("w"), wkb.to_wkb(F.col("ring"), False).alias("v")).orderBy("code").collect()
    assert bytes(back[0].v) == cases["big"] and bytes(back[0].w) == struct.pack("<BII", 1, 3, 1) + ring("<", sq) and back[1].w is None
