import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verdure.functions import geo
from verdure.operators import tiles
from verdure.sources import tilearchive as T


def test_curve_is_one_path(spark):
    for level in (0, 1, 3, 4):
        side = 1 << level
        at = {geo.place_of(x, y, level): (x, y) for x in range(side) for y in range(side)}
        assert sorted(at) == list(range(side * side))
        assert all(abs(at[i][0] - at[i + 1][0]) + abs(at[i][1] - at[i + 1][1]) == 1 for i in range(side * side - 1))
        assert all(geo.cell_at(d, level) == c for d, c in at.items())
        assert all(at[d][0] >> 1 == at[d - d % 4][0] >> 1 and at[d][1] >> 1 == at[d - d % 4][1] >> 1 for d in at if level)
        rows = spark.createDataFrame([(x, y, level) for x, y in at.values()], "x int, y int, z int")
        assert all(geo.place_of(r.x, r.y, level) == r.d and T.zoom_of(r.t) == (level, r.x, r.y) for r in rows.select("*", geo.curve_place(F.col("x"), F.col("y"), F.col("z")).alias("d"), geo.tile_id(F.col("z"), F.col("x"), F.col("y")).alias("t")).collect())
    # the format's own examples
    assert [T.zoom_of(i) for i in (0, 1, 2, 3, 4, 5, 19078479)] == [(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0), (2, 0, 0), (12, 3423, 1763)]


def test_varints_directories_and_images():
    rng = random.Random(5)
    some = [0, 1, 127, 128, 16384, 1 << 60, *(rng.randrange(1 << rng.randrange(1, 62)) for _ in range(200))]
    assert T.numbers(T.varints(some)) == some
    entries, first, at = [], 0, 0
    for _ in range(30_000):
        first += rng.randrange(1, 1 << 20)
        e = T.Entry(first, rng.randrange(1, 5), rng.randrange(100, 1 << 24), at if rng.random() < 0.7 else rng.randrange(at + 1))
        entries.append(e)
        first, at = first + e.run, max(at, e.at + e.size)
    assert T.unpack_directory(T.pack_directory(entries)) == entries
    root, leaves = T.directories(entries)
    assert len(root) <= T.ROOT_END - T.HEADER and leaves
    back = [e for h in T.unpack_directory(root) for e in T.unpack_directory(leaves[h.at : h.at + h.size])]
    assert back == entries
    image = np.random.default_rng(1).integers(0, 256, (64, 64, 4), np.uint8)
    assert (T.decode_png(T.encode_png(image)) == image).all()
    damaged = bytearray(T.encode_png(image))
    damaged[60] ^= 1
    with pytest.raises(ValueError):
        T.decode_png(bytes(damaged))


def test_equal_neighbours_are_one_entry():
    a = T.Archive()
    for tile, data in [(5, b"sea"), (6, b"sea"), (7, b"sea"), (8, b"land"), (9, b"sea"), (11, b"sea")]:
        a.add(tile, data)
    assert [(e.first, e.run) for e in a.entries] == [(5, 3), (8, 1), (9, 1), (11, 1)]
    assert a.body == [b"sea", b"land"] and a.tiles == 6 and a.last == 11


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-180, 180), rng.uniform(-84, 84), rng.randrange(1, 100)) for _ in range(600)]
    rows += [(72.5, 23.25, v) for v in (7, 90, 90)] + [(180.0, 89.9, 3), (-180.0, -89.9, 4), (None, 1.0, 5), (1.0, None, 5), (1.0, 1.0, None), (0.0, 0.0, 0)]
    return spark.createDataFrame(rows, "lon double, lat double, value int")


def test_archives_by_ranges_and_reading_by_number(spark, points, tmp_path):
    pyramid = tiles.pyramid(points, 4, bits=5)
    assert pyramid.filter("z = 0").agg(F.sum("n")).first()[0] == 606
    path = str(tmp_path / "archives")
    T.write_tiles(tiles.colour(pyramid), path, side=32, archive_mb=0)  # an archive for each tile
    few = str(tmp_path / "few")
    T.write_tiles(tiles.colour(pyramid), few, side=32)
    want = sorted(map(tuple, tiles.colour(pyramid).select("z", "tx", "ty", "tile_id", "y", "x", "red", "green", "blue", "alpha").collect()))
    for p in (path, few):
        assert sorted(map(tuple, T.tile_pixels(T.read_tiles(spark, p)).collect())) == want
    ids = sorted({r[3] for r in want})
    assert len(list((tmp_path / "archives").glob("*.pmtiles"))) == len(ids)
    one = ids[len(ids) // 2]
    assert T.read_tiles(spark, path, one, one).rdd.getNumPartitions() == 1  # the others' names exclude them
    for p in (path, few):
        got = T.tile_pixels(T.read_tiles(spark, p, one, ids[-2])).collect()
        assert sorted(map(tuple, got)) == [r for r in want if one <= r[3] <= ids[-2]]
    assert T.read_tiles(spark, path, ids[-1] + 1).count() == 0
    assert not list((tmp_path / "archives").glob("*.part"))


def test_leaf_directories_are_opened_for_asked_numbers(spark, tmp_path):
    archive = T.Archive()
    rng = random.Random(9)
    tile, want = 21845, {}
    for _ in range(20_000):
        tile += rng.randrange(1, 1 << 22)
        want[tile] = rng.randbytes(rng.randrange(1, 9))
        archive.add(tile, want[tile])
    parts = archive.parts({})
    assert parts[3]  # leaves
    (tmp_path / "a.pmtiles").write_bytes(b"".join(parts))
    ids = sorted(want)
    got = {r.tile_id: bytes(r.data) for r in T.read_tiles(spark, str(tmp_path), ids[9_000], ids[9_100]).collect()}
    assert got == {i: want[i] for i in ids[9_000:9_101]}
    assert T.read_tiles(spark, str(tmp_path)).count() == len(ids)


def test_empty_and_unordered(spark, tmp_path):
    pixels = tiles.colour(tiles.pyramid(spark.createDataFrame([], "lon double, lat double, value int"), 1))
    T.write_tiles(pixels, str(tmp_path / "none"))
    assert T.read_tiles(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "1-2.pmtiles").write_bytes(b"something else" * 20)
    with pytest.raises(Exception, match="no archive"):
        T.read_tiles(spark, str(tmp_path / "bad")).collect()
