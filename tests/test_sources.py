import json
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from verdure.operators import incidents
from verdure.sources import grids, sinks
from verdure.streaming import incidents as stream


def test_grd(spark, tmp_path):
    v = np.arange(129 * 135, dtype="<f4").reshape(129, 135)
    v[0, 0], v[1, 1] = -999, np.nan
    (tmp_path / "rain_20240131.grd").write_bytes(v.tobytes())
    df = grids.read_grd(spark, str(tmp_path))
    assert df.count() == 129 * 135 and df.filter("rainfall is null").count() == 2
    r = df.filter("iy = 128 and ix = 134").first()
    assert (str(r["time"]), r["lat"], r["lon"], r["rainfall"]) == ("2024-01-31", 38.5, 100.0, float(v[128, 134]))


def test_prefer(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "time int, v string")
    b = spark.createDataFrame([(2, "b"), (3, "b"), (3, "bb")], "time int, v string")
    assert sorted(tuple(r) for r in grids.prefer(a, b).collect()) == [(1, "a"), (2, "a"), (3, "b"), (3, "bb")]


def test_geojson_and_features(spark, tmp_path):
    square = lambda s: [[[0, 0], [s, 0], [s, s], [0, s], [0, 0]]]
    geo = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": "x"}, "geometry": {"type": "Polygon", "coordinates": square(2)}}, {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [square(1), square(3)]}}]}
    (tmp_path / "a.geojson").write_text(json.dumps(geo, indent=1))
    rows = grids.read_geojson(spark, str(tmp_path / "a.geojson")).collect()
    assert [max(p["x"] for p in r["ring"]) for r in rows] == [2.0, 3.0] and rows[0]["properties"]["name"] == "x"
    (tmp_path / "tiles.json").write_text("\n".join(["", json.dumps(geo["features"][0] | {"properties": {"Name": "43R"}}), ""]))
    tile = grids.read_tiles(spark, str(tmp_path / "tiles.json"))
    assert [r["name"] for r in tile.collect()] == ["43R"]
    f = json.loads(sinks.features(tile).first()["feature"])
    assert f["properties"] == {"name": "43R"} and f["geometry"]["coordinates"][0][0] == [0.0, 0.0] and f["geometry"]["type"] == "Polygon"


def test_files_by_date_and_manifest(spark, tmp_path):
    for n in ("g_20230101.bin", "g_20240101.bin", "other.bin"):
        (tmp_path / n).write_bytes(b"x")
    files = grids.dated_files(spark, str(tmp_path), r"(\d{8})", since="2023-06-01")
    assert [str(r["date"]) for r in files.collect()] == ["2024-01-01"]
    assert grids.new_files(files, files).count() == 0


def test_sinks(spark, tmp_path):
    layer = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 1, 6), (2, 0, 0, 7)], "tile int, y int, x int, value int")
    sinks.write_layer(layer, str(tmp_path / "l"), ["tile"])
    assert spark.read.parquet(str(tmp_path / "l")).filter("tile = 1").count() == 2
    rows = spark.createDataFrame([("a", 2015, "pre", 1.5)], "name string, year int, period string, depth double")
    for kind in ("csv", "json"):
        sinks.write_periods(rows, str(tmp_path / kind), kind)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["depth"] == "1.5"


def test_stream_of_incidents(spark, tmp_path):
    names = "form_id long, region_id int, reporting_date string, " + ", ".join(f"{n} string" for n in incidents.NAMES)
    row = lambda i, status, lat="1.5": (i, 1, f"2024-01-0{i}", lat, "70.5", None, "Mammal", "Deer", status, "V", None, "05-Jan-24")
    src, out, chk = (str(tmp_path / x) for x in ("src", "out", "chk"))
    for n, rows in enumerate(([row(1, "new"), row(2, "new"), row(3, "new", "0")], [row(2, "Closed"), row(4, "new")])):
        spark.createDataFrame(rows, names).coalesce(1).write.mode("append").parquet(src)
        s = spark.readStream.schema(names).parquet(src).withColumn("reporting_date", F.to_date("reporting_date"))
        stream.start(s, out, chk).awaitTermination()
    got = {r["incident_id"]: r["status"] for r in stream.current(spark, out, stream.SCHEMA).collect()}
    assert got == {"rescue_1": "new", "rescue_2": "closed", "rescue_4": "new"}


def test_runs_of_a_stream_are_merged_in_tiers(spark, tmp_path):
    assert stream.outer([(0, 0), (0, 3), (1, 1), (4, 4)]) == [(0, 3), (4, 4)]
    names = "form_id long, region_id int, reporting_date date, " + ", ".join(f"{n} string" for n in incidents.NAMES)
    row = lambda i, day, status: (i, 1, date(2024, 1, day), "1.5", "70.5", None, "Mammal", "Deer", status, "V", None, "05-Jan-24")
    path = str(tmp_path / "runs")
    put = stream.upsert_batch(path, fan=2)
    batches = [[row(1, 9, "new"), row(2, 2, "new")], [row(1, 4, "late")], [row(2, 5, "closed"), row(3, 1, "new")], [row(2, 5, "again"), row(4, 1, "new")], [row(3, 3, "moved")], []]
    want, seen = {}, []
    for n, rows in enumerate(batches):
        for _ in range(2):  # a batch may run again
            put(spark.createDataFrame(rows, names), n)
        for r in rows:
            key = f"rescue_{r[0]}"
            if key not in want or want[key][0] <= r[2]:
                want[key] = (r[2], r[8])
        got = {r.incident_id: (r.reporting_date, r.status) for r in stream.current(spark, path).collect()}
        assert got == want, n  # an older submission that comes late doesn't replace a newer one
        seen.append(stream.outer(stream.runs(spark, path)))
    assert seen == [[(0, 0)], [(0, 1)], [(0, 1), (2, 2)], [(0, 3)], [(0, 3), (4, 4)], [(0, 3), (4, 5)]]
    assert (0, 0) not in stream.runs(spark, path)  # void runs go with a later merge
    assert stream.current(spark, str(tmp_path / "none")).count() == 0


def test_csv_names_and_digests(spark, tmp_path):
    import hashlib

    (tmp_path / "w.csv").write_text("Sr. No,State Name (LGD),state name  lgd\n1,RJ,x\n")
    df = grids.read_wide_csv(spark, str(tmp_path / "w.csv"))
    assert df.columns == ["sr_no", "state_name_lgd", "state_name_lgd_1"] and df.first()["state_name_lgd"] == "RJ"
    assert grids.file_digests(spark, str(tmp_path / "w.csv")).first()["sha1"] == hashlib.sha1((tmp_path / "w.csv").read_bytes()).hexdigest()


def test_replace_table_and_georeferenced(spark):
    rows = spark.createDataFrame([(1, "EPSG:4326", 0.1, 0.1), (2, "", 0.1, 0.1), (3, "EPSG:4326", 0.0, 0.1), (4, None, 0.1, 0.1)], "id int, crs string, pixel_width double, pixel_height double")
    assert [r["id"] for r in grids.georeferenced(rows).collect()] == [1]
    for part in (rows, rows.filter("id = 2")):
        sinks.replace_table(part, "replaced_rows")
    assert [r["id"] for r in spark.table("replaced_rows").collect()] == [2]
    spark.sql("DROP TABLE replaced_rows")


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    names = "form_id long, region_id int, reporting_date date, " + ", ".join(f"{n} string" for n in incidents.NAMES)
    row = lambda i, day, status: (i, 1, day, "1.5", "70.5", "7", "Mammal", "Deer", status, "V", None, "05-Jan-24")
    frame = lambda rows: spark.createDataFrame(rows, names.replace("reporting_date date", "reporting_date string")).withColumn("reporting_date", F.to_date("reporting_date"))
    path, run = str(tmp_path / "t"), stream.upsert_batch(str(tmp_path / "t"))
    first, second = frame([row(1, "2024-01-01", "new"), row(2, "2024-01-02", "b"), row(2, "2024-01-02", "a"), row(2, "2024-01-01", "c")]), frame([row(1, "2024-01-01", "closed")])
    assert stream.current(spark, path).count() == 0
    for n, batch in ((0, first), (1, second), (1, second)):
        run(batch, n)
    assert {r["form_id"]: (r["status"], r["request_id"]) for r in stream.current(spark, path).collect()} == {1: ("closed", 7.0), 2: ("b", 7.0)}


def test_ordered_export_and_features_by_period(spark, tmp_path):
    """Files in order of their names make one sorted list, and each period's folder has its features."""
    rows = spark.range(500).selectExpr("id * 37 % 501 as k", "cast(id as string) as v").repartition(7)
    sinks.write_ordered(rows, str(tmp_path / "o"), ["k"])
    lines = [line for f in sorted((tmp_path / "o").glob("part-*")) for line in f.read_text().splitlines()[1:]]
    assert [int(x.split(",")[0]) for x in lines] == sorted(i * 37 % 501 for i in range(500))
    sinks.write_ordered(rows.limit(0), str(tmp_path / "e"), ["k"])
    shapes = spark.createDataFrame([(2020, 1, "a", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]), (2020, 2, None, None)], "year int, period int, name string, ring array<struct<x:double,y:double>>")
    sinks.write_periods(shapes, str(tmp_path / "g"), "geojson")
    first = json.loads(next((tmp_path / "g/year=2020/period=1").glob("part-*")).read_text())
    assert first["properties"] == {"year": 2020, "period": 1, "name": "a"} and first["geometry"]["coordinates"][0][0] == first["geometry"]["coordinates"][0][-1]
    assert json.loads(next((tmp_path / "g/year=2020/period=2").glob("part-*")).read_text())["geometry"] is None


def test_statements_find_ids_themselves(spark):
    from verdure.operators import publish

    raw = spark.createDataFrame([("b", "l'1", 2.345), ("a", "l'1", 1.0), ("c", "l'1", None), ("a", "m", 0.005)], "code string, label string, value double")
    got = {(r.label, r.block): r.statement for r in publish.lookup_statements(raw, "It's", block=1).collect()}
    assert set(got) == {("l'1", 0), ("l'1", 1), ("m", 0)} and "('b', 'l''1', 2.35)" in got["l'1", 1] and "p.name = 'It''s'" in got["m", 0] and "0.01" in got["m", 0] and "r.type" not in got["m", 0]
