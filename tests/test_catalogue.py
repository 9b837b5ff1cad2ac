"""Every registered query of the library against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from verdure.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def norm(row):
    return tuple("null" if v is None or isinstance(v, float) and math.isnan(v) else repr(round(v, 6)) if isinstance(v, float) else repr(v) for v in row)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(norm(r[c] for c in cols) for r in df.collect())
    if name not in catalogue.ORACLES:
        assert got
        return
    res = con.execute(catalogue.ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    assert got == sorted(norm(r[names.index(c)] for c in cols) for r in res.fetchall())


def test_results_do_not_depend_on_partitions(spark):
    """The same rows whatever the number of shuffle partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    names = ["first_valid_composite", "green_run_length", "scene_pick_primary", "carbon_period_deltas", "scene_set_cover", "ordered_first_mosaic", "soil_moisture_labels", "zonal_weighted_mean", "rain_fortnight_total", "normal_rain_fortnight_dense", "carbon_survival_chart"]
    rows = {}
    try:
        for n in ("1", "4", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows[n] = [sorted(map(norm, catalogue.QUERIES[q](spark, SF).collect())) for q in names]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows["1"] == rows["4"] == rows["7"]
