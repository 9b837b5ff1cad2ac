"""Every registered query of the library, with the SQL that checks it."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdure.fixtures import PERIODS, ctes, load
from verdure.functions import calendar, exact, geo, indices, overlay, wkb
from verdure.operators import carbon, climate, composite, incidents, publish, raster, scenes, series, tiles
from verdure.session import work_folder
from verdure.sources import catalog, geotiff, shapefile, tilearchive
from verdure.streaming import incidents as stream

QUERIES: dict = {}
ORACLES: dict = {}


def half_up(sql: str) -> str:
    """``round(x, places)`` as in ``exact.half_up``: in decimals, with nine more places looked at."""
    m = re.search(r"(?<![\w])round\(", sql)
    if not m:
        return sql
    depth, end, comma = 1, m.end(), None
    while depth:
        depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(sql[end], 0)
        comma = end if sql[end] == "," and depth == 1 else comma
        end += 1
    x, places = sql[m.end() : comma], int(sql[comma + 1 : end - 1])
    return f"{sql[: m.start()]}CAST(ROUND(CAST({half_up(x)} AS DECIMAL(38,{places + 9})), {places}) AS DOUBLE){half_up(sql[end:])}"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = half_up(sql)
        return f

    return add


def r6(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Floating sums depend on their order; both sides are compared to ``places`` places."""
    return df.withColumns({c: exact.half_up(F.col(c), places) for c in columns})


def with_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with their ring: a box, of some the top side notched, of one none."""
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x0, x1, y0, y1 = (F.col(c) for c in ("x0", "x1", "y0", "y1"))
    box = [p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1)]
    ring = F.when(F.col("notched"), F.array(*box[:3], p((x0 + x1) / 2, y1 - 1.37), box[3])).otherwise(F.array(*box))
    return load(spark, sf_dir, "regions").withColumn("ring", F.when(~F.col("no_geom"), ring))


EDGES = """v AS (SELECT code, name, type, 0 AS i, x0 AS x, y0 AS y, notched FROM regions WHERE NOT no_geom UNION ALL SELECT code, name, type, 1, x1, y0, notched FROM regions WHERE NOT no_geom
        UNION ALL SELECT code, name, type, 2, x1, y1, notched FROM regions WHERE NOT no_geom UNION ALL SELECT code, name, type, 3, (x0 + x1) / 2, y1 - 1.37e0, notched FROM regions WHERE NOT no_geom AND notched
        UNION ALL SELECT code, name, type, 4, x0, y1, notched FROM regions WHERE NOT no_geom),
    edges AS (SELECT code, name, type, x AS xa, y AS ya, coalesce(lead(x) OVER w, first_value(x) OVER w) AS xb, coalesce(lead(y) OVER w, first_value(y) OVER w) AS yb FROM v WINDOW w AS (PARTITION BY code ORDER BY i))"""
INSIDE = "sum(CASE WHEN (ya > {y}) <> (yb > {y}) AND {x} < (xb - xa) * ({y} - ya) / (yb - ya) + xa THEN 1 ELSE 0 END) % 2 = 1"
NODES = f"""nodes AS (SELECT DISTINCT iy, ix, lat, lon FROM rain), placed AS (SELECT iy, ix, code AS region FROM nodes, edges WHERE type = 'range' GROUP BY iy, ix, code HAVING {INSIDE.format(x='lon', y='lat')}),
    rd AS (SELECT region, time, avg(CASE WHEN rainfall >= 0 THEN rainfall END) AS rainfall, count(*) AS n, count(*) FILTER (NOT rainfall >= 0) AS missing FROM rain JOIN placed USING (iy, ix) GROUP BY region, time)"""
RAIN = f"WITH {ctes('regions', 'rain')}, {EDGES}, {NODES} "
SHORT = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"
LONG = "['january','february','march','april','may','june','july','august','september','october','november','december']"


def _region_area(p: str, q: str, b: str, d: str) -> str:
    """SQL: the area that a region has in the box (p, b, q, d), which lies in the region's box. The top side of a notched one goes down to its middle: area above height h is the integral
    of s * u - k where that is positive, u being the distance from the middle, on both sides of it."""
    s, mid = "(1.37e0 / ((x1 - x0) / 2))", "((x0 + x1) / 2)"

    def above(h: str) -> str:
        k = f"(({h}) - (y1 - 1.37e0))"
        g = lambda u: f"(CASE WHEN {s} * ({u}) > {k} THEN ({s} * ({u}) - {k}) * ({s} * ({u}) - {k}) / (2 * {s}) ELSE 0 END)"
        left = f"CASE WHEN {p} < {mid} THEN {g(f'{mid} - ({p})')} - {g(f'{mid} - least({q}, {mid})')} ELSE 0 END"
        right = f"CASE WHEN {q} > {mid} THEN {g(f'({q}) - {mid}')} - {g(f'greatest({p}, {mid}) - {mid}')} ELSE 0 END"
        return f"({left} + {right})"

    return f"(CASE WHEN notched THEN {above(b)} - {above(d)} ELSE (({q}) - ({p})) * (({d}) - ({b})) END)"


def _daily_rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return climate.rain_by_region_day(load(spark, sf_dir, "rain"), with_rings(spark, sf_dir))


@query(RAIN + f"""SELECT region, 'average_rainfall_' || year(time) || '_' || {SHORT}[month(time)] || '_fn' || CASE WHEN day(time) <= 15 THEN 1 ELSE 2 END AS label, round(sum(rainfall), 2) AS total
    FROM rd GROUP BY 1, 2""")
def rain_fortnight_total(spark, sf_dir):
    return climate.rain_by_fortnight(_daily_rain(spark, sf_dir))


@query(RAIN + "SELECT region, time, round(rainfall, 9) AS rainfall, n FROM rd")
def rain_daily_region_mean(spark, sf_dir):
    return r6(_daily_rain(spark, sf_dir).drop("missing"), "rainfall", places=9)


@query(RAIN + "SELECT region, time, n, missing FROM rd WHERE missing > 0")
def rain_quality_missing(spark, sf_dir):
    return climate.missing_days(_daily_rain(spark, sf_dir))


@query(f"WITH {ctes('rain')} SELECT time, iy, ix, rainfall FROM rain WHERE rainfall < 0 OR rainfall > 1000")
def rain_quality_anomaly(spark, sf_dir):
    return climate.anomalies(load(spark, sf_dir, "rain")).select("time", "iy", "ix", "rainfall")


@query(RAIN + "SELECT count(DISTINCT region) AS regions, count(*) AS n_rows, min(time) AS first_day, max(time) AS last_day FROM rd")
def rain_summary(spark, sf_dir):
    return climate.rain_summary(_daily_rain(spark, sf_dir))


@query(RAIN + "SELECT code FROM regions WHERE type = 'range' AND code NOT IN (SELECT region FROM placed)")
def rain_regions_without_nodes(spark, sf_dir):
    ranges = with_rings(spark, sf_dir).filter("type = 'range'")
    return ranges.select("code").join(climate.grid_regions(load(spark, sf_dir, "rain"), ranges).select(F.col("region").alias("code")), "code", "left_anti")


NORMALS = f"WITH {ctes('daily', 'regions')}, normals AS (SELECT code, month(date) AS month, day(date) AS day, avg(value) AS normal FROM daily WHERE date >= DATE '2001-06-30' - 1825 AND value IS NOT NULL GROUP BY 1, 2, 3) "


@query(NORMALS + "SELECT code, CAST(month AS INT) AS month, CAST(day AS INT) AS day, round(normal, 6) AS normal FROM normals")
def normal_rain_daily(spark, sf_dir):
    return r6(climate.daily_normals(load(spark, sf_dir, "daily"), "2001-06-30", years=5), "normal")


@query(NORMALS + f""", grid AS (SELECT code, m, fn FROM regions, (SELECT unnest(range(1, 13)) AS m), (SELECT unnest([1, 2]) AS fn))
    SELECT g.code, 'normal_rainfall_' || {SHORT}[m] || '_fn' || fn AS label, round(coalesce(sum(normal), 0), 2) AS total, count(normal) AS n_days
    FROM grid g LEFT JOIN normals n ON g.code = n.code AND n.month = m AND (CASE WHEN n.day <= 15 THEN 1 ELSE 2 END) = fn GROUP BY g.code, m, fn""")
def normal_rain_fortnight_dense(spark, sf_dir):
    return climate.fortnight_normals(climate.daily_normals(load(spark, sf_dir, "daily"), "2001-06-30", years=5), load(spark, sf_dir, "regions"))


DEPTHS = f"""WITH {ctes('wells', 'regions')}, {EDGES}, depths AS (SELECT well_id, longitude, latitude, CAST(regexp_extract(column_name, '\\d{{4}}') AS INT) AS year, CASE WHEN column_name LIKE 'pre%' THEN 'pre' ELSE 'post' END AS period,
    CASE WHEN lower(trim(raw)) = 'dry' THEN 0 WHEN lower(trim(raw)) = 'na' THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS depth
    FROM (UNPIVOT (SELECT * FROM wells WHERE state_name_with_lgd_code ILIKE 'rajasthan%') ON {', '.join(PERIODS)} INTO NAME column_name VALUE raw)) """


@query(DEPTHS + "SELECT well_id, year, period, depth FROM depths")
def well_depth_unpivot(spark, sf_dir):
    return climate.well_depths(load(spark, sf_dir, "wells")).select("well_id", "year", "period", "depth")


@query(DEPTHS + f""", placed AS (SELECT well_id, name FROM (SELECT DISTINCT well_id, longitude, latitude FROM depths), edges WHERE type = 'range' GROUP BY well_id, code, name, longitude, latitude HAVING {INSIDE.format(x='longitude', y='latitude')})
    SELECT name, year, period, round(avg(depth), 6) AS depth, count(*) AS n FROM depths JOIN placed USING (well_id) WHERE depth IS NOT NULL GROUP BY 1, 2, 3""")
def well_depth_region_period(spark, sf_dir):
    return r6(climate.depth_by_region(load(spark, sf_dir, "wells"), with_rings(spark, sf_dir)), "depth")


@query(f"""WITH {ctes('daily')}, f AS (SELECT *, CASE WHEN day(date) <= 15 THEN 1 ELSE 2 END AS fn FROM daily)
    SELECT code, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, fn, 'groundwater_trend_' || year(date) || '_' || {LONG}[month(date)] || '_fn' || fn AS label, round(avg(value * 0.1e0), 6) AS value,
        CAST(date_trunc('month', min(date)) + to_days(CASE WHEN fn = 1 THEN 0 ELSE 15 END) AS DATE) AS start_date, CASE WHEN fn = 1 THEN CAST(date_trunc('month', min(date)) + to_days(14) AS DATE) ELSE last_day(max(date)) END AS end_date
    FROM f GROUP BY 1, 2, 3, 4, 5""")
def gw_fortnight_mean(spark, sf_dir):
    return r6(climate.groundwater_fortnights(load(spark, sf_dir, "daily")), "value")


@query(f"WITH {ctes('stack', 'weights')} SELECT code, year, band, round(sum(c * value) / sum(c), 6) AS mean FROM weights JOIN stack USING (cell) GROUP BY 1, 2, 3")
def zonal_weighted_mean(spark, sf_dir):
    return r6(climate.zonal_mean(load(spark, sf_dir, "stack"), load(spark, sf_dir, "weights"), ["year", "band"]), "mean")


@query(f"WITH {ctes('stack', 'weights')} SELECT code, year, band, round(sum(c * value * value) / sum(c * value), 6) AS mean FROM weights JOIN stack USING (cell) GROUP BY 1, 2, 3")
def zonal_self_weighted_mean(spark, sf_dir):
    return r6(climate.self_weighted_mean(load(spark, sf_dir, "stack"), load(spark, sf_dir, "weights"), ["year", "band"]), "mean")


@query(f"""WITH {ctes('regions')}, g AS (SELECT *, unnest(range(CAST(floor(x0 / 0.5) AS BIGINT), CAST(ceil(x1 / 0.5) AS BIGINT))) AS gx FROM regions WHERE NOT no_geom),
    h AS (SELECT *, unnest(range(CAST(floor(y0 / 0.5) AS BIGINT), CAST(ceil(y1 / 0.5) AS BIGINT))) AS gy FROM g),
    b AS (SELECT *, greatest(x0, gx * 0.5e0) AS p, least(x1, (gx + 1) * 0.5e0) AS q, greatest(y0, gy * 0.5e0) AS b, least(y1, (gy + 1) * 0.5e0) AS d FROM h), a AS (SELECT code, gx, gy, {_region_area('p', 'q', 'b', 'd')} / 0.25e0 AS c FROM b)
    SELECT code, gx, gy, round(c, 6) AS c FROM a WHERE c > 1e-9""")
def zonal_exact_coverage(spark, sf_dir):
    return r6(geo.coverage_weights(with_rings(spark, sf_dir), 0.5, ["code"]).filter("c > 1e-9"), "c")


@query(f"""WITH {ctes('stack', 'weights')}, m AS (SELECT code, year, band, sum(c * value) / sum(c) AS mean FROM weights JOIN stack USING (cell) GROUP BY 1, 2, 3)
    SELECT code, 'soil_moisture_' || year || '_' || {LONG}[(band - 1) // 2 + 1] || '_fn' || CASE WHEN band % 2 = 0 THEN 2 ELSE 1 END AS label, round(mean * 100, 2) AS value FROM m""")
def soil_moisture_labels(spark, sf_dir):
    return climate.soil_moisture(load(spark, sf_dir, "stack"), load(spark, sf_dir, "weights"))


PUBLISH = f"WITH {ctes('raw_values', 'region_codes', 'snapshots', 'products')}, live AS (SELECT s.* FROM snapshots s JOIN products p ON p.id = product_id WHERE s.deleted_at IS NULL AND p.deleted_at IS NULL) "


def _published(spark, sf_dir, how):
    return how(*(load(spark, sf_dir, n) for n in ("raw_values", "region_codes", "snapshots", "products")))


@query(PUBLISH + "SELECT s.id AS snapshot_id, region_id, CAST(round(value, 2) AS DOUBLE) AS value FROM raw_values JOIN region_codes USING (code) JOIN live s USING (label)")
def publish_join(spark, sf_dir):
    return _published(spark, sf_dir, publish.publish).withColumn("value", F.get_json_object("value", "$.value").cast("double"))


_HEAD = "INSERT INTO data_product_snapshots_data (data_product_snapshot_id, region_id, value, created_at, updated_at) SELECT s.id, r.id, to_jsonb(v.value), now(), now() FROM (VALUES "
_TAIL = ") AS v (code, label, value) JOIN regions AS r ON r.code = v.code AND r.deleted_at IS NULL AND r.type = 'range' JOIN data_product_snapshots AS s ON s.label = v.label AND s.deleted_at IS NULL JOIN data_products AS p ON p.id = s.data_product_id AND p.deleted_at IS NULL AND p.name = 'Soil moisture';"


@query(PUBLISH + f""", b AS (SELECT *, chr(39) AS q, CAST((row_number() OVER (PARTITION BY label ORDER BY code) - 1) // 10 AS INT) AS block FROM raw_values WHERE value IS NOT NULL)
    SELECT label, block, $${_HEAD}$$ || string_agg('(' || q || code || q || ', ' || q || label || q || ', ' || CAST(CAST(round(CAST(CAST(value AS VARCHAR) AS DECIMAL(38,11)), 2) AS DECIMAL(18,2)) AS VARCHAR) || ')', ', ' ORDER BY code) || $${_TAIL}$$ AS statement FROM b GROUP BY 1, 2""")
def publish_statements(spark, sf_dir):
    """Values are rounded as the decimals that they are written as: 327106.975 is a half, though its double lies a little under it."""
    return publish.lookup_statements(load(spark, sf_dir, "raw_values"), "Soil moisture", "range", 10)


@query(PUBLISH + """SELECT code, label, round(value, 6) AS value, CASE WHEN code NOT IN (SELECT code FROM region_codes) THEN 'no region' ELSE 'no snapshot' END AS reason FROM raw_values
    WHERE code NOT IN (SELECT code FROM region_codes) OR label NOT IN (SELECT label FROM live)""")
def publish_rejects(spark, sf_dir):
    return r6(_published(spark, sf_dir, publish.rejects), "value")


WANTED = "SELECT DISTINCT o_custkey % 5 AS product_id, 'label_' || (o_orderkey % 14) AS label FROM orders"


def _wanted(spark, sf_dir):
    return spark.sql(WANTED.replace("FROM orders", "FROM {orders}"), orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))


@query(f"""WITH {ctes('snapshots')}, wanted AS ({WANTED}), live AS (SELECT * FROM snapshots WHERE deleted_at IS NULL)
    SELECT w.product_id, w.label, live.id AS live_id, live.id IS NULL AS created FROM wanted w LEFT JOIN live ON live.product_id = w.product_id AND live.label = w.label""")
def snapshot_get_or_create(spark, sf_dir):
    out = publish.get_or_create(_wanted(spark, sf_dir), load(spark, sf_dir, "snapshots"))
    return out.select("product_id", "label", F.when(~F.col("created"), F.col("id").cast("int")).alias("live_id"), "created")


@query(PUBLISH + """, rows AS (SELECT s.id AS snapshot_id, s.product_id, region_id, round(value, 2) AS value FROM raw_values JOIN region_codes USING (code) JOIN live s USING (label)) SELECT snapshot_id, region_id, value FROM rows WHERE product_id = 1""")
def snapshot_semi_join(spark, sf_dir):
    return publish.of_snapshots(publish_join(spark, sf_dir), load(spark, sf_dir, "snapshots").filter("product_id = 1"))


_VALUE = lambda n: f"max_by(value, seq) FILTER (name = '{n}') AS {n}"
INCIDENTS = f"""WITH {ctes('forms', 'form_values')}, latest AS (SELECT form_id, name, value FROM form_values QUALIFY row_number() OVER (PARTITION BY form_id, name ORDER BY seq DESC) = 1),
    a AS (SELECT form_id, region_id, {', '.join(f"max(value) FILTER (name = '{n}') AS {n}" for n in incidents.NAMES)} FROM forms JOIN latest USING (form_id)
        WHERE status IN ('submitted', 'acknowledged') AND template = 'animal-rescue' AND reporting_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25' GROUP BY 1, 2),
    d AS (SELECT *, regexp_extract(trim(date_of_reporting), '^(\\d{{1,2}})-(Jan|Feb)-(\\d{{4}}|\\d{{2}})$', ['d', 'm', 'y']) AS p, coalesce(TRY_CAST(request_id AS BIGINT), 0) AS request FROM a),
    e AS (SELECT *, CASE WHEN p.d <> '' AND p.m = 'Jan' AND CAST(p.d AS INT) BETWEEN 1 AND 31 THEN make_date(CAST(p.y AS INT) % 2000 + 2000, 1, CAST(p.d AS INT)) END AS rescue_date FROM d),
    i AS (SELECT 'rescue_' || form_id AS incident_id, form_id, region_id, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude, CAST(CASE WHEN request > 0 THEN request END AS DOUBLE) AS request_id,
        lower(nullif(trim(animal_category), '')) AS category, lower(nullif(trim(animal_species), '')) AS species, coalesce(lower(nullif(trim(process_status), '')), 'unknown') AS status, nullif(trim(village_town), '') AS village,
        nullif(trim(beat_naka), '') AS beat_naka, rescue_date, trim(animal_category) || ' - ' || trim(animal_species) || ' rescue' || CASE WHEN request <> 0 THEN ' (Request: ' || request || ')' ELSE '' END AS description FROM e),
    incidents AS (SELECT *, 'animal_rescue_' || year(rescue_date) AS label FROM i
        WHERE latitude <> 0 AND longitude <> 0 AND NOT isnan(latitude) AND NOT isnan(longitude) AND category IS NOT NULL AND species IS NOT NULL AND rescue_date IS NOT NULL) """


def _incidents(spark, sf_dir):
    return incidents.extract(incidents.form_attributes(load(spark, sf_dir, "forms"), load(spark, sf_dir, "form_values"), "animal-rescue", None, "2024-01-03", "2024-01-25"))


@query(INCIDENTS + "SELECT * FROM incidents")
def incident_extract(spark, sf_dir):
    return _incidents(spark, sf_dir)


@query(INCIDENTS + """SELECT incidents.* REPLACE (CASE WHEN form_id % 2 = 0 THEN 'moved' ELSE status END AS status), CAST(reporting_date + CASE WHEN form_id % 2 = 0 THEN 1 ELSE 0 END AS DATE) AS reporting_date
    FROM incidents JOIN (SELECT form_id, reporting_date FROM forms) USING (form_id)""")
def incident_stream(spark, sf_dir):
    """Forms as a stream of files, a batch each, with later and earlier submissions of the same forms in any order; runs are merged in twos."""
    rows = incidents.form_attributes(load(spark, sf_dir, "forms"), load(spark, sf_dir, "form_values"), "animal-rescue", None, "2024-01-03", "2024-01-25")
    again = lambda n, days, status: rows.filter(F.col("form_id") % n == 0).withColumns({"reporting_date": F.date_add("reporting_date", days), "process_status": F.lit(status)})
    forms, path, checkpoint = (work_folder(spark, n) for n in ("forms", "incidents", "progress"))
    rows.unionByName(again(2, 1, "Moved")).unionByName(again(3, -2, "Found")).repartition(5).write.parquet(forms)
    stream.start(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(forms), path, checkpoint, fan=2).awaitTermination()
    return stream.current(spark, path)


@query(INCIDENTS + """SELECT incident_id, region_id, CASE WHEN form_id % 3 = 0 THEN 'closed' ELSE status END AS status FROM incidents WHERE form_id % 2 = 0 OR form_id % 3 = 0""")
def incident_upsert(spark, sf_dir):
    rows = _incidents(spark, sf_dir)
    cols = ["incident_id", "region_id", "status"]
    return publish.upsert(rows.filter("form_id % 2 = 0").select(cols), rows.filter("form_id % 3 = 0").withColumn("status", F.lit("closed")).select(cols), "incident_id")


@query(INCIDENTS + """SELECT incident_id, CASE WHEN form_id % 7 = 0 THEN DATE '2023-01-01' WHEN form_id % 4 = 0 THEN DATE '2024-02-01' END AS deleted_at, CASE WHEN form_id % 4 = 0 AND form_id % 7 <> 0 THEN DATE '2024-02-01' ELSE rescue_date END AS updated_at FROM incidents""")
def incident_soft_delete(spark, sf_dir):
    rows = _incidents(spark, sf_dir)
    kept = rows.select("incident_id", F.when(F.col("form_id") % 7 == 0, F.to_date(F.lit("2023-01-01"))).alias("deleted_at"), F.col("rescue_date").alias("updated_at"))
    return publish.soft_delete(kept, rows.filter("form_id % 4 = 0"), "incident_id", "2024-02-01")


@query(INCIDENTS + """, l AS (SELECT unnest([{'facet': 'category', 'key': category}, {'facet': 'species', 'key': species}, {'facet': 'status', 'key': status}, {'facet': 'month', 'key': strftime(rescue_date, '%Y-%m')}, {'facet': 'total', 'key': 'all'}]) AS u FROM incidents)
    SELECT u.facet AS facet, u.key AS key, count(*) AS n FROM l GROUP BY 1, 2""")
def incident_stats_facets(spark, sf_dir):
    return incidents.facets(_incidents(spark, sf_dir))


@query(INCIDENTS + """, s AS (SELECT * FROM incidents WHERE form_id % 7 <> 0 AND rescue_date BETWEEN DATE '2024-01-01' AND DATE '2024-12-31' AND region_id < 9)
    SELECT 'category' AS facet, category AS key, count(*) AS n FROM s GROUP BY 2 UNION ALL SELECT 'species', species, count(*) FROM s GROUP BY 2 UNION ALL SELECT 'status', status, count(*) FROM s GROUP BY 2
    UNION ALL SELECT 'month', strftime(rescue_date, '%Y-%m'), count(*) FROM s GROUP BY 2 UNION ALL SELECT 'total', 'all', count(*) FROM s""")
def incident_statistics(spark, sf_dir):
    rows = _incidents(spark, sf_dir).filter("region_id < 9").withColumn("deleted_at", F.when(F.col("form_id") % 7 == 0, F.to_date(F.lit("2024-02-01"))))
    return incidents.statistics(rows, "2024-01-01", "2024-12-31")


STORED = {"key": "incidentKey", "form": "formId", "day": "rescueDate", "request": "requestId", "category": "animalCategory", "species": "animalSpecies", "status": "processStatus", "lat": "coordinates.latitude", "village": "villageTown", "naka": "beatNaka", "description": "description"}
STORED_SQL = "incident_id AS key, CAST(form_id AS VARCHAR) AS form, CAST(rescue_date AS VARCHAR) AS day, CAST(request_id AS VARCHAR) AS request, category, species, status, CAST(latitude AS VARCHAR) AS lat, village, beat_naka AS naka, description"


@query(INCIDENTS + f"SELECT label, region_id, {STORED_SQL} FROM incidents")
def incident_product_rows(spark, sf_dir):
    rows = incidents.product_rows(_incidents(spark, sf_dir), load(spark, sf_dir, "snapshots"), 2)
    return rows.select("label", "region_id", *(F.get_json_object("value", f"$.{c}").alias(n) for n, c in STORED.items()))


@query(INCIDENTS + """SELECT incident_id AS key, region_id, CASE WHEN form_id % 3 = 0 THEN 'closed' ELSE status END AS status, CASE WHEN form_id % 2 = 0 THEN DATE '2024-01-31' ELSE DATE '2024-02-05' END AS created_at,
    CASE WHEN form_id % 3 = 0 THEN DATE '2024-02-05' ELSE DATE '2024-01-31' END AS updated_at FROM incidents WHERE form_id % 2 = 0 OR form_id % 3 = 0""")
def incident_product_upsert(spark, sf_dir):
    rows, snapshots = _incidents(spark, sf_dir), load(spark, sf_dir, "snapshots")
    day = F.to_date(F.lit("2024-01-31"))
    stored = incidents.product_rows(rows.filter("form_id % 2 = 0"), snapshots, 2).select("snapshot_id", "region_id", "value", day.alias("created_at"), day.alias("updated_at"))
    changes = incidents.product_rows(rows.filter("form_id % 3 = 0").withColumn("status", F.lit("closed")), snapshots, 2)
    out = incidents.store_rows(stored, changes, "2024-02-05")
    return out.select(F.get_json_object("value", "$.incidentKey").alias("key"), "region_id", F.get_json_object("value", "$.processStatus").alias("status"), "created_at", "updated_at")


@query(INCIDENTS + """SELECT incident_id AS key, region_id, CASE WHEN form_id % 3 = 0 THEN 'closed' ELSE status END AS status, CASE WHEN region_id % 4 = 1 THEN DATE '2024-02-02' END AS deleted_at,
    CASE WHEN form_id % 3 = 0 THEN DATE '2024-02-05' WHEN region_id % 4 = 1 THEN DATE '2024-02-02' ELSE DATE '2024-01-31' END AS updated_at FROM incidents""")
def incident_delete_then_upsert(spark, sf_dir):
    """Deleted incidents stay deleted when a later batch changes them."""
    rows, snapshots = _incidents(spark, sf_dir), load(spark, sf_dir, "snapshots")
    day = F.to_date(F.lit("2024-01-31"))
    stored = incidents.product_rows(rows, snapshots, 2).select("snapshot_id", "region_id", "value", day.alias("created_at"), day.alias("updated_at"), F.lit(None).cast("date").alias("deleted_at"))
    gone = stored.filter("region_id % 4 = 1").select("region_id").distinct()
    changes = incidents.product_rows(rows.filter("form_id % 3 = 0").withColumn("status", F.lit("closed")), snapshots, 2)
    out = incidents.store_rows(publish.soft_delete(stored, gone, "region_id", "2024-02-02"), changes, "2024-02-05")
    return out.select(F.get_json_object("value", "$.incidentKey").alias("key"), "region_id", F.get_json_object("value", "$.processStatus").alias("status"), "deleted_at", "updated_at")


_NUM = lambda c, default="0e0": f"coalesce(TRY_CAST({c} AS DOUBLE), {default})"


def _stock(months: str, survival: str) -> str:
    d = f"({_NUM('increment')} * ({months}) / 12)"
    volume = f"(CASE WHEN {d} <= 0 THEN 0 ELSE CASE id % 3 WHEN 0 THEN 0.0005e0 * {d} * {d} + greatest(0.01e0, 0.002e0 * {d}) WHEN 1 THEN 0.001e0 * {d} ELSE sqrt({d}) * 0.003e0 END END)"
    above = f"({volume} * {_NUM('wood_density')})"
    return f"({above} * (1 + {_NUM('root_shoot')} + {_NUM('bef')}) * {_NUM('carbon_fraction')} * {survival} / 100e0 * {_NUM('co2_factor', '3.67e0')})"


@query(f"WITH {ctes('species')} SELECT id, round({_stock('120e0', '60e0')} * num_trees, 6) AS co2 FROM species")
def carbon_at_year(spark, sf_dir):
    return r6(carbon.at_year(load(spark, sf_dir, "species"), 10, 60.0), "co2")


@query(f"WITH {ctes('species')} SELECT id, round({_stock('180e0', '80e0')} * num_trees / 1000 / 2.5e0, 6) AS tonnes_per_ha FROM species")
def carbon_per_hectare(spark, sf_dir):
    return r6(carbon.per_hectare(load(spark, sf_dir, "species"), 2.5, 15, 80.0), "tonnes_per_ha")


def _carbon_sql(rates: str) -> str:
    return f"""WITH {ctes('species')}, f AS (SELECT min(make_date(plant_year, plant_month, 1)) AS p FROM species), b AS (SELECT CAST(p + INTERVAL 1 MONTH AS DATE) AS lo, CAST(p + INTERVAL 361 MONTH AS DATE) AS hi FROM f),
    ys AS (SELECT lo, hi, unnest(range(year(lo), year(hi) + 1)) AS y FROM b), pr AS (SELECT greatest(lo, make_date(y, 1, 1)) AS s, least(hi, make_date(y + 1, 1, 1)) AS e FROM ys),
    periods AS (SELECT row_number() OVER (ORDER BY s) AS no, s, e, strftime(s, '%b %Y') || '-' || strftime(e - 1, '%b %Y') AS label FROM pr WHERE s < e),
    r AS (SELECT sp.*, no, label, survival, date_diff('month', greatest(s, CAST(make_date(plant_year, plant_month, 1) + INTERVAL 1 MONTH AS DATE)), e) AS k FROM species sp, periods, (SELECT unnest([{rates}]) AS survival)
        WHERE e > CAST(make_date(plant_year, plant_month, 1) + INTERVAL 1 MONTH AS DATE)),
    m AS (SELECT *, sum(k) OVER (PARTITION BY id, survival ORDER BY no) AS months FROM r),
    h AS (SELECT *, coalesce(floor((months - k) / 12.0 / harvest_cycle) < floor(months / 12.0 / harvest_cycle), FALSE) AS harvested FROM m),
    x AS (SELECT *, coalesce(sum(CAST(harvested AS INT)) OVER (PARTITION BY id, survival ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM h),
    st AS (SELECT *, {_stock('CASE WHEN harvested THEN harvest_cycle * 12 ELSE months END', 'survival')} * num_trees * CASE WHEN harvested THEN coalesce(retention, 0) / 100 ELSE 1 END AS stock FROM x WHERE earlier = 0),
    d AS (SELECT *, stock - coalesce(lag(stock) OVER (PARTITION BY id, survival ORDER BY no), 0) AS delta FROM st) """


def _deltas(spark, sf_dir, survival=(60,)):
    return carbon.deltas(load(spark, sf_dir, "species"), survival=survival)


@query(_carbon_sql("60") + "SELECT id, name, CAST(survival AS INT) AS survival, CAST(no AS INT) AS no, label, CAST(months AS BIGINT) AS months, round(stock, 4) AS stock, round(delta, 4) AS delta, harvested FROM d")
def carbon_period_deltas(spark, sf_dir):
    return r6(_deltas(spark, sf_dir), "stock", "delta", places=4)


SUMMED = "CAST(sum(CAST(delta AS DECIMAL(27,9))) AS DOUBLE)"


@query(_carbon_sql("60") + f""", u AS (SELECT name, no, delta FROM d UNION ALL SELECT 'Total', no, delta FROM d), g AS (SELECT * FROM (SELECT DISTINCT name FROM u), (SELECT DISTINCT no FROM u)), a AS (SELECT g.name, g.no, coalesce({SUMMED}, 0) / 1e6 AS annual FROM g LEFT JOIN u ON g.name = u.name AND g.no = u.no GROUP BY 1, 2)
    SELECT name, CAST(no AS INT) AS no, round(annual, 6) AS annual, round(sum(annual) OVER (PARTITION BY name ORDER BY no), 6) AS running FROM a""")
def carbon_cumulative(spark, sf_dir):
    return r6(carbon.cumulative(_deltas(spark, sf_dir)), "annual", "running")


@query(_carbon_sql("60") + f"""SELECT CAST(i AS INT) AS species_index, name, CAST(no AS INT) AS year, label, round(coalesce(own, 0) / 1e6, 6) AS co2, round(last / 1e6, 6) AS last_period_co2
    FROM (SELECT * FROM (SELECT name, row_number() OVER (ORDER BY min(id)) - 1 AS i FROM d GROUP BY 1), (SELECT DISTINCT no, label FROM d), (SELECT {SUMMED} AS last FROM d WHERE no = (SELECT max(no) FROM d))) LEFT JOIN (SELECT name, no, {SUMMED} AS own FROM d GROUP BY 1, 2) USING (name, no)""")
def carbon_species_breakdown(spark, sf_dir):
    return r6(carbon.species_breakdown(_deltas(spark, sf_dir)), "co2", "last_period_co2")


NAMES = ["Brand#11", "Brand#12", "Brand#21"]


@query(_carbon_sql("60") + f"""SELECT CAST(no AS INT) AS no, label, {', '.join(f'round(coalesce({SUMMED[:-11]} FILTER (name = {chr(39)}{n}{chr(39)}) AS DOUBLE), 0) / 1e6, 6) AS "{n}"' for n in NAMES)},
    round({SUMMED} / 1e6, 6) AS total FROM d GROUP BY 1, 2""")
def carbon_pivot_total(spark, sf_dir):
    out = carbon.pivot_total(_deltas(spark, sf_dir), NAMES)
    return out.select("no", "label", *(exact.half_up(F.col(f"`{c}`"), 6).alias(c) for c in [*NAMES, "total"]))


CHART = _carbon_sql("40, 60, 80, 100") + f", e AS (SELECT CAST(survival AS INT) AS survival, CAST(no AS INT) AS year, label, {SUMMED} AS d FROM d GROUP BY 1, 2, 3), c AS (SELECT survival, year, label, sum(d) OVER (PARTITION BY survival ORDER BY year) AS co2 FROM e) "


@query(CHART + "SELECT survival, year, label, round(co2, 3) AS co2 FROM c")
def carbon_survival_chart(spark, sf_dir):
    return r6(carbon.survival_chart(_deltas(spark, sf_dir, (40, 60, 80, 100))), "co2", places=3)


@query(CHART + "SELECT survival, CAST(asked AS INT) AS asked, year, label, round(co2, 3) AS co2 FROM c JOIN (SELECT unnest([1, 5, 10, 30, 99]) AS asked) ON year = least(asked, (SELECT max(year) FROM c))")
def carbon_requested_years(spark, sf_dir):
    return r6(carbon.of_years(carbon.survival_chart(_deltas(spark, sf_dir, (40, 60, 80, 100))), [1, 5, 10, 30, 99]), "co2", places=3)


MAXED = "max(CASE WHEN scl IN (4, 5, 6) AND red + nir > 0 THEN (nir - red) / CAST(red + nir AS DOUBLE) END)"
ENCODED = f"coalesce(CAST(floor(least(200, greatest(0, ({MAXED} + 1) * 100))) AS INT), 0)"


@query(f"WITH {ctes('pixels')} SELECT tile, y, x, round({MAXED}, 6) AS ndvi, {MAXED} IS NOT NULL AS valid, {ENCODED} AS value FROM pixels GROUP BY 1, 2, 3")
def max_ndvi_composite(spark, sf_dir):
    return r6(composite.max_composite(load(spark, sf_dir, "pixels"), ["tile", "y", "x"]), "ndvi")


@query(f"""WITH {ctes('pixels')}, s AS (SELECT *, CASE WHEN month(day) IN (4, 5) THEN year(day) || '_apr_may' WHEN month(day) IN (11, 12) THEN year(day) || '_nov_dec' END AS season FROM pixels),
    t AS (SELECT season, tile, y, x, {ENCODED} AS value FROM s WHERE season IS NOT NULL GROUP BY 1, 2, 3, 4) SELECT season, y, x, max(value) AS value FROM t GROUP BY 1, 2, 3""")
def season_mosaic_max(spark, sf_dir):
    return composite.season_mosaic(load(spark, sf_dir, "pixels"))


@query(f"WITH {ctes('pixels')} SELECT tile, y, x, red, nir, blue FROM pixels WHERE scl NOT IN (0, 3, 8, 9, 10) QUALIFY row_number() OVER (PARTITION BY tile, y, x ORDER BY day, seq) = 1")
def first_valid_composite(spark, sf_dir):
    return composite.first_valid(load(spark, sf_dir, "pixels"), ["tile", "y", "x"], ["red", "nir", "blue"])


@query(f"WITH {ctes('layers')} SELECT y, x, coalesce(arg_min(value, chunk) FILTER (value <> 0), 0) AS value FROM layers GROUP BY 1, 2")
def ordered_first_mosaic(spark, sf_dir):
    return composite.ordered_mosaic(load(spark, sf_dir, "layers"))


@query(f"""WITH {ctes('pixels')} SELECT tile, count(*) FILTER (scl NOT IN (8, 9, 10) AND nir <> red) AS in_series, count(*) FILTER (scl NOT IN (0, 3, 8, 9, 10)) AS in_composite, count(*) FILTER (scl IN (4, 5, 6) AND red + nir > 0) AS in_mosaic
    FROM pixels GROUP BY 1""")
def scl_valid_counts(spark, sf_dir):
    return composite.class_counts(load(spark, sf_dir, "pixels"))


@query(f"""WITH {ctes('pixels')} SELECT seq, round(CASE WHEN red + nir > 0 THEN (nir - red) / CAST(red + nir AS DOUBLE) END, 6) AS plain, round((nir - red) / (CAST(nir AS DOUBLE) + red + 1e-3), 6) AS series,
    round((nir - red) / (CAST(nir AS DOUBLE) + red + 1e-8), 6) AS composite FROM pixels""")
def ndvi_three_variants(spark, sf_dir):
    r, n = F.col("red"), F.col("nir")
    return r6(load(spark, sf_dir, "pixels").select("seq", indices.ndvi(r, n).alias("plain"), indices.ndvi_series(r, n).alias("series"), indices.ndvi_composite(r, n).alias("composite")), "plain", "series", "composite")


BANDS = ["red", "green", "blue", "nir", "swir"]
FCD = f"""WITH {ctes('pixels')}, c AS (SELECT tile AS chunk, y, x, {', '.join(f'{b} / 10000e0 AS {b}' for b in BANDS)} FROM pixels WHERE scl NOT IN (0, 3, 8, 9, 10) QUALIFY row_number() OVER (PARTITION BY tile, y, x ORDER BY day, seq) = 1),
    n AS (SELECT *, (nir - red) / (nir + red + 1e-8) AS ndvi, ((swir + blue) - (nir + red)) / ((swir + blue) + (nir + red) + 1e-8) AS bsi FROM c),
    g AS (SELECT *, max(green) OVER w AS mg, max(red) OVER w AS mr, max(ndvi) OVER w AS mx, min(ndvi) OVER w AS mn FROM n WINDOW w AS (PARTITION BY chunk)),
    f AS (SELECT chunk, y, x, CAST(floor(least(255, 100 * sqrt((ndvi - mn) / (mx - mn + 1e-8) * sqrt(sqrt((mg - green) * (mr - red)) * abs(bsi))))) AS INT) AS fcd FROM g),
    k AS (SELECT *, CASE WHEN fcd > 75 THEN 4 WHEN fcd > 50 THEN 3 WHEN fcd > 25 THEN 2 WHEN fcd > 0 THEN 1 ELSE 0 END AS class FROM f) """


def _fcd(spark, sf_dir):
    return composite.canopy_density(composite.first_valid(load(spark, sf_dir, "pixels"), ["tile", "y", "x"], BANDS).withColumnRenamed("tile", "chunk"))


@query(f"WITH {ctes('pixels')} SELECT tile, y, x, day, arg_min(red, seq) AS red, arg_min(nir, seq) AS nir FROM pixels GROUP BY 1, 2, 3, 4")
def solar_day_scenes(spark, sf_dir):
    return composite.by_solar_day(load(spark, sf_dir, "pixels"), ["tile", "y", "x"], ["red", "nir"])


@query(f"WITH {ctes('pixels')} SELECT y, x, arg_min(scl, (day, seq)) AS value FROM pixels WHERE day >= DATE '1997-05-01' AND day < DATE '1998-05-01' GROUP BY 1, 2")
def annual_land_cover(spark, sf_dir):
    rows = load(spark, sf_dir, "pixels").select("y", "x", F.struct("day", "seq").alias("at"), "day", F.col("scl").alias("value"))
    firsts = rows.groupBy("y", "x", "day").agg(F.min_by("value", "at").alias("value"))
    return composite.annual_cover(firsts, 1997, ["y", "x"])


@query()
def cloud_free_composite(spark, sf_dir):
    p = load(spark, sf_dir, "pixels").select(F.col("tile").alias("chunk"), (F.col("seq") % 23).alias("scene"), (F.col("y") * 100 + F.col("x")).cast("long").alias("pixel"), "scl", "red", "nir")
    return composite.cloud_free(p, ["red", "nir"])


@query(FCD + "SELECT chunk, y, x, fcd FROM f")
def fcd_chunk_relative(spark, sf_dir):
    return _fcd(spark, sf_dir)


@query(FCD + "SELECT chunk, class, count(*) AS n FROM k GROUP BY 1, 2")
def fcd_classes(spark, sf_dir):
    return composite.classify(_fcd(spark, sf_dir), "RJ", "fcd").groupBy("chunk", "class").agg(F.count("*").alias("n"))


@query(f"""WITH {ctes('layers', 'mask')}, m AS (SELECT y, x, coalesce(arg_min(value, chunk) FILTER (value <> 0), 0) AS v FROM layers GROUP BY 1, 2)
    SELECT y, x, CASE WHEN forest <> 1 THEN 0 WHEN v > 75 THEN 4 WHEN v > 50 THEN 3 WHEN v > 25 THEN 2 WHEN v > 0 THEN 1 ELSE 0 END AS class FROM m JOIN mask USING (y, x)""")
def canopy_masked(spark, sf_dir):
    return composite.masked(composite.classify(composite.ordered_mosaic(load(spark, sf_dir, "layers")), "RJ"), load(spark, sf_dir, "mask"))


FILLED = f"""WITH {ctes('series')}, q AS (SELECT *, last_value(CASE WHEN ndvi IS NOT NULL THEN step END IGNORE NULLS) OVER b AS ps, last_value(ndvi IGNORE NULLS) OVER b AS pv, first_value(CASE WHEN ndvi IS NOT NULL THEN step END IGNORE NULLS) OVER a AS ns,
        first_value(ndvi IGNORE NULLS) OVER a AS nv FROM series WINDOW b AS (PARTITION BY pixel ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY pixel ORDER BY step ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    filled AS (SELECT pixel, step, lulc, CASE WHEN ps = ns THEN pv WHEN ps IS NULL THEN nv WHEN ns IS NULL THEN pv ELSE pv + (nv - pv) * (step - ps) / CAST(ns - ps AS DOUBLE) END AS v FROM q),
    hi0 AS (SELECT *, max(greatest(v, 0.123e0)) OVER (PARTITION BY pixel ORDER BY step ROWS 2 PRECEDING) AS h0 FROM filled), hi AS (SELECT *, CASE WHEN step < 2 THEN max(CASE WHEN step = 2 THEN h0 END) OVER (PARTITION BY pixel) ELSE h0 END AS high FROM hi0),
    sm0 AS (SELECT *, avg(high) OVER (PARTITION BY pixel ORDER BY step ROWS 2 PRECEDING) AS s0 FROM hi), sm AS (SELECT *, CASE WHEN step < 2 THEN max(CASE WHEN step = 2 THEN s0 END) OVER (PARTITION BY pixel) ELSE s0 END AS smooth FROM sm0),
    meds AS (SELECT pixel, any_value(lulc) AS lulc, count(*) FILTER (v > 0.20) AS n_green, median(smooth) FILTER (step BETWEEN 18 AND 26) AS l, median(smooth) FILTER (step BETWEEN 13 AND 17) AS c, median(smooth) FILTER (step BETWEEN 7 AND 12) AS r FROM sm GROUP BY 1),
    isl AS (SELECT pixel, step - row_number() OVER (PARTITION BY pixel ORDER BY step) AS k FROM sm WHERE smooth > 0.25), runs AS (SELECT pixel, max(n) AS run FROM (SELECT pixel, k, count(*) AS n FROM isl GROUP BY 1, 2) GROUP BY 1),
    green AS (SELECT pixel, lulc, CASE WHEN n_green > 3 AND NOT coalesce(c <= l AND c <= r AND c <= 0.32, FALSE) THEN coalesce(run, 0) ELSE 0 END AS green_steps FROM meds LEFT JOIN runs USING (pixel)) """


def _series(spark, sf_dir):
    return series.gather(load(spark, sf_dir, "series"), ["pixel", "lulc"])


@query(FILLED + "SELECT pixel, step, round(v, 6) AS value FROM filled")
def series_interpolate(spark, sf_dir):
    return r6(series.spread(_series(spark, sf_dir).withColumn("filled", series.interpolate(F.col("a"))), ["pixel"], "filled"), "value")


@query(f"""WITH {ctes('series')} SELECT pixel, step, round(CASE WHEN step >= 2 THEN max(ndvi) OVER w END, 6) AS high, round(CASE WHEN step >= 2 THEN avg(ndvi) OVER w END, 6) AS mean FROM series WINDOW w AS (PARTITION BY pixel ORDER BY step ROWS 2 PRECEDING)""")
def series_rolling_max_mean(spark, sf_dir):
    return r6(series.rolling_long(load(spark, sf_dir, "series"), ["pixel"], 3), "high", "mean")


@query(FILLED + "SELECT pixel, round(l, 6) AS left_med, round(c, 6) AS centre_med, round(r, 6) AS right_med FROM meds WHERE n_green > 0")
def series_window_medians(spark, sf_dir):
    rows = series.green_stages(_series(spark, sf_dir)).filter("exists(a, v -> v is not null) and exists(filled, v -> v > 0.2)")
    return r6(rows.select("pixel", "left_med", "centre_med", "right_med"), "left_med", "centre_med", "right_med")


@query(FILLED + "SELECT pixel, CAST(green_steps AS INT) AS green_steps FROM green")
def green_run_length(spark, sf_dir):
    return series.green_stages(_series(spark, sf_dir)).select("pixel", "green_steps")


@query(FILLED + "SELECT pixel, lulc, CASE WHEN (CASE WHEN lulc IN (5, 6, 7, 8, 1) AND green_steps <= 35 THEN 0 ELSE green_steps END) >= 18 THEN 1 ELSE 0 END AS forest FROM green")
def forest_mask(spark, sf_dir):
    return series.forest_mask(series.green_stages(_series(spark, sf_dir))).select("pixel", "lulc", "forest")


@query(f"""WITH {ctes('scenes')} SELECT pixel, CAST(g AS INT) AS step, round(ndvi, 6) AS ndvi FROM (SELECT s.*, g, row_number() OVER (PARTITION BY pixel, g ORDER BY abs(day - g * 10), day) AS rn FROM scenes s, (SELECT unnest(range(18)) AS g)) WHERE rn = 1""")
def nearest_time_resample(spark, sf_dir):
    return r6(series.nearest_in_time(load(spark, sf_dir, "scenes"), ["pixel"], 18, 10), "ndvi")


@query(f"""WITH RECURSIVE {ctes('scenes')}, n AS (SELECT *, lead(ndvi) OVER w AS nx, lead(day) OVER w - day AS dn, day - lag(day) OVER w AS dp, lead(step) OVER w IS NULL AS fin FROM scenes WINDOW w AS (PARTITION BY pixel ORDER BY day)),
    f AS (SELECT pixel, step, CASE WHEN ndvi IS NOT NULL THEN ndvi WHEN fin THEN NULL ELSE nx END AS v FROM n WHERE step = 0
        UNION ALL SELECT n.pixel, n.step, CASE WHEN n.ndvi IS NOT NULL THEN n.ndvi WHEN n.fin THEN NULL WHEN n.dp < n.dn THEN f.v ELSE n.nx END FROM f JOIN n ON n.pixel = f.pixel AND n.step = f.step + 1)
    SELECT pixel, step, round(v, 6) AS value FROM f""")
def gap_fill_sequential(spark, sf_dir):
    rows = load(spark, sf_dir, "scenes").groupBy("pixel").agg(F.array_sort(F.collect_list(F.struct("day", "ndvi"))).alias("a"))
    return r6(series.spread(series.fill_gaps(rows), ["pixel"], "filled"), "value")


@query(f"""WITH {ctes('mask', 'layers')}, c AS (SELECT y, x, max(value) AS value FROM layers GROUP BY 1, 2)
    SELECT m.y, m.x, m.forest, c.value FROM mask m JOIN c ON c.y = CAST(floor(m.y / 3.0 + 0.5) AS INT) AND c.x = CAST(floor(m.x / 3.0 + 0.5) AS INT)""")
def nearest_grid_align(spark, sf_dir):
    coarse = load(spark, sf_dir, "layers").groupBy("y", "x").agg(F.max("value").alias("value"))
    return series.align_nearest(load(spark, sf_dir, "mask"), coarse, 3.0)


ITEMS = f"""WITH {ctes('items')}, c AS (SELECT *, split_part(id, '_', 2) AS tile, greatest(0, least(fx1, 1) - greatest(fx0, 0)) * greatest(0, least(fy1, 1) - greatest(fy0, 0)) AS coverage FROM items),
    l AS (SELECT c.*, rung FROM c, (SELECT unnest([20, 40, 60, 80, 100]) AS rung) WHERE degraded < 5 AND cloud < rung AND coverage > 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY tile ORDER BY rung, seq) AS rn FROM l), hit AS (SELECT tile, min(rn) AS rn FROM o WHERE coverage > 0.60 GROUP BY 1),
    best AS (SELECT tile, arg_min(rn, (-coverage, rn)) AS rn FROM o GROUP BY 1), pr AS (SELECT o.tile, o.seq, o.coverage FROM o JOIN best USING (tile) LEFT JOIN hit USING (tile) WHERE o.rn = coalesce(hit.rn, best.rn)) """


@query(ITEMS + "SELECT tile, seq, round(coverage, 6) AS coverage FROM pr")
def scene_pick_primary(spark, sf_dir):
    return r6(scenes.primary(load(spark, sf_dir, "items")), "coverage")


@query()
def scene_complement(spark, sf_dir):
    items = load(spark, sf_dir, "items")
    return scenes.complement(items, scenes.primary(items))


@query()
def scene_set_cover(spark, sf_dir):
    p = load(spark, sf_dir, "pixels").filter(~F.col("scl").isin(*indices.CLOUDY_COMPOSITE))
    return composite.covering_scenes(p.select(F.col("tile").alias("chunk"), (F.col("seq") % 23).alias("scene"), (F.col("y") * 100 + F.col("x")).cast("long").alias("pixel")))


@query(ITEMS + """, f AS (SELECT c.tile, c.seq AS own, c.fx0 AS x0, c.fx1 AS x1, c.fy0 AS y0, c.fy1 AS y1, c.coverage AS had FROM c JOIN pr USING (tile, seq) WHERE c.coverage < 1),
    q AS (SELECT tile, seq, cloud, (coverage - greatest(0, least(fx1, x1, 1) - greatest(fx0, x0, 0)) * greatest(0, least(fy1, y1, 1) - greatest(fy0, y0, 0))) / (1 - had) AS gain, CASE WHEN cloud < 20 THEN 0 ELSE 1 END AS tier FROM c JOIN f USING (tile) WHERE seq <> own AND cloud < 50),
    m AS (SELECT *, min(tier) OVER (PARTITION BY tile) AS lowest FROM q WHERE gain > 1e-9), n AS (SELECT *, max(gain) OVER (PARTITION BY tile) AS most FROM m WHERE tier = lowest)
    SELECT tile, seq, round(gain, 6) AS coverage, cloud FROM n WHERE gain >= 0.9 * most QUALIFY row_number() OVER (PARTITION BY tile ORDER BY cloud, seq) = 1""")
def best_candidate(spark, sf_dir):
    items = load(spark, sf_dir, "items")
    return r6(scenes.best_candidate(items, scenes.primary(items)), "coverage")


@query(ITEMS + ", t AS (SELECT *, min(CASE WHEN cloud < 20 THEN 0 ELSE 1 END) OVER (PARTITION BY tile) AS ft FROM c WHERE degraded < 2 AND cloud < 50) SELECT tile, seq FROM t WHERE (CASE WHEN cloud < 20 THEN 0 ELSE 1 END) = ft")
def scene_two_tier(spark, sf_dir):
    return scenes.two_tier(load(spark, sf_dir, "items")).select("tile", "seq")


@query(ITEMS + "SELECT tile, seq, coverage >= 0.60 OR row_number() OVER (PARTITION BY tile ORDER BY coverage DESC, seq) = 1 AS accepted FROM c")
def scene_accepted(spark, sf_dir):
    return scenes.accepted(load(spark, sf_dir, "items"), best_available=True).select("tile", "seq", "accepted")


@query(ITEMS + """, b AS (SELECT c.* FROM c JOIN pr USING (tile, seq)), g AS (SELECT DISTINCT tile, (i + 0.5e0) / 50 AS px, (j + 0.5e0) / 50 AS py FROM b, (SELECT unnest(range(50)) AS i), (SELECT unnest(range(50)) AS j)),
    u AS (SELECT tile, px, py FROM g WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.tile = g.tile AND px >= fx0 - 0.01e0 AND px < fx1 + 0.01e0 AND py >= fy0 - 0.01e0 AND py < fy1 + 0.01e0))
    SELECT tile, count(*) AS points, count(*) / 2500e0 AS share FROM u GROUP BY 1 HAVING count(*) >= 3""")
def tile_uncovered(spark, sf_dir):
    """What the primary scenes leave uncovered."""
    items = load(spark, sf_dir, "items")
    return scenes.uncovered(items.join(scenes.primary(items).select("seq"), "seq", "left_semi"))


def _tile_ring(x0, y0, x1, y1, x=lambda x, y: x, y=lambda x, y: y):
    """A box's ring from columns or numbers; its corners may be moved by ``x`` and ``y``."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    return F.array(*(F.struct(x(a, b).alias("x"), y(a, b).alias("y")) for a, b in corners))


_CLAMPED = lambda u: f"(CASE WHEN {u} <= 0 THEN 0 WHEN {u} <= 1 THEN ({u}) * ({u}) / 2 ELSE ({u}) - 0.5e0 END)"
_LEANING = lambda f: f"({_CLAMPED(f'({f} + 0.25e0 * d)')} - {_CLAMPED(f'({f} + 0.25e0 * b)')}) / 0.25e0"


@query(ITEMS + f""", f AS (SELECT seq, tile, fx0, fx1, greatest(fy0, 0) AS b, least(fy1, 1) AS d FROM c) SELECT seq, tile, round({_LEANING("fx1")} - {_LEANING("fx0")}, 6) AS coverage FROM f""")
def footprint_coverage(spark, sf_dir):
    """Leaning footprints, moved right by a quarter of their height: what they cover of their tile."""
    items = scenes.tile_of(load(spark, sf_dir, "items"))
    lean = _tile_ring(*map(F.col, ("fx0", "fy0", "fx1", "fy1")), x=lambda a, b: a + 0.25 * b)
    unit = items.select("tile").distinct().withColumn("ring", _tile_ring(*map(F.lit, (0.0, 0.0, 1.0, 1.0))))
    return r6(scenes.footprint_coverage(items.select("seq", "tile", lean.alias("ring")), unit, ["seq"], 1.0), "coverage").select("seq", "tile", "coverage")


#: Length to either side that a footprint has in the tile after widening by a hundredth, and the gaps beside it.
_WIDE = lambda a: f"greatest(0, least(f{a}1 + 0.01e0, 1) - greatest(f{a}0 - 0.01e0, 0))"


@query(ITEMS + f""", b AS (SELECT c.*, CAST(fx0 > 0 AS INT) AS l, CAST(fx1 < 1 AS INT) AS r, CAST(fy0 > 0 AS INT) AS u, CAST(fy1 < 1 AS INT) AS o FROM c JOIN pr USING (tile, seq)),
    s AS (SELECT tile, CASE WHEN fx1 > fx0 THEN 1 - ({_WIDE("x")} * {_WIDE("y")} - (l + r) * (u + o) * (1e-4 - 8 * 1e-4 * sin(pi() / 32))) ELSE 1 END AS area,
        CASE WHEN l + r + u + o = 0 THEN 0 WHEN (l + r = 2 AND u + o = 0) OR (l + r = 0 AND u + o = 2) THEN 2 ELSE 1 END AS parts FROM b)
    SELECT tile, parts, round(area * 10000, 3) AS km2 FROM s WHERE parts > 0""")
def tile_uncovered_metres(spark, sf_dir):
    """What the primary scenes, widened by 1 km, leave of tiles of 100 km, whose rings are degrees."""
    items = load(spark, sf_dir, "items")
    chosen = scenes.tile_of(items.join(scenes.primary(items).select("seq"), "seq", "left_semi"))
    degrees = {"x": lambda a, b: geo.from_utm(300_000 + a * 100_000, 2_200_000 + b * 100_000, 43)[0], "y": lambda a, b: geo.from_utm(300_000 + a * 100_000, 2_200_000 + b * 100_000, 43)[1]}
    footprints = chosen.select("tile", _tile_ring(*map(F.col, ("fx0", "fy0", "fx1", "fy1")), **degrees).alias("ring"))
    whole = chosen.select("tile").distinct().withColumn("ring", _tile_ring(*map(F.lit, (0.0, 0.0, 1.0, 1.0)), **degrees))
    left = scenes.uncovered_parts(whole, footprints).groupBy("tile").agg(F.count("*").cast("int").alias("parts"), (F.sum("area") / 1e6).alias("km2"))
    return r6(left, "km2", places=3)


#: Scenes by season and tile: the primary one, and the complements, each the next in catalog order that reaches 5 points more than what is reached.
SELECTION = f"""WITH RECURSIVE {ctes('items')}, c AS (SELECT *, split_part(id, '_', 2) AS tile, greatest(0, least(fx1, 1) - greatest(fx0, 0)) * greatest(0, least(fy1, 1) - greatest(fy0, 0)) AS coverage,
        CASE WHEN month(day) IN (4, 5) THEN year(day) || '_apr_may' WHEN month(day) IN (11, 12) THEN year(day) || '_nov_dec' END AS season FROM items),
    l AS (SELECT c.*, rung FROM c, (SELECT unnest([20, 40, 60, 80, 100]) AS rung) WHERE season IS NOT NULL AND degraded < 5 AND cloud < rung AND coverage > 0),
    o AS (SELECT *, row_number() OVER (PARTITION BY season, tile ORDER BY rung, seq) AS rn FROM l),
    k AS (SELECT season, tile, coalesce(min(rn) FILTER (coverage > 0.60), arg_min(rn, (-coverage, rn))) AS rn FROM o GROUP BY 1, 2), pr AS (SELECT o.* FROM o JOIN k USING (season, tile, rn)),
    u AS (SELECT c.season, c.tile, c.seq, p.coverage + c.coverage - greatest(0, least(c.fx1, p.fx1, 1) - greatest(c.fx0, p.fx0, 0)) * greatest(0, least(c.fy1, p.fy1, 1) - greatest(c.fy0, p.fy0, 0)) AS reach
        FROM c JOIN pr p ON c.season = p.season AND c.tile = p.tile),
    s AS (SELECT season, tile, CAST(-1 AS BIGINT) AS seq, coverage, CAST(0 AS BIGINT) AS place FROM pr WHERE coverage > 0.60
        UNION ALL SELECT season, tile, seq, reach, place + 1 FROM (SELECT u.season, u.tile, u.seq, u.reach, s.place, row_number() OVER (PARTITION BY u.season, u.tile ORDER BY u.seq) AS rn
            FROM s JOIN u ON s.season = u.season AND s.tile = u.tile WHERE s.coverage <= 0.95 AND u.seq > s.seq AND u.reach > s.coverage + 0.05) WHERE rn = 1),
    chosen AS (SELECT season, tile, seq, CAST(0 AS BIGINT) AS place, coverage FROM pr UNION ALL SELECT season, tile, seq, place, coverage FROM s WHERE place > 0) """


def _selection(spark, sf_dir):
    items = load(spark, sf_dir, "items").withColumn("season", calendar.season(F.col("day"))).filter("season is not null")
    return scenes.selection(items, ("season", "tile"))


@query(SELECTION + "SELECT season, tile, seq, place, round(coverage, 6) AS coverage FROM chosen")
def scene_selection(spark, sf_dir):
    return r6(_selection(spark, sf_dir), "coverage")


@query(SELECTION + """, t AS (SELECT season, tile, arg_max(coverage, place) AS coverage, count(*) AS n FROM chosen GROUP BY 1, 2)
    SELECT season, CASE WHEN coverage >= 0.95 THEN '95-100%' WHEN coverage >= 0.80 THEN '80-95%' WHEN coverage >= 0.60 THEN '60-80%' ELSE '<60%' END AS bucket, count(*) AS tiles, count(*) FILTER (n > 1) AS several, CAST(sum(n) AS BIGINT) AS scenes FROM t GROUP BY 1, 2""")
def scene_selection_summary(spark, sf_dir):
    return scenes.selection_summary(_selection(spark, sf_dir), ("season", "tile"), ("season",))


@query(ITEMS + "SELECT seq, md5(tile || '|' || CAST(day AS VARCHAR)) AS key FROM c")
def search_cache_key(spark, sf_dir):
    return scenes.tile_of(load(spark, sf_dir, "items")).select("seq", scenes.search_key("tile", "day").alias("key"))


@query(ITEMS + "SELECT CASE WHEN coverage >= 0.95 THEN '95-100%' WHEN coverage >= 0.80 THEN '80-95%' WHEN coverage >= 0.60 THEN '60-80%' ELSE '<60%' END AS bucket, count(*) AS tiles FROM pr GROUP BY 1")
def coverage_buckets(spark, sf_dir):
    return scenes.coverage_buckets(scenes.primary(load(spark, sf_dir, "items")))


@query(f"""WITH {ctes('band_files')}, s AS (SELECT split_part(file, '-', 2) AS tile, split_part(file, '-', 3) AS date, split_part(file, '-', 4) AS band FROM band_files)
    SELECT tile, date, CAST(count(DISTINCT band) AS INT) AS bands, bool_or(band = 'red') AND bool_or(band = 'nir') AS complete FROM s GROUP BY 1, 2""")
def band_pair_completeness(spark, sf_dir):
    return scenes.complete_pairs(load(spark, sf_dir, "band_files"))


@query(f"""WITH {ctes('band_files')}, s AS (SELECT file, split_part(file, '-', 2) AS tile, split_part(file, '-', 3) AS date, split_part(file, '-', 4) AS band FROM band_files)
    SELECT r.tile, r.date, r.file AS red, n.file AS nir, c.file AS scl FROM (SELECT DISTINCT * FROM s WHERE band = 'red') r JOIN (SELECT DISTINCT * FROM s WHERE band = 'nir') n ON r.tile = n.tile AND r.date = n.date
    LEFT JOIN (SELECT DISTINCT * FROM s WHERE band = 'scl') c ON r.tile = c.tile AND r.date = c.date""")
def band_file_join(spark, sf_dir):
    return scenes.band_rows(load(spark, sf_dir, "band_files"))


@query(ITEMS + "SELECT DISTINCT tile FROM c WHERE tile NOT IN (SELECT tile FROM c WHERE coverage > 0.72 AND cloud < 20 AND degraded < 1)")
def tile_set_difference(spark, sf_dir):
    rows = scenes.with_coverage(load(spark, sf_dir, "items"))
    return scenes.tiles_left(rows, rows.filter("coverage > 0.72 and cloud < 20 and degraded < 1"))


@query(f"""WITH {ctes('regions')}, g AS (SELECT *, unnest(range(CAST(ceil((x1 - x0) / 0.8e0) AS BIGINT))) AS i FROM regions WHERE NOT no_geom), h AS (SELECT *, unnest(range(CAST(ceil((y1 - y0) / 0.8e0) AS BIGINT))) AS j FROM g),
    e AS (SELECT *, x0 + i * 0.8e0 - 1e-4 AS ca, y0 + j * 0.8e0 - 1e-4 AS cb, x0 + (i + 1) * 0.8e0 + 1e-4 AS cc, y0 + (j + 1) * 0.8e0 + 1e-4 AS cd FROM h),
    b AS (SELECT *, greatest(x0, ca) AS p, least(x1, cc) AS q, greatest(y0, cb) AS b, least(y1, cd) AS d FROM e), a AS (SELECT code, i, j, {_region_area('p', 'q', 'b', 'd')} / ((cc - ca) * (cd - cb)) AS share FROM b)
    SELECT code, CAST(i AS INT) AS i, CAST(j AS INT) AS j, round(share, 6) AS share FROM a WHERE share > 1e-9""")
def aoi_grid_cells(spark, sf_dir):
    return r6(tiles.aoi_grid(with_rings(spark, sf_dir), 0.8).filter("share > 1e-9"), "share")


@query(f"""WITH {ctes('regions')}, g AS (SELECT *, unnest(range(CAST(floor(x0 / 0.8e0) AS BIGINT), CAST(floor(x1 / 0.8e0) AS BIGINT) + 1)) AS gx FROM regions WHERE NOT no_geom),
    h AS (SELECT *, unnest(range(CAST(floor(y0 / 0.8e0) AS BIGINT), CAST(floor(y1 / 0.8e0) AS BIGINT) + 1)) AS gy FROM g),
    b AS (SELECT *, greatest(x0, gx * 0.8e0) AS p, least(x1, (gx + 1) * 0.8e0) AS q, greatest(y0, gy * 0.8e0) AS b, least(y1, (gy + 1) * 0.8e0) AS d FROM h), a AS (SELECT code, gx, gy, {_region_area('p', 'q', 'b', 'd')} AS area FROM b)
    SELECT code, gx, gy, round(area, 6) AS area FROM a WHERE area > 1e-6""")
def region_cut_cells(spark, sf_dir):
    """The polygons that a grid cuts regions into, by the areas of their rings."""
    rows = tiles.cut_cells(with_rings(spark, sf_dir), 0.8, ["code"])
    return r6(rows.groupBy("code", "gx", "gy").agg(F.sum("area").alias("area")).filter("area > 1e-6"), "area")


@query(f"""WITH {ctes('regions')} SELECT type, round(sum((x1 - x0) * (y1 - y0) - CASE WHEN notched THEN (x1 - x0) * 1.37e0 / 2 ELSE 0 END), 6) AS area FROM regions WHERE NOT no_geom GROUP BY 1""")
def region_union(spark, sf_dir):
    """Regions of each type, which share borders, as one shape: the area of its parts without their holes."""
    border = overlay.overlay(overlay.sides(with_rings(spark, sf_dir), ["type"]), ["type"], "union", 5.0)
    return r6(overlay.parts(overlay.rings(border, ["type"]), ["type"]).groupBy("type").agg(F.sum("area").alias("area")), "area")


@query(f"""WITH {ctes('regions')}, t AS (SELECT i * 7 + j AS tile, 66 + i * 5e0 AS tx0, 71 + i * 5e0 AS tx1, 6 + j * 5e0 AS ty0, 11 + j * 5e0 AS ty1 FROM (SELECT unnest(range(7)) AS i), (SELECT unnest(range(7)) AS j)),
    b AS (SELECT *, greatest(x0, tx0) AS p, least(x1, tx1) AS q, greatest(y0, ty0) AS b, least(y1, ty1) AS d FROM regions, t WHERE NOT no_geom AND x0 < tx1 AND x1 > tx0 AND y0 < ty1 AND y1 > ty0),
    a AS (SELECT code, tile, {_region_area('p', 'q', 'b', 'd')} / 25 AS share FROM b) SELECT code, tile, round(share, 6) AS share FROM a WHERE share > 1e-9""")
def tiles_in_regions(spark, sf_dir):
    t = spark.range(7).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(6))).alias("j")).select((F.col("i") * 7 + F.col("j")).alias("tile"), *((F.lit(base) + F.col(c) * 5.0).alias(n) for n, base, c in (("tx0", 66, "i"), ("tx1", 71, "i"), ("ty0", 6, "j"), ("ty1", 11, "j"))))
    return r6(geo.box_tiles(with_rings(spark, sf_dir), t, ["code"]).filter("share > 1e-9"), "share")


@query(f"""WITH {ctes('regions')}, r AS (SELECT *, CASE WHEN notched THEN (x1 - x0) * 1.37e0 / 2 ELSE 0 END AS cut FROM regions WHERE NOT no_geom)
    SELECT code, round((x0 + x1) / 2, 6) AS cx, round(((x1 - x0) * (y1 - y0) * (y0 + y1) / 2 - cut * (y1 - 1.37e0 / 3)) / ((x1 - x0) * (y1 - y0) - cut), 6) AS cy, CASE WHEN notched THEN 6 ELSE 5 END AS corners,
        round(x0, 6) AS first_x, round(y0, 6) AS last_y FROM r""")
def region_centroids(spark, sf_dir):
    """The centre of each ring, and its WKT read again: the number of points, of the first one x and of the last one y."""
    c = geo.centroid(F.col("ring"))
    points = F.split(F.regexp_extract(geo.to_wkt(F.col("ring")), r"^POLYGON \(\((.*)\)\)$", 1), ", ")
    number = lambda at, k: F.split(F.element_at(points, at), " ").getItem(k).cast("double")
    rows = with_rings(spark, sf_dir).filter("ring is not null").select("code", c["x"].alias("cx"), c["y"].alias("cy"), F.size(points).alias("corners"), number(1, 0).alias("first_x"), number(-1, 1).alias("last_y"))
    return r6(rows, "cx", "cy", "first_x", "last_y")


_OUTLINES = f"""WITH {ctes('regions')}, r AS (SELECT *, CASE WHEN notched THEN (x1 - x0) * 1.37e0 / 2 ELSE 0 END AS cut, CASE WHEN notched THEN 5 ELSE 4 END AS corners FROM regions) """


@query(_OUTLINES + """SELECT code, name, type, CASE WHEN no_geom THEN NULL ELSE corners END AS corners, CASE WHEN no_geom THEN NULL ELSE round((x0 + x1) / 2, 6) END AS cx,
    CASE WHEN no_geom THEN NULL ELSE round((x1 - x0) * (y1 - y0) - cut, 6) END AS area FROM r""")
def shapefile_round_trip(spark, sf_dir):
    """Regions written as shapefiles and read back, a region without ring among them."""
    path = work_folder(spark, "shapes")
    shapefile.write_shapefile(with_rings(spark, sf_dir), path, ["code", "name", "type"])
    ring = F.col("ring")
    rows = shapefile.read_shapefile(spark, path).withColumn("ring", shapefile.largest_ring(F.col("rings")))
    return r6(rows.select(*(F.col("properties")[c].alias(c) for c in ("code", "name", "type")), F.when(ring.isNotNull(), F.size("ring")).alias("corners"), geo.centroid(ring)["x"].alias("cx"), (overlay._signed(ring) / 2).alias("area")), "cx", "area")


@query(_OUTLINES + """SELECT code, CAST(13 + 16 * (corners + 1) AS INT) AS bytes, code NOT IN ('R1', 'R3', 'R5', 'R7', 'R9') AS little, corners, round(x0, 6) AS first_x, round(y1, 6) AS last_y, round((x1 - x0) * (y1 - y0) - cut, 6) AS area FROM r WHERE NOT no_geom""")
def wkb_round_trip(spark, sf_dir):
    """Rings as well-known binary, some of the other byte order, and back."""
    little = ~F.col("code").isin("R1", "R3", "R5", "R7", "R9")
    rows = with_rings(spark, sf_dir).filter("ring is not null").select("code", wkb.to_wkb(F.col("ring"), little).alias("w"))
    rows = rows.select("code", F.length("w").alias("bytes"), (F.hex(F.substring("w", 1, 1)) == "01").alias("little"), F.get(F.get(wkb.from_wkb("w"), F.lit(0)), F.lit(0)).alias("ring"))
    ring = F.col("ring")
    return r6(rows.select("code", "bytes", "little", F.size(ring).alias("corners"), F.get(ring, F.lit(0))["x"].alias("first_x"), F.element_at(ring, -1)["y"].alias("last_y"), (overlay._signed(ring) / 2).alias("area")), "first_x", "last_y", "area")


@query(f"WITH {ctes('points')} SELECT id, CAST(CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + floor((lon + 180) / 6) + 1 AS INT) AS epsg FROM points")
def utm_zone(spark, sf_dir):
    return load(spark, sf_dir, "points").select("id", geo.utm_epsg(F.col("lon"), F.col("lat")).alias("epsg"))


_STOPS = ", ".join(f"({a[0]}, {b[0]}, {a[1]}, {b[1]}, {a[2]}, {b[2]}, {a[3]}, {b[3]})" for a, b in zip(tiles.RAMP, tiles.RAMP[1:]))
_LERP = lambda c: f"CAST(floor({c}a + (value - lo) / CAST(hi - lo AS DOUBLE) * ({c}b - {c}a) + 0.5) AS INT)"


@query(f"""WITH {ctes('layers')}, m AS (SELECT y, x, max(value) AS value FROM layers GROUP BY 1, 2), s AS (SELECT * FROM (VALUES {_STOPS}) AS t(lo, hi, ra, rb, ga, gb, ba, bb))
    SELECT y, x, value, {_LERP('r')} AS red, {_LERP('g')} AS green, {_LERP('b')} AS blue, CASE WHEN value = 0 THEN 0 ELSE 255 END AS alpha FROM m JOIN s ON (value > lo AND value <= hi) OR (value = 0 AND lo = 0)""")
def colour_ramp(spark, sf_dir):
    return tiles.colour(load(spark, sf_dir, "layers").groupBy("y", "x").agg(F.max("value").alias("value")))


_TX = "CAST(least((1 << z) - 1, greatest(0, floor((lon + 180) / 360 * (1 << z)))) AS INT)"
_TY = "CAST(least((1 << z) - 1, greatest(0, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * (1 << z)))) AS INT)"


@query(f"WITH {ctes('points')} SELECT CAST(z AS INT) AS z, {_TX} AS tx, {_TY} AS ty, count(*) AS n, max(value) AS value FROM points, (SELECT unnest([0, 3, 8]) AS z) GROUP BY 1, 2, 3")
def web_tile_keys(spark, sf_dir):
    return tiles.web_tiles(load(spark, sf_dir, "points"), (0, 3, 8))


#: The outline of a catalog search, and its footprints: leaning parallelograms around places of their tiles.
SOUGHT = [(72.13, 13.21), (76.77, 12.59), (77.41, 16.83), (74.29, 15.07)]
_SOUGHT = ", ".join(f"({i}, {x}e0, {y}e0, {SOUGHT[(i + 1) % 4][0]}e0, {SOUGHT[(i + 1) % 4][1]}e0)" for i, (x, y) in enumerate(SOUGHT))
_TURN = lambda a, b, p: f"sign((({b}x) - ({a}x)) * (({p}y) - ({a}y)) - (({b}y) - ({a}y)) * (({p}x) - ({a}x)))"


@query(f"""WITH {ctes('items')}, f AS (SELECT seq, id, day, cloud, degraded, 70e0 + seq % 10 * 1.1e0 + fx0 AS x, 9e0 + seq // 7 % 8 * 1.3e0 + fy0 AS y, fx1 - fx0 + 0.3e0 AS w, fy1 - fy0 + 0.2e0 AS h FROM items
        WHERE day BETWEEN DATE '1994-03-05' AND DATE '1996-11-20' AND cloud < 40 AND degraded < 5),
    v AS (SELECT seq, unnest([0, 1, 2, 3]) AS i, unnest([x, x + w, x + w + 0.25e0, x + 0.25e0]) AS vx, unnest([y, y + 0.1e0, y + h + 0.1e0, y + h]) AS vy FROM f),
    s AS (SELECT seq, i, vx AS ax, vy AS ay, coalesce(lead(vx) OVER w, first_value(vx) OVER w) AS ex, coalesce(lead(vy) OVER w, first_value(vy) OVER w) AS ey FROM v WINDOW w AS (PARTITION BY seq ORDER BY i)),
    q AS (SELECT * FROM (VALUES {_SOUGHT}) AS t(j, cx, cy, dx, dy)),
    hit AS (SELECT DISTINCT seq FROM s, q WHERE {_TURN('a', 'e', 'c')} * {_TURN('a', 'e', 'd')} <= 0 AND {_TURN('c', 'd', 'a')} * {_TURN('c', 'd', 'e')} <= 0
            AND greatest(ax, ex) >= least(cx, dx) AND greatest(cx, dx) >= least(ax, ex) AND greatest(ay, ey) >= least(cy, dy) AND greatest(cy, dy) >= least(ay, ey)
        UNION SELECT seq FROM s, q WHERE i = 0 GROUP BY seq HAVING {INSIDE.format(x='ax', y='ay').replace('ya', 'cy').replace('yb', 'dy').replace('xb', 'dx').replace('xa', 'cx')}
        UNION SELECT seq FROM s GROUP BY seq HAVING {INSIDE.format(x=f'{SOUGHT[0][0]}e0', y=f'{SOUGHT[0][1]}e0').replace('ya', 'ay').replace('yb', 'ey').replace('xb', 'ex').replace('xa', 'ax')})
    SELECT seq, id, day, cloud, degraded FROM f JOIN hit USING (seq)""")
def catalog_search(spark, sf_dir):
    """Scenes stored by place and time, searched by an outline, days, cloud and degraded share."""
    place = lambda n, m: F.col("seq") % n if m == 1 else F.floor(F.col("seq") / m) % n
    at = load(spark, sf_dir, "items").select("seq", "id", "day", "cloud", "degraded", (70.0 + place(10, 1) * 1.1 + F.col("fx0")).alias("x"), (9.0 + place(8, 7) * 1.3 + F.col("fy0")).alias("y"), (F.col("fx1") - F.col("fx0") + 0.3).alias("w"), (F.col("fy1") - F.col("fy0") + 0.2).alias("h"))
    x, y, w, h = (F.col(c) for c in "xywh")
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    ring = F.array(corner(x, y), corner(x + w, y + 0.1), corner(x + w + 0.25, y + h + 0.1), corner(x + 0.25, y + h))
    path = work_folder(spark, "catalog")
    catalog.write_catalog(at.select("seq", "id", "day", "cloud", "degraded", ring.alias("ring")), path)
    return catalog.search(spark, path, SOUGHT, (date(1994, 3, 5), date(1996, 11, 20)), {"cloud": (None, 40.0), "degraded": (None, 5.0)}).drop("ring")


#: Pixels of web tiles of 256 in SQL, zooms 0 to 6: a tile's pixels are tiles eight zooms on. The curve is walked by a recursive query from a tile's highest bit down.
_PIXELS = f"""placed AS (SELECT {_TX.replace('z)', '14)')} AS px, {_TY.replace('z)', '14)')} AS py, value FROM points),
    pixels AS (SELECT CAST(k AS INT) AS z, px >> (6 - k) AS gx, py >> (6 - k) AS gy, count(*) AS n, max(value) AS value FROM placed, (SELECT unnest(range(7)) AS k) GROUP BY 1, 2, 3),
    pyramid AS (SELECT z, CAST(gx >> 8 AS INT) AS tx, CAST(gy >> 8 AS INT) AS ty, CAST(gy & 255 AS INT) AS y, CAST(gx & 255 AS INT) AS x, n, value FROM pixels),
    walk AS (SELECT DISTINCT z, tx, ty, CAST(tx AS BIGINT) AS ax, CAST(ty AS BIGINT) AS ay, z - 1 AS bit, CAST(0 AS BIGINT) AS d FROM pyramid UNION ALL
        SELECT z, tx, ty, CASE WHEN (ay >> bit) & 1 = 1 THEN ax WHEN (ax >> bit) & 1 = 1 THEN (1 << z) - 1 - ay ELSE ay END, CASE WHEN (ay >> bit) & 1 = 1 THEN ay WHEN (ax >> bit) & 1 = 1 THEN (1 << z) - 1 - ax ELSE ax END,
            bit - 1, d * 4 + xor(3 * ((ax >> bit) & 1), (ay >> bit) & 1) FROM walk WHERE bit >= 0),
    ids AS (SELECT z, tx, ty, CAST((power(4, z) - 1) / 3 AS BIGINT) + d AS tile_id FROM walk WHERE bit < 0)"""


@query(f"WITH RECURSIVE {ctes('points')}, {_PIXELS} SELECT z, tx, ty, tile_id, y, x, n, CAST(value AS INT) AS value FROM pyramid JOIN ids USING (z, tx, ty)")
def tile_pyramid(spark, sf_dir):
    """Pixels of all web tiles of zooms 0 to 6, overviews from their children, numbered along the curve."""
    return tiles.pyramid(load(spark, sf_dir, "points"), 6).withColumn("n", F.col("n").cast("long"))


@query(f"""WITH RECURSIVE {ctes('points')}, {_PIXELS}, s AS (SELECT * FROM (VALUES {_STOPS}) AS t(lo, hi, ra, rb, ga, gb, ba, bb))
    SELECT z, tx, ty, tile_id, y, x, {_LERP('r')} AS red, {_LERP('g')} AS green, {_LERP('b')} AS blue, CASE WHEN value = 0 THEN 0 ELSE 255 END AS alpha FROM pyramid JOIN ids USING (z, tx, ty)
    JOIN s ON (value > lo AND value <= hi) OR (value = 0 AND lo = 0)""")
def tile_archive_round_trip(spark, sf_dir):
    """The pyramid coloured, written as archives of tile images and read back from them."""
    path = work_folder(spark, "tiles")
    tilearchive.write_tiles(tiles.colour(tiles.pyramid(load(spark, sf_dir, "points"), 6)), path)
    return tilearchive.tile_pixels(tilearchive.read_tiles(spark, path))


@query(f"WITH {ctes('layers')} SELECT chunk, y, x, CAST(value AS DOUBLE) AS value FROM layers")
def geotiff_round_trip(spark, sf_dir):
    """Layers written as GeoTIFF files, a file for each chunk, and read back by blocks."""
    path = work_folder(spark, "layers")
    geotiff.write_geotiff(load(spark, sf_dir, "layers").withColumn("band", F.lit(1)), path, "chunk", 60, 60, dtype="int32")
    return geotiff.read_geotiff(spark, path).select(F.regexp_extract("path", r"(\d+)\.tif$", 1).cast("long").alias("chunk"), "y", "x", "value")


@query(f"""WITH {ctes('pixels')}, b AS (SELECT tile, y, x, max(red) AS red, max(nir) AS nir FROM pixels GROUP BY 1, 2, 3), p AS (SELECT tile, 1 AS band, y, x, red AS value FROM b UNION ALL SELECT tile, 2, y, x, nir FROM b)
    SELECT band, CAST(y + tile // 10 * 15 AS INT) AS "row", CAST(x + tile % 10 * 8 AS INT) AS "column", CAST(max(value) AS DOUBLE) AS value FROM p GROUP BY 1, 2, 3""")
def geotiff_mosaic(spark, sf_dir):
    """Two bands of overlapping tiles, each tile a file of its own transform, read back as one mosaic with the greatest value where tiles overlap."""
    rows = load(spark, sf_dir, "pixels").groupBy("tile", "y", "x").agg(F.max("red").alias("red"), F.max("nir").alias("nir"))
    band = lambda n, c: F.struct(F.lit(n).alias("band"), F.col(c).cast("double").alias("value"))
    rows = rows.select("tile", "y", "x", F.inline(F.array(band(1, "red"), band(2, "nir"))))
    rows = rows.withColumns({"x0": 300_000 + F.col("tile") % 10 * 80, "y0": 2_200_000 - F.floor(F.col("tile") / 10) * 150})
    path = work_folder(spark, "tiles")
    geotiff.write_geotiff(rows, path, "tile", 10, 20, 2, "int32", epsg=32643, transform=(0.0, 0.0, 10.0, 10.0))
    return geotiff.read_mosaic(spark, path)


CLIP = raster.Grid(66.47, 38.7, 0.541, 60, 60)
CLIP_SQL = f"""{EDGES}, cells AS (SELECT DISTINCT y, x FROM layers),
    inside AS (SELECT code, c.y, c.x FROM cells c, edges GROUP BY 1, 2, 3 HAVING {INSIDE.format(x="66.47e0 + (c.x + 0.5e0) * 0.541e0", y="(38.7e0 - (c.y + 0.5e0) * 0.541e0)")})"""


@query(f"WITH {ctes('layers', 'regions')}, {CLIP_SQL} SELECT code, chunk, y, x, value FROM layers JOIN inside USING (y, x)")
def raster_clip(spark, sf_dir):
    return raster.clip(load(spark, sf_dir, "layers"), with_rings(spark, sf_dir), ["code"], CLIP, "y", "x")


#: A grid of 1.5 km pixels in UTM zone 43 over a part of one in degrees.
DEGREES, METRES = raster.Grid(74.7, 20.3, 0.01, 60, 60), raster.Grid(470_000.0, 2_244_000.0, 1_500.0, 46, 44)


def _utm_sql() -> str:
    """The inverse series and the four-neighbour stencil in SQL, from (row, column) ``cells`` and a source ``src`` (key, y, x, value)."""
    xi, eta = f"((({METRES.y0!r}e0) - (r + 0.5e0) * 1500e0) / {geo._K0 * geo._R!r}e0)", f"((({METRES.x0!r}e0) + (c + 0.5e0) * 1500e0 - 500000e0) / {geo._K0 * geo._R!r}e0)"
    term = lambda k, f, g: " + ".join(f"({v!r}) * {f}({2 * j} * {xi}) * {g}({2 * j} * {eta})" for j, v in enumerate(k, start=1))
    delta = " + ".join(f"({v!r}) * sin({2 * j} * chi)" for j, v in enumerate(geo._DELTA, start=1))
    return f"""cells AS (SELECT CAST(id // 44 AS INT) AS r, CAST(id % 44 AS INT) AS c FROM (SELECT unnest(range({46 * 44})) AS id)),
        u AS (SELECT r, c, {xi} - ({term(geo._BETA, 'sin', 'cosh')}) AS xi, {eta} - ({term(geo._BETA, 'cos', 'sinh')}) AS eta FROM cells),
        v AS (SELECT *, asin(sin(xi) / cosh(eta)) AS chi FROM u),
        w AS (SELECT r, c, (degrees(atan2(sinh(eta), cos(xi))) + 75 - 74.7e0) / 0.01e0 - 0.5e0 AS fx, (20.3e0 - degrees(chi + {delta})) / 0.01e0 - 0.5e0 AS fy FROM v),
        n AS (SELECT r, c, floor(fy) + di AS i, floor(fx) + dj AS j, (CASE di WHEN 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END) * (CASE dj WHEN 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) AS weight
              FROM w, (SELECT unnest([0, 0, 1, 1]) AS di, unnest([0, 1, 0, 1]) AS dj)),
        warped AS (SELECT key, r AS "row", c AS "column", sum(weight * value) / sum(weight) AS value FROM n JOIN src ON src.y = n.i AND src.x = n.j WHERE weight > 0 GROUP BY 1, 2, 3)"""


@query(f"""WITH {ctes('layers')}, src AS (SELECT chunk AS key, y, x, value FROM layers WHERE value <> 0), {_utm_sql()} SELECT key AS chunk, "row", "column", round(value, 6) AS value FROM warped""")
def bilinear_to_utm(spark, sf_dir):
    """Layers on a grid of degrees, resampled onto one of a UTM zone."""
    source = load(spark, sf_dir, "layers").filter("value <> 0").select("chunk", F.col("y").alias("row"), F.col("x").alias("column"), "value")
    return r6(raster.resample(source, DEGREES, raster.cells(spark, METRES), METRES, lambda x, y: geo.from_utm(x, y, 43), ("chunk",)), "value")




#: A notched outline in metres that the season product is clipped to.
OUTLINE = [(475_000.0, 2_240_000.0), (500_000.0, 2_240_000.0), (500_000.0, 2_190_000.0), (489_000.0, 2_212_500.0), (475_000.0, 2_190_000.0)]
_SEASON_SQL = ORACLES["season_mosaic_max"].split(" s AS (SELECT *, CASE", 1)[1]


@query(f"""WITH {ctes('pixels')}, s AS (SELECT *, CASE{_SEASON_SQL.rsplit(") SELECT season", 1)[0]}), m AS (SELECT season, y, x, max(value) AS value FROM t GROUP BY 1, 2, 3),
    src AS (SELECT season AS key, y + 15 AS y, x + 20 AS x, value FROM m WHERE value <> 0), {_utm_sql()},
    e AS (SELECT * FROM (VALUES {", ".join(f"({a[0]!r}e0, {a[1]!r}e0, {b[0]!r}e0, {b[1]!r}e0)" for a, b in zip(OUTLINE, OUTLINE[1:] + OUTLINE[:1]))}) AS v(xa, ya, xb, yb)),
    i AS (SELECT r, c FROM cells, e GROUP BY 1, 2 HAVING {INSIDE.format(x="470000e0 + (c + 0.5e0) * 1500e0", y="(2244000e0 - (r + 0.5e0) * 1500e0)")})
    SELECT key AS season, "row", "column", round(value, 6) AS value FROM warped JOIN i ON i.r = warped."row" AND i.c = warped."column\"""")
def season_mosaic_product(spark, sf_dir):
    """From scene pixels to a season's product: highest clear index of each pixel and tile, mosaic, resampled from degrees to metres, clipped to an outline."""
    mosaic = composite.season_mosaic(load(spark, sf_dir, "pixels")).filter("value <> 0").select("season", (F.col("y") + 15).alias("row"), (F.col("x") + 20).alias("column"), "value")
    warped = raster.resample(mosaic, DEGREES, raster.cells(spark, METRES), METRES, lambda x, y: geo.from_utm(x, y, 43), ("season",))
    outline = spark.createDataFrame([("outline", [{"x": x, "y": y} for x, y in OUTLINE])], "name string, ring array<struct<x:double,y:double>>")
    return r6(raster.clip(warped, outline, ["name"], METRES), "value").drop("name")


#: The forest mask's steps in SQL on a series of scene pixels: (tile, y, x) as one number, 37 steps of 70 days.
_FOREST_SERIES = f"""{ctes('pixels')}, sd AS (SELECT (tile * 20 + y) * 10 + x AS pixel, day, arg_min(red, seq) AS red, arg_min(nir, seq) AS nir, arg_min(scl, seq) AS scl FROM pixels GROUP BY 1, 2),
    sn AS (SELECT pixel, date_diff('day', DATE '1992-01-01', day) AS day, CASE WHEN scl NOT IN (8, 9, 10) AND nir <> red THEN (nir - red) / (CAST(nir AS DOUBLE) + red + 1e-3) END AS ndvi FROM sd),
    lc AS (SELECT (tile * 20 + y) * 10 + x AS pixel, CAST(arg_min(scl, (day, seq)) % 9 AS INT) AS lulc FROM pixels WHERE day >= DATE '1995-05-01' AND day < DATE '1996-05-01' GROUP BY 1),
    near AS (SELECT pixel, CAST(g AS INT) AS step, ndvi FROM sn, (SELECT unnest(range(37)) AS g) QUALIFY row_number() OVER (PARTITION BY pixel, g ORDER BY abs(day - g * 70), day) = 1),
    series AS (SELECT near.*, lulc FROM near LEFT JOIN lc USING (pixel))"""


def _corners(spark, sf_dir):
    return load(spark, sf_dir, "pixels").select(F.col("tile").alias("chunk")).distinct().select("chunk", (F.floor(F.col("chunk") / 10) * 15).alias("y0"), (F.col("chunk") % 10 * 8).alias("x0"))


@query(FILLED.replace(ctes("series"), _FOREST_SERIES) + """, fm AS (SELECT pixel, CASE WHEN (CASE WHEN coalesce(lulc IN (5, 6, 7, 8, 1), FALSE) AND green_steps <= 35 THEN 0 ELSE green_steps END) >= 18 THEN 1 ELSE 0 END AS forest FROM green),
    pl AS (SELECT pixel // 200 AS tile, pixel // 200 // 10 * 15 + pixel // 10 % 20 AS y, pixel // 200 % 10 * 8 + pixel % 10 AS x, forest FROM fm)
    SELECT CAST(y AS INT) AS y, CAST(x AS INT) AS x, CAST(coalesce(arg_min(forest, tile) FILTER (forest <> 0), 0) AS INT) AS forest FROM pl GROUP BY 1, 2""")
def forest_mask_product(spark, sf_dir):
    """From scene pixels and land cover to the forest mask's mosaic."""
    pixels = load(spark, sf_dir, "pixels").withColumnRenamed("tile", "chunk")
    days = pixels.groupBy("chunk", "y", "x", "day").agg(F.min_by("scl", "seq").alias("value"))
    cover = composite.annual_cover(days, 1995, ["chunk", "y", "x"]).select("chunk", "y", "x", (F.col("value") % 9).alias("lulc"))
    return series.forest_product(pixels, cover, _corners(spark, sf_dir), "1992-01-01", 37, 70)


@query()
def canopy_density_product(spark, sf_dir):
    """From scene pixels and the forest mask's product to classes of canopy density."""
    scenes_ = load(spark, sf_dir, "pixels").withColumn("scene", F.col("seq") % 23).withColumnRenamed("tile", "chunk")
    return composite.density_product(scenes_, forest_mask_product(spark, sf_dir), _corners(spark, sf_dir), 10, "RJ")
