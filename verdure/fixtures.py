"""Inputs in the shape the operators read, derived from the driver's tables.

Each is one SELECT; ``sql(name, "spark")`` and ``sql(name, "duckdb")`` mean the same. Integer division and array access are all that differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PERIODS = [f"{p}monsoon_{y}_meters_below_ground_level" for y in range(2015, 2023) for p in ("pre", "post")]
_WELL = "CASE WHEN (c_custkey + {n}) % 7 = 0 THEN 'Dry' WHEN (c_custkey + {n}) % 11 = 0 THEN 'NA' WHEN (c_custkey + {n}) % 13 = 0 THEN 'junk' WHEN (c_custkey + {n}) % 17 = 0 THEN NULL ELSE CAST((c_custkey * {m} + {n}) % 400 AS VARCHAR(20)) || '.5' END AS {c}"
_WELLS = ", ".join(_WELL.format(n=n, m=2 * n + 3, c=c) for n, c in enumerate(PERIODS))

TABLES = {
    "regions": """SELECT 'R' || n_nationkey AS code, CASE WHEN n_nationkey = 7 THEN 'REGION_6' ELSE 'REGION_' || n_nationkey END AS name,
        CASE WHEN n_nationkey % 5 = 4 THEN 'district' ELSE 'range' END AS type,
        66.43e0 + 6.73e0 * (n_nationkey % 5) AS x0, 66.43e0 + 6.73e0 * (n_nationkey % 5 + 1) AS x1,
        6.41e0 + 6.47e0 * DIV(n_nationkey, 5) AS y0, 6.41e0 + 6.47e0 * (DIV(n_nationkey, 5) + 1) AS y1,
        n_nationkey % 3 = 0 AS notched, n_nationkey = 20 AS no_geom FROM nation""",
    "rain": """SELECT CAST(o_orderdate AS DATE) AS time, CAST(o_orderkey % 129 AS INT) AS iy, CAST(o_custkey % 135 AS INT) AS ix,
        6.5e0 + 0.25e0 * (o_orderkey % 129) AS lat, 66.5e0 + 0.25e0 * (o_custkey % 135) AS lon,
        CASE WHEN o_orderkey % 17 = 0 THEN -999e0 WHEN o_orderkey % 997 = 0 THEN 1500e0 ELSE o_totalprice / 10000e0 END AS rainfall FROM orders""",
    "daily": """SELECT 'R' || (l_suppkey % 25) AS code, CAST(l_shipdate AS DATE) AS date, sum(CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE l_quantity END) AS value
        FROM lineitem GROUP BY 1, 2""",
    "wells": f"""SELECT c_custkey AS well_id, CASE WHEN c_custkey % 10 = 3 THEN 'Gujarat (24)' ELSE 'RAJASTHAN (8)' END AS state_name_with_lgd_code,
        66.5e0 + (c_custkey * 37 % 3300) / 100e0 AS longitude, 6.5e0 + (c_custkey * 53 % 3200) / 100e0 AS latitude, {_WELLS} FROM customer""",
    "stack": """SELECT CAST(1995 + l_orderkey % 3 AS INT) AS year, CAST(1 + l_partkey % 24 AS INT) AS band, l_suppkey % 40 AS cell, sum(l_quantity) / 1000e0 AS value
        FROM lineitem GROUP BY 1, 2, 3""",
    "weights": """SELECT 'R' || n_nationkey AS code, s_suppkey % 40 AS cell, sum((1 + (n_nationkey * 7 + s_suppkey) % 9) / 10e0) AS c
        FROM nation JOIN supplier ON (s_suppkey + n_nationkey) % 3 = 0 GROUP BY 1, 2""",
    "pixels": """SELECT l_suppkey % 50 AS tile, CAST(l_partkey % 20 AS INT) AS y, CAST(DIV(l_partkey, 20) % 10 AS INT) AS x, CAST(l_shipdate AS DATE) AS day, l_orderkey * 10 + l_linenumber AS seq,
        CAST(l_orderkey % 12 AS INT) AS scl, CAST(floor(l_quantity * 40) AS INT) AS red, CAST(floor(l_extendedprice) AS BIGINT) % 4000 AS nir,
        CAST(100 + l_orderkey % 900 AS INT) AS green, CAST(80 + l_partkey % 700 AS INT) AS blue, CAST(200 + (l_orderkey + l_partkey) % 3000 AS INT) AS swir FROM lineitem""",
    "layers": """SELECT l_suppkey % 3 AS chunk, CAST(l_partkey % 60 AS INT) AS y, CAST(l_orderkey % 60 AS INT) AS x, CAST(max(l_orderkey % 5 * 30 % 101) AS INT) AS value FROM lineitem GROUP BY 1, 2, 3""",
    "mask": "SELECT CAST(l_partkey % 60 AS INT) AS y, CAST(l_orderkey % 60 AS INT) AS x, CAST(max(l_linenumber % 2) AS INT) AS forest FROM lineitem GROUP BY 1, 2",
    "series": """SELECT vec_id AS pixel, CAST(step AS INT) AS step, CAST(vec_id % 9 AS INT) AS lulc,
        CASE WHEN (vec_id * 37 + step) % 11 < 2 OR vec_id % 50 = 7 THEN NULL ELSE 0.24e0 + 0.9e0 * CAST(AT(embedding, step + 1) AS DOUBLE) END AS ndvi FROM embeddings, STEPS""",
    "scenes": """SELECT vec_id AS pixel, CAST(step AS INT) AS step, CAST(step * 6 + vec_id % 5 AS INT) AS day,
        CASE WHEN (vec_id + step * 7) % 5 < 2 THEN NULL ELSE 0.24e0 + CAST(AT(embedding, step + 1) AS DOUBLE) END AS ndvi FROM embeddings, STEPS""",
    "items": """SELECT o_orderkey AS seq, 'S2_' || 'T' || (o_custkey % 40) || '_' || CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS VARCHAR(20)) || '_' || o_orderkey AS id,
        CAST(o_orderdate AS DATE) AS day, (o_orderkey * 7 % 1000) / 10e0 AS cloud, (o_orderkey % 60) / 10e0 AS degraded,
        (o_orderkey % 5) / 10e0 AS fx0, (o_orderkey % 5) / 10e0 + (o_custkey % 11) / 10e0 AS fx1, (o_orderkey % 3) / 10e0 AS fy0, (o_orderkey % 3) / 10e0 + (o_orderkey % 9 + 2) / 10e0 AS fy1 FROM orders""",
    "species": """SELECT p_partkey AS id, p_brand AS name, CAST(p_size % 6 AS VARCHAR(20)) AS increment, CAST(0.4e0 + (p_partkey % 5) / 10e0 AS VARCHAR(20)) AS wood_density,
        CAST(0.3e0 + (p_partkey % 3) / 10e0 AS VARCHAR(20)) AS bef, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE '0.47' END AS carbon_fraction, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE '3.67' END AS co2_factor,
        '0.26' AS root_shoot, CAST(100 + p_partkey % 50 AS INT) AS num_trees, CASE WHEN p_partkey % 3 = 0 THEN CAST(5 + p_size % 9 AS INT) END AS harvest_cycle,
        CASE WHEN p_partkey % 2 = 0 THEN 20e0 END AS retention, CAST(1 + p_partkey % 12 AS INT) AS plant_month, CAST(2020 + p_partkey % 4 AS INT) AS plant_year,
        CASE p_partkey % 3 WHEN 0 THEN '0.0005 * D ** 2 + Math.max(0.01, 0.002 * D)' WHEN 1 THEN '0.001 * D' ELSE 'Math.sqrt(D) * 0.003' END AS formula FROM part""",
    "forms": """SELECT event_id AS form_id, CAST(user_id % 25 AS INT) AS region_id, CAST(ts AS DATE) AS reporting_date,
        CASE event_id % 4 WHEN 0 THEN 'draft' WHEN 1 THEN 'acknowledged' ELSE 'submitted' END AS status, CASE WHEN event_id % 9 = 0 THEN 'other' ELSE 'animal-rescue' END AS template FROM events""",
    "form_values": """SELECT event_id AS form_id, name, seq, CASE name
            WHEN 'latitude' THEN CASE WHEN event_id % 31 = 0 THEN '0' WHEN event_id % 37 = 0 THEN 'north' WHEN event_id % 41 = 0 THEN 'NaN' ELSE CAST(event_id % 30 + 1 AS VARCHAR(20)) || '.25' END
            WHEN 'longitude' THEN CAST(event_id % 40 + 60 AS VARCHAR(20)) || '.5'
            WHEN 'animal_category' THEN ' ' || upper(event_type) || ' '
            WHEN 'animal_species' THEN CASE WHEN event_id % 23 = 0 THEN '  ' ELSE 'Species' || (event_id % 6) END
            WHEN 'process_status' THEN CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'Released' END
            WHEN 'village_town' THEN CASE WHEN event_id % 3 = 0 THEN '' ELSE 'Village ' || (event_id % 8) END
            WHEN 'request_id' THEN CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN 'none' ELSE CAST(event_id AS VARCHAR(20)) END
            WHEN 'beat_naka' THEN CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'Naka ' || (event_id % 5) END
            ELSE CASE event_id % 10 WHEN 0 THEN '31-Feb-2024' WHEN 1 THEN '05-jan-24' WHEN 2 THEN ' 5-Jan-2024 ' ELSE CAST(day(ts) AS VARCHAR(20)) || '-Jan-24' END END AS value
        FROM events JOIN (SELECT 'latitude' AS name, 1 AS seq UNION ALL SELECT 'longitude', 2 UNION ALL SELECT 'animal_category', 3 UNION ALL SELECT 'animal_species', 4 UNION ALL SELECT 'process_status', 5
            UNION ALL SELECT 'village_town', 6 UNION ALL SELECT 'date_of_reporting', 7 UNION ALL SELECT 'animal_species', 8 UNION ALL SELECT 'request_id', 9 UNION ALL SELECT 'beat_naka', 10) AS n ON (event_id + seq) % 29 <> 0 AND (seq <> 8 OR event_id % 2 = 0)""",
    "products": "SELECT r_regionkey AS id, 'product_' || r_regionkey AS name, CASE WHEN r_regionkey = 4 THEN DATE '2020-01-01' END AS deleted_at FROM region",
    "snapshots": """SELECT n_nationkey AS id, n_regionkey AS product_id, 'label_' || (n_nationkey % 12) AS label, CASE WHEN n_nationkey % 11 = 10 THEN DATE '2021-01-01' END AS deleted_at FROM nation""",
    "raw_values": "SELECT 'R' || (o_custkey % 27) AS code, 'label_' || (o_orderkey % 14) AS label, avg(o_totalprice) AS value FROM orders GROUP BY 1, 2",
    "region_codes": "SELECT 'R' || n_nationkey AS code, n_nationkey AS region_id FROM nation",
    "band_files": "SELECT 'S-T' || (l_suppkey % 30) || '-' || CAST(l_orderkey % 977 AS VARCHAR(20)) || '-' || CASE (l_linenumber + l_partkey) % 4 WHEN 0 THEN 'red' WHEN 1 THEN 'nir' WHEN 2 THEN 'scl' ELSE 'blue' END AS file FROM lineitem",
    "points": "SELECT c_custkey AS id, ((c_custkey * 7919) % 36000) / 100e0 - 180e0 AS lon, ((c_custkey * 104729) % 16000) / 100e0 - 80e0 AS lat, CAST(c_custkey % 101 AS INT) AS value FROM customer",
}
NEEDS = {"regions": ["nation"], "rain": ["orders"], "daily": ["lineitem"], "wells": ["customer"], "stack": ["lineitem"], "weights": ["nation", "supplier"], "pixels": ["lineitem"], "layers": ["lineitem"], "mask": ["lineitem"], "series": ["embeddings"], "scenes": ["embeddings"], "items": ["orders"], "species": ["part"], "forms": ["events"], "form_values": ["events"], "products": ["region"], "snapshots": ["nation"], "raw_values": ["orders"], "region_codes": ["nation"], "band_files": ["lineitem"], "points": ["customer"]}


def _calls(text: str, name: str, make) -> str:
    """Replace ``name(a, b)``, arguments without commas, by ``make(a, b)``."""
    while (at := text.find(f"{name}(")) >= 0:
        depth, end = 0, at + len(name)
        while True:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            if not depth:
                break
            end += 1
        a, b = text[at + len(name) + 1 : end].split(",", 1)
        text = text[:at] + make(a.strip(), b.strip()) + text[end + 1 :]
    return text


def sql(name: str, dialect: str) -> str:
    spark = dialect == "spark"
    text = _calls(TABLES[name], "DIV", lambda a, b: f"({a} div {b})" if spark else f"({a} // {b})")
    text = _calls(text, "AT", lambda a, b: f"element_at({a}, CAST({b} AS INT))" if spark else f"{a}[{b}]")
    return text.replace("STEPS", "(SELECT explode(sequence(0, 36)) AS step) AS s" if spark else "(SELECT unnest(range(37)) AS step) AS s")


def ctes(*names: str) -> str:
    """The WITH list of these inputs for DuckDB."""
    return ", ".join(f"{n} AS ({sql(n, 'duckdb')})" for n in names)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input as a DataFrame."""
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in NEEDS[name]}
    text = sql(name, "spark")
    for t in frames:
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **frames)
