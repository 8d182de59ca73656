"""Inputs of the queries, projected from the driver's tables.

Each input is one SELECT in the common subset of Spark SQL and DuckDB, so both sides start
from the same rows: Spark runs it on DataFrames, the oracle pastes it as a CTE.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

LAYER_OF_FLAGS = {
    ("R", "O"): "soil_survey_ph",
    ("A", "F"): "crop_suitability_rating_map_rice",
    ("R", "F"): "farmland_importance_level",
    ("A", "O"): "soil_survey_texture_0_30cm",
    ("N", "O"): "soil_survey_drainage",
    ("N", "F"): "farmland_productivity_levels",
}

# Colours the pixels are drawn from: legend colours, both near duplicates, unmapped, whites, black.
PALETTE = [
    (0, 255, 0), (0, 0, 255), (255, 0, 0), (0, 255, 255), (27, 127, 27), (97, 249, 11), (97, 249, 12),
    (107, 178, 253), (107, 178, 254), (3, 5, 245), (1, 254, 3), (217, 224, 246),
    (255, 255, 255), (0, 0, 0), (253, 255, 255), (254, 254, 254),
]

HEXAGON = [(1000, 0), (500, 870), (-500, 870), (-1000, 0), (-500, -870), (500, -870)]


def town_id(k: str) -> str:
    return (
        f"CASE WHEN {k} = 28 THEN 'T28' ELSE chr(CAST(65 + {k} % 25 AS INT)) || "
        f"CASE WHEN {k} < 10 THEN '0' ELSE '' END || CAST({k} AS STRING) END"
    )


def county_id(k: str) -> str:
    return f"chr(CAST(65 + {k} % 25 AS INT))"


def town_version(k: str) -> str:
    return (
        f"CASE WHEN {k} % 20 = 3 THEN 'TOWN_MOI_11403181' WHEN {k} % 4 = 0 THEN 'TOWN_MOI_1140318' "
        f"WHEN {k} % 4 = 1 THEN 'TOWN_MOI_1130701' WHEN {k} % 4 = 2 THEN 'Town_Majia_Sanhe_1140318' ELSE 'TOWN_MOI_draft' END"
    )


def layer_case() -> str:
    cases = " ".join(f"WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN '{c}'" for (f, s), c in LAYER_OF_FLAGS.items())
    return f"CASE {cases} END"


def channel(index: int, idx: str) -> str:
    return "CAST(CASE " + " ".join(f"WHEN {idx} = {i} THEN {c[index]}" for i, c in enumerate(PALETTE)) + " END AS SMALLINT)"


def center(k: str) -> tuple[str, str]:
    return f"(119600000 + ({k} % 25) * 100000)", f"(22200000 + CAST(floor({k} / 25) AS BIGINT) % 30 * 100000)"


def radius(k: str) -> str:
    return f"(30 + ({k} % 7) * 5)"


# Ring variants: (name, condition on k, part, ring, [(dx, dy) in thousandths of the radius], flat).
def rings(k: str) -> list[tuple[str, int, int, list[tuple[int, int]]]]:
    flat = [(x, 0) for x, _ in HEXAGON]
    swapped = [HEXAGON[0], HEXAGON[2], HEXAGON[1], *HEXAGON[3:]]
    plain = f"{k} % 13 <> 4 AND {k} % 17 <> 5 AND {k} % 19 <> 6 AND {k} % 23 <> 7"
    hole = [(300, 300), (-300, 300), (-300, -300), (300, -300), (300, 300)]
    return [
        (plain, 0, 0, [*HEXAGON, HEXAGON[0]]),
        (f"{k} % 13 = 4", 0, 0, [*swapped, swapped[0]]),
        (f"{k} % 13 <> 4 AND {k} % 17 = 5", 0, 0, [HEXAGON[0], *HEXAGON, HEXAGON[0]]),
        (f"{k} % 13 <> 4 AND {k} % 17 <> 5 AND {k} % 19 = 6", 0, 0, HEXAGON),
        (f"{k} % 13 <> 4 AND {k} % 17 <> 5 AND {k} % 19 <> 6 AND {k} % 23 = 7", 0, 0, [*flat, flat[0]]),
        (f"{k} % 5 = 0", 0, 1, hole),
        (f"{k} % 6 = 1", 1, 0, [(2500 + x // 2, y // 2) for x, y in [*HEXAGON, HEXAGON[0]]]),
    ]


def town_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark only: area_id, k and the WKT text of every town (null for some)."""
    cx, cy, r = *center("k"), radius("k")
    micro = lambda v: f"concat(CAST(floor({v} / 1e6) AS STRING), '.', lpad(CAST({v} % 1000000 AS STRING), 6, '0'))"

    def ring_text(points: list[tuple[int, int]]) -> str:
        xs, ys = (", ".join(str(p[i]) for p in points) for i in (0, 1))
        spot = f"{micro(f'({cx} + {r} * dx)')} || ' ' || {micro(f'({cy} + {r} * array({ys})[i])')}"
        return f"'(' || array_join(transform(array({xs}), (dx, i) -> {spot}), ', ') || ')'"

    texts = {}
    for place in ((0, 0), (0, 1), (1, 0)):
        chosen = [(c, p) for c, part, ring, p in rings("k") if (part, ring) == place]
        texts[place] = "CASE " + " ".join(f"WHEN {c} THEN {ring_text(p)}" for c, p in chosen) + " END"
    return spark.sql(
        f"""
SELECT area_id, k, CASE WHEN k % 29 = 3 THEN NULL WHEN second IS NULL THEN 'POLYGON (' || concat_ws(', ', outer_ring, hole) || ')'
  ELSE 'MULTIPOLYGON ((' || concat_ws(', ', outer_ring, hole) || '), (' || second || '))' END AS geometry
FROM (SELECT area_id, k, {texts[(0, 0)]} AS outer_ring, {texts[(0, 1)]} AS hole, {texts[(1, 0)]} AS second
  FROM (SELECT {town_id('s_suppkey')} AS area_id, s_suppkey AS k FROM {{supplier}}))""",
        supplier=load(spark, sf_dir, "supplier"),
    )


def vertex_sql() -> str:
    """DuckDB only: vertices (k, part, ring, seq, x, y) in degrees, straight from the ring variants."""
    cx, cy, r = *center("k"), radius("k")
    selects = []
    for condition, part, ring, points in rings("k"):
        values = ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(points))
        selects.append(
            f"SELECT k, {part} AS part, {ring} AS ring, v.seq, ({cx} + {r} * v.dx) / 1e6 AS x, ({cy} + {r} * v.dy) / 1e6 AS y, "
            f"{len(points)} AS n FROM (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 29 <> 3) s, "
            f"(VALUES {values}) v(seq, dx, dy) WHERE {condition}"
        )
    return " UNION ALL ".join(selects)


def _town(version: str, where: str) -> str:
    k = "s_suppkey"
    return f"""
SELECT {town_id(k)} AS area_id, 'town' AS area_level, {county_id(k)} AS COUNTYID,
  CASE WHEN {k} % 5 < 3 THEN NULL WHEN {k} % 5 = 3 THEN '' ELSE 'Own County' END AS COUNTYENG,
  {town_id(k)} AS TOWNID, CASE WHEN {k} % 11 = 0 THEN NULL ELSE 'Town ' || CAST({k} AS STRING) END AS TOWNENG,
  CAST(s_suppkey AS BIGINT) AS k, {version} AS shp_version, CAST(s_suppkey AS BIGINT) AS pos
FROM supplier {where}"""


INPUTS: dict[str, str] = {}
INPUTS["towns"] = (
    _town(town_version("s_suppkey"), "") + " UNION ALL " + _town("'Town_Majia_Sanhe_1140318'", "WHERE s_suppkey % 10 = 8")
)
INPUTS["counties"] = f"""
SELECT {county_id('n_nationkey')} AS area_id, 'county' AS area_level, {county_id('n_nationkey')} AS COUNTYID,
  CASE WHEN n_nationkey % 5 = 0 THEN NULL WHEN n_nationkey % 7 = 0 THEN '' ELSE 'County ' || n_name END AS COUNTYENG,
  CAST(NULL AS STRING) AS TOWNID, CAST(NULL AS STRING) AS TOWNENG, CAST(n_nationkey AS BIGINT) + 1000000 AS k,
  CASE WHEN n_nationkey % 3 = 0 THEN 'COUNTY_MOI_1130701' ELSE 'COUNTY_MOI_1140318' END AS shp_version,
  CAST(n_nationkey AS BIGINT) AS pos
FROM nation"""
INPUTS["areas"] = "SELECT * FROM towns UNION ALL SELECT * FROM counties"
INPUTS["pixels"] = f"""
SELECT area_id, shp_version, classification, px_row AS row, px_col AS col,
  {channel(0, 'idx')} AS b, {channel(1, 'idx')} AS g, {channel(2, 'idx')} AS r
FROM (
  SELECT {town_id('l_suppkey')} AS area_id, {town_version('l_suppkey')} AS shp_version, {layer_case()} AS classification,
    CAST(l_orderkey % 200 AS INT) AS px_row, CAST(l_partkey % 200 AS INT) AS px_col,
    max(l_partkey + l_linenumber) % 16 AS idx
  FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus, l_orderkey % 200, l_partkey % 200
) p"""
INPUTS["images"] = """
SELECT area_id, 'town' AS area_level, area_id AS region_name, shp_version, classification, n, total,
  'output/wms_images/' || shp_version || '/raw/' || classification || '/' || area_id || '.png' AS path,
  CASE WHEN total % 6 = 0 THEN NULL ELSE CAST(total AS STRING) END AS content, DATE '2000-02-01' AS recorded_at
FROM (SELECT area_id, shp_version, classification, count(*) AS n, CAST(sum(CAST(b AS BIGINT) + g + r) AS BIGINT) AS total
  FROM pixels GROUP BY area_id, shp_version, classification) i"""
INPUTS["images_before"] = """
SELECT CASE WHEN total % 6 = 1 THEN 'gone/' || path ELSE path END AS path, CASE WHEN total % 6 = 2 THEN 'old' ELSE content END AS content FROM images"""
INPUTS["image_ledger"] = """
SELECT (ascii(area_id) * 1000000 + CAST(substr(area_id, 2) AS BIGINT)) * 1000 + row_number() OVER (PARTITION BY area_id ORDER BY classification, shp_version, stage) AS id,
  area_id, area_level, classification, shp_version, stage, replace(path, '/raw/', '/' || stage || '/') AS file_path, false AS layer_updated, DATE '2000-01-01' AS recorded_at
FROM (SELECT *, 'raw' AS stage FROM images WHERE n % 4 > 0 UNION ALL SELECT *, 'masked' AS stage FROM images WHERE n % 4 > 1) l"""
INPUTS["image_files"] = """
SELECT CASE WHEN n % 4 = 2 THEN 'lost/' ELSE '' END || replace(path, '/raw/', '/masked/') AS path FROM images"""
INPUTS["mixed_dates"] = """
SELECT o_orderkey AS id, CASE o_orderkey % 13
  WHEN 0 THEN CAST(year(o_orderdate) - 1911 AS STRING)
  WHEN 1 THEN CAST(year(o_orderdate) - 1911 AS STRING) || '/' || CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING)
  WHEN 2 THEN CAST(year(o_orderdate) - 1911 AS STRING) || '.13.40'
  WHEN 3 THEN CAST(year(o_orderdate) AS STRING) || '/' || CAST(month(o_orderdate) AS STRING) || '/' || CAST(day(o_orderdate) AS STRING)
  WHEN 4 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 03:04:' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')
  WHEN 5 THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '')
  WHEN 6 THEN '0' || CAST(year(o_orderdate) - 1911 AS STRING) || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')
  WHEN 7 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
  WHEN 8 THEN CAST(year(o_orderdate) AS STRING) || '年'
  WHEN 9 THEN CAST(year(o_orderdate) AS STRING)
  WHEN 10 THEN 'order ' || CAST(o_orderkey AS STRING)
  WHEN 11 THEN ' ' || CAST(year(o_orderdate) AS STRING) || ' - ' || CAST(month(o_orderdate) AS STRING) || ' - ' || CAST(day(o_orderdate) AS STRING)
  ELSE NULL END AS raw
FROM orders"""
INPUTS["snapshot_old"] = """
SELECT CASE WHEN doc_id % 2 = 0 THEN 'raw/' ELSE 'masked/' END || CAST(doc_id AS STRING) || '.png' AS path, text AS content
FROM documents"""
INPUTS["snapshot_new"] = """
SELECT CASE WHEN doc_id % 11 = 3 THEN 'added/' WHEN doc_id % 2 = 0 THEN 'raw/' ELSE 'masked/' END || CAST(doc_id AS STRING) || '.png' AS path,
  CASE WHEN doc_id % 7 = 0 THEN text || '!' WHEN doc_id % 7 = 1 THEN upper(text) ELSE text END AS content
FROM documents"""
INPUTS["ledger"] = f"""
SELECT row_number() OVER (PARTITION BY l_suppkey ORDER BY yr, l_returnflag, l_linestatus) + l_suppkey * 1000 AS id,
  {town_id('l_suppkey')} AS area_id, 'town' AS area_level, {layer_case()} AS classification,
  'TOWN_MOI_' || CAST(yr - 1911 AS STRING) || '0318' AS shp_version,
  CASE WHEN (l_suppkey + yr) % 2 = 0 THEN 'raw' ELSE 'masked' END AS stage,
  'output/' || CAST(yr AS STRING) || '/' || l_returnflag || l_linestatus || '/' || CAST(l_suppkey AS STRING) || '.png' AS file_path,
  n_lines % 2 = 0 AS layer_updated, first_day AS recorded_at
FROM (
  SELECT l_suppkey, l_returnflag, l_linestatus, year(l_shipdate) AS yr, count(*) AS n_lines, CAST(min(l_shipdate) AS DATE) AS first_day
  FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus, year(l_shipdate)
) g"""
INPUTS["results"] = f"""
SELECT {town_id('l_suppkey')} AS area_id, 'town' AS area_level, {layer_case()} AS classification,
  'TOWN_MOI_' || CAST(year(l_shipdate) - 1911 AS STRING) || '0318' AS shp_version,
  CASE WHEN l_orderkey % 2 = 0 THEN 'raw' ELSE 'masked' END AS stage,
  'new/' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_' || CAST(l_partkey AS STRING) || '.png' AS file_path,
  CAST(l_shipdate AS DATE) AS recorded_at,
  CASE l_orderkey % 5 WHEN 0 THEN 'created' WHEN 1 THEN 'updated' WHEN 2 THEN 'unchanged' WHEN 3 THEN 'error' ELSE 'created' END AS status,
  ((l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber) * 1000 + l_suppkey % 1000 AS pos
FROM lineitem"""
INPUTS["work"] = f"""
SELECT {town_id('l_suppkey')} AS area_id, {layer_case()} AS classification,
  'TOWN_MOI_' || CAST(year(l_shipdate) - 1911 AS STRING) || '0318' AS shp_version,
  CASE WHEN min(l_partkey) % 4 = 0 THEN 'updated' WHEN min(l_partkey) % 4 = 1 THEN 'error' ELSE 'unchanged' END AS status
FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus, year(l_shipdate)"""
INPUTS["disk_files"] = "SELECT file_path AS path FROM ledger WHERE id % 3 <> 0 UNION ALL SELECT 'output/stray/' || CAST(id AS STRING) || '.png' FROM ledger WHERE id % 17 = 0"
INPUTS["stats"] = f"""
SELECT {town_id('l_suppkey')} AS town_id, {county_id('l_suppkey')} AS county_id, year(l_shipdate) AS year,
  l_returnflag AS item, l_linestatus AS item_group, l_quantity AS quantity
FROM lineitem"""
INPUTS["yields"] = f"""
SELECT {county_id('c_nationkey')} AS county_id, year(o_orderdate) AS year, sum(l_quantity) AS yield
FROM lineitem, orders, customer WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey
GROUP BY {county_id('c_nationkey')}, year(o_orderdate)"""
INPUTS["signals"] = f"""
SELECT {town_id('k')} AS town_id, {county_id('k')} AS county_id, 1995 + CAST(yr AS INT) AS year,
  rain_total, heat_days, storm_distance
FROM (
  SELECT user_id % 100 AS k, CAST(floor(user_id / 7) AS BIGINT) % 7 AS yr, sum(value) AS rain_total,
    count(*) AS heat_days, avg(value) AS storm_distance
  FROM events GROUP BY user_id % 100, CAST(floor(user_id / 7) AS BIGINT) % 7
) e"""
INPUTS["dirty"] = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS amount,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority, o_orderstatus AS status
FROM orders"""
INPUTS["blank_rows"] = """
SELECT CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 2 = 0 OR c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS nationkey
FROM customer"""

DEPENDS = {"areas": ["towns", "counties"], "disk_files": ["ledger"], "images": ["pixels"]}
for _name in ("images_before", "image_ledger", "image_files"):
    DEPENDS[_name] = ["pixels", "images"]


def order_of(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for needed in [*DEPENDS.get(name, []), name]:
            if needed not in out:
                out.append(needed)
    return out


def ctes(*names: str, **extra: str) -> str:
    """WITH clause for DuckDB with the named inputs and further named SELECTs."""
    parts = [f"{name} AS ({INPUTS[name]})" for name in order_of(list(names))]
    parts += [f"{name} AS ({sql})" for name, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """An input as a DataFrame; what is `given` is taken as it is, also by the inputs that depend on it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if given and name in given:
        return given[name]
    if name in TABLES:
        return table(spark, sf_dir, name)
    sql = INPUTS[name]
    needed = DEPENDS.get(name, []) + [t for t in TABLES if f" {t}" in sql.replace("\n", " ").replace(",", " ")]
    used = {n: load(spark, sf_dir, n, given) for n in needed if f" {n}" in sql.replace("\n", " ")}
    for n in used:
        sql = _as_argument(sql, n)
    return spark.sql(sql, **used)


def _as_argument(sql: str, name: str) -> str:
    """Table name after FROM or a comma as a DataFrame argument."""
    return re.sub(rf"(FROM |, ){name}\b(?! AS)", rf"\g<1>{{{name}}}", sql)
