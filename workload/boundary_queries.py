"""Boundary, version and layer-name queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldmosaic.functions.wkt import parse_polygon
from fieldmosaic.operators import boundaries, names
from fieldmosaic.runtime import checkpoint_folder
from fieldmosaic.streaming.boundary_stream import ingest_stream
from fieldmosaic.tables.layer_values import layer_rows
from workload.inputs import INPUTS, ctes, load, town_shapes, vertex_sql
from workload.registry import query

TITLE_CASE = "CASE {n} % 90 " + " ".join(f"WHEN {i} THEN '{zh}'" for i, (zh, _, _) in enumerate(layer_rows())) + " ELSE '未知圖層' || CAST({n} % 90 AS STRING) END"
STATIC_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{zh}', '{en}')" for i, (zh, en, _) in enumerate(layer_rows(), 1)) + ") v(layer_no, name_zh, name_en)"

INPUTS["named_areas"] = "SELECT *, CASE WHEN k % 29 = 3 THEN NULL ELSE 'shape' END AS geometry FROM areas"
INPUTS["gate_areas"] = """
SELECT CASE WHEN pos % 30 = 7 AND shp_version LIKE '%draft' THEN ' ' WHEN pos % 31 = 5 AND shp_version LIKE '%701' THEN NULL ELSE area_id END AS area_id,
  shp_version, pos FROM areas"""
INPUTS["insert_batch"] = """
SELECT CASE WHEN pos % 37 = 0 THEN NULL ELSE area_id END AS area_id, shp_version, TOWNENG AS name, pos FROM areas
UNION ALL SELECT area_id, shp_version, 'copy' AS name, pos + 1000000 AS pos FROM areas WHERE pos % 2 = 0"""
INPUTS["stored_areas"] = "SELECT area_id, shp_version, 'stored' AS name FROM areas WHERE pos % 3 = 0"
INPUTS["file_names"] = """
SELECT CASE pos % 5 WHEN 0 THEN shp_version || '_' || CAST(pos AS STRING) || '.shp' WHEN 1 THEN shp_version || CAST(pos AS STRING) || '.dbf'
  WHEN 2 THEN upper(shp_version) || '.v' || CAST(pos AS STRING) || '.shp' WHEN 3 THEN 'river_' || CAST(pos AS STRING) || '.shp' ELSE 'County' || CAST(pos AS STRING) || '.SHP' END AS file_name
FROM areas"""
INPUTS["map_titles"] = f"SELECT p_partkey AS id, {TITLE_CASE.format(n='p_partkey')} AS map_name FROM part"
INPUTS["overrides"] = f"SELECT CASE WHEN s_suppkey % 3 = 1 THEN {TITLE_CASE.format(n='(s_suppkey * 7)')} ELSE '新圖' || CAST(s_suppkey AS STRING) END AS name_zh, 'over_' || CAST(s_suppkey % 13 AS STRING) AS name_en, s_suppkey AS pos FROM supplier"

DEPENDS_ON_AREAS = ("named_areas", "gate_areas", "insert_batch", "stored_areas", "file_names")
from workload.inputs import DEPENDS  # noqa: E402

for _name in DEPENDS_ON_AREAS:
    DEPENDS[_name] = ["towns", "counties", "areas"]

STAMP = r"regexp_extract(shp_version, '(\d{7})(?:\D|$)', 1)"
BACKFILL = """SELECT a.* REPLACE (CASE WHEN a.area_level = 'town' AND a.COUNTYENG IS NULL THEN n.COUNTYENG ELSE a.COUNTYENG END AS COUNTYENG)
  FROM named_areas a LEFT JOIN (SELECT COUNTYID, arg_max(COUNTYENG, area_id) AS COUNTYENG FROM areas
    WHERE area_level = 'county' AND COUNTYENG IS NOT NULL AND COUNTYENG <> '' GROUP BY COUNTYID) n ON a.COUNTYID = n.COUNTYID"""
REASON = """CASE WHEN area_level = 'town' AND (coalesce(COUNTYENG, '') = '' OR coalesce(TOWNENG, '') = '') THEN 'name missing'
  WHEN area_level = 'county' AND coalesce(COUNTYENG, '') = '' THEN 'name missing' WHEN geometry IS NULL THEN 'geometry missing' END"""


@query("boundary_files", ctes("file_names") + r"""SELECT file_name, regexp_replace(file_name, '\.[^.]*$', '') AS shp_version FROM file_names
  WHERE file_name LIKE '%.shp' AND (lower(file_name) LIKE '%county%' OR lower(file_name) LIKE '%town%')""")
def boundary_files(spark, sf_dir):
    return boundaries.boundary_files(load(spark, sf_dir, "file_names"))


@query("area_identity", ctes("areas") + "SELECT area_id, area_level, shp_version, pos FROM areas")
def area_identity(spark, sf_dir):
    towns = load(spark, sf_dir, "towns").drop("area_id", "area_level")
    counties = load(spark, sf_dir, "counties").drop("area_id", "area_level", "TOWNID", "TOWNENG")
    both = boundaries.union_boundaries([boundaries.with_identity(towns), boundaries.with_identity(counties)])
    return both.select("area_id", "area_level", "shp_version", "pos")


@query("union_boundaries", ctes("areas") + "SELECT COUNTYID, TOWNID, TOWNENG, shp_version FROM areas")
def union_boundaries(spark, sf_dir):
    towns = load(spark, sf_dir, "towns").select("TOWNID", "TOWNENG", "COUNTYID", "shp_version")
    return boundaries.union_boundaries([load(spark, sf_dir, "counties").select("COUNTYID", "shp_version"), towns])


@query("areas_by_level", ctes("towns", vx=vertex_sql(), n="SELECT k, count(DISTINCT part) AS n_parts, count(*) AS n_points FROM vx GROUP BY k")
  + "SELECT area_id, shp_version, n_parts, n_points FROM towns LEFT JOIN n ON n.k = towns.k")
def areas_by_level(spark, sf_dir):
    shapes = town_shapes(spark, sf_dir).select("k", "geometry")
    areas = boundaries.areas_by_level(load(spark, sf_dir, "areas").join(shapes, "k", "left"), "town")
    size = lambda c: F.when(F.col("parts").isNotNull(), F.size(c)).cast("long")
    return areas.select("area_id", "shp_version", size("parts").alias("n_parts"), size(F.flatten(F.flatten("parts"))).alias("n_points"))


@query("version_stamp", ctes("areas") + f"""SELECT area_id, shp_version, nullif({STAMP}, '') AS stamp,
  CAST(try_strptime(CAST(CAST(left(nullif({STAMP}, ''), 3) AS INT) + 1911 AS VARCHAR) || right({STAMP}, 4), '%Y%m%d') AS DATE) AS stamp_date FROM areas""")
def version_stamp(spark, sf_dir):
    return boundaries.version_stamp(load(spark, sf_dir, "areas")).select("area_id", "shp_version", "stamp", "stamp_date")


@query("versions_desc", ctes("areas") + f"SELECT DISTINCT {STAMP} AS stamp FROM areas WHERE {STAMP} <> ''")
def versions_desc(spark, sf_dir):
    return boundaries.versions_desc(load(spark, sf_dir, "areas"))


@query("areas_of_version", ctes("areas") + "SELECT area_id, shp_version FROM areas WHERE contains(shp_version, '1140318')")
def areas_of_version(spark, sf_dir):
    return boundaries.areas_of_version(load(spark, sf_dir, "areas"), "1140318").select("area_id", "shp_version")


@query("overlap_rule", ctes("areas") + "SELECT area_id, shp_version FROM areas WHERE NOT (area_id = 'T28' AND lower(shp_version) LIKE '%town_moi%')")
def overlap_rule(spark, sf_dir):
    return boundaries.without_split_town(load(spark, sf_dir, "areas")).select("area_id", "shp_version")


@query("batch_gate", ctes("gate_areas") + """SELECT shp_version, count(*) AS n_rows, count(*) FILTER (area_id IS NULL OR trim(area_id) = '') AS n_missing,
  count(*) FILTER (area_id IS NULL OR trim(area_id) = '') = 0 AS accepted FROM gate_areas GROUP BY shp_version""")
def batch_gate(spark, sf_dir):
    return boundaries.batch_gate(load(spark, sf_dir, "gate_areas"))


@query("accepted_batches", ctes("gate_areas") + """SELECT * FROM gate_areas WHERE shp_version NOT IN
  (SELECT shp_version FROM gate_areas WHERE area_id IS NULL OR trim(area_id) = '')""")
def accepted_batches(spark, sf_dir):
    return boundaries.accepted_batches(load(spark, sf_dir, "gate_areas"))


@query("backfill_county_name", ctes("named_areas", filled=BACKFILL) + "SELECT area_id, shp_version, COUNTYENG FROM filled")
def backfill_county_name(spark, sf_dir):
    return boundaries.backfill_county_name(load(spark, sf_dir, "named_areas")).select("area_id", "shp_version", "COUNTYENG")


@query("region_names", ctes("named_areas", filled=BACKFILL) + f"""SELECT area_id, shp_version,
  replace(CASE WHEN area_level = 'town' THEN COUNTYENG || '_' || TOWNENG ELSE COUNTYENG END, ' ', '_') AS region_name FROM filled WHERE {REASON} IS NULL""")
def region_names(spark, sf_dir):
    named = boundaries.with_region_name(boundaries.backfill_county_name(load(spark, sf_dir, "named_areas")))
    return named.where("reject_reason is null").select("area_id", "shp_version", "region_name")


@query("region_rejects", ctes("named_areas", filled=BACKFILL) + f"SELECT area_id, shp_version, {REASON} AS reject_reason FROM filled WHERE {REASON} IS NOT NULL")
def region_rejects(spark, sf_dir):
    named = boundaries.with_region_name(boundaries.backfill_county_name(load(spark, sf_dir, "named_areas")))
    return named.where("reject_reason is not null").select("area_id", "shp_version", "reject_reason")


@query("new_versions", ctes("areas") + "SELECT area_id, shp_version FROM areas WHERE shp_version NOT IN (SELECT shp_version FROM areas WHERE pos % 40 = 1)")
def new_versions(spark, sf_dir):
    areas = load(spark, sf_dir, "areas")
    return boundaries.new_versions(areas, areas.where("pos % 40 = 1")).select("area_id", "shp_version")


@query("upsert_ignore", ctes("insert_batch", "stored_areas") + """SELECT area_id, shp_version, name FROM stored_areas UNION ALL
  SELECT area_id, shp_version, name FROM (SELECT *, row_number() OVER (PARTITION BY area_id, shp_version ORDER BY pos) AS rn FROM insert_batch) b
  WHERE area_id IS NULL OR (rn = 1 AND NOT EXISTS (SELECT 1 FROM stored_areas s WHERE s.area_id = b.area_id AND s.shp_version = b.shp_version))""")
def upsert_ignore(spark, sf_dir):
    return boundaries.insert_new(load(spark, sf_dir, "stored_areas"), load(spark, sf_dir, "insert_batch"), "pos")


LAYER_NAMES = f"""SELECT name_zh, name_en, 'static' AS origin FROM ({STATIC_SQL}) s WHERE name_zh NOT IN (SELECT name_zh FROM overrides) UNION ALL
  SELECT name_zh, arg_max(name_en, pos), 'override' FROM overrides GROUP BY name_zh"""


@query("layer_name_lookup", ctes("map_titles", "overrides", known=LAYER_NAMES) + "SELECT id, map_name, name_en, origin FROM map_titles LEFT JOIN known ON map_name = name_zh")
def layer_name_lookup(spark, sf_dir):
    known = names.layer_names(names.static_layers(spark), load(spark, sf_dir, "overrides"), "pos")
    return names.look_up(load(spark, sf_dir, "map_titles"), known)


@query("layer_name_misses", ctes("map_titles", "overrides", known=LAYER_NAMES) + """SELECT map_name, count(*) AS n FROM map_titles
  WHERE map_name NOT IN (SELECT name_zh FROM known) GROUP BY map_name""")
def layer_name_misses(spark, sf_dir):
    known = names.layer_names(names.static_layers(spark), load(spark, sf_dir, "overrides"), "pos")
    found = names.look_up(load(spark, sf_dir, "map_titles"), known)
    return found.where("name_en is null").groupBy("map_name").agg(F.count("*").alias("n"))


OWN = ("土壤坡度", "own_slope")


@query("layer_overrides", ctes("map_titles", "overrides", more=f"SELECT name_zh, name_en, pos FROM overrides UNION ALL SELECT '{OWN[0]}', '{OWN[1]}', (SELECT max(pos) + 1 FROM overrides)",
    known=LAYER_NAMES.replace("overrides", "more")) + "SELECT name_en, origin, count(*) AS n FROM map_titles JOIN known ON map_name = name_zh GROUP BY name_en, origin")
def layer_overrides(spark, sf_dir):
    """How often each name is shown after one more override was added."""
    more = names.add_override(load(spark, sf_dir, "overrides"), *OWN, "pos")
    known = names.layer_names(names.static_layers(spark), more, "pos")
    found = names.look_up(load(spark, sf_dir, "map_titles"), known)
    return found.where("name_en is not null").groupBy("name_en", "origin").agg(F.count("*").alias("n"))


@query("boundary_stream", ctes("gate_areas") + """SELECT shp_version, source, count(DISTINCT area_id) AS n FROM (
    SELECT *, CASE WHEN pos % 3 = 0 THEN 'early' ELSE 'late' END AS source FROM gate_areas) a
  WHERE NOT EXISTS (SELECT 1 FROM gate_areas b WHERE b.shp_version = a.shp_version AND (b.pos % 3 = 0) = (a.pos % 3 = 0) AND (b.area_id IS NULL OR trim(b.area_id) = ''))
    AND NOT (area_id = 'T28' AND lower(shp_version) LIKE '%town_moi%') GROUP BY shp_version, source""")
def boundary_stream(spark, sf_dir):
    """Areas that come in two files, one after the other: what of each file was stored."""
    folder = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = load(spark, sf_dir, "gate_areas").withColumn("early", F.col("pos") % 3 == 0)
    for source in ("early", "late"):
        part = rows.where(F.col("early") == (source == "early")).select("area_id", "shp_version", F.col("pos").alias("record"), F.lit(source).alias("source"))
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        ingest_stream(spark, f"{folder}/in", part.schema, f"{folder}/areas", f"{folder}/state").awaitTermination()
    stored = spark.read.schema("area_id string, source string, shp_version string, source_file string").parquet(f"{folder}/areas")
    return stored.groupBy("shp_version", "source").agg(F.count("*").alias("n"))


@query("wkt_roundtrip", ctes(vx=vertex_sql()) + f"""SELECT k, CAST(nullif(count(x), 0) AS BIGINT) AS n_points, round(sum(x), 6) AS sum_x, round(sum(y), 6) AS sum_y, CASE WHEN count(x) > 0 THEN true END AS same
  FROM (SELECT s_suppkey AS k FROM supplier) t LEFT JOIN vx USING (k) GROUP BY k""")
def wkt_roundtrip(spark, sf_dir):
    from fieldmosaic.functions.wkt import write_multipolygon

    shapes = town_shapes(spark, sf_dir).withColumn("parts", parse_polygon(F.col("geometry")))
    again = shapes.withColumn("again", parse_polygon(write_multipolygon(F.col("parts"))))
    points = F.flatten(F.flatten("again"))
    total = lambda axis: F.round(F.aggregate(F.transform(points, lambda p: p[axis]), F.lit(0.0), lambda a, v: a + v), 6)
    return again.select("k", F.size(points).cast("long").alias("n_points"), total("x").alias("sum_x"), total("y").alias("sum_y"),
                        (F.col("parts") == F.col("again")).alias("same"))
