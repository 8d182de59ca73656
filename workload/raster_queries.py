"""Polygon and pixel queries."""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from fieldmosaic.functions.wkt import parse_polygon
from fieldmosaic.operators import colors, geometry, raster, repair, runs
from fieldmosaic.plans import mapping
from fieldmosaic.runtime import materialize, spread, stored
from fieldmosaic.sources.images import image_pixels
from fieldmosaic.sources.shapefiles import attribute_records, join_records, shape_records
from fieldmosaic.tables.color_values import legend_rows
from fieldmosaic.tables.layer_values import CROP_PREFIX, layer_rows
from workload.inputs import ctes, load, town_shapes, vertex_sql
from workload.registry import query
from workload.state_queries import BOXES, framed_sql

COLOR_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"('{layer}', {b}, {g}, {r}, '{label}', {'NULL' if num is None else num})" for layer, _, b, g, r, label, num, _, _ in legend_rows()
) + ") v(layer, b, g, r, label, value_num)"
LEGEND_CASE = f"CASE WHEN starts_with(classification, '{CROP_PREFIX}') THEN '{CROP_PREFIX}' " + " ".join(
    f"WHEN classification = '{en}' THEN '{legend}'" for _, en, legend in layer_rows() if not en.startswith(CROP_PREFIX)
) + " ELSE classification END"
CLASSES = f"""SELECT area_id, shp_version, classification, coalesce(label, 'unmapped') AS label, count(*) AS n_pixels FROM (
  SELECT p.*, c.label FROM (SELECT *, {LEGEND_CASE} AS layer FROM pixels) p LEFT JOIN ({COLOR_SQL}) c
    ON p.layer = c.layer AND p.b = c.b AND p.g = c.g AND p.r = c.r
  WHERE NOT (p.b >= 254 AND p.g >= 254 AND p.r >= 254) AND NOT (p.b = 0 AND p.g = 0 AND p.r = 0)) q
  GROUP BY area_id, shp_version, classification, coalesce(label, 'unmapped')"""

# Pixel grid of the derived images: the polygon box cut into 200 x 200 pixels.
GRID = 200


def grid_areas(spark, sf_dir):
    """Towns with the frame of the 200 x 200 grid."""
    shapes = spread(town_shapes(spark, sf_dir)).withColumn("parts", parse_polygon(F.col("geometry"))).where("parts is not null")
    return shapes.select("area_id", "k", "parts", geometry.bbox(F.col("parts")).alias("box"), F.lit(GRID).alias("width"), F.lit(GRID).alias("height"))


# Brute force in DuckDB: every pixel against every edge of its area, parity per part.
EDGES = f"""SELECT k, part, (x1 - minx) * {GRID} / (maxx - minx) AS x1, (maxy - y1) * {GRID} / nullif(maxy - miny, 0) AS y1,
    (x2 - minx) * {GRID} / (maxx - minx) AS x2, (maxy - y2) * {GRID} / nullif(maxy - miny, 0) AS y2 FROM (
  SELECT k, part, ring, x AS x1, y AS y1, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
  FROM vx WINDOW w AS (PARTITION BY k, part, ring ORDER BY seq)) e JOIN boxes USING (k)"""
IDS = "SELECT DISTINCT k, area_id FROM towns"
INSIDE = """SELECT area_id, row, col FROM (
  SELECT p.area_id, p.row, p.col, e.part, count(*) AS n FROM (SELECT DISTINCT area_id, row, col FROM pixels) p JOIN ids USING (area_id) JOIN edges e ON e.k = ids.k
  WHERE least(e.y1, e.y2) <= p.row + 0.5 AND p.row + 0.5 < greatest(e.y1, e.y2)
    AND e.x1 + (p.row + 0.5 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) > p.col + 0.5
  GROUP BY p.area_id, p.row, p.col, e.part) h WHERE n % 2 = 1 GROUP BY area_id, row, col"""


def masked_sql(**extra: str) -> str:
    return ctes("towns", "pixels", vx=vertex_sql(), boxes=BOXES, edges=EDGES, ids=IDS, inside=INSIDE, **extra)


@query("quantify_classes", ctes("pixels", classes=CLASSES) + "SELECT *, CAST(n_pixels * 10000 AS DOUBLE) AS area_m2 FROM classes")
def quantify_classes(spark, sf_dir):
    return raster.quantify_classes(load(spark, sf_dir, "pixels"), colors.color_map(spark))


@query("class_share", ctes("pixels", classes=CLASSES) + """SELECT *, round(n_pixels / sum(n_pixels) OVER (PARTITION BY area_id, shp_version, classification), 6) AS share FROM classes""")
def class_share(spark, sf_dir):
    classes = raster.quantify_classes(load(spark, sf_dir, "pixels"), colors.color_map(spark)).drop("area_m2")
    return raster.class_share(classes).withColumn("share", F.round("share", 6))


@query("class_features", ctes("pixels", classes=CLASSES) + f"""SELECT area_id, shp_version, classification, CAST(sum(n_pixels) AS BIGINT) AS n_pixels,
  round(sum(n_pixels * value_num) / sum(CASE WHEN value_num IS NOT NULL THEN n_pixels END), 6) AS mean_value FROM (SELECT *, {LEGEND_CASE} AS layer FROM classes) c
  LEFT JOIN (SELECT DISTINCT layer, label, value_num FROM ({COLOR_SQL}) m) v USING (layer, label) GROUP BY area_id, shp_version, classification""")
def class_features(spark, sf_dir):
    legend = colors.color_map(spark)
    wide = raster.class_features(raster.quantify_classes(load(spark, sf_dir, "pixels"), legend), legend)
    return wide.select("area_id", "shp_version", "classification", "n_pixels", F.round("mean_value", 6).alias("mean_value"))


VECTORS = "SELECT * FROM (VALUES " + ", ".join(
    f"('{layer}', '{label}', {vec[0]}, {vec[1]}, {vec[2]})" for layer, label, vec in sorted({(r[0], r[5], tuple(r[8])) for r in legend_rows() if r[8]})
) + ") v(layer, label, sand, silt, clay)"
VALUES = ("mean_value", "sand", "silt", "clay")
WIDE_LAYERS = ("soil_survey_ph", "soil_survey_texture_0_30cm", "farmland_importance_level")


@query("area_features", ctes("pixels", classes=CLASSES, layered=f"SELECT *, {LEGEND_CASE} AS layer FROM classes",
  valued=f"""SELECT area_id, shp_version, classification, {", ".join(
    f"sum(n_pixels * {v}) / sum(CASE WHEN {v} IS NOT NULL THEN n_pixels END) AS {v}" for v in ("value_num", "sand", "silt", "clay"))}
    FROM layered LEFT JOIN (SELECT DISTINCT layer, label, value_num FROM ({COLOR_SQL}) m) n USING (layer, label) LEFT JOIN ({VECTORS}) t USING (layer, label)
    GROUP BY area_id, shp_version, classification""") + "SELECT area_id, shp_version, " + ", ".join(
    f"round(max(CASE WHEN classification = '{la}' THEN {v.replace('mean_value', 'value_num')} END), 6) AS {la}_{v}" for la in WIDE_LAYERS for v in VALUES)
  + " FROM valued GROUP BY area_id, shp_version")
def area_features(spark, sf_dir):
    legend = colors.color_map(spark)
    long = raster.class_features(raster.quantify_classes(load(spark, sf_dir, "pixels"), legend), legend)
    wide = raster.features_by_area(long, list(WIDE_LAYERS), list(VALUES))
    return wide.select("area_id", "shp_version", *[F.round(c, 6).alias(c) for c in wide.columns[2:]])


# The six layers of the pixel input have no coded class, so this query reads two of them as coded soil maps.
RELAYERED = """SELECT * REPLACE (CASE classification WHEN 'soil_survey_ph' THEN 'soil_survey_soil_properties'
  WHEN 'soil_survey_drainage' THEN 'soil_survey_lime_and_salinity' ELSE classification END AS classification) FROM pixels"""
CODES = ["SP13", "SCSA1"]


@query("code_shares", ctes("pixels", coded=RELAYERED, classes=CLASSES.replace("FROM pixels)", "FROM coded)")) + """SELECT area_id, shp_version, classification,
  round(sum(CASE WHEN value_code = 'SP13' THEN n_pixels ELSE 0 END) / sum(n_pixels), 6) AS share_SP13,
  round(sum(CASE WHEN value_code = 'SCSA1' THEN n_pixels ELSE 0 END) / sum(n_pixels), 6) AS share_SCSA1 FROM (
    SELECT *, CASE WHEN classification = 'soil_survey_soil_properties' AND label = 'recent_alluvium' THEN 'SP13'
      WHEN classification = 'soil_survey_lime_and_salinity' AND label = 'calcareous' THEN 'SCSA1' END AS value_code FROM classes) c
  GROUP BY area_id, shp_version, classification""")
def code_shares(spark, sf_dir):
    legend, layer = colors.color_map(spark), F.col("classification")
    coded = load(spark, sf_dir, "pixels").withColumn(
        "classification", F.when(layer == "soil_survey_ph", "soil_survey_soil_properties")
        .when(layer == "soil_survey_drainage", "soil_survey_lime_and_salinity").otherwise(layer))
    out = raster.code_shares(raster.quantify_classes(coded, legend), legend, CODES)
    return out.withColumns({f"share_{c}": F.round(f"share_{c}", 6) for c in CODES})


@query("distinct_colors", ctes("pixels") + "SELECT DISTINCT b, g, r FROM pixels WHERE b < 254 OR g < 254 OR r < 254")
def distinct_colors(spark, sf_dir):
    return raster.distinct_colors(load(spark, sf_dir, "pixels"))


@query("nearly_white", ctes("pixels") + """SELECT area_id, classification, row, sum(b::BIGINT + g + r) / (3 * count(*)) >= 254 AS nearly_white FROM pixels GROUP BY area_id, classification, row""")
def nearly_white(spark, sf_dir):
    return raster.nearly_white(load(spark, sf_dir, "pixels"), ["area_id", "classification", "row"])


@query("white_background", ctes("pixels") + """SELECT area_id, classification, row, bool_or(b >= 254 AND g >= 254 AND r >= 254) AS has_white FROM pixels GROUP BY area_id, classification, row""")
def white_background(spark, sf_dir):
    return raster.white_background(load(spark, sf_dir, "pixels"), ["area_id", "classification", "row"])


@query("color_map_table", ctes("pixels") + f"""SELECT c.layer, c.b || ',' || c.g || ',' || c.r AS key, c.label, count(p.classification) AS n_pixels
  FROM ({COLOR_SQL}) c LEFT JOIN (SELECT *, {LEGEND_CASE} AS layer FROM pixels) p ON p.layer = c.layer AND p.b = c.b AND p.g = c.g AND p.r = c.r
  GROUP BY c.layer, c.b, c.g, c.r, c.label""")
def color_map_table(spark, sf_dir):
    used = load(spark, sf_dir, "pixels").groupBy(
        raster.legend_of(F.col("classification")).alias("layer"), colors.color_key(F.col("b"), F.col("g"), F.col("r")).alias("key")
    ).agg(F.count("*").alias("n_pixels"))
    legend = colors.color_map(spark).select("layer", colors.color_key(F.col("b"), F.col("g"), F.col("r")).alias("key"), "label")
    return legend.join(used, ["layer", "key"], "left").withColumn("n_pixels", F.coalesce("n_pixels", F.lit(0).cast("long")))


@query("add_color_map", ctes("pixels") + f"""SELECT layer, b, g, r, label FROM ({COLOR_SQL}) c UNION ALL
  SELECT 'new_layer', b, g, r, 'class_' || b || '_' || g FROM (SELECT DISTINCT b, g, r FROM pixels WHERE b < 254 OR g < 254 OR r < 254) d""")
def add_color_map(spark, sf_dir):
    found = raster.distinct_colors(load(spark, sf_dir, "pixels"))
    labelled = found.select(*[F.col(c).cast("int").alias(c) for c in "bgr"], F.concat_ws(" ", F.lit("Class"), "b", "g").alias("label"))
    once = colors.add_legend(colors.color_map(spark), "new_layer", "new data", labelled)
    twice = colors.add_legend(once, "soil_ph", "ignored", labelled)
    return twice.select("layer", "b", "g", "r", "label")


@query("polygon_bbox", ctes(vx=vertex_sql()) + "SELECT k, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM (SELECT s_suppkey AS k FROM supplier) t LEFT JOIN vx USING (k) GROUP BY k")
def polygon_bbox(spark, sf_dir):
    shapes = town_shapes(spark, sf_dir).withColumn("parts", parse_polygon(F.col("geometry")))
    return shapes.select("k", geometry.bbox(F.col("parts")).alias("box")).select("k", "box.*")


@query("polygon_vertices", ctes(vx=vertex_sql()) + "SELECT k, part, ring, seq, x, y FROM vx")
def polygon_vertices(spark, sf_dir):
    shapes = town_shapes(spark, sf_dir).withColumn("parts", parse_polygon(F.col("geometry")))
    return geometry.vertices(shapes, ["k"])


@query("polygon_mask", masked_sql() + """SELECT p.area_id, p.classification, count(*) AS n_pixels, count(i.row) AS n_inside,
  CAST(coalesce(sum(CASE WHEN i.row IS NOT NULL THEN p.row * 1000 + p.col END), 0) AS BIGINT) AS place_sum,
  CAST(sum(CASE WHEN i.row IS NOT NULL THEN p.b + p.g + p.r ELSE 0 END) AS BIGINT) AS color_sum
  FROM pixels p LEFT JOIN inside i ON i.area_id = p.area_id AND i.row = p.row AND i.col = p.col GROUP BY p.area_id, p.classification""")
def polygon_mask(spark, sf_dir):
    pixels = runs.pixel_runs(load(spark, sf_dir, "pixels"), ["area_id", "classification"])
    areas = materialize(grid_areas(spark, sf_dir))  # parsed once: the plan above it stays small
    masked = runs.blackened(runs.clip(pixels, geometry.mask_spans(areas, ["area_id"]), ["area_id"]))
    n = runs.length()
    place = (F.col("row") * 1000 + F.col("first")).cast("long") * n + (n * (n - 1) / 2).cast("long")
    return masked.groupBy("area_id", "classification").agg(
        F.sum(n).alias("n_pixels"), F.sum(F.when(F.col("inside"), n).otherwise(0)).alias("n_inside"),
        F.coalesce(F.sum(F.when(F.col("inside"), place)), F.lit(0)).alias("place_sum"),
        F.sum((F.col("b").cast("long") + F.col("g") + F.col("r")) * n).alias("color_sum"),
    )


# Krüger's series in DuckDB for vx rows, and ring areas relative to the first vertex.
PLANE = """SELECT k, part, ring, seq, 250000 + 0.9999 * rr * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta)
    + a4 * cos(8 * xi) * sinh(8 * eta)) AS px,
  0.9999 * rr * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta) + a4 * sin(8 * xi) * cosh(8 * eta)) AS py FROM (
  SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta, 6378137.0 / (1 + n) * (1 + n * n / 4 + pow(n, 4) / 64) AS rr,
    n / 2 - 2 * pow(n, 2) / 3 + 5 * pow(n, 3) / 16 + 41 * pow(n, 4) / 180 AS a1, 13 * pow(n, 2) / 48 - 3 * pow(n, 3) / 5 + 557 * pow(n, 4) / 1440 AS a2,
    61 * pow(n, 3) / 240 - 103 * pow(n, 4) / 140 AS a3, 49561 * pow(n, 4) / 161280 AS a4 FROM (
    SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t FROM (
      SELECT k, part, ring, seq, radians(y) AS phi, radians(x - 121) AS dl, nn AS n, 2 * sqrt(nn) / (1 + nn) AS e
      FROM vx, (SELECT (1 / 298.257222101) / (2 - 1 / 298.257222101) AS nn) c) s1) s2) s3"""
RING_AREA = """SELECT k, part, ring, abs(sum((x1 - ox) * (y2 - oy) - (x2 - ox) * (y1 - oy))) / 2 AS m2 FROM (
  SELECT k, part, ring, px AS x1, py AS y1, coalesce(lead(px) OVER w, first_value(px) OVER w) AS x2, coalesce(lead(py) OVER w, first_value(py) OVER w) AS y2,
    first_value(px) OVER w AS ox, first_value(py) OVER w AS oy FROM plane WINDOW w AS (PARTITION BY k, part, ring ORDER BY seq)) s GROUP BY k, part, ring"""
AREAS_M2 = "SELECT k, sum(CASE WHEN ring = 0 THEN m2 ELSE -m2 END) AS m2 FROM ring_area GROUP BY k"


@query("polygon_area", ctes(vx=vertex_sql(), plane=PLANE, ring_area=RING_AREA, size=AREAS_M2) + "SELECT k, CAST(round(m2) AS BIGINT) AS area_m2 FROM (SELECT s_suppkey AS k FROM supplier) t LEFT JOIN size USING (k)")
def polygon_area(spark, sf_dir):
    shapes = town_shapes(spark, sf_dir).withColumn("parts", parse_polygon(F.col("geometry")))
    return shapes.select("k", F.round(geometry.polygon_area(F.col("parts"))).cast("long").alias("area_m2"))


@query("quantify_mask", masked_sql(plane=PLANE, ring_area=RING_AREA, size=AREAS_M2, kept="SELECT p.* FROM pixels p JOIN inside i ON i.area_id = p.area_id AND i.row = p.row AND i.col = p.col",
  classes=CLASSES.replace("FROM pixels)", "FROM kept)")) + """SELECT c.*, CAST(round(n_pixels / sum(n_pixels) OVER (PARTITION BY area_id, shp_version, classification) * m2) AS BIGINT) AS class_m2
  FROM classes c JOIN ids USING (area_id) JOIN size USING (k)""".replace("SELECT c.*", "SELECT c.area_id, c.shp_version, c.classification, c.label, c.n_pixels"))
def quantify_mask(spark, sf_dir):
    areas = materialize(grid_areas(spark, sf_dir).withColumn("polygon_m2", geometry.polygon_area(F.col("parts"))))
    out = runs.quantify_mask(load(spark, sf_dir, "pixels"), colors.color_map(spark), areas, ["area_id"])
    return out.select("area_id", "shp_version", "classification", "label", "n_pixels", F.round("class_m2").cast("long").alias("class_m2"))


IMAGE_KEY = "area_id, classification, shp_version"
MAPPED = {
    "state": """SELECT i.*, i.n % 4 = 3 AS done, CASE WHEN i.content IS NULL OR i.area_id NOT IN (SELECT area_id FROM ids JOIN boxes USING (k)) THEN 'error'
      WHEN b.path IS NULL THEN 'created' WHEN b.content = i.content THEN 'unchanged' ELSE 'updated' END AS status FROM images i LEFT JOIN images_before b USING (path)""",
    "acted": "SELECT *, CASE WHEN status = 'error' THEN 'stop' WHEN status = 'unchanged' AND done THEN 'skip' ELSE 'mask' END AS action FROM state",
    "logged": f"""SELECT {IMAGE_KEY}, 'raw' AS stage, path AS file_path FROM acted WHERE action = 'mask' UNION ALL
      SELECT {IMAGE_KEY}, 'masked', replace(path, '/raw/', '/masked/') FROM acted WHERE action = 'mask' AND n % 8 <> 3""",
    "after": f"""SELECT l.id, {IMAGE_KEY}, stage, coalesce(g.file_path, l.file_path) AS file_path, CASE WHEN g.file_path IS NULL THEN l.recorded_at ELSE DATE '2000-02-01' END AS recorded_at
      FROM image_ledger l LEFT JOIN logged g USING ({IMAGE_KEY}, stage) UNION ALL
      SELECT (SELECT max(id) FROM image_ledger) + row_number() OVER (ORDER BY {IMAGE_KEY}, stage), {IMAGE_KEY}, stage, file_path, DATE '2000-02-01'
      FROM logged g ANTI JOIN image_ledger l USING ({IMAGE_KEY}, stage)""",
    # what the store of masks shows: new masks, and old ones whose green channel was one higher in a part of the images
    "kept": f"""SELECT p.area_id, p.shp_version, p.classification, p.row, p.col, p.b, CAST(p.g + CASE WHEN action = 'mask' OR n % 8 = 3 THEN 0 ELSE 1 END AS SMALLINT) AS g, p.r
      FROM pixels p JOIN acted USING ({IMAGE_KEY}) JOIN inside i ON i.area_id = p.area_id AND i.row = p.row AND i.col = p.col WHERE action = 'mask' OR done
      UNION ALL SELECT p.area_id, p.shp_version, p.classification, p.row, p.col, 0, 1, 0 FROM pixels p JOIN acted USING ({IMAGE_KEY})
      LEFT JOIN inside i ON i.area_id = p.area_id AND i.row = p.row AND i.col = p.col WHERE action <> 'mask' AND n % 8 = 7 AND i.row IS NULL""",
}


def mapping_sql() -> str:
    base = ctes("towns", "pixels", "images", "images_before", "image_ledger", vx=vertex_sql(), boxes=BOXES, edges=EDGES, ids=IDS, inside=INSIDE,
                **MAPPED, classes=CLASSES.replace("FROM pixels)", "FROM kept)"),
                counts=f"SELECT {IMAGE_KEY}, CAST(sum(n_pixels) AS BIGINT) AS n_pixels, count(*) AS n_classes FROM classes GROUP BY {IMAGE_KEY}")
    return base + f"SELECT a.*, status, action, n_pixels, n_classes FROM after a LEFT JOIN acted USING ({IMAGE_KEY}) LEFT JOIN counts USING ({IMAGE_KEY})"


@query("mapping_job", mapping_sql())
def mapping_job(spark, sf_dir):
    """The ledger after a run, beside each image's status, action and what its mask shows."""
    given = {"pixels": stored(load(spark, sf_dir, "pixels"), "pixels")}  # grouped out of the line items once, for the images and all that is made of them
    given["images"] = stored(load(spark, sf_dir, "images", given), "images")
    images, pixels = given["images"], given["pixels"]
    areas = materialize(grid_areas(spark, sf_dir))
    spans = stored(geometry.mask_spans(areas, ["area_id"]), "spans")
    old = pixels.join(images.where("n % 4 = 3").select(*mapping.IMAGE, (F.col("n") % 8 == 7).alias("off")), mapping.IMAGE)
    old = raster.apply_mask(old, areas, ["area_id"], spans)
    old = old.withColumn("g", (F.col("g") + F.when(F.col("off"), 1).otherwise(0)).cast("smallint")).select(*pixels.columns)
    known, ledger, files = (load(spark, sf_dir, name, given) for name in ("images_before", "image_ledger", "image_files"))
    out = mapping.run(images.drop("n", "total"), known, pixels, areas, ["area_id"], ledger, stored(old, "masked"), files, spans)
    counts = raster.quantify_classes(out.masked, colors.color_map(spark)).groupBy(*mapping.IMAGE).agg(
        F.sum("n_pixels").alias("n_pixels"), F.count("*").alias("n_classes"))
    rows = out.ledger.join(out.work.select(*mapping.IMAGE, "status", "action"), mapping.IMAGE, "left").join(counts, mapping.IMAGE, "left")
    return rows.select("id", *mapping.IMAGE, "stage", "file_path", "recorded_at", "status", "action", "n_pixels", "n_classes")


@query("pixel_lonlat", ctes("towns", "pixels", vx=vertex_sql(), boxes=BOXES, ids=IDS) + f"""SELECT area_id, classification, row, col,
  round(minx + (col + 0.5) * (maxx - minx) / {GRID}, 9) AS lon, round(maxy - (row + 0.5) * (maxy - miny) / {GRID}, 9) AS lat
  FROM pixels JOIN ids USING (area_id) JOIN boxes USING (k)""")
def pixel_lonlat(spark, sf_dir):
    joined = load(spark, sf_dir, "pixels").join(grid_areas(spark, sf_dir).select("area_id", "box", "width", "height"), "area_id")
    place = geometry.pixel_lonlat(F.col("box"), F.col("width"), F.col("height"), F.col("row"), F.col("col"))
    return joined.select("area_id", "classification", "row", "col", F.round(place.lon, 9).alias("lon"), F.round(place.lat, 9).alias("lat"))


@query("image_size_check", framed_sql("towns", "pixels") + """SELECT p.area_id, p.classification, actual_w, actual_h, width AS expected_w, height AS expected_h,
  coalesce(abs(actual_w - width) <= 110 AND abs(actual_h - height) <= 110, false) AS accepted FROM (
  SELECT area_id, classification, max(col) + 1 AS actual_w, max(row) + 1 AS actual_h FROM pixels GROUP BY area_id, classification) p
  LEFT JOIN (SELECT DISTINCT area_id, width, height FROM towns JOIN frames USING (k)) f USING (area_id)""")
def image_size_check(spark, sf_dir):
    areas = geometry.with_frame(town_shapes(spark, sf_dir))
    return geometry.image_size_check(load(spark, sf_dir, "pixels"), areas, ["area_id", "classification"], ["area_id"], tolerance=110)


SEGMENTS = """SELECT k, part, ring, seq, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy,
    n FROM vx WINDOW w AS (PARTITION BY k, part, ring ORDER BY seq)"""
LOOPS = """SELECT k, part, ring, seq, x1, y1, coalesce(x2, fx) AS x2, coalesce(y2, fy) AS y2, x2 IS NOT NULL AND x1 = x2 AND y1 = y2 AS rep,
    x2 IS NULL AND (x1 <> fx OR y1 <> fy) AS open_end, (x1 - fx) * (coalesce(y2, fy) - fy) - (coalesce(x2, fx) - fx) * (y1 - fy) AS cr, n FROM seg"""
CROSSED = """SELECT DISTINCT a.k, a.part, a.ring FROM loops a JOIN loops b ON a.k = b.k AND a.part = b.part AND a.ring = b.ring AND a.seq < b.seq
  WHERE ((b.x1 - a.x1) * (a.y2 - a.y1) - (b.y1 - a.y1) * (a.x2 - a.x1)) * ((b.x2 - a.x1) * (a.y2 - a.y1) - (b.y2 - a.y1) * (a.x2 - a.x1)) < -1e-22
    AND ((a.x1 - b.x1) * (b.y2 - b.y1) - (a.y1 - b.y1) * (b.x2 - b.x1)) * ((a.x2 - b.x1) * (b.y2 - b.y1) - (a.y2 - b.y1) * (b.x2 - b.x1)) < -1e-22"""


@query("ring_quality", ctes(vx=vertex_sql(), seg=SEGMENTS, loops=LOOPS, crossed=CROSSED) + """SELECT l.k, l.part, l.ring, max(n) AS n_points, bool_or(open_end) AS is_open,
  CAST(sum(rep::INT) AS INT) AS n_repeated, max(n) - sum(rep::INT) + CASE WHEN bool_or(open_end) THEN 1 ELSE 0 END < 4 AS too_few,
  abs(sum(cr)) < 1e-15 AS zero_area, bool_or(c.k IS NOT NULL) AS self_crossing
  FROM loops l LEFT JOIN crossed c ON c.k = l.k AND c.part = l.part AND c.ring = l.ring GROUP BY l.k, l.part, l.ring""")
def ring_quality(spark, sf_dir):
    shapes = town_shapes(spark, sf_dir).where("geometry is not null").withColumn("parts", parse_polygon(F.col("geometry")))
    return geometry.validate_rings(shapes, ["k"])


# The area of a crossing ring by the odd-even rule: between two heights nothing crosses, so every other gap counts.
SPOTS = """SELECT DISTINCT a.k, a.part, a.ring, a.y1 + ((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) / ((b.y2 - b.y1) * (a.x2 - a.x1) - (b.x2 - b.x1) * (a.y2 - a.y1)) * (a.y2 - a.y1) AS y
  FROM loops a JOIN loops b ON a.k = b.k AND a.part = b.part AND a.ring = b.ring AND a.seq < b.seq
  WHERE ((b.x1 - a.x1) * (a.y2 - a.y1) - (b.y1 - a.y1) * (a.x2 - a.x1)) * ((b.x2 - a.x1) * (a.y2 - a.y1) - (b.y2 - a.y1) * (a.x2 - a.x1)) < -1e-22
    AND ((a.x1 - b.x1) * (b.y2 - b.y1) - (a.y1 - b.y1) * (b.x2 - b.x1)) * ((a.x2 - b.x1) * (b.y2 - b.y1) - (a.y2 - b.y1) * (b.x2 - b.x1)) < -1e-22"""
LEVELS = """SELECT *, lead(y) OVER (PARTITION BY k, part, ring ORDER BY y) AS above FROM (
  SELECT k, part, ring, y FROM spots UNION SELECT l.k, l.part, l.ring, l.y1 FROM loops l JOIN (SELECT DISTINCT k, part, ring FROM spots) s ON s.k = l.k AND s.part = l.part AND s.ring = l.ring) h"""
GAPS = """SELECT k, part, ring, sum(CASE WHEN n % 2 = 0 THEN x ELSE -x END * (above - y)) AS size FROM (
  SELECT v.k, v.part, v.ring, v.y, above, x, row_number() OVER (PARTITION BY v.k, v.part, v.ring, v.y ORDER BY x) AS n FROM (
    SELECT v.*, l.x1 - 121 + ((v.y + above) / 2 - l.y1) / (l.y2 - l.y1) * (l.x2 - l.x1) AS x FROM levels v JOIN loops l ON l.k = v.k AND l.part = v.part AND l.ring = v.ring
      AND least(l.y1, l.y2) < (v.y + above) / 2 AND (v.y + above) / 2 < greatest(l.y1, l.y2)) v) g GROUP BY k, part, ring"""


@query("repair_polygons", ctes(vx=vertex_sql(), seg=SEGMENTS, loops=LOOPS, spots=SPOTS, levels=LEVELS, gaps=GAPS, sizes="""SELECT l.k, l.part, l.ring, coalesce(any_value(g.size), abs(sum(cr)) / 2) AS size,
    bool_or(g.k IS NOT NULL) AS broken FROM loops l LEFT JOIN gaps g ON g.k = l.k AND g.part = l.part AND g.ring = l.ring GROUP BY l.k, l.part, l.ring""") + """SELECT t.k, coalesce(n, 0) AS n_repaired,
  false AS still_crossing, s.size AS size FROM (SELECT CAST(s_suppkey AS BIGINT) AS k FROM supplier) t
  LEFT JOIN (SELECT k, CAST(sum(broken::INT) AS INT) AS n, round(sum(CASE WHEN ring = 0 THEN size ELSE -size END), 9) AS size FROM sizes GROUP BY k) s USING (k)""")
def repair_polygons(spark, sf_dir):
    """Every town, those without a shape too: rings rebuilt, whether any ring still crosses itself, the area in square degrees."""
    shapes = spread(town_shapes(spark, sf_dir)).select("k", parse_polygon(F.col("geometry")).alias("parts"))
    fixed = materialize(repair.repair_polygons(materialize(shapes), ["k"]))
    left = geometry.crossing_rings(fixed, ["k"]).select("k").distinct().withColumn("crossing", F.lit(True))

    def size(ring):
        o = F.element_at(ring, 1)
        terms = F.transform(ring, lambda p, i: (p.x - o.x) * (F.element_at(ring, (i + 1) % F.size(ring) + 1).y - o.y) - (F.element_at(ring, (i + 1) % F.size(ring) + 1).x - o.x) * (p.y - o.y))
        return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2

    whole = F.aggregate(F.transform("parts", lambda rings: F.aggregate(F.transform(rings, lambda r, j: size(r) * F.when(j == 0, 1).otherwise(-1)), F.lit(0.0), lambda a, t: a + t)), F.lit(0.0), lambda a, t: a + t)
    return fixed.join(left, "k", "left").select(F.col("k").cast("long").alias("k"), "n_repaired", F.coalesce("crossing", F.lit(False)).alias("still_crossing"), F.round(whole, 9).alias("size"))


def _png(row: np.ndarray, col: np.ndarray, paint: np.ndarray) -> bytes:
    """A 200 x 200 image as PNG bytes, with every line filter in turn; paint is red, green, blue."""
    image = np.full((GRID + 1, GRID + 1, 3), 255, np.uint8)
    image[row + 1, col + 1] = paint
    image[0] = image[:, 0] = 0  # what lies above the first line and left of it
    flat, left, above, corner = (x.reshape(GRID, -1) for x in (image[1:, 1:], image[1:, :-1], image[:-1, 1:], image[:-1, :-1]))
    lines = np.empty((GRID, 3 * GRID + 1), np.uint8)
    lines[:, 0], body = np.arange(GRID) % 5, lines[:, 1:]  # no filter, left, up, average, Paeth
    body[0::5] = flat[0::5]
    body[1::5] = flat[1::5] - left[1::5]
    body[2::5] = flat[2::5] - above[2::5]
    body[3::5] = flat[3::5] - ((left[3::5].astype(np.int16) + above[3::5]) >> 1).astype(np.uint8)
    a, b, c = (x[4::5].astype(np.int16) for x in (left, above, corner))
    near_left, near_above, near_corner = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
    nearest = np.where(near_left <= np.minimum(near_above, near_corner), a, np.where(near_above <= near_corner, b, c))  # the first of equal ones
    body[4::5] = flat[4::5] - nearest.astype(np.uint8)

    def chunk(kind: bytes, content: bytes) -> bytes:
        return struct.pack(">I", len(content)) + kind + content + struct.pack(">I", zlib.crc32(kind + content))

    header = struct.pack(">IIBBBBB", GRID, GRID, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def _pngs(batches):
    """(path, content) of images whose pixels come one after the other; the last of a batch waits for the next."""
    def files(table: pa.Table, bounds: list[int]) -> pa.RecordBatch:
        row, col, *paint = (table.column(c).to_numpy() for c in ("row", "col", "r", "g", "b"))
        paint = np.stack(paint, axis=1).astype(np.uint8)
        names = table.select(["area_id", "classification"]).take(bounds[:-1]).to_pylist()
        return pa.RecordBatch.from_arrays([
            pa.array([f"{n['area_id']}/{n['classification']}.png" for n in names], pa.string()),
            pa.array([_png(row[a:b], col[a:b], paint[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
        ], ["path", "content"])

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        fresh = np.ones(table.num_rows, bool)
        keys = [pc.dictionary_encode(table.column(c), null_encoding="encode").combine_chunks().indices.to_numpy() for c in ("area_id", "classification")]
        fresh[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = np.flatnonzero(fresh).tolist()
        for at in range(0, len(starts) - 1, 64):
            yield files(table, starts[at : at + 65])
        held = table.slice(starts[-1]) if starts else table
    if held is not None and held.num_rows:
        yield files(held, [0, held.num_rows])


@query("image_to_pixels", ctes("pixels") + f"""SELECT area_id || '/' || classification || '.png' AS path, CAST({GRID * GRID} AS BIGINT) AS n_pixels,
  count(*) FILTER (NOT (b >= 254 AND g >= 254 AND r >= 254)) AS n_coloured,
  CAST(coalesce(sum((row * {GRID} + col) * (b + 2 * g + 3 * r)) FILTER (NOT (b >= 254 AND g >= 254 AND r >= 254)), 0) AS BIGINT) AS checksum
  FROM pixels GROUP BY area_id, classification""")
def image_to_pixels(spark, sf_dir):
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # small rows, long work: not to be merged into few tasks
    sorted_ = load(spark, sf_dir, "pixels").repartition(tasks, "area_id", "classification").sortWithinPartitions("area_id", "classification")
    files = sorted_.select("area_id", "classification", "row", "col", "b", "g", "r").mapInArrow(_pngs, "path string, content binary")
    pixels, coloured = image_pixels(files), ~raster.is_white()
    place = (F.col("row") * GRID + F.col("col")).cast("long") * (F.col("b") + 2 * F.col("g") + 3 * F.col("r"))
    return pixels.groupBy("path").agg(
        F.count("*").alias("n_pixels"), F.count_if(coloured).alias("n_coloured"),
        F.coalesce(F.sum(F.when(coloured, place)), F.lit(0)).cast("long").alias("checksum"),
    )


RECORDS_PER_FILE = 50


def _shapefile(pdf: pd.DataFrame) -> pd.DataFrame:
    """A .shp and a .dbf of at most RECORDS_PER_FILE towns."""
    def ring_bytes(points: list, outer: bool) -> np.ndarray:
        ring = np.array([(p["x"], p["y"]) for p in points])
        x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
        turn = np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)
        return ring[::-1] if (turn > 0) == outer and turn != 0 else ring

    records, fields = [], []
    for number, row in enumerate(pdf.sort_values("k").itertuples(), start=1):
        if row.parts is None:
            body = struct.pack("<i", 0)
        else:
            rings = [ring_bytes(ring, i == 0) for part in json.loads(row.parts) for i, ring in enumerate(part)]
            points = np.concatenate(rings)
            starts = np.cumsum([0] + [len(r) for r in rings[:-1]])
            box = (*points.min(axis=0), *points.max(axis=0))
            body = struct.pack("<i4dii", 5, *box, len(rings), len(points)) + starts.astype("<i4").tobytes() + points.astype("<f8").tobytes()
        records.append(struct.pack(">ii", number, len(body) // 2) + body)
        fields.append(b" " + row.area_id.encode().ljust(12) + str(row.k).encode().rjust(10))
    size = 100 + sum(map(len, records))
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<ii", 1000, 5) + bytes(64)
    field = lambda name, kind, n: name.ljust(11, b"\0") + kind + bytes(4) + bytes([n]) + bytes(15)
    described = field(b"TOWNID", b"C", 12) + field(b"KEY", b"N", 10) + b"\r"
    dbf = struct.pack("<BBBBIHH", 3, 125, 1, 1, len(fields), 32 + len(described), 23) + bytes(20) + described + b"".join(fields)
    stem = f"TOWN_{int(pdf['file_no'].iloc[0])}"
    return pd.DataFrame({"path": [f"{stem}.shp", f"{stem}.dbf"], "content": [head + b"".join(records), dbf]})


@query("boundary_scan", ctes("towns", vx=vertex_sql()) + f"""SELECT i.area_id, 'TOWN_' || CAST(CAST(floor(i.k / {RECORDS_PER_FILE}) AS BIGINT) AS VARCHAR) AS shp_version,
  count(DISTINCT v.part) AS n_parts, count(v.k) AS n_points, round(coalesce(sum(v.x), 0), 6) AS sum_x
  FROM (SELECT DISTINCT k, area_id FROM towns) i LEFT JOIN vx v USING (k) GROUP BY i.k, i.area_id""")
def boundary_scan(spark, sf_dir):
    shapes = town_shapes(spark, sf_dir).select(
        "area_id", "k", F.to_json(parse_polygon(F.col("geometry"))).alias("parts"), F.floor(F.col("k") / RECORDS_PER_FILE).alias("file_no")
    )
    files = shapes.groupBy("file_no").applyInPandas(_shapefile, "path string, content binary")
    scanned = join_records(
        shape_records(files.where(F.col("path").endswith(".shp"))), attribute_records(files.where(F.col("path").endswith(".dbf")))
    ).withColumn("parts", parse_polygon(F.col("geometry")))
    points = F.flatten(F.flatten("parts"))
    none = F.col("parts").isNull()
    total = F.aggregate(F.transform(points, lambda p: p.x), F.lit(0.0), lambda a, v: a + v)
    return scanned.select(
        F.col("attributes")["TOWNID"].alias("area_id"), "shp_version",
        F.when(none, 0).otherwise(F.size("parts")).cast("long").alias("n_parts"),
        F.when(none, 0).otherwise(F.size(points)).cast("long").alias("n_points"),
        F.when(none, 0.0).otherwise(F.round(total, 6)).alias("sum_x"),
    )
