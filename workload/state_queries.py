"""Ledger, change-detection, constraint and request queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldmosaic.functions.url import rewrite_query
from fieldmosaic.operators import geometry, ledger, names, quality, wms
from fieldmosaic.runtime import checkpoint_folder, materialize
from fieldmosaic.schemas import LEDGER_FOLDERS
from fieldmosaic.sources import folders, sinks, versions
from workload.boundary_queries import STATIC_SQL
from workload.inputs import DEPENDS, INPUTS, ctes, load, town_id, town_shapes, vertex_sql
from workload.registry import query

INPUTS["store"] = "SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, s_nationkey AS nation FROM supplier"
INPUTS["store_batch"] = """
SELECT CASE WHEN c_custkey % 97 = 5 THEN NULL ELSE c_custkey % 150 END AS key, c_name AS name,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS balance, c_custkey AS pos
FROM customer"""
INPUTS["faulty_ledger"] = """
SELECT id, CASE WHEN id % 41 = 0 THEN NULL ELSE area_id END AS area_id, area_level, classification, shp_version,
  CASE WHEN id % 43 = 0 THEN 'other' ELSE stage END AS stage, CASE WHEN id % 47 = 0 THEN NULL ELSE file_path END AS file_path FROM ledger
UNION ALL SELECT id, area_id, area_level, classification, shp_version, stage, file_path FROM ledger WHERE id % 19 = 0"""
INPUTS["plan_rows"] = """
SELECT CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS INT) AS layer_no, """ + town_id("l_suppkey") + """ AS area_id
FROM lineitem GROUP BY l_returnflag, l_suppkey"""
INPUTS["requested"] = "SELECT area_id, classification, stage, count(*) AS n FROM ledger GROUP BY area_id, classification, stage"
INPUTS["urls"] = """
SELECT page_id, split_part(url, '#', 1) || CASE WHEN contains(url, '?') THEN '' ELSE '?x=1' END || CASE page_id % 5 WHEN 0 THEN '&bbox=0,0,1,1&STYLES=&width=5' WHEN 1 THEN '&BBOX=1%2C2' WHEN 2 THEN '&ref=again&name=a+b'
  WHEN 3 THEN '#part' ELSE '' END AS url
FROM pages"""
INPUTS["response_log"] = """
SELECT event_id, 'https://wms.example.com/' || event_type AS url, CAST(event_id % 4 AS INT) AS attempt,
  CAST(CASE user_id % 8 WHEN 0 THEN 200 WHEN 1 THEN 200 WHEN 2 THEN 404 WHEN 3 THEN 500 WHEN 4 THEN 503 WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE 200 END AS INT) AS status,
  CASE user_id % 8 WHEN 0 THEN 'image/png' WHEN 1 THEN 'text/xml' WHEN 7 THEN NULL ELSE 'text/html' END AS content_type,
  CASE user_id % 8 WHEN 5 THEN 'timeout' WHEN 6 THEN 'connection refused' ELSE NULL END AS error
FROM events"""
for _name in ("faulty_ledger", "requested"):
    DEPENDS[_name] = ["ledger"]

LEDGER_COLUMNS = "id, area_id, area_level, classification, shp_version, stage, file_path, layer_updated, recorded_at"
KEYS = "area_id, classification, shp_version, stage"


@query("upsert_update", ctes("store", "store_batch", last="""SELECT key, name, balance FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY pos DESC) AS rn FROM store_batch) b WHERE rn = 1 OR key IS NULL""") + """
  SELECT coalesce(l.key, s.key) AS key, CASE WHEN l.name IS NULL THEN s.name ELSE l.name END AS name,
    CASE WHEN l.name IS NULL THEN s.balance ELSE l.balance END AS balance, s.nation FROM store s FULL JOIN last l ON s.key = l.key""")
def upsert_update(spark, sf_dir):
    return ledger.upsert(load(spark, sf_dir, "store"), load(spark, sf_dir, "store_batch"), ["key"], "pos")


@query("ledger_upsert", ctes("ledger", "results", last=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY pos DESC) AS rn
  FROM results WHERE status NOT IN ('error', 'unchanged')) r WHERE rn = 1""") + f"""
  SELECT l.id, l.area_id, l.area_level, l.classification, l.shp_version, l.stage, coalesce(n.file_path, l.file_path) AS file_path, l.layer_updated,
    coalesce(n.recorded_at, l.recorded_at) AS recorded_at FROM ledger l LEFT JOIN last n USING ({KEYS}) UNION ALL
  SELECT (SELECT max(id) FROM ledger) + row_number() OVER (ORDER BY {KEYS}), area_id, area_level, classification, shp_version, stage, file_path, false, recorded_at
  FROM last n WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.area_id = n.area_id AND l.classification = n.classification
    AND l.shp_version = n.shp_version AND l.stage = n.stage)""")
def ledger_upsert(spark, sf_dir):
    return ledger.log_results(load(spark, sf_dir, "ledger"), load(spark, sf_dir, "results"), "pos")


VERSION_RESULTS = "SELECT * FROM results WHERE shp_version = 'TOWN_MOI_870318'"
VERSION_LAST = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY pos DESC) AS rn
  FROM sent WHERE status NOT IN ('error', 'unchanged')) r WHERE rn = 1"""


@query("ledger_store", ctes("ledger", "results", sent=VERSION_RESULTS, last=VERSION_LAST, after=f"""
  SELECT l.id, shp_version, classification, coalesce(n.file_path, l.file_path) AS file_path FROM ledger l LEFT JOIN last n USING ({KEYS}) UNION ALL
  SELECT (SELECT max(id) FROM ledger) + row_number() OVER (ORDER BY {KEYS}), shp_version, classification, file_path FROM last n WHERE NOT EXISTS (
    SELECT 1 FROM ledger l WHERE l.area_id = n.area_id AND l.classification = n.classification AND l.shp_version = n.shp_version AND l.stage = n.stage)""")
    + """SELECT shp_version, classification, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, count(*) FILTER (starts_with(file_path, 'new/')) AS n_new,
    NOT EXISTS (SELECT 1 FROM last WHERE last.shp_version = after.shp_version AND last.classification = after.classification) AS untouched
  FROM after GROUP BY shp_version, classification""")
def ledger_store(spark, sf_dir):
    """The stored ledger after the results of one version were logged, and which folders kept every file."""
    path = f"{checkpoint_folder(spark)}/ledger-{uuid.uuid4().hex}"
    rows = load(spark, sf_dir, "ledger").withColumn("id", F.col("id").cast("long"))
    folders.write_folders(rows, path, LEDGER_FOLDERS)
    file = F.col("_metadata.file_path")
    before = materialize(spark.read.schema(rows.schema).parquet(path).select(file.alias("file")).distinct())
    ledger.log_into_store(path, rows.schema, load(spark, sf_dir, "results").where("shp_version = 'TOWN_MOI_870318'"), "pos")
    stored = spark.read.schema(rows.schema).parquet(path).select("*", file.alias("file"))
    shown = stored.join(before.withColumn("old", F.lit(True)), "file", "left")
    return shown.groupBy(*LEDGER_FOLDERS).agg(
        F.count("*").alias("n"), F.sum("id").alias("ids"), F.count_if(F.startswith("file_path", F.lit("new/"))).alias("n_new"),
        F.every(F.coalesce("old", F.lit(False))).alias("untouched"))


INPUTS["bare_ledger"] = """
SELECT id, classification, CASE WHEN id % 5 = 0 THEN NULL ELSE recorded_at END AS recorded_at, CASE WHEN id % 3 = 0 THEN NULL ELSE layer_updated END AS layer_updated FROM ledger"""
DEPENDS["bare_ledger"] = ["ledger"]


@query("stamped_defaults", ctes("bare_ledger") + """SELECT classification, recorded_at IS NULL AS stamped_now, coalesce(layer_updated, false) AS layer_updated, count(*) AS n
  FROM bare_ledger GROUP BY ALL""")
def stamped_defaults(spark, sf_dir):
    """Rows whose missing time became the time of the run, to within a day, and rows that kept theirs."""
    rows = ledger.with_defaults(load(spark, sf_dir, "bare_ledger"))
    now = F.col("recorded_at") > F.date_sub(F.current_date(), 1)
    return rows.groupBy("classification", now.alias("stamped_now"), "layer_updated").agg(F.count("*").alias("n"))


@query("json_sink", ctes("ledger") + "SELECT id, area_id, classification, file_path, layer_updated, CAST(recorded_at AS VARCHAR) AS recorded_at FROM ledger")
def json_sink(spark, sf_dir):
    """The ledger written as JSON lines and read again."""
    rows = load(spark, sf_dir, "ledger").select("id", "area_id", "classification", "file_path", "layer_updated", F.col("recorded_at").cast("string").alias("recorded_at"))
    path = sinks.write_json(rows, f"{checkpoint_folder(spark)}/json-{uuid.uuid4().hex}")
    return spark.read.schema("id long, area_id string, classification string, file_path string, layer_updated boolean, recorded_at string").json(path)


@query("log_outcomes", ctes("results") + """SELECT status, CASE WHEN status IN ('error', 'unchanged') THEN 'skipped' ELSE 'logged' END AS outcome, count(*) AS n
  FROM results GROUP BY status""")
def log_outcomes(spark, sf_dir):
    results = load(spark, sf_dir, "results")
    return results.groupBy("status", ledger.log_outcome(F.col("status")).alias("outcome")).agg(F.count("*").alias("n"))


@query("ledger_scan", ctes("ledger") + f"SELECT {LEDGER_COLUMNS} FROM ledger WHERE shp_version = 'TOWN_MOI_870318' AND classification = 'soil_survey_ph'")
def ledger_scan(spark, sf_dir):
    found = ledger.ledger_scan(load(spark, sf_dir, "ledger"), shp_version="TOWN_MOI_870318", area_level=None, classification="soil_survey_ph")
    return found.withColumn("id", F.col("id").cast("long"))


CHANGES = """SELECT n.path, CASE WHEN o.path IS NULL THEN 'created' WHEN o.content = n.content THEN 'unchanged' ELSE 'updated' END AS status
  FROM snapshot_new n LEFT JOIN snapshot_old o ON n.path = o.path"""


@query("change_status", ctes("snapshot_old", "snapshot_new") + CHANGES)
def change_status(spark, sf_dir):
    return ledger.change_status(load(spark, sf_dir, "snapshot_old"), load(spark, sf_dir, "snapshot_new"))


DONE = """SELECT w.*, EXISTS (SELECT 1 FROM ledger l JOIN disk_files d ON l.file_path = d.path WHERE l.stage = 'masked' AND l.area_id = w.area_id
  AND l.classification = w.classification AND l.shp_version = w.shp_version) AS done FROM work w"""


@query("pending_masks", ctes("ledger", "work", "disk_files", flagged=DONE) + "SELECT area_id, classification, shp_version, status FROM flagged WHERE status <> 'unchanged' OR NOT done")
def pending_masks(spark, sf_dir):
    rows = ledger.pending(load(spark, sf_dir, "work"), load(spark, sf_dir, "ledger"), files=load(spark, sf_dir, "disk_files"))
    return rows.select("area_id", "classification", "shp_version", "status")


@query("mask_decision", ctes("ledger", "work", "disk_files", flagged=DONE) + """SELECT area_id, classification, shp_version, status,
  CASE WHEN status = 'error' THEN 'stop' WHEN status = 'unchanged' AND done THEN 'skip' ELSE 'mask' END AS action,
  CASE WHEN status = 'unchanged' AND NOT done THEN 'created' ELSE status END AS logged_status FROM flagged""")
def mask_decision(spark, sf_dir):
    rows = ledger.mask_decision(load(spark, sf_dir, "work"), load(spark, sf_dir, "ledger"), load(spark, sf_dir, "disk_files"))
    return rows.select("area_id", "classification", "shp_version", "status", "action", "logged_status")


@query("ledger_lookup", ctes("ledger", "requested") + """SELECT r.area_id, r.classification, r.stage, n, l.file_path FROM requested r LEFT JOIN
  (SELECT * FROM ledger WHERE shp_version = 'TOWN_MOI_870318') l USING (area_id, classification, stage)""")
def ledger_lookup(spark, sf_dir):
    return ledger.ledger_lookup(load(spark, sf_dir, "requested"), load(spark, sf_dir, "ledger"), "TOWN_MOI_870318")


@query("reconcile_storage", ctes("ledger", "disk_files") + """SELECT coalesce(l.file_path, d.path) AS path,
  CASE WHEN d.path IS NULL THEN 'missing_on_disk' ELSE 'not_in_ledger' END AS problem
  FROM (SELECT DISTINCT file_path FROM ledger) l FULL JOIN (SELECT DISTINCT path FROM disk_files) d ON l.file_path = d.path WHERE l.file_path IS NULL OR d.path IS NULL""")
def reconcile_storage(spark, sf_dir):
    return ledger.reconcile(load(spark, sf_dir, "ledger"), load(spark, sf_dir, "disk_files"))


@query("resume_plan", ctes("plan_rows") + "SELECT layer_no, area_id FROM plan_rows WHERE layer_no > 2 OR (layer_no = 2 AND area_id > 'K10')")
def resume_plan(spark, sf_dir):
    return ledger.resume_plan(load(spark, sf_dir, "plan_rows"), 2, "K10")


@query("image_store_path", ctes("ledger") + "SELECT id, 'output/wms_images/' || shp_version || '/' || stage || '/' || classification || '/' || area_id || '.png' AS path FROM ledger")
def image_store_path(spark, sf_dir):
    path = ledger.image_path(F.col("shp_version"), F.col("stage"), F.col("classification"), F.col("area_id"))
    return load(spark, sf_dir, "ledger").select(F.col("id").cast("long").alias("id"), path.alias("path"))


@query("constraint_violations", ctes("faulty_ledger") + " UNION ALL ".join(
    [f"SELECT 'not_null' AS rule, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n FROM faulty_ledger"
     for c in ("area_id", "area_level", "classification", "shp_version", "stage", "file_path")]
    + ["SELECT 'domain', 'stage', count(*) FILTER (stage NOT IN ('raw', 'masked')) FROM faulty_ledger",
       f"SELECT 'unique', '{KEYS.replace(' ', '')}', CAST(coalesce(sum(extra), 0) AS BIGINT) FROM (SELECT count(*) - 1 AS extra FROM faulty_ledger WHERE area_id IS NOT NULL GROUP BY {KEYS}) u"]))
def constraint_violations(spark, sf_dir):
    return quality.constraint_violations(load(spark, sf_dir, "faulty_ledger"), quality.LEDGER_RULES)


@query("layer_area_plan", ctes("areas") + f"SELECT layer_no, name_en, area_id, shp_version FROM areas, ({STATIC_SQL}) s")
def layer_area_plan(spark, sf_dir):
    layers = names.static_layers(spark).select("layer_no", "name_en")
    return wms.layer_area_plan(layers, load(spark, sf_dir, "areas").select("area_id", "shp_version"))


@query("rewrite_url", ctes("urls", cut="""SELECT page_id, CASE WHEN contains(url, '#') THEN '#part' ELSE '' END AS frag, string_split(replace(url, '#part', ''), '?')[1] AS base,
    string_split(string_split(replace(url, '#part', ''), '?')[2], '&') AS pairs FROM urls""",
    kept="""SELECT page_id, frag, base, list_filter(list_transform(pairs, lambda p: {'k': string_split(p, '=')[1], 'v': string_split(p, '=')[2]}),
      lambda s: s.v <> '' AND lower(s.k) NOT IN ('bbox', 'width')) AS kv FROM cut""") + """
  SELECT page_id, base || '?' || array_to_string(list_concat(
    flatten(list_transform(list_filter(kv, lambda s, i: i = list_position(list_transform(kv, lambda t: t.k), s.k)),
      lambda first: list_transform(list_filter(kv, lambda t: t.k = first.k), lambda t: t.k || '=' || t.v))),
    ['BBOX=120%2C23%2C121%2C24', 'WIDTH=857']), '&') || frag AS url FROM kept""")
def rewrite_url(spark, sf_dir):
    url = rewrite_query(F.col("url"), {"BBOX": F.lit("120,23,121,24"), "WIDTH": F.lit(857)})
    return load(spark, sf_dir, "urls").select("page_id", url.alias("url"))


# Vincenty's series over rows (id, la1, lo1, la2, lo2), in DuckDB: table `solved` with km.
VINCENTY = """u AS (SELECT id, sin(u1) AS su1, cos(u1) AS cu1, sin(u2) AS su2, cos(u2) AS cu2, dl FROM (
    SELECT id, atan((1 - 1 / 298.257223563) * tan(radians(la1))) AS u1, atan((1 - 1 / 298.257223563) * tan(radians(la2))) AS u2, radians(lo2 - lo1) AS dl FROM lines) a),
  it AS (SELECT *, dl AS lam, 0 AS i FROM u UNION ALL
    SELECT id, su1, cu1, su2, cu2, dl, dl + (1 - c) * f * sa * (sig + c * ss * (cm + c * cs * (-1 + 2 * cm * cm))), i + 1 FROM (
      SELECT *, f / 16 * ca * (4 + f * (4 - 3 * ca)) AS c, cs - CASE WHEN ca = 0 THEN 0 ELSE 2 * su1 * su2 / ca END AS cm FROM (
        SELECT *, 1 - sa * sa AS ca, atan2(ss, cs) AS sig FROM (
          SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM (
            SELECT *, 1 / 298.257223563 AS f, sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss,
              su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM it WHERE i < 12) p1) p2) p3) p4),
  solved AS (SELECT id, round(b * ba * (sig - bb * ss * (cm + bb / 4 * (cs * (-1 + 2 * cm * cm) - bb / 6 * cm * (-3 + 4 * ss * ss) * (-3 + 4 * cm * cm)))) / 1000, 6) AS km FROM (
    SELECT *, 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2))) AS ba, u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2))) AS bb FROM (
      SELECT *, ca * (6378137.0 * 6378137.0 - b * b) / (b * b) AS u2, cs - CASE WHEN ca = 0 THEN 0 ELSE 2 * su1 * su2 / ca END AS cm FROM (
        SELECT *, 1 - sa * sa AS ca, atan2(ss, cs) AS sig FROM (
          SELECT *, CASE WHEN ss = 0 THEN 0 ELSE cu1 * cu2 * sin(lam) / ss END AS sa FROM (
            SELECT *, 6378137.0 * (1 - 1 / 298.257223563) AS b, sqrt(pow(cu2 * sin(lam), 2) + pow(cu1 * su2 - su1 * cu2 * cos(lam), 2)) AS ss,
              su1 * su2 + cu1 * cu2 * cos(lam) AS cs FROM it WHERE i = 12) q1) q2) q3) q4) q5)"""
BOXES = "SELECT k, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM vx GROUP BY k"
LINES = """SELECT k * 2 AS id, (miny + maxy) / 2 AS la1, minx AS lo1, (miny + maxy) / 2 AS la2, maxx AS lo2 FROM boxes UNION ALL
  SELECT k * 2 + 1, miny, (minx + maxx) / 2, maxy, (minx + maxx) / 2 FROM boxes"""
FRAMES = """SELECT b.*, greatest(1, CAST(round_even(w.km * 1000 / 100, 0) AS INT)) AS width, greatest(1, CAST(round_even(h.km * 1000 / 100, 0) AS INT)) AS height
  FROM boxes b JOIN solved w ON w.id = b.k * 2 JOIN solved h ON h.id = b.k * 2 + 1"""


def framed_sql(*inputs: str) -> str:
    """WITH clause that also offers vx, boxes and frames (k, box, width, height)."""
    base = ctes(*inputs, vx=vertex_sql(), boxes=BOXES, lines=LINES).rstrip()
    return base.replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + VINCENTY + f",\nframes AS ({FRAMES})\n"


@query("bbox_pixel_size", framed_sql() + "SELECT k, width, height FROM (SELECT s_suppkey AS k FROM supplier) t LEFT JOIN frames USING (k)")
def bbox_pixel_size(spark, sf_dir):
    return geometry.with_frame(town_shapes(spark, sf_dir)).select("k", "width", "height")


@query("request_plan", framed_sql("towns") + f"""SELECT layer_no, area_id, shp_version, 'https://wms.example.com/' || name_en || '?SERVICE=WMS&BBOX=' ||
    CAST(minx AS VARCHAR) || '%2C' || CAST(miny AS VARCHAR) || '%2C' || CAST(maxx AS VARCHAR) || '%2C' || CAST(maxy AS VARCHAR) ||
    '&WIDTH=' || CAST(width AS VARCHAR) || '&HEIGHT=' || CAST(height AS VARCHAR) AS request_url
  FROM towns JOIN frames USING (k), ({STATIC_SQL}) s""")
def request_plan(spark, sf_dir):
    url = F.concat(F.lit("https://wms.example.com/"), F.col("name_en"), F.lit("?SERVICE=WMS&bbox=0,0,1,1&STYLES=&width=5"))
    layers = names.static_layers(spark).select("layer_no", url.alias("map_url"))
    shapes = geometry.with_frame(town_shapes(spark, sf_dir).where("geometry is not null")).select("k", "box", "width", "height")
    areas = load(spark, sf_dir, "towns").select("area_id", "shp_version", "k").join(shapes, "k")
    return wms.request_plan(layers, areas).select("layer_no", "area_id", "shp_version", "request_url")


@query("response_triage", ctes("response_log") + """SELECT event_id, attempt, CASE
    WHEN (status >= 400 OR coalesce(error = 'timeout', false)) AND attempt < 3 THEN 'retry' WHEN status >= 400 OR coalesce(error = 'timeout', false) THEN 'give_up'
    WHEN error IS NOT NULL THEN 'fail' WHEN content_type LIKE '%image%' THEN 'keep' ELSE 'not_image' END AS action,
  CASE WHEN (status >= 400 OR coalesce(error = 'timeout', false)) AND attempt < 3 THEN CAST(5 * pow(2, attempt) AS INT) END AS wait_s,
  coalesce(status BETWEEN 400 AND 499, false) AS client_error FROM response_log""")
def response_triage(spark, sf_dir):
    return wms.response_triage(load(spark, sf_dir, "response_log")).select("event_id", "attempt", "action", "wait_s", "client_error")


@query("published_versions", ctes("ledger") + """SELECT CAST(1 AS BIGINT) AS version, shp_version, count(*) AS n FROM ledger WHERE stage = 'raw' GROUP BY shp_version
  UNION ALL SELECT 2, shp_version, count(*) FROM ledger GROUP BY shp_version""")
def published_versions(spark, sf_dir):
    """The raw rows published first, then all of them, and a third publication that never got its manifest."""
    path = f"{checkpoint_folder(spark)}/published-{uuid.uuid4().hex}"
    rows = load(spark, sf_dir, "ledger")
    for part in (rows.where("stage = 'raw'"), rows):
        versions.publish(part, path)
    rows.write.parquet(f"{path}/parts/unfinished")
    shown = [versions.read_published(spark, path, number).withColumn("version", F.lit(given).cast("long")) for number, given in ((1, 1), (None, 2))]
    return shown[0].unionByName(shown[1]).groupBy("version", "shp_version").agg(F.count("*").alias("n"))
