"""Record, registry and cleaning-report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmosaic.operators import clean, records
from workload.inputs import INPUTS, ctes, load
from workload.registry import query

INPUTS["registry"] = """
SELECT event_type || '_' || CAST(user_id % 40 AS STRING) AS category_table_id, event_id AS pos, value AS payload FROM events"""
INPUTS["table_registry"] = """
SELECT CASE n_nationkey % 5 WHEN 0 THEN 'orders' WHEN 1 THEN 'part' WHEN 2 THEN 'supplier' WHEN 3 THEN 'no_such_table' ELSE 'events' END AS category_table_id,
  n_name AS title, n_nationkey AS pos
FROM nation"""
INPUTS["links_a"] = "SELECT p_type || CAST(p_size AS STRING) AS map_name, 'a/' || p_name || CAST(p_partkey AS STRING) AS map_url, p_partkey AS pos FROM part"
INPUTS["links_b"] = "SELECT p_type || CAST(p_size AS STRING) AS map_name, 'b/' || p_name AS map_url, p_partkey AS pos FROM part"
INPUTS["links_c"] = "SELECT p_type || CAST(p_size AS STRING) AS map_name, 'c/' || p_brand AS map_url, p_partkey AS pos FROM part"
INPUTS["json_texts"] = """
SELECT event_id AS id, CASE event_id % 8 WHEN 0 THEN props WHEN 1 THEN '[' || props || ', ' || props || ']' WHEN 2 THEN '[1, 2]'
  WHEN 3 THEN '"text"' WHEN 4 THEN 'not json' WHEN 5 THEN '[]' WHEN 6 THEN '[' || props || ', 2]' ELSE NULL END AS doc
FROM events"""
INPUTS["copies"] = "SELECT event_type, user_id % 20 AS user_no, CAST(floor(value) AS BIGINT) AS amount, event_id AS pos FROM events"
INPUTS["text_table"] = """
SELECT CAST(o_orderkey AS STRING) AS order_no, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING) AS price,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, o_orderstatus AS status, CASE WHEN o_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS flag,
  CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS mixed,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS gaps, CAST(NULL AS STRING) AS empty, o_orderstatus AS foreign_key
FROM orders"""
INPUTS["odd_names"] = 'SELECT n_nationkey AS n_key, n_name AS n_name, n_regionkey AS n_region FROM nation'


@query("ensure_columns", "SELECT c_custkey, c_mktsegment, CAST(NULL AS VARCHAR) AS REMARK FROM customer")
def ensure_columns(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return records.ensure_columns(customer, ["c_custkey", "REMARK"])


@query("infer_schema", ctes("text_table") + r"""SELECT column_name, CASE WHEN seen = 0 THEN 'text' WHEN ints = seen THEN 'integer' WHEN floats = seen THEN 'float'
  WHEN bools = seen THEN 'boolean' WHEN days = seen THEN 'datetime' ELSE 'text' END AS label FROM (
  SELECT column_name, count(v) AS seen, count(*) FILTER (regexp_matches(v, '^[+-]?\d+$')) AS ints,
    count(*) FILTER (regexp_matches(v, '^[+-]?\d+(\.\d+)?$')) AS floats, count(*) FILTER (v IN ('true', 'false')) AS bools,
    count(try_cast(v AS TIMESTAMP)) AS days
  FROM (UNPIVOT (SELECT order_no, price, day, status, flag, mixed, coalesce(gaps, '~') AS gaps, coalesce(empty, '~') AS empty FROM text_table)
    ON COLUMNS(*) INTO NAME column_name VALUE raw) u, LATERAL (SELECT nullif(raw, '~') AS v) l
  GROUP BY column_name) c""")
def infer_schema(spark, sf_dir):
    return records.infer_labels(load(spark, sf_dir, "text_table"))


@query("sanitize_columns", "SELECT n_nationkey AS n_key, n_name AS n_name, n_regionkey AS n_region FROM nation")
def sanitize_columns(spark, sf_dir):
    return records.sanitize_columns(load(spark, sf_dir, "odd_names").toDF("n.key", "n name", "n-region"))


@query("pick_nth", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 1 OFFSET 120")
def pick_nth(spark, sf_dir):
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return records.pick_nth(customer, ["c_acctbal", "c_custkey"], 121)


@query("paginate", """SELECT c_custkey, rn AS row_no, page_size, CAST(floor((rn - 1) / page_size) AS BIGINT) + 1 AS page FROM (
  SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS rn,
    CASE WHEN count(*) OVER () <= 25 THEN count(*) OVER () WHEN count(*) OVER () <= 100 THEN 20 ELSE 50 END AS page_size
  FROM customer) c""")
def paginate(spark, sf_dir):
    order = [F.col("c_acctbal"), F.col("c_custkey")]
    return records.paginate(load(spark, sf_dir, "customer"), order).select("c_custkey", "row_no", "page_size", "page")


@query("unpivot_record", """SELECT c_custkey, field, value FROM (
  SELECT c_custkey, 'c_name' AS field, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer) u""")
def unpivot_record(spark, sf_dir):
    return records.unpivot_record(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), ["c_custkey"])


@query("table_counts", """SELECT 'orders' AS table_name, CAST(count(*) AS VARCHAR) AS n FROM orders UNION ALL SELECT 'lineitem', CAST(count(*) AS VARCHAR) FROM lineitem
  UNION ALL SELECT 'absent', '0'""")
def table_counts(spark, sf_dir):
    return records.table_counts({"orders": load(spark, sf_dir, "orders"), "lineitem": load(spark, sf_dir, "lineitem"), "absent": None})


@query("registry_latest", ctes("registry") + """SELECT category_table_id, pos, payload FROM (
  SELECT *, row_number() OVER (PARTITION BY category_table_id ORDER BY pos DESC) AS rn FROM registry) r WHERE rn = 1""")
def registry_latest(spark, sf_dir):
    return records.registry_latest(load(spark, sf_dir, "registry"), "pos")


@query("registry_counts", ctes("table_registry") + """SELECT r.category_table_id, title, pos, coalesce(n, 0) AS n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY category_table_id ORDER BY pos DESC) AS rn FROM table_registry) r LEFT JOIN (
  SELECT 'orders' AS category_table_id, count(*) AS n FROM orders UNION ALL SELECT 'part', count(*) FROM part
  UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'events', count(*) FROM events) t USING (category_table_id) WHERE rn = 1""")
def registry_counts(spark, sf_dir):
    tables = {name: load(spark, sf_dir, name) for name in ("orders", "part", "supplier", "events")}
    return records.registry_counts(records.registry_latest(load(spark, sf_dir, "table_registry"), "pos"), tables)


@query("layer_links", ctes("links_a", "links_b", "links_c") + """SELECT map_name, map_url FROM (
  SELECT map_name, map_url, row_number() OVER (PARTITION BY map_name ORDER BY t DESC, pos DESC) AS rn FROM (
    SELECT *, 0 AS t FROM links_a UNION ALL SELECT *, 2 AS t FROM links_b) u) l WHERE rn = 1""")
def layer_links(spark, sf_dir):
    tables = {"A102": load(spark, sf_dir, "links_a"), "A001": load(spark, sf_dir, "links_c"), "B102_2": load(spark, sf_dir, "links_b")}
    return records.layer_links(tables, "pos")


@query("dedup_records", ctes("copies") + "SELECT event_type, user_no, amount, min(pos) AS pos FROM copies GROUP BY event_type, user_no, amount")
def dedup_records(spark, sf_dir):
    return records.dedup_records(load(spark, sf_dir, "copies"), "pos")


@query("json_shape_filter", ctes("json_texts") + """SELECT id, shape FROM (SELECT id, CASE WHEN NOT json_valid(doc) THEN NULL
  WHEN json_type(doc) = 'OBJECT' THEN 'object' WHEN json_type(doc) = 'ARRAY' AND
    len(list_filter(json_extract(doc, '$[*]'), lambda x: json_type(x) <> 'OBJECT')) = 0 THEN 'array' END AS shape FROM json_texts) j WHERE shape IS NOT NULL""")
def json_shape_filter(spark, sf_dir):
    docs = load(spark, sf_dir, "json_texts")
    return docs.select("id", records.json_shape(F.col("doc")).alias("shape")).where("shape is not null")


@query("drop_all_null", ctes("blank_rows") + "SELECT * FROM blank_rows WHERE segment IS NOT NULL OR balance IS NOT NULL OR nationkey IS NOT NULL")
def drop_all_null(spark, sf_dir):
    return clean.drop_all_null(load(spark, sf_dir, "blank_rows"))


@query("clean_dedup", ctes("blank_rows") + "SELECT DISTINCT * FROM blank_rows WHERE segment IS NOT NULL OR balance IS NOT NULL OR nationkey IS NOT NULL")
def clean_dedup(spark, sf_dir):
    return clean.clean(load(spark, sf_dir, "blank_rows"), ["drop_all_null", "drop_duplicates"])[0]


@query("cleaning_report", ctes("blank_rows", kept="SELECT * FROM blank_rows WHERE segment IS NOT NULL OR balance IS NOT NULL OR nationkey IS NOT NULL") + """
  SELECT 1 AS step, 'drop_all_null' AS rule, a AS n_before, b AS n_after, a - b AS rows_deleted
  FROM (SELECT (SELECT count(*) FROM blank_rows) AS a, (SELECT count(*) FROM kept) AS b) x UNION ALL
  SELECT 2, 'drop_duplicates', b, c, b - c FROM (SELECT (SELECT count(*) FROM kept) AS b, (SELECT count(*) FROM (SELECT DISTINCT * FROM kept) d) AS c) y""")
def cleaning_report(spark, sf_dir):
    return clean.clean(load(spark, sf_dir, "blank_rows"), ["drop_all_null", "drop_duplicates"])[1]
