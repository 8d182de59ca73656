"""Text, date and sort queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldmosaic.functions import dates, sortkeys, text
from fieldmosaic.operators import names
from fieldmosaic.operators.ranking import global_rank
from fieldmosaic.tables.layer_values import CROP_PREFIX, CROP_SUFFIX, SOIL_PREFIX, SOIL_WORD
from workload.inputs import INPUTS, ctes, load
from workload.registry import query

INPUTS["titles"] = """
SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '農地空間圖' || text WHEN 1 THEN text || ' - 農業資料開放平臺'
  WHEN 2 THEN repeat('水', 30) || text WHEN 3 THEN repeat('𠀀', CAST(18 + doc_id % 7 AS INT)) || text ELSE text END AS title
FROM documents"""
INPUTS["paths"] = """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'out/' || source || '/' || replace(text, '/', '_') || '.geojson'
  WHEN 1 THEN 'out/' || repeat('土壤', CAST(doc_id % 15 AS INT)) || replace(text, '/', '_') || '.png' WHEN 2 THEN '.hidden' || replace(text, '/', '_')
  ELSE 'a.b/' || lang || CAST(doc_id AS STRING) || replace(text, '/', '_') END AS path
FROM documents"""
INPUTS["layer_titles"] = f"""
SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_name || '{CROP_SUFFIX}' WHEN 1 THEN '{SOIL_WORD}' || p_type
  WHEN 2 THEN p_type ELSE ' ' || p_name || ' {CROP_SUFFIX} ' END AS title,
  CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) ELSE p_name || '-' || CAST(p_size AS STRING) END AS english
FROM part"""
INPUTS["roc_years"] = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 6 = 0 THEN 'abc' WHEN o_orderkey % 10 = 1 THEN NULL
  ELSE CAST(year(o_orderdate) - 1911 AS STRING) END AS roc
FROM orders"""
INPUTS["thousands"] = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 = 0 THEN 'n/a' WHEN o_orderkey % 9 = 0 THEN NULL ELSE
  CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS STRING) || ',' ||
  lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS STRING), 3, '0') || '.' ||
  lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS STRING), 2, '0') END AS raw
FROM orders"""
INPUTS["labels_mixed"] = """
SELECT c_custkey AS pos, CASE WHEN c_custkey % 50 = 3 THEN NULL WHEN c_custkey % 50 = 7 THEN ''
  WHEN c_custkey % 4 = 0 THEN 'TOWN' || CAST(c_custkey AS STRING)
  WHEN c_custkey % 4 = 1 THEN chr(CAST(65 + c_custkey % 23 AS INT)) || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || 'B' || CAST(c_custkey % 7 AS STRING)
  WHEN c_custkey % 4 = 2 THEN CAST(c_custkey AS STRING) ELSE chr(CAST(65 + c_custkey % 23 AS INT)) END AS name
FROM customer"""
WORDS = ["上", "中", "下", "前", "後", "一", "二", "三", "水稻", "甘薯"]
WORD_CASE = "CASE {k} % 11 " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(WORDS)) + " ELSE NULL END"
INPUTS["words"] = f"SELECT p_partkey AS pos, {WORD_CASE.format(k='p_partkey')} AS word FROM part"
INPUTS["typed"] = f"""
SELECT o_orderkey AS pos, CASE o_orderkey % 4 WHEN 0 THEN CAST(year(o_orderdate) - 1911 AS STRING)
  WHEN 1 THEN CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') WHEN 2 THEN 'soon' ELSE NULL END AS day_text,
  {WORD_CASE.format(k='o_custkey')} AS word,
  CASE WHEN o_orderkey % 6 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) || '.5' END AS amount
FROM orders"""

CUT = "CASE WHEN length(t) > 21 THEN left(t, list_max(list_filter(range(0, 22), lambda k: strlen(left(t, k)) <= {limit}))) ELSE t END"
BLANKS = r"\p{Z}\s\x1c-\x1f\x85"
DATE_SQL = r"""
SELECT id, raw, coalesce(CAST(ts AS DATE), d, DATE '0001-01-01') AS day, ts FROM (
  SELECT id, raw,
    CASE WHEN regexp_matches(trim(raw), '^\d{4}[/-]\d{1,2}[/-]\d{1,2}\s+\d{1,2}:\d{1,2}:\d{1,2}$')
      THEN try_strptime(replace(trim(raw), '/', '-'), '%Y-%m-%d %H:%M:%S') END AS ts,
    CASE
      WHEN regexp_matches(c, '^\d{1,3}$') THEN make_date(CAST(c AS INT) + 1911, 1, 1)
      WHEN regexp_matches(c, '^\d{1,3}[./]\d{1,2}[./]\d{1,2}$') THEN
        CAST(try_strptime(CAST(CAST(split_part(replace(c, '.', '/'), '/', 1) AS INT) + 1911 AS VARCHAR) || '/' ||
          split_part(replace(c, '.', '/'), '/', 2) || '/' || split_part(replace(c, '.', '/'), '/', 3), '%Y/%m/%d') AS DATE)
      WHEN regexp_matches(c, '^\d{4}/\d{1,2}/\d{1,2}$') THEN CAST(try_strptime(c, '%Y/%m/%d') AS DATE)
      WHEN regexp_matches(c, '^\d{4}-\d{1,2}-\d{1,2}$') THEN CAST(try_strptime(c, '%Y-%m-%d') AS DATE)
      WHEN regexp_matches(c, '^\d{8}$') THEN CAST(try_strptime(c, '%Y%m%d') AS DATE)
      WHEN regexp_matches(c, '^\d{7}$') THEN
        CAST(try_strptime(CAST(CAST(left(c, 3) AS INT) + 1911 AS VARCHAR) || right(c, 4), '%Y%m%d') AS DATE)
      WHEN regexp_matches(c, '^\d{4}-\d{1,2}$') THEN CAST(try_strptime(c || '-1', '%Y-%m-%d') AS DATE)
      WHEN regexp_matches(c, '^\d{4}年?$') THEN CAST(try_strptime(left(c, 4) || '-1-1', '%Y-%m-%d') AS DATE)
    END AS d
  FROM (SELECT id, raw, replace(raw, ' ', '') AS c FROM mixed_dates) m
) p"""
WORD_RANK = "CASE word WHEN '上' THEN 1 WHEN '前' THEN 1 WHEN '一' THEN 1 WHEN '中' THEN 2 WHEN '二' THEN 2 WHEN '下' THEN 3 WHEN '後' THEN 3 WHEN '三' THEN 3 WHEN '水稻' THEN 5 WHEN '甘薯' THEN 6 ELSE 4 END"


@query("clean_table_name", ctes("titles") + "SELECT doc_id, " + CUT.format(limit="63") + r""" AS name FROM (
  SELECT doc_id, regexp_replace(replace(replace(title, ' - 農業資料開放平臺', ''), '農地空間圖', ''), '[^\p{L}\p{N}_]', '', 'g') AS t FROM titles) c""")
def clean_table_name(spark, sf_dir):
    return load(spark, sf_dir, "titles").select("doc_id", text.clean_table_name(F.col("title")).alias("name"))


@query("clean_string", rf"""SELECT doc_id, md5(clean) AS digest, length(clean) AS n FROM (
  SELECT doc_id, coalesce(regexp_replace(lower(regexp_replace(text, '[^\p{{L}}\p{{N}}_{BLANKS}]', '', 'g')), '^[{BLANKS}]+|[{BLANKS}]+$', '', 'g'), '') AS clean
  FROM documents) c""")
def clean_string(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", text.clean_string(F.col("text")).alias("clean"))
    return docs.select("doc_id", F.md5("clean").alias("digest"), F.length("clean").cast("long").alias("n"))


@query("process_string", "SELECT p_partkey AS id, replace(lower(upper(p_name) || ' ' || p_type), ' ', '_') AS name FROM part")
def process_string(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").alias("id"), text.process_string(F.concat_ws(" ", F.upper("p_name"), "p_type")).alias("name"))


@query("short_filename", ctes("paths") + "SELECT doc_id, " + CUT.format(limit="63 - strlen(ext)") + r""" || ext AS name FROM (
  SELECT doc_id, ext, left(base, length(base) - length(ext)) AS t FROM (
    SELECT doc_id, base, regexp_extract(base, '(?s)^\.*[^.].*(\.[^.]*)$', 1) AS ext FROM (
      SELECT doc_id, list_extract(string_split(path, '/'), -1) AS base FROM paths) a) b) c""")
def short_filename(spark, sf_dir):
    return load(spark, sf_dir, "paths").select("doc_id", text.short_filename(F.col("path")).alias("name"))


@query("truncate_text", """SELECT p_partkey AS id, CASE WHEN length(t) > 15 THEN left(t, 15) || '...' ELSE t END AS t
FROM (SELECT p_partkey, p_name || ' ' || p_type || '水' AS t FROM part) p""")
def truncate_text(spark, sf_dir):
    from fieldmosaic.operators.records import truncate_strings

    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.expr("p_name || ' ' || p_type || '水'").alias("t"))
    return truncate_strings(part)


@query("roc_to_ad", ctes("roc_years") + "SELECT id, try_cast(roc AS INT) + 1911 AS year FROM roc_years")
def roc_to_ad(spark, sf_dir):
    return load(spark, sf_dir, "roc_years").select("id", dates.roc_to_ad(F.col("roc")).alias("year"))


@query("parse_mixed_dates", ctes("mixed_dates") + DATE_SQL)
def parse_mixed_dates(spark, sf_dir):
    raw = F.col("raw")
    return load(spark, sf_dir, "mixed_dates").select("id", "raw", dates.parse_date(raw).alias("day"), dates.parse_timestamp(raw).alias("ts"))


@query("date_sort", ctes("mixed_dates", parsed=DATE_SQL) + "SELECT id, row_number() OVER (ORDER BY day, id) AS rn FROM parsed")
def date_sort(spark, sf_dir):
    rows = load(spark, sf_dir, "mixed_dates").select("id", dates.parse_date(F.col("raw")).alias("day"))
    return global_rank(rows, [F.col("day"), F.col("id")]).select("id", "rn")


@query("natural_sort", ctes("labels_mixed") + r"""SELECT pos, name, row_number() OVER (ORDER BY
  CASE WHEN name = '' THEN 0 WHEN name IS NULL THEN 1 ELSE 2 END, t1, n1 NULLS FIRST, t2, n2 NULLS FIRST, pos) AS rn FROM (
  SELECT pos, name, regexp_extract(name, '^(\D*)', 1) AS t1, try_cast(regexp_extract(name, '^\D*(\d*)', 1) AS BIGINT) AS n1,
    regexp_extract(name, '^\D*\d*(\D*)', 1) AS t2, try_cast(regexp_extract(name, '^\D*\d*\D*(\d*)', 1) AS BIGINT) AS n2 FROM labels_mixed) k""")
def natural_sort(spark, sf_dir):
    rows = load(spark, sf_dir, "labels_mixed")
    order = [*sortkeys.natural_order(F.col("name")), F.col("pos")]
    return global_rank(rows, order).select("pos", "name", "rn")


@query("priority_sort", ctes("words") + f"SELECT pos, word, row_number() OVER (ORDER BY {WORD_RANK}, pos) AS rn FROM words")
def priority_sort(spark, sf_dir):
    order = [*sortkeys.priority_key(F.col("word")), F.col("pos")]
    return global_rank(load(spark, sf_dir, "words"), order).select("pos", "word", "rn")


@query("typed_sort", ctes("typed", days=r"""SELECT *, CASE WHEN regexp_matches(day_text, '^\d{1,3}$') THEN make_date(CAST(day_text AS INT) + 1911, 1, 1)
  WHEN regexp_matches(day_text, '^\d{4}-\d{2}$') THEN CAST(day_text || '-01' AS DATE) ELSE DATE '0001-01-01' END AS day FROM typed""")
  + f"SELECT pos, row_number() OVER (ORDER BY day, {WORD_RANK}, try_cast(amount AS DOUBLE) NULLS LAST, pos) AS rn FROM days")
def typed_sort(spark, sf_dir):
    keys = [["day_text", "date_asc"], ["word", "text_asc"], ["amount", "number_asc"]]
    return global_rank(load(spark, sf_dir, "typed"), sortkeys.sort_columns(keys, "pos")).select("pos", "rn")


@query("parse_thousands", ctes("thousands") + "SELECT id, try_cast(replace(trim(raw), ',', '') AS DOUBLE) AS amount FROM thousands")
def parse_thousands(spark, sf_dir):
    return load(spark, sf_dir, "thousands").select("id", text.parse_thousands(F.col("raw")).alias("amount"))


@query("layer_kind", ctes("layer_titles") + f"""SELECT id, kind, core, CASE WHEN kind = 'other' THEN english
  WHEN regexp_matches(en, '^[a-z0-9_]+$') THEN CASE kind WHEN 'crop' THEN '{CROP_PREFIX}_' ELSE '{SOIL_PREFIX}_' END || en END AS name_en FROM (
  SELECT id, english, replace(lower(english), ' ', '_') AS en,
    CASE WHEN contains(title, '{CROP_SUFFIX}') THEN 'crop' WHEN contains(title, '{SOIL_WORD}') THEN 'soil' ELSE 'other' END AS kind,
    trim(CASE WHEN contains(title, '{CROP_SUFFIX}') THEN replace(title, '{CROP_SUFFIX}', '') ELSE replace(title, '{SOIL_WORD}', '') END) AS core
  FROM layer_titles) k""")
def layer_kind(spark, sf_dir):
    title = F.col("title")
    rows = load(spark, sf_dir, "layer_titles").withColumn("kind", names.layer_kind(title))
    return rows.select("id", "kind", names.layer_core(title).alias("core"), names.classification_of(F.col("kind"), F.col("english")).alias("name_en"))


@query("layer_name_valid", ctes("layer_titles") + "SELECT id, english, regexp_matches(english, '^[a-z0-9_]+$') AS valid FROM layer_titles")
def layer_name_valid(spark, sf_dir):
    return load(spark, sf_dir, "layer_titles").select("id", "english", names.is_valid_name(F.col("english")).alias("valid"))
