"""Upserts, ledger, gates and requests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldmosaic.functions import dates, url, wkt
from fieldmosaic.operators import boundaries, clean, geometry, ledger, names, quality, records, resilience, stats, wms

LEDGER = "id long, area_id string, area_level string, classification string, shp_version string, stage string, file_path string, layer_updated boolean, recorded_at date"
DAY, LATER = dt.date(2025, 3, 18), dt.date(2025, 4, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_upsert_last_row_wins_and_missing_columns_stay(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "key int, name string, size int")
    batch = spark.createDataFrame([(2, "old", 0), (2, None, 1), (3, "c", 2), (None, "m", 3), (None, "m", 4)], "key int, name string, pos int")
    got = ledger.upsert(target, batch, ["key"], "pos")
    assert rows_of(got) == sorted([(1, "a", 10), (2, None, 20), (3, "c", None), (None, "n", 0), (None, "m", None), (None, "m", None)], key=repr)
    keyed = batch.where("key is not null")
    once = ledger.upsert(target, keyed, ["key"], "pos")
    assert rows_of(ledger.upsert(once, keyed, ["key"], "pos")) == rows_of(once)


def test_upsert_of_keys_only_changes_nothing_known(spark):
    target = spark.createDataFrame([(1, "a")], "key int, name string")
    batch = spark.createDataFrame([(1, 0), (2, 1)], "key int, pos int")
    assert rows_of(ledger.upsert(target, batch, ["key"], "pos")) == [(1, "a"), (2, None)]


def test_log_results(spark):
    stored = spark.createDataFrame([(7, "A", "town", "ph", "v1", "raw", "old", True, DAY)], LEDGER)
    results = spark.createDataFrame([
        ("A", "county", "ph", "v1", "raw", "new", LATER, "updated", 1), ("A", "town", "ph", "v1", "raw", "ignored", LATER, "unchanged", 2),
        ("B", "town", "ph", "v1", "raw", "b1", DAY, "created", 3), ("B", "town", "ph", "v1", "raw", "b2", LATER, "created", 4),
        ("C", "town", "ph", "v1", "raw", "c", DAY, "error", 5), ("A", "town", "ph", "v1", "masked", "m", DAY, "created", 6),
    ], "area_id string, area_level string, classification string, shp_version string, stage string, file_path string, recorded_at date, status string, pos int")
    got = {(r.area_id, r.stage): r for r in ledger.log_results(stored, results, "pos").collect()}
    assert set(got) == {("A", "raw"), ("A", "masked"), ("B", "raw")}
    known = got["A", "raw"]
    assert (known.id, known.area_level, known.file_path, known.layer_updated, known.recorded_at) == (7, "town", "new", True, LATER)
    assert (got["A", "masked"].id, got["B", "raw"].id, got["B", "raw"].file_path, got["B", "raw"].layer_updated) == (8, 9, "b2", False)


def test_change_status(spark):
    old = spark.createDataFrame([("a", b"1"), ("b", b"12"), ("c", b"xy")], "path string, content binary")
    new = spark.createDataFrame([("a", b"1"), ("b", b"1"), ("c", b"xz"), ("d", b"")], "path string, content binary")
    assert dict(rows_of(ledger.change_status(old, new))) == {"a": "unchanged", "b": "updated", "c": "updated", "d": "created"}


def test_mask_decision_needs_ledger_and_file(spark):
    work = spark.createDataFrame([(a, "ph", "v", s) for a, s in (("A", "unchanged"), ("B", "unchanged"), ("C", "unchanged"), ("D", "updated"), ("E", "error"))],
                                 "area_id string, classification string, shp_version string, status string")
    stored = spark.createDataFrame([(a, "ph", "v", "masked", f"{a}.png") for a in "ABD"], "area_id string, classification string, shp_version string, stage string, file_path string")
    files = spark.createDataFrame([("A.png",), ("D.png",)], "path string")
    got = {r.area_id: (r.action, r.logged_status) for r in ledger.mask_decision(work, stored, files).collect()}
    assert got == {"A": ("skip", "unchanged"), "B": ("mask", "created"), "C": ("mask", "created"), "D": ("mask", "updated"), "E": ("stop", "error")}
    assert {r.area_id for r in ledger.pending(work, stored, files=files).collect()} == {"B", "C", "D", "E"}


def test_resume(spark):
    plan = spark.createDataFrame([(n, a) for n in (1, 2, 3) for a in ("A", "A01", "B")], "layer_no int, area_id string")
    left = lambda *at: rows_of(ledger.resume_plan(plan, *at))
    assert left(2, "A01") == [(2, "B"), (3, "A"), (3, "A01"), (3, "B")]
    assert len(left(None, None)) == 9 and len(left(2, None)) == 6


def test_defaults_are_stamped(spark):
    rows = spark.createDataFrame([(None, None), (True, dt.datetime(2020, 1, 1))], "layer_updated boolean, recorded_at timestamp")
    got = ledger.with_defaults(rows).collect()
    assert all(r.recorded_at is not None for r in got) and sorted(r.layer_updated for r in got) == [False, True]


def test_insert_new_keeps_first_and_is_idempotent(spark):
    target = spark.createDataFrame([("A", "v1", "stored")], "area_id string, shp_version string, name string")
    batch = spark.createDataFrame([("A", "v1", "x", 0), ("A", "v2", "first", 1), ("A", "v2", "second", 2)], "area_id string, shp_version string, name string, pos int")
    once = boundaries.insert_new(target, batch, "pos")
    assert rows_of(once) == [("A", "v1", "stored"), ("A", "v2", "first")]
    assert rows_of(boundaries.insert_new(once, batch, "pos")) == rows_of(once)


def test_gate_refuses_whole_version(spark):
    rows = spark.createDataFrame([("A", "v1"), (" ", "v1"), ("B", "v2"), ("nan", "v3"), (None, "v4")], "area_id string, shp_version string")
    assert rows_of(boundaries.accepted_batches(rows)) == [("B", "v2")]
    assert {r.shp_version: (r.n_missing, r.accepted) for r in boundaries.batch_gate(rows).collect()} == {
        "v1": (1, False), "v2": (0, True), "v3": (1, False), "v4": (1, False)}


def test_split_town(spark):
    rows = spark.createDataFrame([("T28", "TOWN_MOI_1"), ("T28", "Town_Majia_Sanhe_1"), ("T01", "TOWN_MOI_1"), ("T28", None)], "area_id string, shp_version string")
    assert len(boundaries.without_split_town(rows).collect()) == 3


def test_region_names(spark):
    rows = spark.createDataFrame([
        ("1", "county", "K", "Big County", None, "g"), ("2", "town", "K", None, "Old Town", "g"), ("3", "town", "K", "", "T", "g"),
        ("4", "village", "K", "C", "T", "g"), ("5", "town", "K", "C", "T", None),
    ], "area_id string, area_level string, COUNTYID string, COUNTYENG string, TOWNENG string, geometry string")
    got = {r.area_id: (r.region_name, r.reject_reason) for r in boundaries.with_region_name(boundaries.backfill_county_name(rows)).collect()}
    assert got == {"1": ("Big_County", None), "2": ("Big_County_Old_Town", None), "3": (None, "name missing"),
                   "4": (None, "unknown level"), "5": (None, "geometry missing")}


def test_sort_column():
    pick = boundaries.sort_column
    assert pick(["COUNTYID", "geometry"], "COUNTY_MOI.shp") == "COUNTYID"
    assert pick(["COUNTYID", "TOWNID"], "town_county.shp") == "COUNTYID"
    assert pick(["COUNTYID", "TOWNID"], "TOWN_MOI.shp") == "TOWNID"
    assert pick(["COUNTYID"], "TOWN_MOI.shp") is None and pick(["x"], "county.shp") is None


def test_dedup(spark):
    rows = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (None, "a", 2), (None, "a", 3), (1, None, 4)], "k int, v string, pos int")
    once = records.dedup_records(rows, "pos")
    assert sorted(r.pos for r in once.collect()) == [0, 2, 4]
    assert rows_of(records.dedup_records(once, "pos")) == rows_of(once)


def test_layer_names(spark):
    static = names.static_layers(spark)
    assert static.count() == 74
    overrides = spark.createDataFrame([("母岩性質", "first", 0), ("母岩性質", "last", 1), ("新圖", "new", 2)], "name_zh string, name_en string, pos int")
    merged = {r.name_zh: (r.name_en, r.origin) for r in names.layer_names(static, names.add_override(overrides, "新圖", "newer", "pos"), "pos").collect()}
    assert merged["母岩性質"] == ("last", "override") and merged["新圖"] == ("newer", "override") and len(merged) == 75
    legends = spark.createDataFrame([(e,) for e in ("soil_survey_texture_30_60cm", "crop_suitability_rating_map_rice", "farmland_importance_level", "other")], "c string")
    assert [r[0] for r in legends.select(names.legend_of(F.col("c"))).collect()] == ["soil_texture", "crop_suitability_rating_map", "farmland_importance_level", "other"]


def test_layer_area_product_is_complete(spark):
    layers = spark.createDataFrame([(i,) for i in range(7)], "layer_no int")
    areas = spark.range(50).select(F.concat(F.lit("A"), "id").alias("area_id"), F.lit("v").alias("shp_version"))
    plan = wms.layer_area_plan(layers, areas)
    assert plan.count() == 350 and plan.distinct().count() == 350
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_triage(spark):
    log = spark.createDataFrame([(0, 500, None, None), (2, 404, None, None), (3, 503, None, None), (1, None, None, "timeout"), (0, None, None, "refused"),
                                 (0, 200, "image/png", None), (0, 200, "text/xml", None)], "attempt int, status int, content_type string, error string")
    got = [(r.action, r.wait_s, r.client_error) for r in wms.response_triage(log).collect()]
    assert got == [("retry", 5, False), ("retry", 20, True), ("give_up", None, False), ("retry", 10, False), ("fail", None, False),
                   ("keep", None, False), ("not_image", None, False)]


def test_constraints(spark):
    rows = spark.createDataFrame([(None, "town", "g", "v"), ("A", "village", "g", "v"), ("A", "town", None, "v")], "area_id string, area_level string, geometry string, shp_version string")
    got = {(r.rule, r.column_name): r.n for r in quality.constraint_violations(rows, quality.AREA_RULES).collect()}
    assert got == {("not_null", "area_id"): 1, ("not_null", "area_level"): 0, ("not_null", "geometry"): 1, ("not_null", "shp_version"): 0,
                   ("domain", "area_level"): 1, ("unique", "area_id,shp_version"): 1}


def test_cleaning_edges(spark):
    rows = spark.createDataFrame([(None, None), (float("nan"), None), (1.0, "a"), (1.0, "a"), (3.0, None), (None, "b")], "v double, c string")
    cleaned, report = clean.clean(rows, ["drop_all_null", "drop_duplicates"])
    assert cleaned.count() == 3
    assert [(r.rule, r.n_before, r.n_after, r.rows_deleted) for r in report.orderBy("step").collect()] == [("drop_all_null", 6, 4, 2), ("drop_duplicates", 4, 3, 1)]
    filled = clean.handle_missing(rows, {"v": "median", "c": "mode"})
    assert sorted((r.v, r.c) for r in filled.collect()) == [(1.0, "a"), (1.0, "a"), (1.0, "a"), (1.0, "a"), (1.0, "b"), (3.0, "a")]
    flat = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert {r.v for r in clean.scale(flat, ["v"]).collect()} == {0.0, None}
    assert {r.is_outlier for r in clean.outlier_zscore(flat, "v").collect()} == {False, None}
    assert {r.v for r in clean.scale(flat, ["v"], "minmax").collect()} == {0.0, None}


def test_modes_of_all_columns_come_from_one_action(spark, monkeypatch):
    rows = spark.createDataFrame([(2.0, "b", 10, None), (2.0, "a", 9, None), (10.0, "a", 10, None), (10.0, "b", 9, None), (float("nan"), None, 8, None)], "v double, c string, n int, none string")
    calls = []
    first = type(rows).first
    monkeypatch.setattr(type(rows), "first", lambda self: calls.append(1) or first(self))
    assert clean.column_modes(rows, ["v", "c", "n", "none"]) == {"v": 2.0, "c": "a", "n": 9, "none": None}
    assert len(calls) == 1
    assert clean.column_modes(rows, ["n"]) == {"n": 9}


def test_cleaning_report_scans_once(spark, tmp_path):
    spark.createDataFrame([(1.0, "a"), (None, None)], "v double, c string").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    for rules in (["drop_duplicates", "drop_all_null"], ["drop_all_null", "drop_duplicates", "drop_duplicates"]):
        plan = clean.clean(rows, rules)[1]._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1


def test_onehot_has_no_cap_and_a_sparse_form(spark):
    rows = spark.range(1200).select(F.col("id").cast("string").alias("c"), "id")
    assert len(clean.encode_onehot(rows, "c", [str(k) for k in range(1200)]).columns) == 1201
    some = clean.encode_onehot(rows, "c", ["3", "none"]).agg(F.sum("c_3"), F.sum("c_none")).first()
    assert tuple(some) == (1, 0)
    assert clean.encode_sparse(rows, "id", ["c"]).count() == 1200


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (4.0,)], "v double")
    assert [r.v for r in clean.scale(df, ["v"], "minmax").collect()] == [0.0, 1 / 3, None, None, 1.0]
    for flag in (clean.outlier_zscore, clean.outlier_iqr):
        assert [r.is_outlier for r in flag(df, "v").collect()] == [False, False, None, None, False]
    assert sum(r.n for r in stats.histogram(df, "v").collect()) == 3
    assert [r["corr"] for r in stats.correlation(df, ["v"]).collect()] == [1.0]


def test_missing_score_has_no_class(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "id int, f double")
    got = {r.id: r.stability_class for r in resilience.resilience(df, {"f": 1.0}, 2, "id").collect()}
    assert got == {1: 1, 2: None, 3: 2}


def test_towns_without_signals_stay(spark):
    towns = spark.createDataFrame([("t1", "c"), ("t2", "c")], "town_id string, county_id string")
    signals = spark.createDataFrame([("t1", 2001, 5.0)], "town_id string, year int, rain_total double")
    targets = spark.createDataFrame([("c", 2001, 7.0)], "county_id string, year int, yield double")
    got = sorted((r.town_id, r.year, r.rain_total, r["yield"]) for r in resilience.align_targets(targets, towns, signals).collect())
    assert got == [("t1", 2001, 5.0, 7.0), ("t2", 2001, None, 7.0)]


def test_odd_inputs_do_not_fail_the_job(spark):
    texts = ["POLYGON EMPTY", "", "POINT (1 2)", "POLYGON ((a b))", None, "POLYGON Z ((0 0 5, 1 0 5, 1 1 5, 0 0 5))", "POLYGON ((0 0, 1 0, 1 1, 0 0))"]
    df = spark.createDataFrame([(t,) for t in texts], "w string").select(wkt.parse_polygon(F.col("w")).alias("p"), wkt.wkt_problem(F.col("w")).alias("why")).collect()
    assert [r.why for r in df] == ["empty", "missing", "not a polygon", "bad coordinates", "missing", None, None]
    assert [r.p is None for r in df] == [True] * 5 + [False] * 2 and df[5].p == df[6].p
    odd = spark.createDataFrame([("2147483647", "http://h/p?a=100%&b=1")], "y string, u string").select(dates.roc_to_ad(F.col("y")).alias("y"), url.rewrite_query(F.col("u"), {"WIDTH": F.lit(5)}).alias("u")).first()
    assert odd.y is None and odd.u == "http://h/p?a=100%25&b=1&WIDTH=5"
    assert {(r.table_name, r.n) for r in records.table_counts({"a": None}).collect()} == {("a", "0")}


def test_mask_spans_are_never_broadcast(spark):
    pixels = spark.createDataFrame([("a", 0, 0)], "area_id string, row int, col int")
    mask = spark.createDataFrame([("a", 0, 0, 0, 5)], "area_id string, row int, block int, c0 int, c1 int")
    joined = geometry.with_inside(pixels, mask, ["area_id"])
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString() and joined.first().inside

def test_labels_and_schema_text(spark):
    rows = spark.createDataFrame([], "id long, size double, ok boolean, at timestamp, name string, geometry string, foreign_key string, tags array<string>")
    labels = records.schema_labels(rows)
    assert labels == {"id": "integer", "size": "float", "ok": "boolean", "at": "datetime", "name": "text", "geometry": "geometry", "tags": "json"}
    assert records.columns_ddl({"a b": "integer", "c.d-e": "float", "x": "unheard", "foreign_key": "text"}) == "`a_b` bigint, `c_d_e` double, `x` string"
