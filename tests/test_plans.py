"""The jobs from end to end on small inputs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmosaic.operators import geometry, raster
from fieldmosaic.plans import mapping
from fieldmosaic.plans.training import TrainingPlan, train
from fieldmosaic.schemas import PIXELS
from workload import inputs, raster_queries

BOX = "POLYGON ((120 23, 120.002 23, 120.002 23.004, 120 23.004, 120 23))"


def test_mapping_job_twice(spark):
    wkt = [("A", "v", BOX), ("B", "v", BOX), ("C", "v", "POLYGON EMPTY")]
    areas = geometry.with_frame(spark.createDataFrame(wkt, "area_id string, shp_version string, geometry string"))
    layer = "soil_survey_ph"
    pixels = spark.createDataFrame([(a, "v", layer, r, c, 1, 254, 3) for a in "ABC" for r in range(5) for c in range(4)], PIXELS)
    images = spark.createDataFrame(
        [(a, "v", layer, "town", a, f"raw/{a}", text, dt.date(2025, 1, 1)) for a, text in (("A", "x"), ("B", None), ("C", "z"))],
        "area_id string, shp_version string, classification string, area_level string, region_name string, path string, content string, recorded_at date")
    ledger = spark.createDataFrame([], "id long, area_id string, area_level string, classification string, shp_version string, stage string, file_path string, layer_updated boolean, recorded_at date")
    nothing = images.select("path", "content").limit(0)
    first = mapping.run(images, nothing, pixels, areas, ["area_id", "shp_version"], ledger, pixels.limit(0))
    assert {r.area_id: (r.status, r.action) for r in first.work.collect()} == {"A": ("created", "mask"), "B": ("error", "stop"), "C": ("error", "stop")}
    rows = first.ledger.collect()
    assert sorted((r.id, r.area_id, r.stage, r.file_path) for r in rows) == [
        (1, "A", "masked", f"output/wms_images/v/masked/{layer}/A.png"), (2, "A", "raw", "raw/A")]
    assert first.masked.count() == 20 and first.masked.where("g = 0").count() > 0

    later = images.withColumn("recorded_at", F.lit(dt.date(2026, 1, 1)))
    seen = images.select("path", "content")
    second = mapping.run(later, seen, pixels, areas, ["area_id", "shp_version"], first.ledger, first.masked)
    assert {r.area_id: r.action for r in second.work.collect()}["A"] == "skip"
    assert sorted(second.ledger.collect()) == sorted(rows) and sorted(second.masked.collect()) == sorted(first.masked.collect())

    rejects = spark.createDataFrame([("raw/A", "16 bits per sample")], "path string, reason string")
    torn = mapping.run(later, nothing, pixels, areas, ["area_id", "shp_version"], ledger, pixels.limit(0), rejects=rejects)
    assert {r.area_id: (r.action, r.reason) for r in torn.work.collect()} == {
        "A": ("stop", "16 bits per sample"), "B": ("stop", "content missing"), "C": ("stop", "geometry missing")}
    assert torn.ledger.isEmpty() and torn.masked.isEmpty()

    # new bytes, same pixels: the raw row is renewed, the mask's row is not
    bytes_only = later.withColumn("content", F.concat("content", F.lit("!")))
    third = mapping.run(bytes_only, seen, pixels, areas, ["area_id", "shp_version"], first.ledger, first.masked)
    days = {r.stage: r.recorded_at.year for r in third.ledger.collect()}
    assert days == {"raw": 2026, "masked": 2025}


def test_mapping_query_groups_line_items_once(spark, monkeypatch):
    """Images, old images, ledger and files are made of the stored pixels, not of the line items again."""
    read = []
    monkeypatch.setattr(inputs, "table", lambda spark, sf_dir, name, plain=inputs.table: read.append(name) or plain(spark, sf_dir, name))
    assert raster_queries.mapping_job(spark, "/root/testdata/sf0.001").count() > 0
    assert read.count("lineitem") == 1


def test_features_by_area(spark):
    rows = spark.createDataFrame([("A", "v", "x", 1.0, None), ("A", "v", "y", 2.0, 5.0), ("B", "v", "z", 3.0, 6.0)],
                                 "area_id string, shp_version string, classification string, mean_value double, sand double")
    got = {r.area_id: r for r in raster.features_by_area(rows, ["x", "y"], ["mean_value", "sand"]).collect()}
    assert got["A"].asDict() == {"area_id": "A", "shp_version": "v", "x_mean_value": 1.0, "x_sand": None, "y_mean_value": 2.0, "y_sand": 5.0}
    assert got["B"].x_mean_value is None and got["B"].y_sand is None


def test_training_job(spark, tmp_path):
    features = spark.createDataFrame([("A", 10.0, "x"), ("B", 20.0, "y"), ("C", 30.0, None)], "area_id string, cover double, soil string")
    detail = spark.createDataFrame([("A", 2020, 1.0), ("A", 2020, 1.0), ("A", 2021, 3.0), ("B", 2020, 5.0), ("B", 2021, 4.0), (None, None, None)],
                                   "town_id string, year int, amount double")
    plan = TrainingPlan(summary={"amount": "sum"}, missing={"amount_sum": "zero"}, onehot={"soil": ["x", "y"]}, scaled=["cover"], method="minmax", trend=("year", "amount"))
    out = train(features, detail, plan, str(tmp_path), "001_soil", ["cover", "amount_sum"], ("parquet", "csv"), dt.date(2025, 3, 1))
    assert out.paths == [f"{tmp_path}/GIS_processed_001_soil_20250301.{f}" for f in ("parquet", "csv")]
    assert spark.read.option("header", "true").csv(out.paths[1]).count() == out.table.count() == 3
    assert [(r.rule, r.rows_deleted) for r in out.cleaning.orderBy("step").collect()] == [("drop_all_null", 1), ("drop_duplicates", 1)]
    steps = {(r.step, r.column_name): r for r in out.steps.collect()}
    assert (steps["missing", "amount_sum"].n_null_before, steps["missing", "amount_sum"].n_null_after) == (1, 0)
    assert (steps["scale", "cover"].mean_before, steps["scale", "cover"].mean_after) == (20.0, pytest.approx(0.5))
    assert set(steps) == {("missing", "amount_sum"), ("one-hot", "soil"), ("scale", "cover")} and steps["one-hot", "soil"].n_null_after is None
    assert out.correlation.count() > 0 and out.histograms["cover"].agg(F.sum("n")).first()[0] == 3
