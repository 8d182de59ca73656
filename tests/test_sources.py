"""Decoders, sinks, streaming and whole plans, on files under a fresh folder."""

from __future__ import annotations

import datetime as dt
import json
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldmosaic.operators import boundaries, colors, stats
from fieldmosaic.plans import ingest, mapping
from fieldmosaic.plans.training import TrainingPlan, run
from fieldmosaic.runtime import checkpoint_folder
from fieldmosaic.sources import images, shapefiles, sinks, tables
from fieldmosaic.streaming.boundary_stream import ingest_shape_stream, ingest_stream
from workload.raster_queries import _shapefile


def png(pixels: np.ndarray, colour: int, palette: np.ndarray | None = None) -> bytes:
    """PNG bytes that use every line filter in turn."""
    height, width = pixels.shape[:2]
    flat = pixels.reshape(height, -1).astype(int)
    step = flat.shape[1] // width
    lines = []
    for y in range(height):
        kind, line = y % 5, []
        for i, value in enumerate(flat[y]):
            a = flat[y, i - step] if i >= step else 0
            b = flat[y - 1, i] if y else 0
            c = flat[y - 1, i - step] if y and i >= step else 0
            paeth = min((a, b, c), key=lambda v: abs(a + b - c - v))
            line.append((value - (0, a, b, (a + b) // 2, paeth)[kind]) & 255)
        lines.append(bytes([kind, *line]))

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    extra = chunk(b"PLTE", palette.astype(np.uint8).tobytes()) if palette is not None else b""
    packed = zlib.compress(b"".join(lines))
    half = len(packed) // 2
    return (images.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + extra
            + chunk(b"IDAT", packed[:half]) + chunk(b"IDAT", packed[half:]) + chunk(b"IEND", b""))


def test_png_kinds():
    rng = np.random.default_rng(3)
    rgb = rng.integers(0, 256, (11, 7, 3))
    bgr = rgb[:, :, ::-1]
    assert np.array_equal(images.decode_png(png(rgb, 2)), bgr)
    rgba = np.concatenate([rgb, rng.integers(0, 256, (11, 7, 1))], axis=2)
    assert np.array_equal(images.decode_png(png(rgba, 6)), bgr)
    gray = rgb[:, :, :1]
    assert np.array_equal(images.decode_png(png(gray, 0)), np.repeat(gray, 3, axis=2))
    table = rng.integers(0, 256, (9, 3))
    index = rng.integers(0, 9, (11, 7, 1))
    assert np.array_equal(images.decode_png(png(index, 3, table)), table[index[:, :, 0]][:, :, ::-1])
    for broken in (b"", b"not a png", png(rgb, 2)[:60]):
        assert images.decode_png(broken) is None


def test_line_filters():
    rng = np.random.default_rng(1)
    for shape in ((1, 1, 1), (7, 1, 3), (1, 9, 4), (13, 8, 3), (8, 17, 1)):
        kinds, body = rng.integers(0, 5, shape[0]), rng.integers(0, 256, shape).astype(np.uint8)
        want = np.zeros(shape, int)
        for y, x, c in np.ndindex(shape):
            left, above = want[y, x - 1, c] if x else 0, want[y - 1, x, c] if y else 0
            corner = want[y - 1, x - 1, c] if x and y else 0
            nearest = min((left, above, corner), key=lambda v: abs(left + above - corner - v))
            want[y, x, c] = (int(body[y, x, c]) + (0, left, above, (left + above) // 2, nearest)[kinds[y]]) & 255
        assert np.array_equal(images._by_diagonals(kinds, body), want)


def test_read_images(spark, tmp_path):
    rgb = np.arange(130 * 4 * 3).reshape(130, 4, 3) % 256
    (tmp_path / "水.png").write_bytes(png(rgb, 2))
    (tmp_path / "bad.png").write_bytes(b"nothing")
    deep = png(rgb, 2)
    (tmp_path / "deep.png").write_bytes(deep[:24] + b"\x10" + deep[25:])
    rows = images.read_images(spark, str(tmp_path)).collect()
    assert len(rows) == 130 * 4
    rejects = {r.path.rsplit("/", 1)[1]: r.reason for r in images.image_rejects(images.image_files(spark, str(tmp_path))).collect()}
    assert rejects == {"bad.png": "image unreadable: no PNG signature", "deep.png": "image unreadable: 16 bits per sample"}
    assert all((r.r, r.g, r.b) == tuple(rgb[r.row, r.col]) for r in rows)


def test_images_restored_together():
    rng = np.random.default_rng(5)
    shapes = [(11, 7), (4, 9), (11, 7), (1, 1), (11, 7), (4, 9)]
    pictures = [rng.integers(0, 256, (*shape, 3)) for shape in shapes]
    table = rng.integers(0, 256, (9, 3))
    files = [(str(i), png(rgb, 2)) for i, rgb in enumerate(pictures)] + [("bad", b"nothing"), ("few", png(np.full((11, 7, 1), 9), 3, table))]
    for pixels in (1, 100, 10_000):
        got = dict(images.decode_many(files, pixels))
        assert sorted(got) == [str(i) for i in range(len(pictures))]
        assert all(np.array_equal(got[str(i)], rgb[:, :, ::-1]) for i, rgb in enumerate(pictures))


def test_image_leaves_worker_as_runs(spark):
    rgb = np.full((40, 50, 3), 255)
    rgb[3, 7:9], rgb[4, 0], rgb[39, 49] = (1, 2, 3), (4, 5, 6), (255, 255, 254)
    files = spark.createDataFrame([("a", png(rgb, 2)), ("bad", b"nothing"), ("none", None)], "path string, content binary")
    assert images.image_runs(files).count() == 40 + 2 + 1 + 1
    rows = images.image_pixels(files).collect()
    assert len(rows) == 40 * 50 and len({(r.row, r.col) for r in rows}) == 40 * 50
    assert all(r.path == "a" and (r.r, r.g, r.b) == tuple(rgb[r.row, r.col]) for r in rows)


SQUARE = [(120.0, 23.0), (120.0, 24.0), (121.0, 24.0), (121.0, 23.0), (120.0, 23.0)]
HOLE = [(120.2, 23.2), (120.4, 23.2), (120.4, 23.4), (120.2, 23.4), (120.2, 23.2)]


def boundary_folder(path, names=("TOWN_MOI_1140318", "River_1", "COUNTY_notes")):
    as_points = lambda ring: [{"x": x, "y": y} for x, y in ring]
    ids = ["A10", "A2", "T28", "A1"]
    parts = [[[as_points(SQUARE), as_points(HOLE)]], [[as_points(SQUARE)], [as_points([(x + 5, y) for x, y in SQUARE])]], [[as_points(SQUARE)]], None]
    table = pd.DataFrame({"area_id": ids, "k": range(4), "file_no": 0, "parts": [None if p is None else json.dumps(p) for p in parts]})
    shp, dbf = _shapefile(table)["content"]
    for name in names:
        (path / f"{name}.shp").write_bytes(shp)
        (path / f"{name}.dbf").write_bytes(dbf.replace(b"KEY", b"COUNTYID"[:3]))
    return str(path)


def test_boundary_files(spark, tmp_path):
    folder = boundary_folder(tmp_path)
    records = shapefiles.read_boundary_files(spark, folder)
    assert {r.shp_version for r in records.collect()} == {"TOWN_MOI_1140318", "COUNTY_notes"}
    rows = {r.attributes["TOWNID"]: r for r in records.where("shp_version = 'TOWN_MOI_1140318'").collect()}
    assert rows["A1"].geometry is None and rows["A10"].geometry.count("(") == 4 and rows["A2"].geometry.count("((") == 2
    table = shapefiles.read_boundary_file(spark, f"{folder}/TOWN_MOI_1140318.shp")
    assert "TOWNID" in table.columns and table.count() == 4
    names = {r.file_name: r.shp_version for r in boundaries.list_boundary_files(spark, folder).collect()}
    assert names == {"TOWN_MOI_1140318.shp": "TOWN_MOI_1140318", "COUNTY_notes.shp": "COUNTY_notes"}


def test_boundary_files_that_are_odd(spark, tmp_path):
    boundary_folder(tmp_path, ("TOWN_a", "TOWN_cut", "TOWN_deleted", "TOWN_big5", "River_cut"))
    for name in ("TOWN_cut.shp", "River_cut.shp"):
        (tmp_path / name).write_bytes((tmp_path / name).read_bytes()[:-10])
    whole = (tmp_path / "TOWN_deleted.dbf").read_bytes()
    (tmp_path / "TOWN_deleted.dbf").write_bytes(whole.replace(b" A10", b"*A10", 1))
    renamed = whole.replace(b"A10".ljust(12), "北".encode("big5").ljust(12))
    (tmp_path / "TOWN_big5.dbf").write_bytes(renamed)
    rejects = lambda: {r.path.rsplit("/", 1)[1]: r.status for r in shapefiles.read_boundary_rejects(spark, str(tmp_path)).collect()}
    assert rejects() == {"TOWN_cut.shp": "error", "TOWN_big5.dbf": "error"}  # rivers are not read at all
    (tmp_path / "TOWN_big5.cpg").write_text("950\n")
    assert rejects() == {"TOWN_cut.shp": "error"}
    found: dict[str, set] = {}
    for r in shapefiles.read_boundary_files(spark, str(tmp_path)).collect():
        found.setdefault(r.shp_version, set()).add(r.attributes["TOWNID"])
    assert found == {"TOWN_a": {"A10", "A2", "T28", "A1"}, "TOWN_deleted": {"A2", "T28", "A1"}, "TOWN_big5": {"北", "A2", "T28", "A1"}}
    assert shapefiles.read_boundary_file(spark, f"{tmp_path}/TOWN_big5.shp").count() == 4
    assert shapefiles.read_boundary_file(spark, f"{tmp_path}/TOWN_cut.shp").count() == 0


def test_records_meet_within_their_folder(spark):
    shapes = spark.createDataFrame([("x/TOWN_1.shp", 0, "p"), ("y/TOWN_1.shp", 0, "q")], "path string, record int, geometry string")
    notes = spark.createDataFrame([("x/TOWN_1.dbf", 0, {"a": "1"}), ("y/TOWN_1.dbf", 0, {"a": "2"})], "path string, record int, attributes map<string,string>")
    assert sorted((r.geometry, r.attributes["a"]) for r in shapefiles.join_records(shapes, notes).collect()) == [("p", "1"), ("q", "2")]


def test_ingest_twice_adds_nothing(spark, tmp_path):
    batch = ingest.areas_from_records(shapefiles.read_boundary_files(spark, boundary_folder(tmp_path, ("TOWN_MOI_1140318",))))
    assert not ingest.has_refused(batch)
    columns = "area_id string, area_level string, TOWNID string, geometry string, shp_version string, created_at timestamp"
    empty = spark.createDataFrame([], columns)
    once = ingest.ingest(empty, batch)
    assert sorted(r.area_id for r in once.collect()) == ["A1", "A10", "A2"]  # T28 comes from another file
    assert once.where("created_at is null").isEmpty() and "attributes" in once.columns
    sinks.replace_table(once, f"{tmp_path}/areas")
    stored = spark.read.parquet(f"{tmp_path}/areas")
    assert ingest.ingest(stored, batch).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.replace_table(stored, f"{tmp_path}/areas")


def test_stream_ingests_each_version_once(spark, tmp_path):
    schema = "area_id string, name string, shp_version string, record int"
    incoming, target, state = f"{tmp_path}/in", f"{tmp_path}/areas", f"{tmp_path}/state"

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(incoming)
        ingest_stream(spark, incoming, schema, target, state).awaitTermination()
        return sorted((r.area_id, r.shp_version, r.name) for r in spark.read.parquet(target).collect())

    first = arrive([("A", "a", "v1", 0), ("A", "again", "v1", 1), ("B", "b", "v1", 2)])
    assert first == [("A", "v1", "a"), ("B", "v1", "b")]
    assert arrive([("A", "changed", "v1", 0)]) == first
    late = arrive([("C", "late", "v1", 0), ("A", "changed", "v1", 1)])
    assert late == [*first, ("C", "v1", "late")]  # a later file of a version adds the areas it lacks
    assert arrive([("D", "d", "v1", 0), (None, "nameless", "v1", 1)]) == late
    refused = spark.read.parquet(f"{target}_refused").where("n_missing > 0").collect()
    assert [(r.shp_version, r.n_rows, r.n_missing) for r in refused] == [("v1", 2, 1)]
    assert arrive([("A", "a", "v2", 0), ("T28", "x", "TOWN_MOI_1", 0), ("Z", "z", "TOWN_MOI_1", 1), (" ", "", "v3", 0), ("C", "c", "v3", 1)]) == sorted(
        [*late, ("A", "v2", "a"), ("Z", "TOWN_MOI_1", "z")])
    ingest_stream(spark, incoming, schema, target, f"{tmp_path}/fresh").awaitTermination()
    assert spark.read.parquet(target).count() == 5


def test_shape_parts_arrive_in_different_batches(spark, tmp_path):
    for name in ("whole", "in"):
        (tmp_path / name).mkdir()
    whole, incoming, target = tmp_path / "whole", tmp_path / "in", f"{tmp_path}/areas"
    boundary_folder(whole, ("TOWN_1", "TOWN_[2]", "COUNTY_3", "River_4", "TOWN_bad"))
    (whole / "TOWN_bad.shp").write_bytes((whole / "TOWN_bad.shp").read_bytes()[:-10])

    def arrive(*names):
        for name in names:
            (incoming / name).write_bytes((whole / name).read_bytes())
        ingest_shape_stream(spark, str(incoming), target, f"{tmp_path}/state").awaitTermination()
        return sorted({r.shp_version for r in spark.read.parquet(target).collect()}) if (tmp_path / "areas").exists() else []

    assert arrive("TOWN_1.shp", "COUNTY_3.dbf", "River_4.shp", "River_4.dbf") == []
    assert arrive("TOWN_[2].shp", "TOWN_[2].dbf") == ["TOWN_[2]"]
    assert arrive("TOWN_1.dbf", "TOWN_bad.dbf") == ["TOWN_1", "TOWN_[2]"]
    assert arrive("COUNTY_3.shp", "TOWN_bad.shp") == ["COUNTY_3", "TOWN_1", "TOWN_[2]"]
    key = ["area_id", "shp_version", "area_level", "geometry"]
    want = ingest.areas_from_records(shapefiles.read_boundary_files(spark, str(whole))).select(*key)
    got = spark.read.parquet(target).select(*key)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == 12
    rejects = spark.read.parquet(f"{target}_refused_parts").collect()
    assert [r.path.rsplit("/", 1)[1] for r in rejects] == ["TOWN_bad.shp"]
    assert arrive() == ["COUNTY_3", "TOWN_1", "TOWN_[2]"]


def test_json_sources(spark, tmp_path):
    for name, body in {"a": '{"k": 1}', "b": '[{"k": 1}, {"j": 2}]', "c": "[1]", "d": "oops", "e": "[]"}.items():
        (tmp_path / f"{name}.json").write_text(body)
    got = {r.path[-6]: r.shape for r in tables.load_json(spark, str(tmp_path)).select("path", "shape").collect()}
    assert got == {"a": "object", "b": "array", "e": "array"}


def test_color_file_round_trip(spark, tmp_path):
    entry = {"data_type": "x", "color_to_value": {"1,2,3": ["a", 2.5], "4,5,6": ["b", "STF1"], "7,8,9": ["c", [0.9, 0.05, 0.05]], "0,0,1": ["d", "None"]}}
    (tmp_path / "colours.json").write_text(json.dumps({"layer_a[illustrative_diagram]": entry}))
    got = {(r.b, r.g, r.r): (r.layer, r.label, r.value_num, r.value_code, r.value_vec) for r in colors.read_color_map(spark, str(tmp_path)).collect()}
    assert got == {(1, 2, 3): ("layer_a", "a", 2.5, None, None), (4, 5, 6): ("layer_a", "b", None, "STF1", None),
                   (7, 8, 9): ("layer_a", "c", None, None, [0.9, 0.05, 0.05]), (0, 0, 1): ("layer_a", "d", None, "None", None)}


def test_exports(spark, tmp_path):
    rows = spark.range(5).withColumn("v", F.col("id") * 1.5)
    day = dt.date(2025, 1, 2)
    for fmt in ("csv", "parquet"):
        path = sinks.export_training_set(rows, str(tmp_path), "002_farmland", fmt, day)
        assert path.endswith(f"GIS_processed_002_farmland_20250102.{fmt}")
        back = spark.read.option("header", "true").schema(rows.schema).format(fmt).load(path)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    sinks.export_training_set(rows, str(tmp_path), "002_farmland", "csv", dt.date(2025, 3, 1))
    newest = tables.latest_output(tables.list_outputs(spark, str(tmp_path))).collect()
    assert [(r.layer, r.path[-12:]) for r in newest] == [("002_farmland", "20250301.csv")]
    with pytest.raises(ValueError):
        sinks.export_training_set(rows, str(tmp_path), "x", "xls")


def test_pixel_store(spark, tmp_path):
    rows = spark.createDataFrame([("v1", "raw", "ph", 1), ("v1", "masked", "ph", 2)], "shp_version string, stage string, classification string, row int")
    sinks.write_pixels(rows, f"{tmp_path}/px")
    masked = spark.read.parquet(f"{tmp_path}/px").where("stage = 'masked'")
    assert [r.row for r in masked.collect()] == [2]
    assert "PartitionFilters: [isnotnull(stage" in masked._jdf.queryExecution().executedPlan().toString()
    documents = f"{tmp_path}/json"
    sinks.write_json(rows, documents)
    assert spark.read.json(documents).count() == 2


def test_classify_end_to_end(spark):
    wkt = "POLYGON ((120 23, 120.01 23, 120.01 23.01, 120 23.01, 120 23))"
    areas = spark.createDataFrame([("A", "v", wkt)], "area_id string, shp_version string, geometry string")
    width, height = 10, 11  # 0.01 degree at 100 m
    cells = [("A", "v", "soil_survey_ph", r, c, *((1, 254, 3) if c < 5 else (3, 5, 245))) for r in range(height) for c in range(width)]
    small = [("A", "v", "soil_survey_drainage", 0, 0, 217, 224, 246)]
    schema = "area_id string, shp_version string, classification string, row int, col int, b smallint, g smallint, r smallint"
    out = mapping.classify(spark.createDataFrame(cells + small, schema), areas, colors.color_map(spark), ["area_id", "shp_version"]).collect()
    assert {r.classification for r in out} == {"soil_survey_ph"}  # the one-pixel image has the wrong size
    assert {r.label: (r.n_pixels, r.share) for r in out} == {"ph6.6-7.3": (55, 0.5), "ph4.6-5.0": (55, 0.5)}
    assert abs(sum(r.class_m2 for r in out) - out[0].polygon_m2) < 1e-6


def test_requests_end_to_end(spark):
    wkt = "POLYGON ((120 23, 120.01 23, 120.01 23.01, 120 23.01, 120 23))"
    areas = spark.createDataFrame([
        ("K", "county", "K", "Kee County", None, wkt, "COUNTY_1140318"), ("K01", "town", "K", None, "North", wkt, "TOWN_1140318"),
        ("K02", "town", "K", None, None, wkt, "TOWN_1140318"), ("K03", "town", "K", None, "Old", wkt, "TOWN_1130101"),
    ], "area_id string, area_level string, COUNTYID string, COUNTYENG string, TOWNENG string, geometry string, shp_version string")
    layers = spark.createDataFrame([(1, "ph", "https://e.com/w?bbox=1&STYLES=&a=1"), (2, "slope", "https://e.com/w?a=2")], "layer_no int, name_en string, map_url string")
    plan = mapping.requests(areas, layers, "1140318").collect()
    assert sorted((r.layer_no, r.area_id, r.region_name) for r in plan) == [
        (1, "K", "Kee_County"), (1, "K01", "Kee_County_North"), (2, "K", "Kee_County"), (2, "K01", "Kee_County_North")]
    assert {r.request_url for r in plan if r.layer_no == 1} == {"https://e.com/w?a=1&BBOX=120.0%2C23.0%2C120.01%2C23.01&WIDTH=10&HEIGHT=11"}
    rest = mapping.requests(areas, layers, "1140318", done=(1, "K")).collect()
    assert sorted((r.layer_no, r.area_id) for r in rest) == [(1, "K01"), (2, "K"), (2, "K01")]


def test_training_modes(spark):
    features = spark.createDataFrame([("A", 10, "x"), ("B", 20, "y"), ("C", 30, None)], "area_id string, cover int, soil string")
    detail = spark.createDataFrame([("A", 2020, 1.0), ("A", 2021, 3.0), ("B", 2020, 5.0), ("B", 2021, 4.0), (None, None, None)], "town_id string, year int, amount double")
    plan = TrainingPlan(summary={"amount": ["sum", "median"]}, missing={"amount_median": "median", "amount_sum": "zero"}, onehot={"soil": ["x", "y"]},
                        labels=["area_id"], scaled=["amount_sum"], method="minmax", trend=("year", "amount"))
    first = run(features, detail, plan, "preprocess")
    whole = {r.area_id: r for r in run(features, detail, plan).collect()}
    again = {r.area_id: r for r in run(first, detail, plan, "features").collect()}
    assert "slope" not in first.columns and whole == again
    assert (whole["A"].slope, whole["B"].slope, whole["C"].slope) == (2.0, -1.0, None)
    assert [whole[a].amount_sum for a in "ABC"] == [pytest.approx(4 / 9), 1.0, 0.0]
    assert whole["C"].amount_median == pytest.approx(3.25) and (whole["A"].soil_x, whole["A"].soil_y, whole["C"].soil_x) == (1, 0, 0)
    assert [whole[a].area_id_code for a in "ABC"] == [0, 1, 2]
    with pytest.raises(ValueError):
        run(features, detail, plan, "other")


def test_hp_trend(spark):
    years = list(range(2000, 2012))
    values = [float(v) for v in (3, 5, 4, 6, 8, 7, 9, 12, 10, 13, 15, 14)]
    rows = spark.createDataFrame([("A", y, v) for y, v in zip(years, values)] + [("B", 2000, 2.0), ("B", 2001, 4.0)], "county string, year int, v double")
    got = {(r.county, r.year): r.trend for r in stats.hp_trend(rows, "county", "year", "v", 10.0).collect()}
    trend = np.array([got["A", y] for y in years])
    cost = lambda t: np.sum((np.array(values) - t) ** 2) + 10 * np.sum(np.diff(t, 2) ** 2)
    rng = np.random.default_rng(0)
    assert all(cost(trend) <= cost(trend + rng.normal(0, 0.1, len(years))) for _ in range(50))
    assert (got["B", 2000], got["B", 2001]) == (2.0, 4.0)


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_folder(spark) == spark.sparkContext.getCheckpointDir()
