"""Masks, areas and ring checks against brute force."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldmosaic.functions.wkt import parse_polygon
from fieldmosaic.operators import colors, geometry, raster

W, H = 150, 90


def star(rng: random.Random, cx: float, cy: float, n: int, shuffle: bool = False) -> list[tuple[float, float]]:
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    if shuffle:
        rng.shuffle(angles)
    ring = [(cx + rng.uniform(0.2, 1) * math.cos(a), cy + rng.uniform(0.2, 1) * math.sin(a)) for a in angles]
    return ring + ring[:1]


def polygons(seed: int, count: int) -> list[tuple[str, list]]:
    rng, out = random.Random(seed), []
    for i in range(count):
        parts = [[star(rng, 120, 23, rng.randint(3, 14), i % 4 == 3)]]
        if i % 2:
            parts[0].append(star(rng, 120, 23, 5))
        if i % 3 == 0:
            parts.append([star(rng, 120.7, 23.3, 6)])  # overlaps the first part
        out.append((f"A{i}", parts))
    return out


def to_wkt(parts: list) -> str:
    ring = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")"
    return "MULTIPOLYGON (" + ", ".join("(" + ", ".join(map(ring, p)) + ")" for p in parts) + ")"


def frame(spark, shapes):
    rows = spark.createDataFrame([(a, to_wkt(p)) for a, p in shapes], "area_id string, geometry string")
    return rows.withColumn("parts", parse_polygon(F.col("geometry"))).withColumn("box", geometry.bbox(F.col("parts"))).withColumns(
        {"width": F.lit(W), "height": F.lit(H)}
    )


def brute_inside(parts, box, row, col) -> bool:
    minx, miny, maxx, maxy = box
    to_px = lambda x, y: ((x - minx) * W / (maxx - minx), (maxy - y) * H / (maxy - miny))
    for part in parts:
        n = 0
        for ring in part:
            for (xa, ya), (xb, yb) in zip(ring, ring[1:]):
                (x1, y1), (x2, y2) = to_px(xa, ya), to_px(xb, yb)
                if min(y1, y2) <= row + 0.5 < max(y1, y2):
                    n += x1 + (row + 0.5 - y1) * (x2 - x1) / (y2 - y1) > col + 0.5
        if n % 2:
            return True
    return False


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 32)])
def test_mask_equals_point_in_polygon(spark, monkeypatch, seed, block):
    monkeypatch.setattr(geometry, "BLOCK", block)
    shapes = polygons(seed, 6)
    areas = frame(spark, shapes)
    boxes = {r.area_id: tuple(r.box) for r in areas.select("area_id", "box").collect()}
    grid = spark.range(W * H).select((F.col("id") / W).cast("int").alias("row"), (F.col("id") % W).cast("int").alias("col"))
    pixels = areas.select("area_id", F.explode(F.sequence(F.lit(0), F.lit(0))).alias("_")).drop("_").join(grid, F.lit(True))
    got = geometry.with_inside(pixels, geometry.mask_spans(areas, ["area_id"]), ["area_id"]).collect()
    by_area = dict(shapes)
    assert len(got) == W * H * len(shapes)
    wrong = [r for r in got if r.inside != brute_inside(by_area[r.area_id], boxes[r.area_id], r.row, r.col)]
    assert not wrong


def test_mask_fills_black_and_keeps_size(spark):
    areas = frame(spark, [("A", [[[(120, 23), (121, 23), (121, 24), (120, 24), (120, 23)]]])]).withColumns({"width": F.lit(2), "height": F.lit(2)})
    cells = [("A", "v", "soil_survey_ph", r, c, 1, 254, 3) for r in range(3) for c in range(3)]
    pixels = spark.createDataFrame(cells, "area_id string, shp_version string, classification string, row int, col int, b smallint, g smallint, r smallint")
    out = raster.apply_mask(pixels, areas, ["area_id"]).collect()
    assert len(out) == 9
    assert {(r.row, r.col) for r in out if r.inside} == {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert all((r.b, r.g, r.r) == ((1, 254, 3) if r.inside else (0, 0, 0)) for r in out)
    stored = geometry.mask_spans(areas, ["area_id"])
    assert sorted(map(tuple, raster.apply_mask(pixels, areas, ["area_id"], stored).collect())) == sorted(map(tuple, out))


def proper_crossing(ring) -> bool:
    turn = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
    sides = list(zip(ring, ring[1:]))
    return any(
        turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0
        for i, (a, b) in enumerate(sides) for c, d in sides[i + 1:]
    )


def test_crossing_rings_equals_pairwise_test(spark):
    rng = random.Random(5)
    shapes = [(f"R{i}", [[star(rng, 120, 23, rng.randint(4, 9), i % 2 == 1)]]) for i in range(40)]
    got = {r.area_id for r in geometry.crossing_rings(frame(spark, shapes), ["area_id"]).collect()}
    assert got == {a for a, p in shapes if proper_crossing(p[0][0])}
    assert 5 < len(got) < 40


def test_ring_checks(spark):
    shapes = [
        ("open", [[[(0, 0), (1, 0), (1, 1)]]]), ("line", [[[(0, 0), (1, 0), (2, 0), (0, 0)]]]),
        ("twice", [[[(0, 0), (0, 0), (1, 0), (1, 1), (0, 0)]]]), ("short", [[[(0, 0), (1, 0), (0, 0)]]]),
        ("bow", [[[(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)]]]),
    ]
    got = {r.area_id: r for r in geometry.validate_rings(frame(spark, shapes), ["area_id"]).collect()}
    assert got["open"].is_open and not got["twice"].is_open
    assert got["line"].zero_area and got["bow"].zero_area and not got["open"].zero_area
    assert got["twice"].n_repeated == 1 and got["open"].n_repeated == 0
    assert got["short"].too_few and not got["twice"].too_few
    assert {a for a, r in got.items() if r.self_crossing} == {"bow"}


def test_area_of_a_box(spark):
    box = [(121, 23), (121.01, 23), (121.01, 23.01), (121, 23.01), (121, 23)]
    hole = [(121.002, 23.002), (121.004, 23.002), (121.004, 23.004), (121.002, 23.004), (121.002, 23.002)]
    areas = frame(spark, [("full", [[box]]), ("hole", [[box, hole]])])
    got = {r.area_id: r.m2 for r in areas.select("area_id", geometry.polygon_area(F.col("parts")).alias("m2")).collect()}
    side_x, side_y = 1025.1, 1107.5  # 0.01 degree near 23 N in metres, scale 0.9999
    assert abs(got["full"] / (side_x * side_y) - 1) < 2e-3
    assert abs(got["hole"] / got["full"] - 0.96) < 1e-4


def test_classes_group_by_label_and_count_unmapped(spark):
    def pixel(i, bgr):
        return ("A", "v", "soil_survey_texture_0_30cm", i, 0, *bgr)

    colours = [(97, 249, 11), (97, 249, 12), (1, 2, 3), (255, 255, 255), (254, 254, 254), (253, 255, 255), (0, 0, 0)]
    pixels = spark.createDataFrame([pixel(i, c) for i, c in enumerate(colours)],
                                   "area_id string, shp_version string, classification string, row int, col int, b smallint, g smallint, r smallint")
    classes = raster.quantify_classes(pixels, colors.color_map(spark))
    assert {r.label: r.n_pixels for r in classes.collect()} == {"loam": 2, "unmapped": 2}
    assert abs(sum(r.share for r in raster.class_share(classes).collect()) - 1) < 1e-12
    texture = raster.class_features(classes, colors.color_map(spark)).first()
    assert (round(texture.sand, 6), round(texture.silt, 6), round(texture.clay, 6)) == (0.4, 0.4, 0.2)
