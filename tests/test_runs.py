"""Run-length pixels against the pixel-wise mask."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from fieldmosaic.operators import geometry, raster, runs

IMAGE = ["area_id", "classification"]
PIXELS = "area_id string, classification string, row int, col int, b smallint, g smallint, r smallint"


def picture(spark, rng, width, height):
    """Lines of few colours, in order, as a decoded image gives them."""
    rows = [("a", "x", y, x, *((9, 9, 9) if (x // 40 + y) % 3 else (1, 2, y))) for y in range(height) for x in range(width)]
    odd = [("a", "x", None, None, 5, 5, 5), ("a", "x", 0, 0, 9, 9, 9), ("a", "x", 0, 0, 9, 9, 9), (None, "x", 1, 1, 5, 5, 5), ("far", "x", 1, 1, 5, 5, 5), ("a", "y", 1, 1, None, 5, 5)]
    return spark.createDataFrame(rows + rng.sample(odd, len(odd)), PIXELS)


def frame(spark, wkt, width, height):
    areas = geometry.with_frame(spark.createDataFrame([("a", wkt), ("none", None)], "area_id string, geometry string"))
    return areas.withColumn("width", F.lit(width)).withColumn("height", F.lit(height))


def unfolded(found):
    return sorted((place(r, c) for r in found.collect() for c in (range(r.first, r.last + 1) if r.first is not None else [None])), key=repr)


def place(r, col):
    return r.area_id, r.classification, r.row, col, r.b, r.g, r.r, r.inside


def test_clipped_runs_equal_masked_pixels(spark):
    rng = random.Random(21)
    points = [(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(11)]
    ring = ", ".join(f"{x} {y}" for x, y in [*points, points[0]])
    areas = frame(spark, f"MULTIPOLYGON ((({ring})), ((5 5, 39 5, 39 9, 5 9, 5 5)))", 1500, 12)  # crosses itself, parts overlap, two blocks
    pixels = picture(spark, rng, 1500, 12)
    folded = runs.pixel_runs(pixels, IMAGE)
    assert folded.agg(F.sum(runs.length())).first()[0] == pixels.count() and folded.count() < pixels.count() / 20
    masked = raster.apply_mask(pixels, areas, ["area_id"])
    want = sorted((place(r, r.col) for r in masked.collect()), key=repr)
    spans = geometry.mask_spans(areas, ["area_id"])
    assert unfolded(runs.blackened(runs.clip(folded, spans, ["area_id"]))) == want
    inside = runs.clip(folded, spans, ["area_id"], outside=False)
    assert unfolded(inside) == [w for w in want if w[-1]] and 1 < inside.count() < 600


def test_what_is_shuffled_are_runs(spark):
    pixels = picture(spark, random.Random(1), 300, 4)
    areas = frame(spark, "POLYGON ((0 0, 40 0, 40 40, 0 40, 0 0))", 300, 4)
    found = runs.clip(runs.pixel_runs(pixels, IMAGE), geometry.mask_spans(areas, ["area_id"]), ["area_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" in above and "Exchange" not in plan[plan.index("MapInArrow") : plan.index("MapInArrow") + 400].split("Scan")[0]


def test_no_pixels(spark):
    empty = picture(spark, random.Random(1), 1, 1).limit(0)
    areas = frame(spark, "POLYGON ((0 0, 40 0, 40 40, 0 40, 0 0))", 10, 10)
    assert runs.clip(runs.pixel_runs(empty, IMAGE), geometry.mask_spans(areas, ["area_id"]), ["area_id"]).collect() == []
