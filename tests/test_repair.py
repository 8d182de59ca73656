"""Crossing pairs and rebuilt rings against brute force."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from fieldmosaic.functions.wkt import parse_polygon
from fieldmosaic.operators import crossings, geometry, repair

RING = ["k", "part", "ring"]


def polygons(spark, rings):
    """One area per list of points."""
    texts = [(k, "POLYGON ((" + ", ".join(f"{x!r} {y!r}" for x, y in [*points, points[0]]) + "))") for k, points in enumerate(rings)]
    return spark.createDataFrame(texts, "k long, wkt string").select("k", parse_polygon(F.col("wkt")).alias("parts"))


def random_rings(seed, sizes):
    rng = random.Random(seed)
    return [[(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(n)] for n in sizes]


def side(a, b, c):
    return (c[0] - a[0]) * (b[1] - a[1]) - (c[1] - a[1]) * (b[0] - a[0])


def brute_pairs(points):
    lines = list(zip(points, [*points[1:], points[0]]))
    return {(i, j) for (i, (a, b)), (j, (c, d)) in itertools.combinations(enumerate(lines), 2) if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0}


def signed(points):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, [*points[1:], points[0]])) / 2


def odd_even_area(points, rows=4000):
    """By scan lines."""
    ys = [y for _, y in points]
    low, high, total = min(ys), max(ys), 0.0
    for k in range(rows):
        y = low + (k + 0.5) * (high - low) / rows
        xs = sorted(a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(points, [*points[1:], points[0]]) if (a[1] <= y) != (b[1] <= y))
        total += sum(q - p for p, q in zip(xs[::2], xs[1::2])) * (high - low) / rows
    return total


@pytest.mark.parametrize("full", [3, 32])
def test_pairs_match_brute_force(spark, full):
    rings = random_rings(31, [3, 4, 5, 9, 40, 60])
    lines = geometry.edges(polygons(spark, rings), ["k"])
    got = {}
    for r in crossings.crossing_pairs(lines, RING, full).collect():
        got.setdefault(r.k, set()).add((r.seq, r.other))
    assert got == {k: brute_pairs(points) for k, points in enumerate(rings) if brute_pairs(points)}


def test_cells_of_a_zigzag(spark):
    """20,000 long thin teeth: few rows per segment, few segments per cell."""
    teeth = [(k / 1000, 10.0 * (k % 2)) for k in range(20_000)]
    lines = spark.createDataFrame([(k, *a, *b) for k, (a, b) in enumerate(zip(teeth, [*teeth[1:], (25.0, -5.0)]))], "seq int, x1 double, y1 double, x2 double, y2 double")
    cells = crossings.segment_cells(lines.withColumns({"k": F.lit(1), "part": F.lit(0), "ring": F.lit(0)}), RING).cache()
    assert cells.count() < 20 * 20_000
    assert cells.groupBy("cell").count().agg(F.max("count")).first()[0] <= crossings.FULL


def test_rebuilt_rings_cover_the_same(spark):
    rings = [[(0, 0), (2, 2), (2, 0), (0, 2)], [(0, 0), (4, 0), (4, 4), (0, 4)], *random_rings(32, [5, 7, 12, 25])]
    areas = polygons(spark, rings)
    fixed = repair.repair_polygons(areas, ["k"])
    rows = {r.k: r for r in fixed.collect()}
    assert len(rows) == len(rings)
    for k, points in enumerate(rings):
        found = [[(p.x, p.y) for p in ring] for part in rows[k].parts for ring in part]
        assert rows[k].n_repaired == bool(brute_pairs(points))
        if rows[k].n_repaired:
            assert all(ring[0] == ring[-1] for ring in found)
            whole = sum(abs(signed([(p.x, p.y) for p in ring][:-1])) * (-1 if j else 1) for part in rows[k].parts for j, ring in enumerate(part))
            assert math.isclose(whole, sum(signed(r[:-1]) for r in found), rel_tol=1e-9)
            assert math.isclose(whole, odd_even_area(points), rel_tol=2e-3)
            for ring in found:
                corners = ring[:-1]
                assert len(corners) >= 3 and not {p for p in brute_pairs(corners) if near(corners, p)}
    assert [(p.x, p.y) for p in rows[1].parts[0][0]][:4] == rings[1]
    assert sorted(round(signed([(p.x, p.y) for p in part[0]][:-1]), 9) for part in rows[0].parts) == [1.0, 1.0]


def near(corners, pair):
    """Whether two segments cross by more than the rounding of a cut corner."""
    n = len(corners)
    (a, b), (c, d) = ((corners[i], corners[(i + 1) % n]) for i in pair)
    return min(abs(side(a, b, c)), abs(side(a, b, d)), abs(side(c, d, a)), abs(side(c, d, b))) > 1e-9


def test_nothing_to_repair(spark):
    empty = polygons(spark, [[(0, 0), (1, 0), (1, 1)]])
    assert repair.repair_polygons(empty.limit(0), ["k"]).collect() == []
    null = empty.withColumn("parts", F.when(F.col("k") > 5, F.col("parts")))
    row = repair.repair_polygons(null, ["k"]).first()
    assert row.parts is None and row.n_repaired == 0
