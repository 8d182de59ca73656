"""Rings that cross themselves, rebuilt without crossings.

The odd-even rule decides what is inside, as in masks: segments are cut at their crossings and turned
so that the inside lies on their left; where several meet, a segment goes on to the first one
clockwise, and pointer doubling collects the closed walks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fieldmosaic.operators.crossings import crossing_pairs
from fieldmosaic.operators.geometry import edges
from fieldmosaic.operators.ranking import running_sum
from fieldmosaic.runtime import materialize, spread


def rebuilt_rings(areas: DataFrame, keys: list[str]) -> DataFrame:
    """Rings that cross themselves, rebuilt: keys, part, ring, piece, step, x, y, the corners of each new ring in order.

    The new rings of a ring do not cross; together they cover what lay inside the old one by the odd-even
    rule, counter-clockwise where they surround it and clockwise around holes. They may touch in
    corners. Rings without crossings are left out. Overlapping segments are not resolved.
    """
    ring = [*keys, "part", "ring"]
    lines = materialize(edges(spread(areas), keys).select(*ring, "seq", "x1", "y1", "x2", "y2"))
    pairs = materialize(crossing_pairs(lines, ring))
    lines = lines.join(pairs.select(*ring).distinct(), ring, "left_semi")
    along = F.when(F.abs(F.col("x2") - F.col("x1")) >= F.abs(F.col("y2") - F.col("y1")), F.try_divide(F.col("x") - F.col("x1"), F.col("x2") - F.col("x1"))).otherwise(F.try_divide(F.col("y") - F.col("y1"), F.col("y2") - F.col("y1")))
    spots = pairs.select(*ring, "seq", "x", "y").union(pairs.select(*ring, "other", "x", "y"))
    starts = lines.select(*ring, "seq", F.col("x1").alias("x"), F.col("y1").alias("y"), F.lit(0.0).alias("t"), F.lit(0).alias("flip"))
    starts = starts.union(spots.join(lines, [*ring, "seq"]).select(*ring, "seq", "x", "y", along.alias("t"), F.lit(1).alias("flip")))
    # every corner and crossing starts a piece, which ends where the next of the same segment starts, or the segment
    within = Window.partitionBy(*ring, "seq").orderBy("t")
    ends = starts.join(lines.select(*ring, "seq", "x2", "y2"), [*ring, "seq"])
    pieces = ends.select(*ring, "seq", "t", "flip", F.col("x").alias("ax"), F.col("y").alias("ay"), F.coalesce(F.lead("x").over(within), F.col("x2")).alias("bx"), F.coalesce(F.lead("y").over(within), F.col("y2")).alias("by"))
    pieces = running_sum(pieces, [*ring, "seq", "t"], "flip", "flips")
    pieces = materialize(pieces.withColumn("e", F.monotonically_increasing_id()))
    # the piece at the leftmost corner that points down most has the inside on its left if it starts there
    slope = lambda x, y, to_x, to_y: F.atan2(F.col(to_y) - F.col(y), F.col(to_x) - F.col(x))
    at = lambda x, y, to_x, to_y, left: F.struct(F.col(x).alias("x"), F.col(y).alias("y"), slope(x, y, to_x, to_y).alias("slope"), F.lit(left).alias("left"), F.col("flips").alias("flips"))
    corner = F.least(at("ax", "ay", "bx", "by", 1), at("bx", "by", "ax", "ay", 0))
    first = pieces.groupBy(*ring).agg(F.min(corner).alias("_f"))
    inside_left = (F.col("_f.left") + F.col("flips") - F.col("_f.flips")) % 2 != 0
    turned = pieces.join(first, ring).select(*ring, "e", *[F.when(inside_left, F.col(p)).otherwise(F.col(q)).alias(p) for p, q in (("ax", "bx"), ("ay", "by"), ("bx", "ax"), ("by", "ay"))])
    turned = materialize(turned)
    # around every corner, clockwise: what comes in goes on with the next that leaves
    comes = turned.select(*ring, F.col("bx").alias("x"), F.col("by").alias("y"), slope("bx", "by", "ax", "ay").alias("slope"), "e", F.lit(True).alias("comes"))
    leaves = turned.select(*ring, F.col("ax").alias("x"), F.col("ay").alias("y"), slope("ax", "ay", "bx", "by").alias("slope"), "e", F.lit(False).alias("comes"))
    around = Window.partitionBy(*ring, "x", "y").orderBy(F.desc("slope"))
    circle = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    linked = comes.union(leaves).withColumn("to", F.coalesce(F.lead("e").over(around), F.first("e").over(circle))).where("comes").select("e", "to")
    walks = _walks(linked)
    return turned.join(walks, "e").select(*ring, F.col("walk").alias("piece"), "step", F.col("ax").alias("x"), F.col("ay").alias("y"))


def _walks(linked: DataFrame) -> DataFrame:
    """(e, walk, step): the least member of the closed walk each `e` is on, and the number of steps from it.

    Pointer doubling: a round joins every pointer with the pointer of its end, so a walk of n takes log n rounds.
    """
    pointers = materialize(linked)
    known = pointers.select("e", "to", F.least("e", "to").alias("low"))
    while True:
        ahead = known.select(F.col("e").alias("to"), F.col("to").alias("_to"), F.col("low").alias("_low"))
        longer = materialize(known.join(ahead, "to").select("e", F.col("_to").alias("to"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("news")))
        known = longer.drop("news")
        if longer.where("news").isEmpty():
            break
    heads = known.select("e", F.col("low").alias("walk"))
    # steps to the least member from every other one; a pointer that has arrived stays
    left = pointers.join(heads, "e").select("e", "walk", "to", F.when(F.col("e") == F.col("walk"), 0).otherwise(1).cast("long").alias("n"), (F.col("e") == F.col("walk")).alias("there"))
    left = materialize(left.withColumn("to", F.when(F.col("there"), F.col("e")).otherwise(F.col("to"))))
    while not left.where("to <> walk").isEmpty():
        ahead = left.select(F.col("e").alias("to"), F.col("to").alias("_to"), F.col("n").alias("_n"))
        left = materialize(left.join(ahead, "to").select("e", "walk", F.col("_to").alias("to"), (F.col("n") + F.col("_n")).alias("n")))
    size = left.groupBy("walk").agg(F.count("*").alias("size"))
    return left.join(size, "walk").select("e", "walk", ((F.col("size") - F.col("n")) % F.col("size")).alias("step"))


POLYGONS = "array<array<array<struct<x:double,y:double>>>>"


def _corners(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in ring], float)


def _size(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T
    return abs(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2


def _holds(ring: np.ndarray, spot: np.ndarray) -> bool:
    a, b = ring, np.roll(ring, -1, axis=0)
    over = (a[:, 1] <= spot[1]) != (b[:, 1] <= spot[1])
    a, b = a[over], b[over]
    return bool(np.sum(a[:, 0] + (spot[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1]) > spot[0]) % 2)


def _assembled(parts, fixed) -> list:
    """The parts of an area with rebuilt rings in place of broken ones; every hole goes to the least ring that holds its first edge."""
    new: dict[tuple[int, int], list[np.ndarray]] = {}
    for f in fixed:
        new.setdefault((f["part"], f["ring"]), []).append(_corners(f["points"]))
    out = []
    for i, rings in enumerate(parts):
        outers, holes = [], []
        for j, ring in enumerate(rings):
            for piece in new.get((i, j), [_corners(ring)]):
                x, y = (piece - piece[0]).T
                clockwise = (i, j) in new and np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y) < 0
                (holes if (j > 0) != clockwise else outers).append(piece)
        outers = [[outer] for outer in sorted(outers, key=_size)]
        for hole in holes:
            spot = (hole[0] + hole[1]) / 2
            next((o for o in outers if _holds(o[0], spot)), outers[-1]).append(hole)
        out += [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in reversed(outers)]
    return out


def repair_polygons(areas: DataFrame, keys: list[str]) -> DataFrame:
    """Areas with `parts` in which no ring crosses itself, and `n_repaired`, the number of rings rebuilt.

    Rebuilt rings take the place of the ring they came from: those that surround something become parts, those around
    holes join the least part that holds them, as do the holes the part had. Only crossing rings are taken apart into
    rows; an area without any stays as it is, null parts stay null.
    """
    corners = rebuilt_rings(areas, keys)
    point = F.struct("step", F.struct("x", "y").alias("p"))
    ring = corners.groupBy(*keys, "part", "ring", "piece").agg(F.transform(F.array_sort(F.collect_list(point)), lambda s: s.p).alias("points"))
    ring = ring.withColumn("points", F.concat("points", F.slice("points", 1, 1)))
    fixed = ring.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "ring", "piece", "points"))).alias("_fixed"))
    fixed = fixed.withColumnsRenamed({k: f"_{k}" for k in keys})
    joined = areas.join(fixed, reduce(and_, [F.col(k) == F.col(f"_{k}") for k in keys]), "left")
    broken = F.col("_fixed").isNotNull()

    @F.arrow_udf(POLYGONS)
    def assembled(parts: pa.Array, fixed: pa.Array) -> pa.Array:
        return pa.array([None if f is None else _assembled(p, f) for p, f in zip(parts.to_pylist(), fixed.to_pylist())], parts.type)

    rebuilt = F.size(F.array_distinct(F.transform("_fixed", lambda f: F.struct(f.part, f.ring))))
    done = joined.withColumns({"_done": assembled(F.when(broken, F.col("parts")), F.col("_fixed")), "n_repaired": F.when(broken, rebuilt).otherwise(0)})
    return done.withColumn("parts", F.when(broken, F.col("_done")).otherwise(F.col("parts"))).drop("_fixed", "_done", *[f"_{k}" for k in keys])
