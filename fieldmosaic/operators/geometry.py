"""Polygon tables: boxes, edges, scanline masks, areas and ring checks.

A polygon is one nested value per row (parts > rings > points). Everything that grows with
the raster is a table of edges or column spans that joins on equal keys.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmosaic.functions.geodesy import pixel_size, plane_xy
from fieldmosaic.functions.wkt import parse_polygon
from fieldmosaic.operators.crossings import crossing_pairs
from fieldmosaic.runtime import spread

BLOCK = 1024  # pixel columns per mask block


def bbox(parts: Column) -> Column:
    """struct<minx,miny,maxx,maxy> over all parts and rings."""
    points = F.flatten(F.flatten(parts))
    xs, ys = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return F.struct(
        F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
        F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"),
    )


def vertices(areas: DataFrame, keys: list[str], parts: str = "parts") -> DataFrame:
    """One row per vertex: keys, part, ring, seq, x, y (counted from 0)."""
    return (
        areas.select(*keys, F.posexplode(parts).alias("part", "_rings"))
        .select(*keys, "part", F.posexplode("_rings").alias("ring", "_points"))
        .select(*keys, "part", "ring", F.posexplode("_points").alias("seq", "_p"))
        .select(*keys, "part", "ring", "seq", "_p.x", "_p.y")
    )


def _segments(points: Column) -> Column:
    """Segments of a ring, with the closing one where the ring is open; zero-length ones are left out."""
    n = F.size(points)
    ends = F.transform(
        points,
        lambda p, i: F.struct(
            i.alias("seq"), p.x.alias("x1"), p.y.alias("y1"),
            F.element_at(points, (i + 1) % n + 1).x.alias("x2"), F.element_at(points, (i + 1) % n + 1).y.alias("y2"),
        ),
    )
    return F.filter(ends, lambda s: (s.x1 != s.x2) | (s.y1 != s.y2))


def edges(areas: DataFrame, keys: list[str], parts: str = "parts") -> DataFrame:
    """One row per ring segment: keys, part, ring, seq, x1, y1, x2, y2."""
    return (
        areas.select(*keys, F.posexplode(parts).alias("part", "_rings"))
        .select(*keys, "part", F.posexplode("_rings").alias("ring", "_points"))
        .select(*keys, "part", "ring", F.explode(_segments(F.col("_points"))).alias("_s"))
        .select(*keys, "part", "ring", "_s.*")
    )


def with_frame(areas: DataFrame, resolution: float = 100) -> DataFrame:
    """Add parts, box, width and height to areas that carry WKT in `geometry`."""
    framed = spread(areas).withColumn("parts", parse_polygon(F.col("geometry"))).withColumn("box", bbox(F.col("parts")))
    size = pixel_size(F.col("box"), resolution)
    return framed.withColumn("_size", size).select("*", "_size.width", "_size.height").drop("_size")


def pixel_lonlat(box: Column, width: Column, height: Column, row: Column, col: Column) -> Column:
    """Centre of a pixel in degrees."""
    lon = box.minx + (col + 0.5) * (box.maxx - box.minx) / width
    lat = box.maxy - (row + 0.5) * (box.maxy - box.miny) / height
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def crossings(areas: DataFrame, keys: list[str]) -> DataFrame:
    """Where the edges of each area cross the middles of its raster rows: keys, _w, part, row, x in pixels."""
    frame = ["_w", "_h", "_minx", "_maxy", "_dx", "_dy"]
    framed = spread(areas).where(F.col("parts").isNotNull()).select(
        *keys, "parts", F.col("width").alias("_w"), F.col("height").alias("_h"),
        F.col("box.minx").alias("_minx"), F.col("box.maxy").alias("_maxy"),
        (F.col("box.maxx") - F.col("box.minx")).alias("_dx"), (F.col("box.maxy") - F.col("box.miny")).alias("_dy"),
    )
    def px(x: str) -> Column:
        return F.try_divide((F.col(x) - F.col("_minx")) * F.col("_w"), F.col("_dx"))

    def py(y: str) -> Column:
        return F.try_divide((F.col("_maxy") - F.col(y)) * F.col("_h"), F.col("_dy"))

    lines = edges(framed, [*keys, *frame]).select(
        *keys, "part", px("x1").alias("x1"), py("y1").alias("y1"), px("x2").alias("x2"), py("y2").alias("y2"), "_w"
    )
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = lines.withColumn("r0", F.ceil(low - 0.5)).withColumn("r1", F.ceil(high - 0.5) - 1).where("r0 <= r1")
    return lines.withColumn("row", F.explode(F.sequence("r0", "r1"))).select(
        *keys, "_w", "part", F.col("row").cast("int").alias("row"),
        (F.col("x1") + (F.col("row") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x"),
    )


def mask_spans(areas: DataFrame, keys: list[str]) -> DataFrame:
    """Inside pixels of each area as column spans: keys, row, block, c0, c1 (inclusive).

    Needs parts, box, width and height. A pixel is inside where a ray to the right of its
    centre crosses the rings of any one part an odd number of times. Edges are cut into the
    pixel rows they cross and crossings of a row pair up into spans; spans of overlapping parts
    are merged and cut at block borders. All of it happens behind one shuffle on (keys, row).
    The spans of a block are apart from each other, so a pixel meets at most one of them and
    a block holds at most BLOCK / 2, whatever the polygon looks like.
    """
    along = Window.partitionBy(*keys, "part", "row").orderBy("x")
    spans = (
        crossings(areas, keys).repartition(*keys, "row")
        .withColumn("_n", F.row_number().over(along))
        .withColumn("_to", F.lead("x").over(along))
        .where("_n % 2 = 1 and _to is not null")
        .select(
            *keys, "row",
            F.greatest(F.lit(0), F.ceil(F.col("x") - 0.5)).cast("int").alias("c0"),
            F.least(F.col("_w") - 1, F.ceil(F.col("_to") - 0.5) - 1).cast("int").alias("c1"),
        )
        .where("c0 <= c1")
    )
    across = Window.partitionBy(*keys, "row").orderBy("c0", "c1")
    reach = F.max("c1").over(across.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce((F.col("c0") > F.col("_reach") + 1).cast("int"), F.lit(1))
    merged = (
        spans.withColumn("_reach", reach)
        .withColumn("_island", F.sum(starts).over(across))
        .groupBy(*keys, "row", "_island")
        .agg(F.min("c0").alias("c0"), F.max("c1").alias("c1"))
    )
    place = lambda c: F.floor(F.col(c) / BLOCK).cast("int")
    cut = merged.withColumn("block", F.explode(F.sequence(place("c0"), place("c1"))))
    return cut.select(
        *keys, "row", "block",
        F.greatest("c0", F.col("block") * BLOCK).alias("c0"), F.least("c1", (F.col("block") + 1) * BLOCK - 1).alias("c1"),
    )


def with_inside(pixels: DataFrame, mask: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels with a flag `inside`; one equi-join on area, row and column block.

    The planner's estimate of a mask ignores that polygons unfold into rows of spans, so the join
    is asked to shuffle: a mask grows with areas times raster rows and must never be broadcast.
    """
    spans = mask.withColumnsRenamed({c: f"_{c}" for c in [*keys, "row", "block", "c0", "c1"]})
    same = [F.col(k) == F.col(f"_{k}") for k in [*keys, "row"]]
    on = reduce(and_, [*same, F.floor(F.col("col") / BLOCK).cast("int") == F.col("_block"), F.col("col").between(F.col("_c0"), F.col("_c1"))])
    return pixels.join(spans.hint("shuffle_merge"), on, "left").select(*[pixels[c] for c in pixels.columns], F.col("_c0").isNotNull().alias("inside"))


def polygon_area(parts: Column) -> Column:
    """Area in square metres in the TWD97/TM2 plane: outer rings minus holes, over all parts."""
    def ring_area(points: Column) -> Column:
        flat = F.transform(points, lambda p: plane_xy(p.x, p.y))

        def shoelace(xy: Column) -> Column:
            n = F.size(xy)
            ox, oy = F.element_at(xy, 1).x, F.element_at(xy, 1).y
            terms = F.transform(
                F.sequence(F.lit(1), n),
                lambda i: (F.element_at(xy, i).x - ox) * (F.element_at(xy, i % n + 1).y - oy)
                - (F.element_at(xy, i % n + 1).x - ox) * (F.element_at(xy, i).y - oy),
            )
            return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2

        return F.element_at(F.transform(F.array(flat), shoelace), 1)

    def part_area(rings: Column) -> Column:
        sizes = F.transform(rings, ring_area)
        return 2 * F.element_at(sizes, 1) - F.aggregate(sizes, F.lit(0.0), lambda a, s: a + s)

    return F.aggregate(F.transform(parts, part_area), F.lit(0.0), lambda a, s: a + s)


def image_size_check(pixels: DataFrame, areas: DataFrame, image: list[str], keys: list[str], tolerance: int = 0) -> DataFrame:
    """Per image its size, the expected one, and whether they agree within the tolerance.

    `areas` carries width and height per key; an image without an area is not accepted.
    """
    sizes = pixels.groupBy(*image).agg((F.max("col") + 1).alias("actual_w"), (F.max("row") + 1).alias("actual_h"))
    expected = areas.select(*keys, F.col("width").alias("expected_w"), F.col("height").alias("expected_h"))
    close = (F.abs(F.col("actual_w") - F.col("expected_w")) <= tolerance) & (
        F.abs(F.col("actual_h") - F.col("expected_h")) <= tolerance
    )
    return sizes.join(expected, keys, "left").withColumn("accepted", F.coalesce(close, F.lit(False)))


def validate_rings(areas: DataFrame, keys: list[str]) -> DataFrame:
    """Per ring: point count, open, repeated vertices, too few points, zero area, self-crossing.

    The counts are taken on the ring as a nested value. Self-crossing is found over
    tables, see `crossing_pairs`.
    """
    rings = areas.select(*keys, F.posexplode("parts").alias("part", "_rings")).select(
        *keys, "part", F.posexplode("_rings").alias("ring", "_points")
    )
    points = F.col("_points")
    n = F.size(points)
    same = lambda a, b: (a.x == b.x) & (a.y == b.y)
    closed = same(F.element_at(points, 1), F.element_at(points, -1))
    repeats = F.size(F.filter(
        F.sequence(F.lit(1), n), lambda i: (i < n) & same(F.element_at(points, i), F.element_at(points, F.least(i + 1, n)))
    ))
    cross = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: (F.element_at(points, i).x - F.element_at(points, 1).x)
        * (F.element_at(points, i % n + 1).y - F.element_at(points, 1).y)
        - (F.element_at(points, i % n + 1).x - F.element_at(points, 1).x)
        * (F.element_at(points, i).y - F.element_at(points, 1).y),
    )
    twice = F.aggregate(cross, F.lit(0.0), lambda a, c: a + c)
    distinct = n - repeats + F.when(closed, 0).otherwise(1)
    checks = rings.select(
        *keys, "part", "ring", n.alias("n_points"), (~closed).alias("is_open"), repeats.alias("n_repeated"),
        (distinct < 4).alias("too_few"), (F.abs(twice) < 1e-15).alias("zero_area"),
    )
    ring_key = [*keys, "part", "ring"]
    crossing = crossing_rings(areas, keys).withColumn("self_crossing", F.lit(True))
    return checks.join(crossing, ring_key, "left").withColumn("self_crossing", F.coalesce("self_crossing", F.lit(False)))


def crossing_rings(areas: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the rings in which two segments properly cross."""
    ring = [*keys, "part", "ring"]
    return crossing_pairs(edges(spread(areas), keys), ring).select(*ring).distinct()
