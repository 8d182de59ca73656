"""Polygons as WKT text and as nested rings: parts > rings > points."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _inner(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s(]+|[\s)]+$", "")


def _point(text: Column) -> Column:
    xy = F.split(F.trim(text), r"\s+")
    return F.struct(F.try_element_at(xy, F.lit(1)).try_cast("double").alias("x"), F.try_element_at(xy, F.lit(2)).try_cast("double").alias("y"))


def parse_polygon(wkt: Column) -> Column:
    """array<part: array<ring: array<struct<x,y>>>>; a single polygon becomes one part.

    Z and M values are left out. Text that is empty, EMPTY, no polygon or has a point that is no
    pair of numbers gives null; `wkt_problem` says which.
    """
    return F.when(wkt_problem(wkt).isNull(), _parse(wkt))


def wkt_problem(wkt: Column) -> Column:
    """Why a text is no usable polygon: missing, empty, not a polygon, bad coordinates; null if it is one."""
    number = r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?"
    point = rf"\s*{number}(\s+{number}){{1,3}}\s*"
    coordinates = F.regexp_replace(wkt, r"^\s*[A-Za-z]+(\s+[ZzMm]{1,2})?|[()]", "")
    broken = F.exists(F.split(coordinates, ","), lambda p: ~F.rlike(p, F.lit(f"^{point}$")))
    return (
        F.when(wkt.isNull() | (F.trim(wkt) == ""), "missing")
        .when(F.rlike(wkt, F.lit(r"(?i)^\s*(multi)?polygon(\s+[zm]{1,2})?\s+empty\s*$")), "empty")
        .when(~F.rlike(wkt, F.lit(r"(?i)^\s*(multi)?polygon(\s+[zm]{1,2})?\s*\(")), "not a polygon")
        .when(broken, "bad coordinates")
    )


def _parse(wkt: Column) -> Column:
    body = _inner(F.regexp_replace(wkt, r"^\s*[A-Za-z]+(\s+[ZzMm]{1,2})?\s*", ""))
    parts = F.split(body, r"\)\s*\)\s*,\s*\(\s*\(")
    return F.transform(
        parts,
        lambda part: F.transform(
            F.split(_inner(part), r"\)\s*,\s*\("),
            lambda ring: F.transform(F.split(_inner(ring), ","), _point),
        ),
    )


def write_multipolygon(rings: Column) -> Column:
    """Nested rings back to MULTIPOLYGON text."""
    def point(p: Column) -> Column:
        return F.concat_ws(" ", p.x.cast("string"), p.y.cast("string"))

    def ring(points: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(points, point), ", "), F.lit(")"))

    def part(inner: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(inner, ring), ", "), F.lit(")"))

    return F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform(rings, part), ", "), F.lit(")"))
