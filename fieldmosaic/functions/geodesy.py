"""Distances on the WGS84 ellipsoid and TWD97/TM2 plane coordinates as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from fieldmosaic.functions.binding import let

WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
WGS84_B = WGS84_A * (1 - WGS84_F)
STEPS = 12  # the longitude series settles in 3-5 rounds away from antipodes

GRS80_A, GRS80_F = 6378137.0, 1 / 298.257222101
TM_SCALE, TM_MERIDIAN, TM_EASTING = 0.9999, 121.0, 250000.0


def _reduced(lat: Column) -> tuple[Column, Column]:
    u = F.atan((1 - WGS84_F) * F.tan(F.radians(lat)))
    return F.sin(u), F.cos(u)


def geodesic_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Vincenty's inverse solution in kilometres, kept to the millimetre."""
    (su1, cu1), (su2, cu2) = _reduced(lat1), _reduced(lat2)
    start = F.struct(
        su1.alias("su1"), cu1.alias("cu1"), su2.alias("su2"), cu2.alias("cu2"),
        F.radians(lon2 - lon1).alias("dl"),
    )

    def sphere(p: Column, lam: Column) -> Column:
        cross = p.cu1 * p.su2 - p.su1 * p.cu2 * F.cos(lam)
        return F.struct(
            F.sqrt(F.pow(p.cu2 * F.sin(lam), F.lit(2)) + cross * cross).alias("sin_s"),
            (p.su1 * p.su2 + p.cu1 * p.cu2 * F.cos(lam)).alias("cos_s"),
            (p.cu1 * p.cu2 * F.sin(lam)).alias("num"),
        )

    def angles(p: Column, s: Column) -> Column:
        sin_a = F.coalesce(F.try_divide(s.num, s.sin_s), F.lit(0.0))
        cos2_a = 1 - sin_a * sin_a
        mid = s.cos_s - F.coalesce(F.try_divide(2 * p.su1 * p.su2, cos2_a), F.lit(0.0))
        return F.struct(
            s.sin_s.alias("sin_s"), s.cos_s.alias("cos_s"), F.atan2(s.sin_s, s.cos_s).alias("sigma"),
            sin_a.alias("sin_a"), cos2_a.alias("cos2_a"), mid.alias("mid"),
        )

    def next_lambda(p: Column, q: Column) -> Column:
        c = WGS84_F / 16 * q.cos2_a * (4 + WGS84_F * (4 - 3 * q.cos2_a))
        tail = q.mid + c * q.cos_s * (-1 + 2 * q.mid * q.mid)
        return p.dl + (1 - c) * WGS84_F * q.sin_a * (q.sigma + c * q.sin_s * tail)

    def arc(q: Column) -> Column:
        u2 = q.cos2_a * ((WGS84_A**2 - WGS84_B**2) / WGS84_B**2)
        big_a = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
        big_b = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
        m2 = q.mid * q.mid
        last = big_b / 6 * q.mid * (-3 + 4 * q.sin_s * q.sin_s) * (-3 + 4 * m2)
        delta = big_b * q.sin_s * (q.mid + big_b / 4 * (q.cos_s * (-1 + 2 * m2) - last))
        return F.round(WGS84_B * big_a * (q.sigma - delta) / 1000, 6)

    def solve(p: Column) -> Column:
        def step(lam: Column, _: Column) -> Column:
            return let(sphere(p, lam), lambda s: let(angles(p, s), lambda q: next_lambda(p, q)))

        settled = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), p.dl, step)
        return let(sphere(p, settled), lambda s: let(angles(p, s), arc))

    return let(start, solve)


def pixel_size(bbox: Column, resolution: float = 100) -> Column:
    """(width, height) in pixels of a bbox struct at a ground resolution in metres, at least 1.

    Measured along the two middle lines of the box and rounded half to even.
    """
    mid_lat, mid_lon = (bbox.miny + bbox.maxy) / 2, (bbox.minx + bbox.maxx) / 2
    across = geodesic_km(mid_lat, bbox.minx, mid_lat, bbox.maxx)
    along = geodesic_km(bbox.miny, mid_lon, bbox.maxy, mid_lon)
    sizes = [F.bround(km * 1000 / resolution).cast("int") for km in (across, along)]
    pixels = [F.when(size.isNotNull(), F.greatest(F.lit(1), size)) for size in sizes]  # no box, no size
    return F.struct(pixels[0].alias("width"), pixels[1].alias("height"))


def plane_xy(lon: Column, lat: Column) -> Column:
    """TWD97/TM2 (121°E) easting and northing in metres, by Krüger's series."""
    n = GRS80_F / (2 - GRS80_F)
    radius = GRS80_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    e = 2 * math.sqrt(n) / (1 + n)
    phi, dlon = F.radians(lat), F.radians(lon - TM_MERIDIAN)
    conformal = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    base = F.struct(
        F.atan2(conformal, F.cos(dlon)).alias("xi"),
        F.atanh(F.sin(dlon) / F.sqrt(1 + conformal * conformal)).alias("eta"),
    )

    def series(p: Column) -> Column:
        east, north = p.eta, p.xi
        for j, coefficient in enumerate(alpha, start=1):
            east = east + coefficient * F.cos(2 * j * p.xi) * F.sinh(2 * j * p.eta)
            north = north + coefficient * F.sin(2 * j * p.xi) * F.cosh(2 * j * p.eta)
        scale = TM_SCALE * radius
        return F.struct((TM_EASTING + scale * east).alias("x"), (scale * north).alias("y"))

    return let(base, series)
