"""Geometry as plain columns: points are ``struct<x,y>``, a ring is ``array<struct<x,y>>``.

A polygon is an array of rings (holes after the shell), a multi-polygon an array of polygons.
Everything here is a column expression, so the work stays in the JVM.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F

from canopy.functions.scalars import ColumnLike, col

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
MULTI = f"array<array<{RING}>>"

# GRS80 ellipsoid and UTM zone 33.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE = 0.9996
CENTRAL_MERIDIAN = 15.0
FALSE_EASTING = 500000.0


def point(x: ColumnLike, y: ColumnLike) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Closed ring of an axis-parallel box."""
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1), point(x0, y0))


def edges(ring: ColumnLike) -> Column:
    """Consecutive vertex pairs ``(x1, y1, x2, y2)`` of a closed ring."""
    ring = col(ring)
    return F.transform(
        F.sequence(F.lit(1), F.size(ring) - 1),
        lambda i: F.struct(ring[i - 1]["x"].alias("x1"), ring[i - 1]["y"].alias("y1"),
                           ring[i]["x"].alias("x2"), ring[i]["y"].alias("y2")))


def polygon_edges(rings: ColumnLike) -> Column:
    return F.flatten(F.transform(col(rings), edges))


def multi_edges(multi: ColumnLike) -> Column:
    return F.flatten(F.transform(col(multi), polygon_edges))


def bbox(edge_list: ColumnLike) -> Column:
    e = col(edge_list)

    def pick(f: Callable, field: str) -> Column:
        return f(F.transform(e, lambda s: s[field]))

    return F.struct(pick(F.array_min, "x1").alias("x0"), pick(F.array_min, "y1").alias("y0"),
                    pick(F.array_max, "x1").alias("x1"), pick(F.array_max, "y1").alias("y1"))


def _turn(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def turn(e: Column, x: Column, y: Column) -> Column:
    """Positive left of the edge, negative right of it, 0 on its line."""
    return _turn(e["x1"], e["y1"], e["x2"], e["y2"], x, y)


def on_edge(e: Column, x: Column, y: Column) -> Column:
    straight = _turn(e["x1"], e["y1"], e["x2"], e["y2"], x, y) == 0
    return (straight & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))


def contains(edge_list: ColumnLike, x: ColumnLike, y: ColumnLike) -> Column:
    """Strictly inside by the even-odd rule over all edges, so holes and parts need no extra case.

    A point on an edge is outside.
    """
    edge_list, x, y = col(edge_list), col(x), col(y)

    def flip(inside: Column, e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        meets = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return inside != (spans & F.coalesce(meets > x, F.lit(False)))

    inside = F.aggregate(edge_list, F.lit(False), flip)
    return inside & ~F.exists(edge_list, lambda e: on_edge(e, x, y))


def _cross(a: Column, b: Column) -> Column:
    """Whether two segments share a point, touching included."""
    d1 = _turn(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    d2 = _turn(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    d3 = _turn(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    d4 = _turn(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])
    proper = (d1 * d2 < 0) & (d3 * d4 < 0)
    return (proper | on_edge(a, b["x1"], b["y1"]) | on_edge(a, b["x2"], b["y2"])
            | on_edge(b, a["x1"], a["y1"]) | on_edge(b, a["x2"], a["y2"]))


def intersects(a: ColumnLike, b: ColumnLike) -> Column:
    """Two shapes, given by their edges, share a point: an edge meets an edge, or one holds the other."""
    a, b = col(a), col(b)
    meets = F.exists(a, lambda ea: F.exists(b, lambda eb: _cross(ea, eb)))
    # The cheap test first: it settles every small shape inside a large one.
    return contains(b, a[0]["x1"], a[0]["y1"]) | meets | contains(a, b[0]["x1"], b[0]["y1"])


# --- projection -------------------------------------------------------------------------------
# Krueger's series for the transverse Mercator projection to the fourth order of the third
# flattening: well below a millimetre inside a zone.

_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Published coefficients of the series.
_FORWARD = [_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3 + 41 / 180 * _N**4,
            13 / 48 * _N**2 - 3 / 5 * _N**3 + 557 / 1440 * _N**4,
            61 / 240 * _N**3 - 103 / 140 * _N**4,
            49561 / 161280 * _N**4]
_BACKWARD = [_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3 - 1 / 360 * _N**4,
             1 / 48 * _N**2 + 1 / 15 * _N**3 - 437 / 1440 * _N**4,
             17 / 480 * _N**3 - 37 / 840 * _N**4,
             4397 / 161280 * _N**4]
_GEODETIC = [2 * _N - 2 / 3 * _N**2 - 2 * _N**3 + 116 / 45 * _N**4,
             7 / 3 * _N**2 - 8 / 5 * _N**3 - 227 / 45 * _N**4,
             56 / 15 * _N**3 - 136 / 35 * _N**4,
             4279 / 630 * _N**4]
_ECC = 2 * math.sqrt(_N) / (1 + _N)


def to_utm33(lon: ColumnLike, lat: ColumnLike) -> Column:
    """ETRS89 / UTM zone 33 easting and northing of a WGS84 longitude and latitude."""
    lam = F.radians(col(lon) - CENTRAL_MERIDIAN)
    sin_phi = F.sin(F.radians(col(lat)))
    t = F.sinh(F.atanh(sin_phi) - _ECC * F.atanh(_ECC * sin_phi))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_FORWARD, start=1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return point(FALSE_EASTING + SCALE * _RECTIFYING * east, SCALE * _RECTIFYING * north)


def to_wgs84(east: ColumnLike, north: ColumnLike) -> Column:
    """WGS84 longitude and latitude of an ETRS89 / UTM zone 33 easting and northing."""
    xi = col(north) / (SCALE * _RECTIFYING)
    eta = (col(east) - FALSE_EASTING) / (SCALE * _RECTIFYING)
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BACKWARD, start=1):
        xi0 = xi0 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta0 = eta0 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    lat = chi
    for j, d in enumerate(_GEODETIC, start=1):
        lat = lat + d * F.sin(2 * j * chi)
    lon = F.atan2(F.sinh(eta0), F.cos(xi0))
    return point(CENTRAL_MERIDIAN + F.degrees(lon), F.degrees(lat))


def ring_to_wgs84(ring: ColumnLike) -> Column:
    return F.transform(col(ring), lambda p: to_wgs84(p["x"], p["y"]))


def multi_to_wgs84(multi: ColumnLike) -> Column:
    return F.transform(col(multi), lambda polygon: F.transform(polygon, ring_to_wgs84))
