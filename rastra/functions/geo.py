"""Geometry as column expressions: boxes, distances, projections, GeoJSON."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from rastra.functions.algebra import col

#: Kilometres that count as a degree, in either direction (fixed value).
KM_PER_DEGREE = 111.0
#: Half the width of the web mercator world in metres.
MERCATOR_HALF = math.pi * 6378137.0


def boxes_meet(a: tuple, b: tuple) -> Column:
    """Whether two boxes ``(xmin, ymin, xmax, ymax)`` share a point."""
    a, b = [col(x) for x in a], [x if not isinstance(x, str) else F.col(x) for x in b]
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def distance2(x1, y1, x2, y2) -> Column:
    """Square of the planar distance."""
    dx, dy = col(x1) - col(x2), col(y1) - col(y2)
    return dx * dx + dy * dy


def box_distance2(x, y, xmin, ymin, xmax, ymax) -> Column:
    """Square of the distance from a point to a box, 0 inside."""
    zero = F.lit(0)
    dx = F.greatest(col(xmin) - col(x), zero, col(x) - col(xmax))
    dy = F.greatest(col(ymin) - col(y), zero, col(y) - col(ymax))
    return dx * dx + dy * dy


def in_buffer(dx: Column, dy: Column, r: Column, sides: int = 64) -> Column:
    """Whether an offset lies in the regular polygon inscribed in a circle, with a corner on the x axis."""
    wedge = 2 * math.pi / sides
    angle = F.pmod(F.atan2(dy, dx), F.lit(wedge)) - wedge / 2
    return F.sqrt(dx * dx + dy * dy) * F.cos(angle) <= r * math.cos(wedge / 2)


def box_iou(a: tuple, b: tuple) -> Column:
    """Intersection over union of two boxes; 0 if they don't overlap."""
    a, b = [col(x) for x in a], [col(x) for x in b]
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    both = (w * h).cast("double")
    either = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.coalesce(F.try_divide(both, either), F.lit(0.0))


def mercator_x(lon: Column | str) -> Column:
    return col(lon) * (MERCATOR_HALF / 180.0)


def mercator_y(lat: Column | str) -> Column:
    return F.ln(F.tan((col(lat) + 90.0) * (math.pi / 360.0))) * (MERCATOR_HALF / math.pi)


def mercator_lonlat(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    lon = col(x) * (180.0 / MERCATOR_HALF)
    lat = F.atan(F.exp(col(y) * (math.pi / MERCATOR_HALF))) * (360.0 / math.pi) - 90.0
    return lon, lat


def tile_bounds(z: int, x: int, y: int) -> tuple[float, float, float, float]:
    """Mercator bounds of a slippy map tile."""
    if not (0 <= x < 1 << z and 0 <= y < 1 << z):
        raise ValueError(f"no tile {z}/{x}/{y}")
    size = 2 * MERCATOR_HALF / (1 << z)
    return -MERCATOR_HALF + x * size, MERCATOR_HALF - (y + 1) * size, -MERCATOR_HALF + (x + 1) * size, MERCATOR_HALF - y * size


def tile_lonlat_bounds(z: int, x: int, y: int) -> tuple[float, float, float, float]:
    n = 1 << z
    lat = lambda k: math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * k / n))))
    return x / n * 360 - 180, lat(y + 1), (x + 1) / n * 360 - 180, lat(y)


def tile_position(lon: Column | str, lat: Column | str, z: int, x: int, y: int, extent: int = 4096) -> tuple[Column, Column]:
    """Integer position in a tile, y downwards."""
    n = float(1 << z)
    fx = (col(lon) + 180.0) / 360.0 * n - x
    turn = F.ln(F.tan((col(lat) + 90.0) * (math.pi / 360.0))) / math.pi
    fy = (F.lit(1.0) - turn) / 2.0 * n - y
    return F.floor(fx * extent).cast("int"), F.floor(fy * extent).cast("int")


def utm(lon: Column | str, lat: Column | str, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Easting and northing by the transverse Mercator series of third order (WGS84); northings of a southern zone start from 10,000 km."""
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    radius = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(col(lat)), F.radians(col(lon) - F.lit(zone * 6 - 183.0))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(c) * F.atanh(F.lit(c) * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.lit(500000.0) + 0.9996 * radius * east, F.lit(1e7 if south else 0.0) + 0.9996 * radius * north


def utm_lonlat(east: Column | str, north: Column | str, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Longitude and latitude of a place of a zone, by the inverse series of third order."""
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    radius = 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    xi, eta = (col(north) - (1e7 if south else 0.0)) / radius, (col(east) - 500000.0) / radius
    up, across = xi, eta
    for j, b in enumerate(beta, 1):
        up = up - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        across = across - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(up) / F.cosh(across))
    lat = chi
    for j, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * j * chi)
    return F.degrees(F.atan2(F.sinh(across), F.cos(up))) + F.lit(zone * 6 - 183.0), F.degrees(lat)


def point_feature(lon, lat, **properties: Column) -> Column:
    """GeoJSON Point feature as text."""
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("Point").alias("type"), F.array(col(lon), col(lat)).alias("coordinates")).alias("geometry"),
            F.struct(*[c.alias(k) for k, c in properties.items()]).alias("properties"),
        )
    )


def polygon_feature(rings: Column | str, **properties: Column) -> Column:
    """GeoJSON Polygon feature as text; ``rings`` is an array of arrays of ``(x, y)``."""
    points = F.transform(col(rings), lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"])))
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("Polygon").alias("type"), points.alias("coordinates")).alias("geometry"),
            F.struct(*[c.alias(k) for k, c in properties.items()]).alias("properties"),
        )
    )
