"""Coordinates: boxes, map offsets, and transverse Mercator to geographic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The box in which coordinates are believed (upper bounds excluded).
LATITUDES, LONGITUDES = (32.0, 40.0), (124.0, 132.0)


def in_box(latitude: Column, longitude: Column, south: Column, west: Column, north: Column, east: Column) -> Column:
    """Within a box, edges included."""
    return (latitude >= south) & (latitude <= north) & (longitude >= west) & (longitude <= east)


def is_believed(latitude: Column, longitude: Column) -> Column:
    return (latitude >= LATITUDES[0]) & (latitude < LATITUDES[1]) & (longitude >= LONGITUDES[0]) & (longitude < LONGITUDES[1])


def scaled_degrees(value: Column) -> Column:
    """Degrees of an integer text in units of 1e-7; null unless an integer."""
    return F.when(value.rlike(r"^-?[0-9]+$"), value.try_cast("bigint") / F.lit(1e7))


def latitude_below(latitude: Column, zoom: Column, pixels: Column) -> Column:
    """The latitude that lies so many pixels south at a Web-Mercator zoom with tiles of 256 pixels."""
    world = F.lit(256.0) * F.pow(F.lit(2.0), zoom)
    y = (0.5 - F.log(F.tan(F.lit(math.pi / 4) + F.radians(latitude) / 2)) / (2 * math.pi)) * world + pixels
    return F.degrees(2 * F.atan(F.exp((0.5 - y / world) * 2 * math.pi)) - math.pi / 2)


def _inverse_mercator(x: Column, y: Column, axis: float, flattening: float, lat0: float, lon0: float, scale: float, east: float, north: float) -> tuple[Column, Column]:
    """Geographic radians by the series of Snyder (1987), equations 8-17 to 8-25."""
    e2 = flattening * (2 - flattening)
    ep2 = e2 / (1 - e2)
    p0 = math.radians(lat0)
    arc = axis * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p0 - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p0) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p0) - 35 * e2**3 / 3072 * math.sin(6 * p0))
    mu = (arc + (y - north) / scale) / (axis * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    p1 = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu) + 1097 * e1**4 / 512 * F.sin(8 * mu)
    c1, t1, root = ep2 * F.pow(F.cos(p1), 2), F.pow(F.tan(p1), 2), 1 - e2 * F.pow(F.sin(p1), 2)
    n1, r1 = axis / F.sqrt(root), axis * (1 - e2) / F.pow(root, 1.5)
    d = (x - east) / (n1 * scale)
    lat = p1 - n1 * F.tan(p1) / r1 * (d * d / 2 - (5 + 3 * t1 + 10 * c1 - 4 * c1 * c1 - 9 * ep2) * F.pow(d, 4) / 24 + (61 + 90 * t1 + 298 * c1 + 45 * t1 * t1 - 252 * ep2 - 3 * c1 * c1) * F.pow(d, 6) / 720)
    lon = math.radians(lon0) + (d - (1 + 2 * t1 + c1) * F.pow(d, 3) / 6 + (5 - 2 * c1 + 28 * t1 - 3 * c1 * c1 + 8 * ep2 + 24 * t1 * t1) * F.pow(d, 5) / 120) / F.cos(p1)
    return lat, lon


# Bessel 1841, the central belt (38 N, 127 E, 200,000 m, 500,000 m), and the seven-parameter shift to WGS84.
BESSEL = (6377397.155, 1 / 299.1528128)
WGS84 = (6378137.0, 1 / 298.257223563)
BELT = (38.0, 127.0028902777778, 1.0, 200_000.0, 500_000.0)
SHIFT = (-115.80, 474.99, 674.11, 1.16, -2.31, -1.63, 6.43)
# End of fixed values.


def belt_to_degrees(x: Column, y: Column) -> Column:
    """Struct (latitude, longitude) on WGS84 of central-belt metres on Bessel 1841."""
    lat, lon = _inverse_mercator(x, y, *BESSEL, *BELT)
    e2 = BESSEL[1] * (2 - BESSEL[1])
    n = BESSEL[0] / F.sqrt(1 - e2 * F.pow(F.sin(lat), 2))
    gx, gy, gz = n * F.cos(lat) * F.cos(lon), n * F.cos(lat) * F.sin(lon), n * (1 - e2) * F.sin(lat)
    rx, ry, rz = (math.radians(s / 3600) for s in SHIFT[3:6])
    k = 1 + SHIFT[6] * 1e-6
    wx, wy, wz = SHIFT[0] + k * (gx - rz * gy + ry * gz), SHIFT[1] + k * (rz * gx + gy - rx * gz), SHIFT[2] + k * (-ry * gx + rx * gy + gz)
    w2 = WGS84[1] * (2 - WGS84[1])
    p, minor = F.sqrt(wx * wx + wy * wy), WGS84[0] * (1 - WGS84[1])
    t = F.atan2(wz * WGS84[0], p * minor)
    out_lat = F.atan2(wz + w2 / (1 - w2) * minor * F.pow(F.sin(t), 3), p - w2 * WGS84[0] * F.pow(F.cos(t), 3))
    return F.struct(F.degrees(out_lat).alias("latitude"), F.degrees(F.atan2(wy, wx)).alias("longitude"))
