"""WGS84, Lambert-93 and Web Mercator, in closed form (Snyder 1987); degrees and metres."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

A = 6378137.0
F_GRS80 = 1 / 298.257222101
E = math.sqrt(2 * F_GRS80 - F_GRS80**2)
LON0, LAT0, LAT1, LAT2, EASTING, NORTHING = 3.0, 46.5, 49.0, 44.0, 700000.0, 6600000.0


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (E * math.sin(phi)) ** 2)


def _t(phi: float) -> float:
    s = E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (E / 2)


_P0, _P1, _P2 = (math.radians(x) for x in (LAT0, LAT1, LAT2))
N = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
C = _m(_P1) / (N * _t(_P1) ** N)
RHO0 = A * C * _t(_P0) ** N


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return A * F.radians(lon), A * F.log(F.tan(math.pi / 4 + F.radians(lat) / 2))


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / A), F.degrees(2 * F.atan(F.exp(y / A)) - math.pi / 2)


def lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = F.radians(lat)
    s = E * F.sin(phi)
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(E / 2))
    rho, theta = A * C * F.pow(t, F.lit(N)), N * F.radians(lon - LON0)
    return EASTING + rho * F.sin(theta), NORTHING + RHO0 - rho * F.cos(theta)


def from_lambert93(x: Column, y: Column, rounds: int = 6) -> tuple[Column, Column]:
    """Inverse by a fixed number of rounds (six leave less than 1e-7 units)."""
    dx, dy = x - EASTING, RHO0 - (y - NORTHING)
    t = F.pow(F.sqrt(dx * dx + dy * dy) / (A * C), F.lit(1 / N))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        s = E * F.sin(phi)
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(E / 2)))
    return LON0 + F.degrees(F.atan2(dx, dy) / N), F.degrees(phi)


def reproject(geom: Column, how) -> Column:
    """A geometry with every vertex taken through ``how`` (x, y) -> (x, y)."""

    def vertex(v: Column) -> Column:
        x, y = how(v["x"], v["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    parts = F.transform(geom["parts"], lambda p: F.transform(p, lambda r: F.transform(r, vertex)))
    return F.when(geom.isNotNull(), F.struct(geom["type"].alias("type"), parts.alias("parts")))
