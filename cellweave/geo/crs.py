"""WGS 84 longitude and latitude to and from the British National Grid, as column arithmetic and for numpy.

The datum change is the published seven-parameter Helmert transformation, good to a few metres; the projection is
the Transverse Mercator series of the public guide to coordinate systems in Great Britain. One set of formulas
serves all: ``m`` is numpy, a data frame's columns, or SQL text, and ``m.keep`` names a value that is used again.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ellipsoids (semi-axes), the grid's origin and scale, and the Helmert parameters WGS 84 to OSGB 36.
WGS84 = (6378137.0, 6356752.314245)
AIRY = (6377563.396, 6356256.909)
SCALE, LAT0, LON0, E0, N0 = 0.9996012717, math.radians(49), math.radians(-2), 400000.0, -100000.0
SHIFT = (-446.448, 125.157, -542.060)
TURN = tuple(math.radians(x / 3600) for x in (-0.1502, -0.2470, -0.8421))
PPM = 20.4894e-6

_NUMPY = SimpleNamespace(sin=np.sin, cos=np.cos, tan=np.tan, sqrt=np.sqrt, atan2=np.arctan2, keep=lambda x: x)


class _Columns:
    """Values kept as further columns, so that no expression is repeated inside another."""

    sin, cos, tan, sqrt, atan2 = map(staticmethod, (F.sin, F.cos, F.tan, F.sqrt, F.atan2))

    def __init__(self, df: DataFrame):
        self.df, self.names = df, []

    def keep(self, value: Column) -> Column:
        self.names.append(f"kept_{len(self.names)}_")
        self.df = self.df.withColumn(self.names[-1], value)
        return F.col(self.names[-1])

    def done(self, **columns: Column) -> DataFrame:
        return self.df.withColumns(columns).drop(*self.names)


class _Text:
    """An SQL expression."""

    def __init__(self, text: str):
        self.text = text

    def __str__(self) -> str:
        return self.text


def _operator(sign: str):
    return lambda a, b: _Text(f"({a!s} {sign} {b!s})"), lambda a, b: _Text(f"({b!s} {sign} {a!s})")


for _name, _sign in (("add", "+"), ("sub", "-"), ("mul", "*"), ("truediv", "/")):
    _left, _right = _operator(_sign)
    setattr(_Text, f"__{_name}__", _left)
    setattr(_Text, f"__r{_name}__", _right)
_Text.__neg__ = lambda a: _Text(f"(-{a})")


class _Sql:
    """The formulas as nested queries over ``source``."""

    def __init__(self, source: str):
        self.query, self.n = f"SELECT * FROM {source}", 0
        for name in ("sin", "cos", "tan", "sqrt", "atan2"):
            setattr(self, name, lambda *x, name=name: _Text(f"{name}({', '.join(map(str, x))})"))

    def keep(self, value: _Text) -> _Text:
        self.n += 1
        self.query = f"SELECT *, {value} AS kept_{self.n}_ FROM ({self.query})"
        return _Text(f"kept_{self.n}_")


def _to_cartesian(m, lat, lon, axes):
    a, b = axes
    e2 = 1 - b * b / (a * a)
    nu = a / m.sqrt(1 - e2 * m.sin(lat) * m.sin(lat))
    nu = m.keep(nu)
    return nu * m.cos(lat) * m.cos(lon), nu * m.cos(lat) * m.sin(lon), nu * (1 - e2) * m.sin(lat)


def _to_geodetic(m, x, y, z, axes):
    """Latitude by a parametric first guess and one exact correction, which is below a micrometre near the surface."""
    a, b = axes
    e2, f2 = 1 - b * b / (a * a), a * a / (b * b) - 1
    p = m.keep(m.sqrt(x * x + y * y))
    t = m.keep(m.atan2(z * a, p * b))
    for _ in range(2):
        lat = m.keep(m.atan2(z + f2 * b * m.sin(t) * m.sin(t) * m.sin(t), p - e2 * a * m.cos(t) * m.cos(t) * m.cos(t)))
        t = m.keep(m.atan2(b * m.sin(lat), a * m.cos(lat)))
    return lat, m.atan2(y, x)


def _helmert(m, x, y, z, sign):
    (tx, ty, tz), (rx, ry, rz), s = SHIFT, TURN, PPM
    if sign > 0:
        x, y, z = m.keep(x), m.keep(y), m.keep(z)
        return tx + (1 + s) * x - rz * y + ry * z, ty + rz * x + (1 + s) * y - rx * z, tz - ry * x + rx * y + (1 + s) * z
    # The inverse of the small rotation and scale, exact to second order and corrected once.
    x, y, z = m.keep(x - tx), m.keep(y - ty), m.keep(z - tz)
    u, v, w = x, y, z
    for _ in range(3):
        u, v, w = map(m.keep, ((x + rz * v - ry * w) / (1 + s), (y - rz * u + rx * w) / (1 + s), (z + ry * u - rx * v) / (1 + s)))
    return u, v, w


def _arc(m, lat):
    a, b = AIRY
    n = (a - b) / (a + b)
    d, s = lat - LAT0, lat + LAT0
    return b * SCALE * ((1 + n + 1.25 * n**2 + 1.25 * n**3) * d - (3 * n + 3 * n**2 + 2.625 * n**3) * m.sin(d) * m.cos(s) + (1.875 * n**2 + 1.875 * n**3) * m.sin(2 * d) * m.cos(2 * s) - 35 / 24 * n**3 * m.sin(3 * d) * m.cos(3 * s))


def _radii(m, lat):
    a, b = AIRY
    e2 = 1 - b * b / (a * a)
    k = m.keep(1 - e2 * m.sin(lat) * m.sin(lat))
    nu = a * SCALE / m.sqrt(k)
    nu = m.keep(nu)
    return nu, m.keep(nu * (1 - e2) / k)


def _project(m, lat, lon):
    nu, rho = _radii(m, lat)
    eta2 = m.keep(nu / rho - 1)
    s, c, t = m.keep(m.sin(lat)), m.keep(m.cos(lat)), m.tan(lat)
    t2, d = m.keep(t * t), m.keep(lon - LON0)
    c3, c5 = c * c * c, c * c * c * c * c
    north = _arc(m, lat) + N0 + nu / 2 * s * c * d * d + nu / 24 * s * c3 * (5 - t2 + 9 * eta2) * d * d * d * d + nu / 720 * s * c5 * (61 - 58 * t2 + t2 * t2) * d * d * d * d * d * d
    east = E0 + nu * c * d + nu / 6 * c3 * (nu / rho - t2) * d * d * d + nu / 120 * c5 * (5 - 18 * t2 + t2 * t2 + 14 * eta2 - 58 * t2 * eta2) * d * d * d * d * d
    return east, north


def _unproject(m, east, north):
    a, _ = AIRY
    lat = m.keep((north - N0) / (a * SCALE) + LAT0)
    for _ in range(5):
        lat = m.keep(lat + (north - N0 - _arc(m, lat)) / (a * SCALE))
    nu, rho = _radii(m, lat)
    eta2, t, c = m.keep(nu / rho - 1), m.keep(m.tan(lat)), m.cos(lat)
    t2, d = m.keep(t * t), m.keep((east - E0) / nu)
    d2 = m.keep(d * d)
    lat = lat - t * nu / rho * d2 * (1 / 2 - d2 / 24 * (5 + 3 * t2 + eta2 - 9 * t2 * eta2) + d2 * d2 / 720 * (61 + 90 * t2 + 45 * t2 * t2))
    lon = LON0 + d / c * (1 - d2 / 6 * (nu / rho + 2 * t2) + d2 * d2 / 120 * (5 + 28 * t2 + 24 * t2 * t2) - d2 * d2 * d2 / 5040 * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2))
    return lat, lon


def _forward(m, lon, lat):
    lat, lon = m.keep(lat * (math.pi / 180)), m.keep(lon * (math.pi / 180))
    lat, lon = _to_geodetic(m, *map(m.keep, _helmert(m, *_to_cartesian(m, lat, lon, WGS84), 1)), AIRY)
    return _project(m, m.keep(lat), m.keep(lon))


def _inverse(m, east, north):
    lat, lon = map(m.keep, _unproject(m, east, north))
    lat, lon = _to_geodetic(m, *_helmert(m, *_to_cartesian(m, lat, lon, AIRY), -1), WGS84)
    return lon * (180 / math.pi), lat * (180 / math.pi)


def with_grid(df: DataFrame, lon: str, lat: str, east: str = "x", north: str = "y") -> DataFrame:
    """``df`` with easting and northing in metres; the arithmetic stays in generated code."""
    m = _Columns(df)
    e, n = _forward(m, F.col(lon), F.col(lat))
    return m.done(**{east: e, north: n})


def with_lonlat(df: DataFrame, east: str, north: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``df`` with longitude and latitude in degrees."""
    m = _Columns(df)
    x, y = _inverse(m, F.col(east), F.col(north))
    return m.done(**{lon: x, lat: y})


def grid_sql(source: str, lon: str, lat: str) -> tuple[str, str, str]:
    """(query, easting, northing) as SQL text over ``source``."""
    m = _Sql(source)
    e, n = _forward(m, _Text(lon), _Text(lat))
    return m.query, str(e), str(n)


def lonlat_sql(source: str, east: str, north: str) -> tuple[str, str, str]:
    m = _Sql(source)
    x, y = _inverse(m, _Text(east), _Text(north))
    return m.query, str(x), str(y)


def to_grid_np(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _forward(_NUMPY, np.asarray(lon, np.float64), np.asarray(lat, np.float64))


def to_lonlat_np(east: np.ndarray, north: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _inverse(_NUMPY, np.asarray(east, np.float64), np.asarray(north, np.float64))
