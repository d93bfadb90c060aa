"""Spatial functions on WKB columns, as Arrow-batched UDFs. UDFs are made on first use, within a session."""

from __future__ import annotations

import struct
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.geo import batch, crs, hexgrid, shapes

BOX = "struct<xmin: double, ymin: double, xmax: double, ymax: double>"


def _series(n: int, kind: str, f):
    """A pandas UDF of ``n`` columns that gets whole batches."""

    def run(*columns: pd.Series) -> pd.Series:
        return pd.Series(f(*columns))

    def frame(*columns: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(f(*columns), columns=["xmin", "ymin", "xmax", "ymax"], dtype=np.float64)

    made = frame if kind.startswith("struct") else run
    made.__annotations__ = {"columns": pd.Series, "return": pd.DataFrame if made is frame else pd.Series}
    return F.pandas_udf(made, kind)


def _known(values: np.ndarray, *columns: pd.Series) -> np.ndarray:
    """The values, none where a column is null."""
    bad = np.logical_or.reduce([c.isna().to_numpy() for c in columns])
    if values.dtype == bool:
        values = values.astype(object)
    values[bad] = None if values.dtype == object else np.nan
    return values


def _pair(f):
    """Of two columns of shapes, each distinct one is read once."""

    def run(one: pd.Series, other: pd.Series) -> np.ndarray:
        (a, i), (b, j) = batch.unique(one), batch.unique(other)
        return _known(f(a, i, b, j), one, other)

    return run


def _ends(last: bool):
    def run(geom: pd.Series) -> list:
        b = batch.Batch(geom)
        has = b.start[:-1] < b.start[1:]
        xy = b.b[b.start[1:][has] - 1] if last else b.a[b.start[:-1][has]]
        out = [None] * b.n
        for k, p in zip(np.flatnonzero(has).tolist(), xy.tolist(), strict=True):
            out[k] = p
        return out

    return run


def _centroid(axis: int):
    def run(geom: pd.Series) -> np.ndarray:
        return np.array([np.nan if v is None or (c := shapes.centroid(shapes.read_wkb(v))) is None else c[axis] for v in geom], np.float64)

    return run


@cache
def _made() -> dict:
    one = batch.Batch
    return {
        "area": _series(1, "double", lambda g: _known(one(g).areas(), g)),
        "length": _series(1, "double", lambda g: _known(one(g).lengths(), g)),
        "box": _series(1, BOX, lambda g: one(g).boxes()),
        "centroid_x": _series(1, "double", _centroid(0)),
        "centroid_y": _series(1, "double", _centroid(1)),
        "start": _series(1, "array<double>", _ends(False)),
        "end": _series(1, "array<double>", _ends(True)),
        "intersects": _series(2, "boolean", _pair(lambda a, i, b, j: batch.distances(a, i, b, j) <= shapes.EPS)),
        "distance": _series(2, "double", _pair(batch.distances)),
        "overlap": _series(2, "double", _pair(batch.overlaps)),
        "to_grid": _series(1, "binary", lambda g: batch.mapped(g, crs.to_grid_np)),
        "to_lonlat": _series(1, "binary", lambda g: batch.mapped(g, crs.to_lonlat_np)),
        "n_rings": _series(1, "int", lambda g: np.bincount((b := one(g)).ring_row[b.kind[b.ring_row] == shapes.POLYGON], minlength=b.n)),
    }


def st_area(geom) -> Column:
    return _made()["area"](geom)


def st_length(geom) -> Column:
    return _made()["length"](geom)


def st_box(geom) -> Column:
    return _made()["box"](geom)


def st_centroid(geom) -> tuple[Column, Column]:
    return _made()["centroid_x"](geom), _made()["centroid_y"](geom)


def st_start(geom) -> Column:
    return _made()["start"](geom)


def st_end(geom) -> Column:
    return _made()["end"](geom)


def st_intersects(a, b) -> Column:
    return _made()["intersects"](a, b)


def st_distance(a, b) -> Column:
    return _made()["distance"](a, b)


def st_overlap(cell, geom) -> Column:
    """The area or length of ``geom`` within the convex ``cell``."""
    return _made()["overlap"](cell, geom)


@cache
def _contains():
    def contains(geom: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        polygons, which = batch.unique(geom)
        xy = np.stack([x.to_numpy(np.float64), y.to_numpy(np.float64)], axis=1)
        return pd.Series(_known(batch.contained(polygons, which, xy), geom, x, y))

    contains.__annotations__ = {"geom": pd.Series, "x": pd.Series, "y": pd.Series, "return": pd.Series}
    return F.pandas_udf(contains, "boolean")


def st_contains(geom, x, y) -> Column:
    """Whether a point lies strictly inside."""
    return _contains()(geom, x, y)


def st_to_grid(geom) -> Column:
    """Longitude and latitude to easting and northing, vertex by vertex."""
    return _made()["to_grid"](geom)


def st_to_lonlat(geom) -> Column:
    return _made()["to_lonlat"](geom)


def st_point(x: Column, y: Column) -> Column:
    """A point's WKB; null if a coordinate is null."""
    return _point()(x, y)


@cache
def _turned(forward: bool):
    def turn(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        x, y = (crs.to_grid_np if forward else crs.to_lonlat_np)(a.to_numpy(np.float64), b.to_numpy(np.float64))
        return pd.DataFrame({"a": x, "b": y}).replace(np.nan, None).astype(object)

    turn.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(turn, "a double, b double")


def with_grid(df: DataFrame, lon: str, lat: str, east: str, north: str) -> DataFrame:
    """``df`` with easting and northing, by one Arrow UDF.

    ``cellweave.geo.crs.with_grid`` does the same in generated code, but through some fifty named columns: below
    filters and joins Spark's inference of constraints over these takes very long, so extracts use this form.
    """
    return df.withColumn("at_", _turned(True)(lon, lat)).withColumns({east: F.col("at_.a"), north: F.col("at_.b")}).drop("at_")


def with_lonlat(df: DataFrame, east: str, north: str, lon: str, lat: str) -> DataFrame:
    return df.withColumn("at_", _turned(False)(east, north)).withColumns({lon: F.col("at_.a"), lat: F.col("at_.b")}).drop("at_")


def _written(n: int, head: bytes, order: tuple[int, ...]):
    """WKB of one layout from ``n`` columns of doubles."""

    def build(*columns: pd.Series) -> pd.Series:
        values = [c.to_numpy(np.float64) for c in columns]
        return pd.Series(batch.layout(head, *[values[k] for k in order]), dtype=object)

    build.__annotations__ = {"columns": pd.Series, "return": pd.Series}
    return F.pandas_udf(build, "binary")


@cache
def _point():
    return _written(2, struct.pack("<BI", 1, 1), (0, 1))


@cache
def _rectangle():
    return _written(4, struct.pack("<BIII", 1, 3, 1, 5), (0, 1, 2, 1, 2, 3, 0, 3, 0, 1))


@cache
def _line():
    return _written(4, struct.pack("<BII", 1, 2, 2), (0, 1, 2, 3))


def st_rectangle(xmin, ymin, xmax, ymax) -> Column:
    return _rectangle()(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in (xmin, ymin, xmax, ymax)])


@cache
def _polygon():
    def build(rings: pa.Array) -> pa.Array:
        flat = rings.flatten()
        points = flat.flatten()
        xy = np.stack([points.field(n).to_numpy(zero_copy_only=False) for n in "xy"], axis=1).astype("<f8").tobytes()
        ends = np.concatenate([[0], np.cumsum(flat.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64).tolist()
        out, at = [], 0
        for n in rings.value_lengths().to_pylist():
            if n is None:
                out.append(None)
                continue
            own = [struct.pack("<I", ends[j + 1] - ends[j]) + xy[16 * ends[j] : 16 * ends[j + 1]] for j in range(at, at + n)]
            out.append(struct.pack("<BII", 1, shapes.POLYGON, n) + b"".join(own))
            at += n
        return pa.array(out, pa.binary())

    return F.arrow_udf(build, "binary")


def st_polygon(rings: Column) -> Column:
    """A polygon from an array of closed rings, each an array of (x, y) structs of doubles."""
    return _polygon()(rings)


def st_rings(geom) -> Column:
    """The number of rings of a polygon's parts together."""
    return _made()["n_rings"](geom)


def st_line(x1, y1, x2, y2) -> Column:
    """A straight line between two points."""
    return _line()(x1, y1, x2, y2)


def _hex(cells: np.ndarray) -> list:
    return [f"{c:x}" if c else None for c in cells.tolist()]


def _ints(text: pd.Series) -> np.ndarray:
    return np.array([int(t, 16) if isinstance(t, str) else 0 for t in text], np.int64)


@cache
def _cell_of(res: int):
    def cell(lat: pd.Series, lng: pd.Series) -> pd.Series:
        return pd.Series(_hex(hexgrid.latlng_to_cell(lat.to_numpy(np.float64), lng.to_numpy(np.float64), res)), dtype=object)

    cell.__annotations__ = {"lat": pd.Series, "lng": pd.Series, "return": pd.Series}
    return F.pandas_udf(cell, "string")


def cell_of(lat, lng, res: int) -> Column:
    """The cell that holds a point, as 15 lower-case hex digits; latitude first."""
    return _cell_of(res)(lat, lng)


@cache
def _cell_boundary(on_grid: bool):
    def boundary(cell: pd.Series) -> pd.Series:
        rings = hexgrid.cell_boundary(_ints(cell))
        out = []
        for r in rings:
            if np.isnan(r).any():
                out.append(None)
            else:
                ring = np.stack(crs.to_grid_np(*r.T), axis=1) if on_grid else r
                out.append(shapes.write_wkb(shapes.polygon(ring)))
        return pd.Series(out, dtype=object)

    boundary.__annotations__ = {"cell": pd.Series, "return": pd.Series}
    return F.pandas_udf(boundary, "binary")


def cell_boundary(cell, on_grid: bool = False) -> Column:
    """The cell's polygon in degrees, or in metres of the national grid."""
    return _cell_boundary(on_grid)(cell)


@cache
def _cell_area():
    def area(cell: pd.Series) -> pd.Series:
        return pd.Series(hexgrid.cell_area(_ints(cell)))

    area.__annotations__ = {"cell": pd.Series, "return": pd.Series}
    return F.pandas_udf(area, "double")


def cell_area(cell) -> Column:
    """Spherical area in square metres."""
    return _cell_area()(cell)
