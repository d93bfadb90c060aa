"""Well-known text read and written by column expressions; only the binary form is packed and unpacked in Arrow batches."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweave.geo import shapes

#: A geometry as its kind (1 points, 2 lines, 3 polygons), and its parts: rings of points, one ring for a point or a line.
PARTS = "struct<kind: int, parts: array<array<array<struct<x: double, y: double>>>>>"
_KINDS = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3}


def text_parts(text: Column) -> Column:
    """The parts of a text, of any of the six simple types, any case, spacing, with or without a leading SRID; further dimensions go.

    Null for null, for other types and for texts without the brackets of their type; an empty geometry has no parts. A number that is none becomes null.
    """
    tidy = F.regexp_replace(F.upper(F.trim(F.regexp_replace(text, r"(?i)^\s*SRID=\d+;", ""))), r"\s*([(),])\s*", "$1")
    name = F.regexp_extract(tidy, r"^(MULTI)?(POINT|LINESTRING|POLYGON)( ?Z?M?)(\(.*\)| ?EMPTY)$", 2)
    many = F.regexp_extract(tidy, r"^(MULTI)?", 1) == "MULTI"
    body = F.regexp_extract(tidy, r"^[A-Z ]*(\(.*\))$", 1)
    kind = F.coalesce(*[F.when(name == n, F.lit(k)) for n, k in _KINDS.items()])
    deep = F.when(name == "POLYGON", 2).otherwise(1) + many.cast("int")
    flat = F.when(many & (name == "POINT"), F.concat(F.lit("(("), F.replace(F.regexp_replace(body, r"[()]", ""), F.lit(","), F.lit("),(")), F.lit("))"))).otherwise(body)
    opened = F.substring(flat, deep + 1, F.length(flat) - 2 * deep)
    # Parts, then rings, then points, then numbers; a level that the type lacks is one of its own.
    part = F.when(many & (name == "POLYGON"), F.split(opened, r"\)\),\(\(")).when(many, F.split(opened, r"\),\(")).otherwise(F.array(opened))

    def point(p: Column) -> Column:
        xy = F.split(p, " +")
        return F.struct(F.get(xy, F.lit(0)).try_cast("double").alias("x"), F.get(xy, F.lit(1)).try_cast("double").alias("y"))

    ring = lambda r: F.transform(F.split(r, ","), point)
    parts = F.transform(part, lambda p: F.transform(F.split(p, r"\),\("), ring))
    none = F.lit(None).cast("array<array<array<struct<x: double, y: double>>>>")
    empty = F.array().cast("array<array<array<struct<x: double, y: double>>>>")
    found = F.when(name == "", none).when(body == "", empty).otherwise(parts)
    return F.when((name != "") & text.isNotNull(), F.struct(kind.alias("kind"), found.alias("parts")))


@cache
def _packed():
    def pack(shape: pa.Array) -> pa.Array:
        out = []
        for value in shape.to_pylist():
            if value is None or value["parts"] is None:
                out.append(None)
                continue
            kind = value["kind"]
            rings = [[np.array([(p["x"], p["y"]) for p in ring], np.float64) for ring in part] for part in value["parts"]]
            flat = [r for part in rings for r in part]
            out.append(shapes.write_wkb((kind, rings if kind == shapes.POLYGON else flat if kind == shapes.LINE else np.concatenate([*flat, np.empty((0, 2))]))))
        return pa.array(out, pa.binary())

    return F.arrow_udf(pack, "binary")


def from_text(text: Column) -> Column:
    """WKB of a well-known text; null for what ``text_parts`` gives null for."""
    return _packed()(text_parts(text))


@cache
def _unpacked():
    def unpack(geom: pa.Array) -> pa.Array:
        rows = []
        for raw in geom.to_pylist():
            shape = shapes.read_wkb(raw)
            if shape is None:
                rows.append({"kind": None, "parts": None})
                continue
            kind, own = shape
            rings = [[p[None]] for p in own] if kind == shapes.POINT else [[line] for line in own] if kind == shapes.LINE else own
            rows.append({"kind": kind, "parts": [[[{"x": x, "y": y} for x, y in ring.tolist()] for ring in part] for part in rings]})
        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
        return pa.array(rows, pa.struct([("kind", pa.int32()), ("parts", pa.list_(pa.list_(pa.list_(point))))]))

    return F.arrow_udf(unpack, PARTS)


def to_text(geom: Column) -> Column:
    """The well-known text of WKB: whole numbers without a point, one part as the single type, none as EMPTY; null for null."""
    shape = _unpacked()(geom)
    number = lambda v: F.regexp_replace(v.cast("string"), r"\.0$", "")
    bracket = lambda v, inner: F.concat(F.lit("("), F.array_join(F.transform(v, inner), ", "), F.lit(")"))
    point = lambda p: F.concat(number(p["x"]), F.lit(" "), number(p["y"]))
    ring = lambda r: bracket(r, point)
    name = F.element_at(F.array(*[F.lit(n) for n in _KINDS]), shape["kind"])
    polygon = shape["kind"] == 3
    one = F.when(polygon, bracket(shape["parts"][0], ring)).otherwise(ring(shape["parts"][0][0]))
    many = F.when(polygon, bracket(shape["parts"], lambda p: bracket(p, ring))).otherwise(bracket(shape["parts"], lambda p: ring(p[0])))
    size = F.size(shape["parts"])
    return F.when(size == 0, F.concat(name, F.lit(" EMPTY"))).when(size == 1, F.concat(name, F.lit(" "), one)).when(size > 1, F.concat(F.lit("MULTI"), name, F.lit(" "), many))
