"""Features of a paged map service: the service is asked how many there are, and each page is a task's part."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cellweave.sources.parts import answer, planned, reads

AGENT = "cellweave/1.0 (place analytics)"
#: The service's field types by Spark's; all others are text.
FIELD_TYPES = {"esriFieldTypeOID": T.LongType(), "esriFieldTypeInteger": T.LongType(), "esriFieldTypeSmallInteger": T.LongType(), "esriFieldTypeBigInteger": T.LongType(), "esriFieldTypeDouble": T.DoubleType(), "esriFieldTypeSingle": T.DoubleType()}


def _ring(points: list) -> bytes:
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<2d", *p[:2]) for p in points)


def geojson_wkb(geometry: dict | None) -> bytes | None:
    """The WKB of a GeoJSON geometry; further dimensions go."""
    if not geometry:
        return None
    kind, at = geometry["type"], geometry["coordinates"]
    if kind == "Point":
        return struct.pack("<BI2d", 1, 1, *at[:2])
    if kind == "LineString":
        return struct.pack("<BI", 1, 2) + _ring(at)
    if kind == "Polygon":
        return struct.pack("<BII", 1, 3, len(at)) + b"".join(map(_ring, at))
    if kind in ("MultiPoint", "MultiLineString", "MultiPolygon"):
        parts = [geojson_wkb({"type": kind[5:], "coordinates": x}) for x in at]
        return struct.pack("<BII", 1, {"MultiPoint": 4, "MultiLineString": 5, "MultiPolygon": 6}[kind], len(parts)) + b"".join(parts)
    raise ValueError(f"geometry type {kind} is not supported")


@reads("features")
def _page(part: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    found = answer(part["url"], part["ask"], AGENT, part["timeout"])["features"]
    if len(found) != part["rows"]:
        raise OSError(f"{part['url']}: {len(found)} features from {part['ask']['resultOffset']} on where {part['rows']} were announced")
    cast = lambda v, t: v if v is None or not pa.types.is_string(t) else str(v)
    columns = {f.name: [geojson_wkb(x.get("geometry")) if f.name == "geom" else cast(x["properties"].get(f.name), f.type) for x in found] for f in schema}
    yield pa.RecordBatch.from_pydict(columns, schema)


def read_features(spark: SparkSession, url: str, page: int = 2000, reference: int = 27700, where: str = "1=1", timeout: int = 60) -> DataFrame:
    """All features of a service's layer (``url`` ends in ``/query``) with their fields and the geometry as WKB in ``geom``.

    Two small answers reach the driver: the layer's description and the number of features. Pages are as long as asked for or as the service allows, and
    ordered by the service's object id, so that none is read twice; a page of another length than announced is an error and read again by Spark's retry.
    """
    about = answer(url.removesuffix("/query"), {"f": "json"}, AGENT, timeout)
    count = answer(url, {"where": where, "returnCountOnly": "true", "f": "json"}, AGENT, timeout)["count"]
    step = min(page, about.get("maxRecordCount", page))
    key = about.get("objectIdField") or next(f["name"] for f in about["fields"] if f["type"] == "esriFieldTypeOID")
    schema = T.StructType([*[T.StructField(f["name"], FIELD_TYPES.get(f["type"], T.StringType())) for f in about["fields"]], T.StructField("geom", T.BinaryType())])
    ask = {"where": where, "outFields": "*", "outSR": reference, "f": "geojson", "orderByFields": key, "resultRecordCount": step}
    plan = [{"url": url, "ask": ask | {"resultOffset": at}, "rows": min(step, count - at), "timeout": timeout} for at in range(0, count, step)]
    return planned(spark, "features", plan, schema)
