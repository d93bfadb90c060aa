"""File sources: CSV (plain, zipped, by encoding), GeoPackage, shapefile, spreadsheet, JSON nodes, nested Parquet.

Spark lists the files. Those without a Spark reader are planned as parts (members, ranges of rows or records) that tasks open and read as streams.
"""

from __future__ import annotations

import fnmatch
import io
import itertools
import json
import re
import shutil
import sqlite3
import struct
import tempfile
import urllib.parse
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import closing
from functools import reduce
from xml.etree import ElementTree

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.geo import shapes
from cellweave.sources.parts import in_task, listed, members, opened, planned, reads
from cellweave.storage import written

_RESERVED = {"month", "date", "time", "order", "group", "select", "from", "where", "table", "user", "year", "day", "end", "start"}


def normalize_name(name: str) -> str:
    """Lower snake case; reserved words get a leading underscore."""
    tidy = re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")
    return f"_{tidy}" if tidy in _RESERVED or tidy[:1].isdigit() else tidy


def normalize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


#: The encodings that Spark's CSV reader takes, and what stands in Windows-1252 where ISO-8859-1 has control characters.
SPARK_CHARSETS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8")
C1_BYTES = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
#: Bytes of members or of a file that one task reads.
PART_BYTES = 64 << 20


def _text_csv(file, **options):
    return pd.read_csv(file, dtype=str, keep_default_na=False, na_values=[""], **options)


def read_csv_text(spark: SparkSession, path: str, encoding: str = "UTF-8", schema: T.StructType | None = None, multiline: bool = True) -> DataFrame:
    """A CSV with a header; all columns text unless a schema is given. Quotes are doubled inside quotes.

    With ``multiline`` cells may hold line feeds and a file is one task; without, files are split. Windows-1252 is read as ISO-8859-1, of which
    it differs in 27 characters only, and those are put right in the columns; other encodings that Spark lacks are an error.
    """
    windows = encoding.lower() in ("windows-1252", "cp1252")
    if not windows and encoding.lower() not in SPARK_CHARSETS:
        raise ValueError(f"encoding {encoding} is not supported")
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline).option("encoding", "ISO-8859-1" if windows else encoding)
    df = (reader.schema(schema) if schema else reader).csv(path)
    if not windows:
        return df
    wrong, right = C1_BYTES.decode("latin-1"), C1_BYTES.decode("cp1252")
    names = [n.translate(str.maketrans(wrong, right)) for n in df.columns]
    return df.select(*[(F.translate(F.col(f"`{f.name}`"), wrong, right) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(n) for f, n in zip(df.schema, names, strict=True)])


def read_zipped_csv(spark: SparkSession, archive: str, pattern: str) -> DataFrame:
    """All members of the zip files at ``archive`` whose names fit ``pattern``, as one table of text columns, names normalised.

    The columns are those of the first member's header; a member that lacks one gives nulls. Members go to tasks by the archives' directories,
    small ones together, and are parsed as streams, some thousand rows at a time.
    """
    files = listed(spark, archive)
    found = [json.loads(v) for v in in_task(spark, lambda: [json.dumps([a, m.filename, m.file_size]) for a, _ in files for m in members(a) if fnmatch.fnmatch(m.filename, pattern)])]
    if not found:
        raise FileNotFoundError(f"no member {pattern} in {archive}")
    found.sort()
    names = in_task(spark, lambda: _header(*found[0][:2]))
    plan: list[dict] = []
    size = PART_BYTES
    for address, member, more in found:
        if size + more > PART_BYTES or plan[-1]["address"] != address:
            plan.append({"address": address, "members": []})
            size = 0
        plan[-1]["members"].append(member)
        size += more
    return planned(spark, "zipped csv", plan, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def _header(address: str, member: str) -> list[str]:
    with opened(address) as file, zipfile.ZipFile(file) as z, z.open(member) as text:
        return [normalize_name(c) for c in pd.read_csv(text, nrows=0).columns]


@reads("zipped csv")
def _zipped_csv(part: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    with opened(part["address"]) as file, zipfile.ZipFile(file) as z:
        for member in part["members"]:
            with z.open(member) as text:
                for frame in _text_csv(text, chunksize=20_000):
                    frame.columns = [normalize_name(c) for c in frame.columns]
                    yield pa.RecordBatch.from_pandas(frame.reindex(columns=schema.names).astype(object), schema, preserve_index=False)


def _local(address: str, member: str | None, suffix: str):
    """A file that SQLite can open: the file itself in a folder, else a copy in the task's own temporary folder that goes with the task."""
    if member is None and (address.startswith("file:") or "://" not in address):
        return open("/" + address.removeprefix("file:").lstrip("/"), "rb")  # noqa: SIM115
    copy = tempfile.NamedTemporaryFile(suffix=suffix)
    with opened(address) as file:
        if member is None:
            shutil.copyfileobj(file, copy, 1 << 20)
        else:
            with zipfile.ZipFile(file) as z, z.open(member) as source:
                shutil.copyfileobj(source, copy, 1 << 20)
    copy.flush()
    return copy


_SQL_TYPES = (("INT", T.LongType()), ("BOOL", T.BooleanType()), ("REAL", T.DoubleType()), ("DOUB", T.DoubleType()), ("FLOA", T.DoubleType()))


def geopackage_wkb(blob: bytes | None) -> bytes | None:
    """The WKB of a GeoPackage geometry: what follows the header and its envelope."""
    if blob is None or blob[:2] != b"GP":
        return blob
    return bytes(blob[8 + (0, 32, 48, 48, 64)[(blob[3] >> 1) & 7] :])


def _layers(db: sqlite3.Connection) -> dict[str, str]:
    return dict(db.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY rowid"))


def _geopackage_of(address: str, size: int) -> tuple[str | None, int]:
    """(member, size): the first GeoPackage of a zip file, or the file itself."""
    if not zipfile.is_zipfile(file := opened(address)):
        return None, size
    with file:
        found = sorted((m.filename, m.file_size) for m in members(address) if m.filename.lower().endswith(".gpkg"))
    if not found:
        raise FileNotFoundError(f"no .gpkg member in {address}")
    return found[0]


def read_geopackage(spark: SparkSession, path: str, layer: str | None = None, part_bytes: int = PART_BYTES) -> DataFrame:
    """Features of one layer (default: the first) with the geometry as WKB in ``geom``; ``path`` may name zips and globs.

    A file of some size is read by several tasks, each a range of row ids. A member of a zip file is unpacked by each of its tasks into the
    task's temporary folder, so zipped ones are cut into fewer parts.
    """
    files = listed(spark, path)
    found = [json.loads(v) for v in in_task(spark, lambda: [json.dumps([a, *_geopackage_of(a, n)]) for a, n in files])]

    def describe() -> list[str]:
        address, member, _ = found[0]
        with _local(address, member, ".gpkg") as file, closing(sqlite3.connect(f"file:{urllib.parse.quote(file.name)}?mode=ro&immutable=1", uri=True)) as db:
            layers = _layers(db)
            table = layer or next(iter(layers))
            return [json.dumps([c[1], c[2].upper(), c[1] == layers[table]]) for c in db.execute(f'PRAGMA table_info("{table}")')]

    kind = lambda t: next((k for name, k in _SQL_TYPES if t.startswith(name)), T.StringType())
    schema = T.StructType([T.StructField("geom" if geo else name, T.BinaryType() if geo else kind(sql)) for name, sql, geo in map(json.loads, in_task(spark, describe))])
    plan = []
    for address, member, size in found:
        parts = max(1, -(-size // (part_bytes if member is None else 8 * part_bytes)))
        plan += [{"address": address, "member": member, "layer": layer, "part": k, "parts": parts} for k in range(parts)]
    return planned(spark, "geopackage", plan, schema)


@reads("geopackage")
def _geopackage(part: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    with _local(part["address"], part["member"], ".gpkg") as file, closing(sqlite3.connect(f"file:{urllib.parse.quote(file.name)}?mode=ro&immutable=1", uri=True)) as db:
        layers = _layers(db)
        table = part["layer"] or next(iter(layers))
        low, high = db.execute(f'SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) + 1 FROM "{table}"').fetchone()
        ends = [low + (high - low) * (part["part"] + k) // part["parts"] for k in (0, 1)]
        names = ", ".join(f'"{layers[table] if n == "geom" else n}"' for n in schema.names)
        cursor = db.execute(f'SELECT {names} FROM "{table}" WHERE rowid >= ? AND rowid < ?', ends)
        while found := cursor.fetchmany(10_000):
            columns = list(zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([_typed(c, f) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _typed(values: tuple, field: pa.Field) -> pa.Array:
    """A column of SQLite's values, which may be of any type, as the declared one."""
    if pa.types.is_binary(field.type):
        return pa.array(map(geopackage_wkb, values), field.type)
    to = str if pa.types.is_string(field.type) else bool if pa.types.is_boolean(field.type) else float if pa.types.is_floating(field.type) else int
    return pa.array([None if v is None else to(v) for v in values], field.type)


def read_geopackages(spark: SparkSession, paths: Sequence[str], layer: str | None = None) -> DataFrame:
    """The union of several GeoPackages by column name; none is an error."""
    if not paths:
        raise FileNotFoundError("no GeoPackage found")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [read_geopackage(spark, p, layer) for p in sorted(paths)])


def _dbf_fields(file, encoding: str) -> tuple[int, int, list[tuple[str, str, int]]]:
    """(bytes of the head, bytes of a record, fields) of a dBASE table; the head has been read then."""
    _, head, size = struct.unpack("<IHH", file.read(12)[4:])
    raw = file.read(head - 12)
    fields, at = [], 20
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(encoding), chr(raw[at + 11]), raw[at + 16]))
        at += 32
    return head, size, fields


def _dbf_row(raw: bytes, fields: list[tuple[str, str, int]], encoding: str) -> list:
    at, row = 1, []
    for _, kind, width in fields:
        text = raw[at : at + width].decode(encoding).strip()
        row.append(float(text) if kind in "NF" and text else text or None)
        at += width
    return row


def _shape_wkb(raw: bytes) -> bytes | None:
    """WKB of a shape record: points, lines, and polygons whose clockwise rings are outer ones."""
    (kind,) = struct.unpack_from("<I", raw)
    if kind % 10 == 1:
        return shapes.write_wkb((shapes.POINT, np.frombuffer(raw, "<f8", 2, 4).reshape(1, 2)))
    if kind % 10 not in (3, 5):
        return None
    parts, points = struct.unpack_from("<II", raw, 36)
    starts = [*struct.unpack_from(f"<{parts}I", raw, 44), points]
    xy = np.frombuffer(raw, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    rings = [xy[a:b] for a, b in itertools.pairwise(starts)]
    if kind % 10 == 3:
        return shapes.write_wkb((shapes.LINE, rings))
    polygons: list = []
    for ring in rings:
        if shapes._ring_sum(ring) <= 0 or not polygons:
            polygons.append([ring])
        else:
            polygons[-1].append(ring)
    return shapes.write_wkb((shapes.POLYGON, polygons))


def read_shapefile(spark: SparkSession, archive: str, member: str, encoding: str = "ISO-8859-1", part_bytes: int = PART_BYTES) -> DataFrame:
    """The shapefile in a zip whose path ends in ``member`` (``….shp``): text and number columns and ``geom``.

    Tasks take ranges of records; each streams through the archive's members to its own and holds a batch of records.
    """
    files = listed(spark, archive)

    def describe() -> list[str]:
        out = []
        for address, _ in files:
            name = next((m.filename for m in members(address) if m.filename.endswith(member)), None)
            if name is None:
                raise FileNotFoundError(f"{member} not found in the archive")
            with opened(address) as file, zipfile.ZipFile(file) as z, z.open(name[:-4] + ".dbf") as table:
                (rows,) = struct.unpack("<I", table.read(8)[4:])
                table.seek(0)
                out.append(json.dumps([address, name, rows, z.getinfo(name).file_size, [(n, k) for n, k, _ in _dbf_fields(table, encoding)[2]]]))
        return out

    found = [json.loads(v) for v in in_task(spark, describe)]
    schema = T.StructType([*[T.StructField(n, T.DoubleType() if k in "NF" else T.StringType()) for n, k in found[0][4]], T.StructField("geom", T.BinaryType())])
    plan = []
    for address, name, rows, size, _ in found:
        parts = max(1, -(-size // part_bytes))
        plan += [{"address": address, "member": name, "encoding": encoding, "first": rows * k // parts, "end": rows * (k + 1) // parts} for k in range(parts)]
    return planned(spark, "shapefile", plan, schema)


@reads("shapefile")
def _shapefile(part: dict, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    with opened(part["address"]) as file, opened(part["address"]) as again, zipfile.ZipFile(file) as z, zipfile.ZipFile(again) as y, z.open(part["member"]) as shp, y.open(part["member"][:-4] + ".dbf") as dbf:
        head, size, fields = _dbf_fields(dbf, part["encoding"])
        dbf.seek(head + part["first"] * size)
        shp.seek(100)
        for _ in range(part["first"]):
            shp.seek(2 * struct.unpack(">I", shp.read(8)[4:])[0], 1)
        rows: list = []
        for k in range(part["first"], part["end"]):
            rows.append((*_dbf_row(dbf.read(size), fields, part["encoding"]), _shape_wkb(shp.read(2 * struct.unpack(">I", shp.read(8)[4:])[0]))))
            if len(rows) == 5_000 or k + 1 == part["end"]:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                rows = []


_ODS = {"t": "{urn:oasis:names:tc:opendocument:xmlns:table:1.0}", "x": "{urn:oasis:names:tc:opendocument:xmlns:text:1.0}", "o": "{urn:oasis:names:tc:opendocument:xmlns:office:1.0}"}


def ods_rows(raw: bytes, sheet: str) -> Iterator[list]:
    """The rows of a sheet of an OpenDocument spreadsheet; numbers as floats, other cells as text, empty cells as None."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        root = ElementTree.fromstring(z.read("content.xml"))
    for table in root.iter(_ODS["t"] + "table"):
        if table.get(_ODS["t"] + "name") != sheet:
            continue
        for line in table.iter(_ODS["t"] + "table-row"):
            row: list = []
            for cell in line:
                if cell.tag not in (_ODS["t"] + "table-cell", _ODS["t"] + "covered-table-cell"):
                    continue
                number = cell.get(_ODS["o"] + "value")
                text = "\n".join("".join(p.itertext()) for p in cell.iter(_ODS["x"] + "p"))
                value = float(number) if number is not None else text or None
                row += [value] * min(int(cell.get(_ODS["t"] + "number-columns-repeated", 1)), 1024)
            while row and row[-1] is None:
                row.pop()
            for _ in range(min(int(line.get(_ODS["t"] + "number-rows-repeated", 1)), 1024 if not row else 1 << 20)):
                yield list(row)
        return
    raise ValueError(f"no sheet {sheet}")


def read_ods(spark: SparkSession, path: str, sheet: str, header: int) -> DataFrame:
    """A sheet whose names stand in row ``header`` (from 0), names stripped; a column with nothing but numbers is one of doubles.

    The sheet is parsed in a task and written once; the header and a row of counts reach the driver.
    """

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for raw in frame["content"]:
                numbered = enumerate(ods_rows(raw, sheet))
                while part := list(itertools.islice(numbered, 5_000)):
                    yield pd.DataFrame([(n, [None if v is None else str(v) for v in row], [v if isinstance(v, float) else None for v in row]) for n, row in part], columns=["n", "text", "number"])

    rows = written(spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "n long, text array<string>, number array<double>"), "sheet")
    names = [str(n).strip() if n is not None else f"column_{k}" for k, n in enumerate(rows.where(F.col("n") == header).first()["text"])]
    body = rows.where((F.col("n") > header) & (F.size("text") > 0))
    at = lambda c, k: F.try_element_at(c, F.lit(k + 1))
    counts = body.agg(*[F.struct(F.count(at("text", k)).alias("t"), F.count(at("number", k)).alias("n")).alias(f"c{k}") for k in range(len(names))]).first()
    return body.select(*[at("number" if counts[k]["t"] == counts[k]["n"] > 0 else "text", k).alias(n) for k, n in enumerate(names)])


def read_json_nodes(spark: SparkSession, path: str) -> DataFrame:
    """``id`` (``node/…``), ``lon``, ``lat`` of a map query's answer; elements without a place go; none left is an error."""
    schema = "elements array<struct<type: string, id: long, lon: double, lat: double>>"
    found = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("elements").alias("e")).where("e.lon is not null and e.lat is not null")
    out = found.select(F.concat(F.lit("node/"), F.col("e.id").cast("string")).alias("id"), "e.lon", "e.lat")
    if out.isEmpty():
        raise RuntimeError("the answer holds no placed element")
    return out


def read_places(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Nested place records in Parquet, restricted to a box (xmin, ymin, xmax, ymax) by pushed filters on ``bbox``."""
    df = spark.read.parquet(path)
    if box and "bbox" in df.columns:
        df = df.where((F.col("bbox.xmax") >= box[0]) & (F.col("bbox.xmin") <= box[2]) & (F.col("bbox.ymax") >= box[1]) & (F.col("bbox.ymin") <= box[3]))
    return df
