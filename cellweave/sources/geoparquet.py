"""GeoParquet that is clustered in space: rows along a Z-order curve, their bounds in a column, and the format's metadata in each file.

Row groups then hold what lies together, and the statistics of the bounds let a reader of a window skip the others.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cellweave.functions import spatial as S
from cellweave.sources.parts import registered

#: Rows of a row group.
GROUP_ROWS = 20_000
#: Metres of the national grid that one step of the curve spans; positions are cut to 16 bits a side.
STEP = 32.0
#: The format's names of geometry types.
TYPES = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}


def _spread(v: Column) -> Column:
    """The low 16 bits of a number with a zero after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def z_order(x: Column, y: Column, step: float = STEP) -> Column:
    """The place of a point on the curve; null for none, and the ends of the curve for what lies beyond it."""
    cut = lambda v: F.when(v.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(0xFFFF), F.floor(v / step))).cast("long"))
    return _spread(cut(x)).bitwiseOR(F.shiftleft(_spread(cut(y)), 1))


class _Written(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


def _store(address: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1).replace(" ", "%20"))


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.address, self.geom, self.rows = options["path"], options["geom"], int(options["rows"])
        self.reference = json.loads(options.get("reference", "null"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        """A partition as one file under a hidden name; the driver's commit gives it its own. An empty partition writes none."""
        store, root = _store(self.address)
        store.create_dir(root)
        name = f"part-{TaskContext.get().partitionId():05}-{uuid.uuid4().hex}.parquet"
        held, n, writer, types = [], 0, None, set()
        bounds = [float("inf"), float("inf"), float("-inf"), float("-inf")]

        def flush() -> None:
            nonlocal writer, held, n
            table = pa.Table.from_batches(held)
            if writer is None:
                writer = pq.ParquetWriter(f"{root}/.{name}", table.schema, filesystem=store, compression="zstd")
            writer.write_table(table, row_group_size=self.rows)
            held, n = [], 0

        for batch in iterator:
            for value in batch.column(self.geom):
                if (raw := value.as_py()) and len(raw) > 4:
                    types.add(TYPES.get(struct.unpack_from("<I" if raw[0] == 1 else ">I", raw, 1)[0] % 1000, "GeometryCollection"))
            boxes = batch.column("bbox")
            for k, (side, f) in enumerate((("xmin", min), ("ymin", min), ("xmax", max), ("ymax", max))):
                known = [v for v in boxes.field(side).to_pylist() if v is not None]
                bounds[k] = f([bounds[k], *known])
            held.append(batch)
            n += batch.num_rows
            if n >= self.rows:
                flush()
        if n:
            flush()
        if writer is None:
            return _Written("")
        column = {"encoding": "WKB", "geometry_types": sorted(types), "crs": self.reference, "covering": {"bbox": {s: ["bbox", s] for s in ("xmin", "ymin", "xmax", "ymax")}}}
        if bounds[0] <= bounds[2]:
            column["bbox"] = bounds
        writer.add_key_value_metadata({"geo": json.dumps({"version": "1.1.0", "primary_column": self.geom, "columns": {self.geom: column}})})
        writer.close()
        return _Written(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _store(self.address)
        store.create_dir(root)
        for m in messages:
            if m and m.name:
                store.move(f"{root}/.{m.name}", f"{root}/{m.name}")
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _store(self.address)
        for m in messages:
            if m and m.name:
                store.delete_file(f"{root}/.{m.name}")


class GeoParquet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cellweave_geoparquet"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def with_bounds(df: DataFrame, geom: str = "geom") -> DataFrame:
    """``df`` with the bounds of its geometry in ``bbox``, null fields for none."""
    return df.withColumn("bbox", S.st_box(geom))


def write_geoparquet(df: DataFrame, address: str, geom: str = "geom", reference: dict | None = None, partitions: int | None = None, rows: int = GROUP_ROWS, counted: tuple[Observation, list[Column]] | None = None) -> None:
    """``df`` at a new address, with ``bbox``, sorted along the curve over all files; ``reference`` is the coordinate system as PROJJSON (null: undefined).

    One range shuffle; its ranges follow a sample of the data, so a crowded town takes as many files as it needs. Rows without a geometry come
    first. A column ``bbox`` of ``df`` is replaced. ``counted`` is observed on the rows as they are written, for the shuffle's sample sees ``df``, too.
    """
    boxed = with_bounds(df, geom).withColumn("curve_", z_order((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2, (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2))
    dealt = (boxed.repartitionByRange(partitions, "curve_") if partitions else boxed.repartitionByRange("curve_")).sortWithinPartitions("curve_").drop("curve_")
    if counted:
        dealt = dealt.observe(counted[0], *counted[1])
    options = {"geom": geom, "rows": str(rows)} | ({"reference": json.dumps(reference)} if reference else {})
    dealt.write.format(registered(df.sparkSession, GeoParquet)).mode("append").options(**options).save(address)


def read_window(spark: SparkSession, address: str, box: tuple[float, float, float, float]) -> DataFrame:
    """The rows whose bounds meet the window (xmin, ymin, xmax, ymax); the filters reach the scan and skip row groups."""
    xmin, ymin, xmax, ymax = box
    df = spark.read.parquet(address)
    return df.where((F.col("bbox.xmax") >= xmin) & (F.col("bbox.xmin") <= xmax) & (F.col("bbox.ymax") >= ymin) & (F.col("bbox.ymin") <= ymax))
