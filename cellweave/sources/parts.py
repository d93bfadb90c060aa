"""A data source whose partitions are planned parts of files or of a service's answers: a member of an archive, a range of rows or records, a page.

The plan is a list of small dictionaries; each becomes one task, which opens the file where it lies and reads its part as a stream.
No file is ever a row. Files are opened through Arrow's file systems (local and shared folders, S3, HDFS and others by their addresses).
"""

from __future__ import annotations

import io
import json
import time
import urllib.error
import urllib.parse
import urllib.request
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

#: What reads a part of each kind: from the part and the wanted schema to Arrow batches.
READERS: dict[str, Callable[[dict, pa.Schema], Iterator[pa.RecordBatch]]] = {}


def reads(kind: str):
    def add(f):
        READERS[kind] = f
        return f

    return add


class _Part(InputPartition):
    def __init__(self, part: dict):
        self.part = part


class _Reader(DataSourceReader):
    def __init__(self, kind: str, plan: list[dict], schema: T.StructType):
        self.kind, self.plan, self.wanted = kind, plan, schema

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in self.plan]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        import cellweave.sources.features
        import cellweave.sources.files  # noqa: F401  the readers register themselves

        yield from READERS[self.kind](partition.part, to_arrow_schema(self.wanted)) if partition is not None else ()


class Parts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cellweave_parts"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options["kind"], json.loads(self.options["plan"]), schema)


def registered(spark: SparkSession, source: type[DataSource]) -> str:
    """The source's name, known to the session. Spark looks it up in the thread's active session, which threads of a pool lack."""
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)
    spark.dataSource.register(source)
    return source.name()


def planned(spark: SparkSession, kind: str, plan: list[dict], schema: T.StructType) -> DataFrame:
    """The rows of all parts, a task each; an empty plan gives no rows."""
    if not plan:
        return spark.createDataFrame([], schema)
    return spark.read.format(registered(spark, Parts)).schema(schema).option("kind", kind).option("plan", json.dumps(plan)).load()


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(address, size) of the files at a path, which may hold globs, by name; Spark lists them and reads none."""
    found = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    if not found:
        raise FileNotFoundError(path)
    return sorted((r["path"], r["length"]) for r in found)


def opened(address: str):
    """A file that can be read from any place."""
    if address.startswith("file:") or "://" not in address:
        return open("/" + address.removeprefix("file:").lstrip("/"), "rb")  # noqa: SIM115
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))
    return io.BufferedReader(store.open_input_file(path))


def in_task(spark: SparkSession, f: Callable[[], list[str]]) -> list[str]:
    """What ``f`` gives, run in a task: a look into a file's head costs the driver neither memory nor the file."""
    return [r["v"] for r in spark.range(0, 1, 1, 1).mapInArrow(lambda batches: _texts(batches, f), "v string").collect()]


def _texts(batches: Iterator[pa.RecordBatch], f: Callable[[], list[str]]) -> Iterator[pa.RecordBatch]:
    if sum(b.num_rows for b in batches):
        yield pa.RecordBatch.from_arrays([pa.array(f(), pa.string())], ["v"])


def members(address: str) -> list[zipfile.ZipInfo]:
    """The directory of a zip file, read from its end."""
    with opened(address) as file, zipfile.ZipFile(file) as z:
        return [m for m in z.infolist() if not m.is_dir()]


def answer(url: str, parameters: dict, agent: str, timeout: int = 60, tries: int = 5, wait: float = 1.0) -> dict:
    """A service's JSON; busy or broken answers are asked for again after growing pauses, refusals are not."""
    request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(parameters)}", headers={"User-Agent": agent})
    for k in range(tries):
        try:
            with urllib.request.urlopen(request, timeout=timeout) as said:
                found = json.load(said)
            if "error" not in found:
                return found
            refused, error = found["error"].get("code", 500) < 500, OSError(f"{url}: {found['error']}")
        except urllib.error.HTTPError as e:
            refused, error = e.code < 500 and e.code != 429, e
        except (OSError, ValueError) as e:
            refused, error = False, e
        if refused or k == tries - 1:
            raise error
        time.sleep(wait * 2**k)
    raise AssertionError
