"""Files and folders of any store that Spark reaches, through Hadoop's file systems: names, times, renames, small texts.

Contents are moved by Spark jobs or streamed by the driver's JVM; none is held in Python.
"""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Place = str | Path


def address(place: Place) -> str:
    """A path as an address; one that has a scheme stays."""
    return str(place).rstrip("/") if "://" in str(place) or str(place).startswith("file:") else f"file://{Path(place).absolute()}"


def under(place: Place, *names: str) -> str:
    return "/".join([address(place), *names])


def name_of(place: Place) -> str:
    return address(place).rsplit("/", 1)[-1]


class Store:
    def __init__(self, spark: SparkSession):
        self.spark, self.jvm = spark, spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, place: Place):
        path = self.jvm.org.apache.hadoop.fs.Path(address(place))
        return path.getFileSystem(self.conf), path

    def exists(self, place: Place) -> bool:
        fs, path = self._at(place)
        return fs.exists(path)

    def modified(self, place: Place) -> float:
        """Seconds since the epoch."""
        fs, path = self._at(place)
        return fs.getFileStatus(path).getModificationTime() / 1000

    def names(self, place: Place) -> list[str]:
        fs, path = self._at(place)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def delete(self, place: Place) -> None:
        fs, path = self._at(place)
        fs.delete(path, True)

    def rename(self, place: Place, to: Place) -> None:
        """To a name that must not be there; in one step where the store can do so."""
        fs, path = self._at(place)
        if self.exists(to) or not fs.rename(path, self._at(to)[1]):
            raise OSError(f"{place} can't be renamed to {to}")

    def read(self, place: Place) -> str:
        fs, path = self._at(place)
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, text: str, place: Place) -> None:
        """A small text at a new place; it appears whole, by a rename."""
        staging = f"{address(place)}.{uuid.uuid4().hex}"
        fs, path = self._at(staging)
        stream = fs.create(path, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self.rename(staging, place)
        finally:
            self.delete(staging)

    def copy(self, place: Place, to: Place, modified: float) -> None:
        """One file, streamed, over what is there; its time is set."""
        fs, path = self._at(place)
        other, dest = self._at(to)
        if not self.jvm.org.apache.hadoop.fs.FileUtil.copy(fs, path, other, dest, False, True, self.conf):
            raise OSError(f"{place} can't be copied to {to}")
        other.setTimes(dest, int(modified * 1000), -1)

    def listing(self, root: Place) -> DataFrame:
        """``name, mtime, md5`` of all files below a folder; digests are made in tasks, and only where they are used."""
        schema = "name string, mtime double, md5 string"
        if not self.exists(root):
            return self.spark.createDataFrame([], schema)
        fs, path = self._at(root)
        prefix = str(fs.makeQualified(path).toString()).rstrip("/") + "/"
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(address(root))
        return found.select(F.substring("path", len(prefix) + 1, 1 << 20).alias("name"), (F.unix_millis("modificationTime") / 1000).alias("mtime"), F.md5("content").alias("md5"))
