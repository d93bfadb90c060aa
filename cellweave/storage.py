"""Reading tables, and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the session names none (a local test) a temporary folder is made and removed at exit.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        own = tempfile.mkdtemp(prefix="cellweave-")
        atexit.register(shutil.rmtree, own, True)
        _OWN_DIRS[app] = f"file://{own}"
    return _OWN_DIRS[app]


def written(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read again.

    The lineage ends there, so a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many tasks as a shuffle has: before dear work on the rows of a small file, which is read in one or two tasks."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
