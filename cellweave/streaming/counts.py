"""Incremental counts by cell: a file stream of points folded into an event count per cell, type and window of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions import spatial as S


def windowed_cell_counts(points: DataFrame, time: str, lat: str, lon: str, kind: str, res: int = 9, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts per cell, type and window; points later than ``late`` are dropped, and a window is final when the watermark passes it."""
    cells = points.withWatermark(time, late).where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("spatial_id", S.cell_of(lat, lon, res))
    counts = cells.groupBy(F.window(time, window), "spatial_id", kind).agg(F.count("*").alias("count"))
    return counts.select("spatial_id", kind, F.col("window.start").alias("window_start"), "count")
