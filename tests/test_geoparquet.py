import json

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.geo import shapes
from cellweave.sources.geoparquet import read_window, write_geoparquet, z_order


def scanned(df):
    """Rows that the scan gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    rows = plan.executeCollect()
    leaves = plan.collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value(), len(rows)


def test_z_order_interleaves(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (3.0, 5.0), (-9.0, 1e9), (None, 1.0)], "x double, y double")
    got = [r[0] for r in rows.select(z_order(F.col("x"), F.col("y"), 1.0)).collect()]
    both = lambda x, y: sum((x >> k & 1) << 2 * k | (y >> k & 1) << 2 * k + 1 for k in range(16))
    assert got == [both(0, 0), both(1, 0), both(0, 1), both(3, 5), both(0, 0xFFFF), None]


def test_a_window_reads_few_row_groups(spark, tmp_path):
    x, y = F.col("id") * 7919 % 50_000, F.col("id") * 104_729 % 50_000
    made = spark.range(20_000).select("id", S.st_rectangle(x, y, x + 40, y + 30).alias("geom"))
    made = made.union(spark.range(-3, 0).select("id", F.lit(None).cast("binary")))
    path = f"file://{tmp_path}/with space/geo"
    write_geoparquet(made, path, partitions=4, rows=500)
    assert spark.read.parquet(path).drop("bbox").exceptAll(made).isEmpty() and spark.read.parquet(path).count() == 20_003
    box = (10_000.0, 20_000.0, 12_000.0, 22_000.0)
    window = read_window(spark, path, box)
    want = made.withColumn("b", S.st_box("geom")).where(f"b.xmax >= {box[0]} and b.xmin <= {box[2]} and b.ymax >= {box[1]} and b.ymin <= {box[3]}").count()
    given, found = scanned(window)
    assert found == want > 10 and given < 4_000  # of 20,003
    files = sorted((tmp_path / "with space/geo").glob("part-*"))
    assert len(files) == 4 and not list((tmp_path / "with space/geo").glob(".part*"))
    for f in files:
        geo = json.loads(pq.read_metadata(f).metadata[b"geo"])
        own = geo["columns"]["geom"]
        table = pq.read_table(f)
        boxes = np.array([shapes.bounds(shapes.read_wkb(v)) for v in table["geom"].to_pylist() if v])
        assert geo["primary_column"] == "geom" and own["geometry_types"] == ["Polygon"] and own["bbox"] == [*boxes[:, :2].min(0), *boxes[:, 2:].max(0)]
        assert pq.read_metadata(f).num_row_groups > 3


def test_a_failed_write_leaves_no_table(spark, tmp_path):
    bad = spark.range(10).select("id", F.when(F.col("id") == 9, F.raise_error(F.lit("broken"))).otherwise(S.st_point(F.lit(1.0), F.lit(2.0))).cast("binary").alias("geom"))
    try:
        write_geoparquet(bad, f"file://{tmp_path}/t", partitions=2)
        raise AssertionError
    except Exception as error:
        assert "broken" in str(error)
    assert not list(tmp_path.glob("t/part-*")) and not (tmp_path / "t/_SUCCESS").exists()
