import datetime as dt

from cellweave.streaming.counts import windowed_cell_counts


def test_stream_equals_batch(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1 + k % 3, k % 24), 51.5 + k % 5 / 10, -0.1, "theft" if k % 2 else "drugs") for k in range(60)] + [(dt.datetime(2024, 1, 1), None, 0.0, "theft")]
    schema = "ts timestamp, lat double, lon double, crime_type string"
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/in")
    stream = windowed_cell_counts(spark.readStream.schema(schema).parquet(f"file://{tmp_path}/in"), "ts", "lat", "lon", "crime_type", res=8)
    query = stream.writeStream.format("memory").queryName("cells").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    got = spark.table("cells")
    want = windowed_cell_counts(spark.createDataFrame(rows, schema), "ts", "lat", "lon", "crime_type", res=8)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.groupBy().sum("count").first()[0] == 60
