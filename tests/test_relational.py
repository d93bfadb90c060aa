import pandas as pd

from cellweave.operators import relational as R
from cellweave.operators.components import connected_components
from pyspark.sql import functions as F


def test_percentile_ranks_equal_pandas(spark):
    values = [5, 5, 7, None, 9, 1, 7]
    df = spark.createDataFrame([(k, "a", v) for k, v in enumerate(values)] + [(99, "b", 3)], "k int, g string, v int")
    got = {r.k: r.p for r in df.withColumn("p", R.pct_rank("v", ["g"])).collect()}
    want = pd.Series(values, dtype=float).rank(pct=True)
    assert got[99] == 1 and all((got[k] is None) if pd.isna(w) else abs(got[k] - w) < 1e-12 for k, w in enumerate(want))


def test_descending_ranks(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 9), (4, 1)], "k int, v int").withColumn("g", F.lit(0))
    assert {r.k: r.r for r in df.withColumn("r", R.min_rank_desc("v", ["g"])).collect()} == {3: 1, 1: 2, 2: 2, 4: 4}


def test_null_force_and_null_place_are_dropped(spark):
    rows = [(1.0, 1.0, "a"), (None, 1.0, "a"), (1.0, None, "a"), (1.0, 1.0, None), (1.0, 1.0, "BTP")]
    assert R.countable_events(spark.createDataFrame(rows, "lat double, lon double, f string"), "lat", "lon", "f", "BTP").count() == 1


def test_hierarchy_with_padding_and_missing_parents(spark):
    rows = [("1 ", " sg", "One "), ("1a", "g", " Group "), ("1a1", "subg", "Sub"), ("2b1", "subg", "Orphan")]
    got = {tuple(r) for r in R.decode_hierarchy(spark.createDataFrame(rows, "c string, l string, n string"), "c", "l", "n").collect()}
    assert got == {("1a1", "Sub", "Group", "One"), ("2b1", "Orphan", None, None)}


def test_distinct_on_is_the_least_row_and_nulls_are_one_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (None, "x", 1), (None, "y", 0)], "k int, s string, n int")
    assert sorted(map(tuple, R.distinct_on(df, ["k"]).collect()), key=str) == sorted([(1, "a", 9), (None, "x", 1)], key=str)


def test_fold(spark):
    df = spark.createDataFrame([("c", 2, 5.0), ("c", 1, 10.0), ("d", 3, 1.0)], "spatial_id string, green_id int, overlap_area double")
    got = {r.spatial_id: r for r in R.fold(df, "green", "overlap_area", "max").collect()}
    assert got["c"].green_ids == [1, 2] and got["c"].green_overlap_area == 10
    assert {r.spatial_id: r.green_overlap_area for r in R.fold(df, "green", "overlap_area", "sum").collect()} == {"c": 15.0, "d": 1.0}


def test_codes_texts_lists(spark):
    df = spark.createDataFrame([("BCT", "12.5", None), ("ZZZ", "", "BT1"), (None, "n/a", "B1")], "t string, x string, p string")
    got = df.select(R.category(F.col("t"), {"BCT": "bus"}, "other").alias("c"), R.numeric_text("x").alias("x"), R.without_prefix("p", "BT").alias("k")).collect()
    assert [tuple(r) for r in got] == [("bus", 12.5, True), ("other", None, False), ("other", None, True)]
    nested = spark.createDataFrame([([("a",), ("b",)],), ([],), (None,)], "l array<struct<postcode: string>>")
    assert [r[0] for r in nested.select(R.first_of_list("l", "postcode")).collect()] == ["a", None, None]


def test_counts_within_and_names(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), (None, "z")], "h3_9_id string, use string")
    cells = spark.createDataFrame([("a",), ("a",), ("q",)], "spatial_id string")
    assert [tuple(r) for r in R.counts_within(df, "h3_9_id", cells, ["use"], "n").collect()] == [("a", "x", 2)]
    look = spark.createDataFrame([("Cardiff", "W1"), ("Cardiff", "W2")], "name string, code string")
    assert [tuple(r) for r in R.code_by_name(spark.createDataFrame([("Cardiff",), ("Nowhere",)], "name string"), look, "name", "code").orderBy("name").collect()] == [("Cardiff", "W2"), ("Nowhere", None)]


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (None, 3), (500, 501)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{100 + k: 100 for k in range(60)}, 500: 500, 501: 500}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
