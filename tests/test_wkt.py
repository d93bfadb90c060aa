from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.functions.wkt import from_text, to_text

#: Texts, what they read as, and area or length.
TEXTS = [
    ("POINT (1 2)", "POINT (1 2)", 0.0),
    ("  srid=27700; point(1.5   -2e3)", "POINT (1.5 -2000)", 0.0),
    ("LINESTRING(0 0,3 4 , 3 10)", "LINESTRING (0 0, 3 4, 3 10)", 11.0),
    ("POLYGON((0 0,10 0,10 10,0 10,0 0))", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))", 100.0),
    ("polygon ( ( 0 0, 10 0, 10 10, 0 10, 0 0 ) , ( 2 2, 4 2, 4 4, 2 2 ) )", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (2 2, 4 2, 4 4, 2 2))", 98.0),
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 9 5, 9 9, 5 9, 5 5), (6 6, 7 6, 7 7, 6 7, 6 6)))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 9 5, 9 9, 5 9, 5 5), (6 6, 7 6, 7 7, 6 7, 6 6)))", 15.5),
    ("MULTILINESTRING((0 0,1 0),(5 5,5 7))", "MULTILINESTRING ((0 0, 1 0), (5 5, 5 7))", 3.0),
    ("MULTIPOINT (1 2, 3 4)", "MULTIPOINT ((1 2), (3 4))", 0.0),
    ("MULTIPOINT ((1 2), (3 4))", "MULTIPOINT ((1 2), (3 4))", 0.0),
    ("POINT Z (1 2 3)", "POINT (1 2)", 0.0),
    ("LINESTRING ZM (0 0 1 1, 0 2 9 9)", "LINESTRING (0 0, 0 2)", 2.0),
    ("POLYGON EMPTY", "POLYGON EMPTY", 0.0),
    ("MULTIPOLYGON EMPTY", "POLYGON EMPTY", 0.0),
    ("CIRCULARSTRING (0 0, 1 1, 2 0)", None, None),
    ("POLYGON 1 2", None, None),
    ("", None, None),
    (None, None, None),
]


def test_texts_are_read_and_written(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(TEXTS)], "k int, t string").withColumn("geom", from_text(F.col("t")))
    rows = df.select("k", to_text(F.col("geom")).alias("t"), (S.st_area("geom") + S.st_length("geom")).alias("m")).orderBy("k").collect()
    assert [(r.t, r.m) for r in rows] == [(t, m) for _, t, m in TEXTS]
    again = spark.createDataFrame([(t,) for _, t, _ in TEXTS if t], "t string").withColumn("again", to_text(from_text(F.col("t"))))
    assert again.where("t <> again or again is null").count() == 0
