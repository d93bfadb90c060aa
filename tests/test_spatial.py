import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.geo import shapes
from cellweave.operators import spatial_join
from cellweave.operators.isochrone import graph_edges, graph_nodes, isochrones
from cellweave.operators.spatial_join import best_overlap, box_join, containing, intersecting, nearest_within
from cellweave.plans import registry
from cellweave.storage import spread


def box(a, b, c, d):
    return bytearray(shapes.write_wkb(shapes.polygon([(a, b), (c, b), (c, d), (a, d)])))


def test_boxes_that_share_many_tiles_meet_once(spark):
    rng = np.random.default_rng(0)
    make = lambda n: [(k, *map(float, (x, y, x + w, y + h))) for k, (x, y, w, h) in enumerate(zip(*(rng.integers(0, m, n).tolist() for m in (1000, 1000, 300, 300)), strict=True))]
    a, b = make(60), make(80)
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} int, xmin double, ymin double, xmax double, ymax double")
    got = [tuple(r) for r in box_join(frame(a, "a"), frame(b, "b"), 50.0).select("a", "b").collect()]
    want = {(p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]}
    assert len(got) == len(set(got)) and set(got) == want


def test_tile_join_is_an_equi_join(spark, capsys):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], "k int, xmin double, ymin double, xmax double, ymax double")
    box_join(rows, rows.withColumnRenamed("k", "j")).explain()
    assert "NestedLoop" not in capsys.readouterr().out


def test_best_overlap_ties_touches_and_misses(spark):
    cells = spark.createDataFrame([("a", box(0, 0, 10, 10)), ("b", box(100, 0, 110, 10)), ("c", box(500, 500, 510, 510)), ("d", box(20, 0, 30, 10))], "spatial_id string, cell_geom binary")
    areas = spark.createDataFrame([("X", box(-50, -50, 6, 50)), ("Y", box(6, -50, 20, 50)), ("P", box(100, 0, 105, 10)), ("Q", box(105, 0, 110, 10))], "code string, geom binary")
    assert {tuple(r) for r in best_overlap(cells, areas, "cell_geom", "geom", "code").collect()} == {("a", "X"), ("b", "P"), ("d", "Y")}
    pairs = {(r.spatial_id, r.code): r.m for r in intersecting(cells, areas, "cell_geom", "geom", "m").collect()}
    assert pairs == {("a", "X"): 60.0, ("a", "Y"): 40.0, ("b", "P"): 50.0, ("b", "Q"): 50.0, ("d", "Y"): 0.0}


def test_nearest_within_is_inclusive_with_a_row_per_cell(spark):
    cells = spark.createDataFrame([(str(k), box(k * 10_000, 0, k * 10_000 + 10, 10)) for k in range(5)], "spatial_id string, cell_geom binary")
    at = {0: 0.0, 1: 1999.9, 2: 2000.0, 3: 2000.1}
    centres = spark.createDataFrame([(f"r{k}", box(k * 10_000 + 10 + d, 0, k * 10_000 + 20 + d, 5)) for k, d in at.items()], "rc string, geom binary")
    got = {r.spatial_id: (r.rc, r.distance) for r in nearest_within(cells, centres, "cell_geom", "geom", "rc", 2000.0).collect()}
    assert got["0"] == ("r0", 0.0) and got["2"] == ("r2", 2000.0) and got["3"] == (None, None) and got["4"] == (None, None) and abs(got["1"][1] - 1999.9) < 1e-9


def _pairs_met(monkeypatch):
    """The numbers of pairs that each tile join gives from now on."""
    seen, join = [], spatial_join.box_join
    monkeypatch.setattr(spatial_join, "box_join", lambda *a, **k: (out := join(*a, **k), seen.append(out.count()))[0])
    return seen


def _copies(spark):
    """Twenty copies of each of two cells, thirty of each of two features."""
    cells = spark.createDataFrame([(f"{g}{k:02}", box(x, 0, x + 10, 10)) for g, x in (("a", 0), ("b", 100)) for k in range(20)], "spatial_id string, cell_geom binary")
    features = spark.createDataFrame([(f"{g}{k:02}", box(x, 0, x + 20, 10)) for g, x in (("Y", 4), ("X", 98)) for k in reversed(range(30))], "code string, geom binary")
    return cells, features


def test_nearest_of_equal_cells_and_features_is_measured_once(spark, monkeypatch):
    cells, features = _copies(spark)
    seen = _pairs_met(monkeypatch)
    got = {tuple(r) for r in nearest_within(cells, features, "cell_geom", "geom", "code", 10.0).collect()}
    assert got == {(f"{g}{k:02}", code, 0.0) for g, code in (("a", "Y00"), ("b", "X00")) for k in range(20)} and seen == [2]


def test_best_overlap_of_equal_cells_and_features_is_measured_once(spark, monkeypatch):
    cells, features = _copies(spark)
    seen = _pairs_met(monkeypatch)
    got = {tuple(r) for r in best_overlap(cells, features, "cell_geom", "geom", "code").collect()}
    assert got == {(f"{g}{k:02}", code) for g, code in (("a", "Y00"), ("b", "X00")) for k in range(20)} and seen == [2]


def test_overlaps_of_equal_shapes_are_measured_once_and_give_all_their_rows(spark, monkeypatch):
    cells, features = _copies(spark)
    seen = _pairs_met(monkeypatch)
    got = [tuple(r) for r in intersecting(cells, features, "cell_geom", "geom", "m", digits=1).select("spatial_id", "code", "m").collect()]
    assert len(got) == 2 * 20 * 30 and set(got) == {(f"{g}{k:02}", f"{c}{j:02}", m) for g, c, m in (("a", "Y", 60.0), ("b", "X", 100.0)) for k in range(20) for j in range(30)} and seen == [2]


def test_points_on_a_shared_edge_lie_in_no_polygon(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 5.0), (3, 15.0, 5.0), (4, None, 1.0), (5, 99.0, 99.0)], "id int, x double, y double")
    areas = spark.createDataFrame([("A", box(0, 0, 10, 10)), ("B", box(10, 0, 20, 10))], "code string, geom binary")
    assert {(r.id, r.code) for r in containing(pts, areas, "x", "y", "geom", "code").collect()} == {(1, "A"), (2, None), (3, "B"), (4, None), (5, None)}


def test_rows_of_repeated_and_unknown_ids_keep_their_polygon(spark):
    pts = spark.createDataFrame([(None, 5.0, 5.0), (None, 15.0, 5.0), (7, 5.0, 5.0), (7, 15.0, 5.0), (7, 15.0, 5.0)], "id int, x double, y double")
    areas = spark.createDataFrame([("A", box(0, 0, 10, 10)), ("B", box(10, 0, 20, 10)), ("C", box(0, 0, 20, 10)), ("D", None)], "code string, geom binary")
    got = sorted((r.id is None, r.x, r.code) for r in containing(pts, areas, "x", "y", "geom", "code").collect())
    assert got == [(False, 5.0, "A"), (False, 15.0, "B"), (False, 15.0, "B"), (True, 5.0, "A"), (True, 15.0, "B")]


def test_isochrones(spark):
    line = lambda *p: bytearray(shapes.write_wkb((shapes.LINE, [np.array(p, float)])))
    roads = [("A", "B", 100.0, line((0, 0), (100, 0))), ("B", "C", 100.0, line((100, 0), (100, 100))), ("C", "D", 100.0, line((100, 100), (0, 100))), ("D", "A", 100.0, line((0, 100), (0, 0))), ("A", "B", 900.0, line((0, 0), (100, 0))), ("D", "E", 0.0, line((0, 100), (0, 300))), ("F", "F", 5.0, line((5000, 5000), (5001, 5000)))]
    df = spark.createDataFrame(roads, "start_node string, end_node string, length double, geom binary")
    edges, nodes = graph_edges(df), graph_nodes(df)
    assert {tuple(r) for r in edges.collect()} == {("A", "B", 100.0), ("B", "C", 100.0), ("C", "D", 100.0), ("A", "D", 100.0), ("F", "F", 5.0)}
    places = spark.createDataFrame([(1, 10.0, 10.0), (2, 9000.0, 9000.0)], "place int, px double, py double")
    got = {r.place: r for r in isochrones(places, edges, nodes).collect()}
    assert got[1].n_nodes == 4 and abs(got[1].area_km2 - 0.01) < 1e-12 and got[2].n_nodes == 1 and got[2].area_km2 == 0
    near = {r.place: r.n_nodes for r in isochrones(places, edges, nodes, 100.0).collect()}
    assert near[1] == 3  # a node just at the distance counts


def test_cells_in_spark(spark):
    df = spark.createDataFrame([(51.5, -0.1), (None, 1.0)], "lat double, lon double")
    got = df.select(S.cell_of("lat", "lon", 8).alias("c")).select("c", S.cell_area("c").alias("a"), S.st_area(S.cell_boundary("c", on_grid=True)).alias("p")).collect()
    assert len(got[0].c) == 15 and abs(got[0].a / got[0].p - 1) < 0.01 and got[1].c is None and got[1].p is None
    at = spark.range(1).select(S.st_point(F.lit(3.0), F.lit(4.0)).alias("g")).first().g
    assert shapes.vertices(shapes.read_wkb(bytes(at))).tolist() == [[3, 4]]


def test_equal_cells_and_features_are_overlaid_once(spark, monkeypatch):
    seen = []

    def counted(pairs, key, one, other):
        seen.append((pairs.count(), pairs.select(one, other).distinct().count()))
        raise LookupError

    monkeypatch.setattr(registry.overlay, "intersection", counted)
    with pytest.raises(LookupError):
        registry.intersection_parts(spark, "/root/testdata/sf0.1")
    assert seen[0][0] == seen[0][1] > 0


def test_polygons_from_rings(spark):
    outer, hole = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 0.0)], [(5.0, 1.0), (6.0, 1.0), (6.0, 2.0), (5.0, 1.0)]
    rows = spark.createDataFrame([(0, None), (1, [outer, hole]), (2, [hole]), (3, [])], "id int, rings array<array<struct<x: double, y: double>>>").coalesce(1)
    got = {r.id: r.g for r in rows.select("id", S.st_polygon(F.col("rings")).alias("g")).collect()}
    want = {k: bytes(shapes.write_wkb((shapes.POLYGON, [[np.array(r) for r in rings]]))) for k, rings in ((1, [outer, hole]), (2, [hole]), (3, []))}
    assert got.pop(0) is None and {k: bytes(v) for k, v in got.items()} == want


def test_rows_of_one_small_file_are_dealt_over_tasks(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() >= 4 and spread(one).count() == 100
    for name in ("well_known_text", "h3_boundary", "h3_area"):
        assert registry.queries()[name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() >= 4
