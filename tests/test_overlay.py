"""Union, repair, intersection and difference of polygons against areas by vertical slabs and membership of points."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.geo import shapes
from cellweave.operators import overlay as O
from cellweave.operators.components import connected_components

WORLD = 100


def wkb(*polygons):
    """WKB of polygons, each a list of rings, each a list of points."""
    return bytearray(shapes.write_wkb((shapes.POLYGON, [[np.array([*r, r[0]], float) for r in p] for p in polygons])))


def square(x, y, w, h=None):
    return [[(x, y), (x + w, y), (x + w, y + (h or w)), (x, y + (h or w))]]


def slab_area(groups, inside):
    """The area where ``inside(number of rings of each group crossed)`` holds, by slabs between all vertices and crossings."""
    edges = [(g, min(p, q), max(p, q)) for g, rings in enumerate(groups) for r in rings for p, q in zip(r, [*r[1:], r[0]], strict=True) if p[0] != q[0]]
    xs = {v for _, p, q in edges for v in (p[0], q[0])}
    for (_, (a, b), (c, d)), (_, (e, f), (g, h)) in itertools.combinations(edges, 2):
        det = (c - a) * (h - f) - (d - b) * (g - e)
        if det:
            t = ((e - a) * (h - f) - (f - b) * (g - e)) / det
            if 0 <= t <= 1:
                xs.add(a + t * (c - a))
    total, xs = 0.0, sorted(xs)
    for lo, hi in itertools.pairwise(xs):
        mid = (lo + hi) / 2
        at = lambda e, x: e[1][1] + (x - e[1][0]) * (e[2][1] - e[1][1]) / (e[2][0] - e[1][0])
        own = sorted((e for e in edges if e[1][0] < mid < e[2][0]), key=lambda e: at(e, mid))
        count = [0] * len(groups)
        for e, f in itertools.pairwise(own):
            count[e[0]] += 1
            if inside(count):
                total += (at(f, mid) - at(e, mid)) * (hi - lo)
    return total


def areas(df):
    return [shapes.area(shapes.read_wkb(bytes(r.geom))) for r in df.collect()]


def star(rng, n, cx, cy, r):
    """A simple polygon around a centre, with whole coordinates."""
    angles = sorted(rng.random() * 2 * np.pi for _ in range(n))
    pts = [(round(cx + r * (0.3 + 0.7 * rng.random()) * np.cos(a)), round(cy + r * (0.3 + 0.7 * rng.random()) * np.sin(a))) for a in angles]
    return [list(dict.fromkeys(pts))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, kind string, geom binary")


@pytest.mark.parametrize("tile", [7_000, 40_000, 500_000])
def test_union_of_overlapping_polygons(spark, tile):
    rng = random.Random(tile)
    kinds = {"a": [], "b": [], None: []}
    for k in range(60):
        pts = star(rng, 7, rng.randrange(WORLD), rng.randrange(WORLD), rng.randrange(5, 20))
        if len(pts[0]) > 2:
            kinds[("a", "b", None)[k % 3]].append(pts[0])
    rows = [(k, kind, wkb([r])) for kind, rings in kinds.items() for k, r in enumerate(rings)]
    out = O.union(frame(spark, rows), ["kind"], tile=tile).cache()
    for kind, rings in kinds.items():
        own = out.where(F.col("kind").eqNullSafe(kind))
        got = [shapes.read_wkb(bytes(r.geom)) for r in own.collect()]
        want = slab_area([[r] for r in rings], lambda c: any(x % 2 for x in c))
        assert sum(map(shapes.area, got)) == pytest.approx(want, abs=0.02)
        pts = np.array([(rng.random() * WORLD, rng.random() * WORLD) for _ in range(500)])
        covered = np.any([shapes.covers_points(shapes.polygon(r), pts) for r in rings], axis=0)
        held = np.sum([shapes.covers_points(g, pts) for g in got], axis=0)
        assert (held == covered).all()  # each point in one part at most
        assert not any(O.tangled(O.whole_rings(shapes.write_wkb(g), O.GRAIN)) for g in got)


def test_union_cases_with_known_parts(spark):
    """T-vertices, corner touches, holes, islands in holes, contained and repeated polygons, several tiles."""
    ring = [square(0, 0, 30, 10)[0]], [square(0, 20, 30, 10)[0]], [square(0, 5, 10, 20)[0]], [square(20, 5, 10, 20)[0]]
    cases = {
        "t-vertices": ([square(0, 0, 10), square(10, 2, 10, 3), square(10, 5, 10, 20)], [(330.0, 0)]),
        "corners": ([square(0, 0, 10), square(10, 10, 10)], [(100.0, 0), (100.0, 0)]),
        "ring": ([*ring], [(800.0, 1)]),
        "island": ([*ring, square(12, 12, 3)], [(9.0, 0), (800.0, 1)]),
        "contained": ([square(0, 0, 50), square(10, 10, 5), square(10, 10, 5), square(0, 0, 50)], [(2500.0, 0)]),
        "two holes that touch": ([square(0, 0, 30, 10), square(0, 30, 30, 10), square(0, 10, 10, 20), square(20, 10, 10, 20), square(10, 10, 5, 10), square(15, 20, 5, 10)], [(1100.0, 2)]),
        "holed, filled": ([[*square(0, 0, 30), *square(10, 10, 10)], square(10, 10, 10)], [(900.0, 0)]),
        "holed, crossed": ([[*square(0, 0, 30), *square(10, 10, 10)], square(14, -5, 2, 40)], [(900 - 100 + 20 + 2 * 10.0, 2)]),
    }
    rows = [(k, name, wkb(p)) for name, (polygons, _) in cases.items() for k, p in enumerate(polygons)] + [(99, "none", None), (98, "none", wkb([[(0, 0), (5, 5)]]))]
    for tile in (6_000, 500_000):
        got = {}
        for r in O.union(frame(spark, rows), ["kind"], tile=tile).collect():
            g = shapes.read_wkb(bytes(r.geom))
            got.setdefault(r.kind, []).append((round(shapes.area(g), 6), len(g[1][0]) - 1))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(want) for k, (_, want) in cases.items()}


def test_union_equals_components_of_squares(spark):
    """Parts of many random squares: as many as there are groups that overlap or share an edge."""
    rng = random.Random(8)
    at = [(k, rng.randrange(60), rng.randrange(60), rng.choice([2, 3, 4])) for k in range(260)]
    links = [(a[0], b[0]) for a, b in itertools.combinations(at, 2) if (w := min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])) >= 0 and (h := min(a[2] + a[3], b[2] + b[3]) - max(a[2], b[2])) >= 0 and w + h > 0]
    roots = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a int, b int")).collect()}
    cells: dict = {}
    for k, x, y, w in at:
        cells.setdefault(roots.get(k, k), set()).update((x + i, y + j) for i in range(w) for j in range(w))
    out = O.union(frame(spark, [(k, "s", wkb(square(x, y, w))) for k, x, y, w in at]), ["kind"], tile=10_000)
    assert sorted(round(a) for a in areas(out)) == sorted(len(c) for c in cells.values())


def test_make_valid(spark):
    rows = [
        (1, "", wkb([[(0, 0), (10, 10), (10, 0), (0, 10)]])),  # a bow-tie
        (2, "", wkb([[(0, 0), (10, 0), (10, 10), (5, 10), (5, 15), (5, 10), (0, 10)]])),  # a spike
        (3, "", wkb([[(0, 0), (10, 0), (10, 10), (0, 10)], [(2, 0), (8, 0), (5, 5)]])),  # a hole that lies on the outer ring
        (4, "", wkb([[(0, 0), (10, 0), (10, 10), (0, 10)], [(0, 0), (10, 0), (10, 10), (0, 10)]])),  # nothing is left
        (5, "", wkb(square(0, 0, 10), square(5, 5, 10))),  # parts that overlap
        (6, "", wkb([[(0, 0), (20, 0), (20, 20), (0, 20), (0, 0), (-5, -5), (-10, 0)]])),  # a ring through a vertex of its own
        (7, "", wkb([[(0, 0), (7, 3), (1, 9), (9, 8), (3, 1)]])),  # crossings at rounded points
        (8, "", None),
    ]
    got: dict = {}
    for r in O.make_valid(frame(spark, rows), ["id"], tile=4_000).collect():
        g = shapes.read_wkb(bytes(r.geom))
        assert not O.tangled(O.whole_rings(bytes(r.geom), O.GRAIN))
        got.setdefault(r.id, []).append((round(shapes.area(g), 3), len(g[1][0]) - 1))
    assert sorted(got[1]) == [(25.0, 0), (25.0, 0)] and got[2] == [(100.0, 0)] and got[3] == [(85.0, 0)] and sorted(got[5]) == [(75.0, 0), (75.0, 0)] and sorted(got[6]) == [(25.0, 0), (400.0, 0)]
    assert sum(a for a, _ in got[7]) == pytest.approx(slab_area([[[(0, 0), (7, 3), (1, 9), (9, 8), (3, 1)]]], lambda c: c[0] % 2), abs=0.02)
    assert set(got) == {1, 2, 3, 5, 6, 7}


def test_union_repairs_what_is_tangled(spark):
    rows = [(1, "k", wkb([[(0, 0), (10, 10), (10, 0), (0, 10)]])), (1, "k", wkb([[(0, 0), (10, 10), (10, 0), (0, 10)]])), (2, "k", wkb(square(10, 0, 5, 10)))]
    assert sorted(areas(O.union(frame(spark, rows), ["kind"]))) == [25.0, 75.0]


@pytest.mark.parametrize("tile", [9_000, 500_000])
def test_intersection_and_difference(spark, tile):
    rng = random.Random(3)
    rows, rings = [], []
    for k in range(25):
        a, b = (star(rng, 9, rng.randrange(40, 60), rng.randrange(40, 60), 30) for _ in range(2))
        rows.append((k, wkb(a), wkb(b)))
        rings.append((a[0], b[0]))
    rows += [(100, wkb(square(0, 0, 10)), wkb(square(10, 0, 10))), (101, wkb(square(0, 0, 10)), None), (102, wkb(square(0, 0, 9)), wkb([[(0, 3), (9, 3), (9, 6), (0, 6)]]))]
    # A comb over a bar: the parts stay apart.
    rows.append((103, wkb([[(0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9)]]), wkb(square(0, 5, 9, 2))))
    pairs = spark.createDataFrame(rows, "id int, one binary, other binary")
    for f, inside in ((O.intersection, lambda c: c[0] % 2 and c[1] % 2), (O.difference, lambda c: c[0] % 2 and not c[1] % 2)):
        got: dict = {}
        for r in f(pairs, ["id"], "one", "other", tile=tile).collect():
            got.setdefault(r.id, []).append(shapes.area(shapes.read_wkb(bytes(r.geom))))
        for k, (a, b) in enumerate(rings):
            assert sum(got.get(k, [])) == pytest.approx(slab_area([[a], [b]], inside), abs=0.02)
        if f is O.intersection:
            assert 100 not in got and 101 not in got and got[102] == [27.0] and sorted(got[103]) == [6.0, 6.0]
        else:
            assert got[100] == [100.0] and got[101] == [100.0] and sorted(got[102]) == [27.0, 27.0] and sorted(got[103]) == [6.0, 6.0, 39.0]


def test_no_broadcast_grows_with_the_outline(spark, monkeypatch):
    """Joins by tile and rounds over the links of chains, which are texts, are shuffled: broadcasts of these would add up on the driver."""
    from cellweave.operators import components

    links = spark.createDataFrame([(f"k|{i},0,{i + 1},0", f"k|{i + 1},0,{i + 2},0") for i in range(40)], "a string, b string")
    seen = []
    monkeypatch.setattr(components.F, "broadcast", lambda df: seen.append(df.columns) or df)
    assert {r.component for r in connected_components(links).collect()} == {"k|0,0,1,0"} and not seen
    hints, hint = [], type(links).hint
    monkeypatch.setattr(type(links), "hint", lambda df, name, *a: hints.append(name) or hint(df, name, *a))
    rows = spark.createDataFrame([("a", wkb(square(i, 0, 2))) for i in range(6)], "k string, geom binary")
    assert [r.n for r in O.union(rows, ["k"], tile=2000).groupBy("k").agg(F.count("*").alias("n")).collect()] == [1]
    assert hints.count("merge") >= 4


def test_small_files_are_dealt_over_tasks_before_their_shapes_are_built(spark, monkeypatch):
    from cellweave.plans import registry

    for name in ("_dissolved", "union_parts"):
        given = []
        monkeypatch.setattr(registry.overlay, "union", lambda df, key, given=given: given.append(df) or df)
        getattr(registry, name)(spark, "/root/testdata/sf0.001")
        assert given[0].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
