"""Measures of batches against those of single shapes."""

import numpy as np
import pytest

from cellweave.geo import batch, shapes


def star(rng, n, at, size):
    t = np.sort(rng.random(n) * 2 * np.pi)
    r = size * (0.2 + rng.random(n))
    return np.stack([at[0] + r * np.cos(t), at[1] + r * np.sin(t)], axis=1)


@pytest.fixture(scope="module")
def features():
    """Polygons with and without holes and of several parts, lines, points, empty ones and nulls, in mixed layouts."""
    rng = np.random.default_rng(6)
    out = []
    for k in range(240):
        at = rng.random(2) * 100
        ring = star(rng, 4 + k % 5, at, 25)
        closed = lambda r: np.vstack([r, r[:1]])
        out.append([
            shapes.polygon(ring), (shapes.POLYGON, [[closed(ring), closed(at + (ring - at) * 0.4)]]), (shapes.POLYGON, [[closed(ring)], [closed(ring + 60)]]), (shapes.LINE, [ring]), (shapes.LINE, [ring, ring[::-1] + 30]),
            (shapes.POINT, ring[:1]), (shapes.POINT, ring), (shapes.POLYGON, [[np.array([(at[0], at[1]), (at[0] + 20, at[1]), (at[0] + 20, at[1] + 30), (at[0], at[1] + 30), (at[0], at[1])])]]),
        ][k % 8])
    return out


@pytest.fixture(scope="module")
def values(features):
    return [shapes.write_wkb(s) for s in features] + [None, b"\x01\x03\x00\x00\x00\x00\x00\x00\x00", b"\x00" + b"\x00\x00\x00\x01" + np.array([3.0, 4.0], ">f8").tobytes()]


@pytest.fixture(scope="module")
def cells():
    hexagon = lambda x, y, r, turn: shapes.polygon([(x + r * np.cos(t + turn), y + r * np.sin(t + turn)) for t in np.arange(6) * np.pi / 3])
    rng = np.random.default_rng(7)
    own = [hexagon(*(rng.random(2) * 100), 15 + 20 * rng.random(), rng.random()) for _ in range(40)]
    return own + [shapes.polygon([(20, 20), (60, 20), (60, 70), (20, 70)]), shapes.polygon([(20, 20), (20, 70), (60, 70), (60, 20)]), shapes.polygon([(0, 0), (50, 10), (10, 60)])]


def test_single_measures(features, values):
    b = batch.Batch(values)
    assert np.allclose(b.areas()[: len(features)], [shapes.area(s) for s in features]) and np.allclose(b.lengths()[: len(features)], [shapes.length(s) for s in features])
    assert np.allclose(b.boxes()[: len(features)], [shapes.bounds(s) for s in features]) and np.isnan(b.boxes()[-3:-1]).all() and b.boxes()[-1].tolist() == [3, 4, 3, 4]
    for k, s in enumerate(features):
        assert shapes.write_wkb(b.shape(k)) == values[k], s[0]


def test_pairs(features, values, cells):
    b, c = batch.Batch(values), batch.Batch([shapes.write_wkb(x) for x in cells])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(cells)), np.arange(len(features)), indexing="ij"))
    want = [shapes.overlap_with_convex(cells[p], features[q]) for p, q in zip(i, j, strict=True)]
    assert np.allclose(batch.overlaps(c, i, b, j), want, atol=1e-7)
    want = [shapes.distance(cells[p], features[q]) for p, q in zip(i, j, strict=True)]
    assert np.allclose(batch.distances(c, i, b, j), want, atol=1e-9)
    empty = np.full(2, len(features))
    assert np.isinf(batch.distances(c, np.array([0, 1]), b, empty)).all() and (batch.overlaps(c, np.array([0, 1]), b, empty) == 0).all()


def test_slices_change_nothing(features, values, cells, monkeypatch):
    b, c = batch.Batch(values), batch.Batch([shapes.write_wkb(x) for x in cells])
    i, j = np.arange(240) % len(cells), np.arange(240)
    xy = np.random.default_rng(1).random((240, 2)) * 100
    now = [batch.overlaps(c, i, b, j), batch.distances(c, i, b, j), batch.contained(b, j, xy)]
    monkeypatch.setattr(batch, "SLICE", 3)  # every pair of outlines is a long one
    for x, y in zip(now, [batch.overlaps(c, i, b, j), batch.distances(c, i, b, j), batch.contained(b, j, xy)], strict=True):
        assert np.allclose(x, y)


def test_contained_is_strict(features, values):
    b = batch.Batch(values)
    xy = np.random.default_rng(2).random((240, 2)) * 100
    xy[::3] = [shapes.vertices(s)[0] for s in features[::3]]
    assert batch.contained(b, np.arange(240), xy).tolist() == [bool(shapes.contains_points(s, p[None])[0]) for s, p in zip(features, xy, strict=True)]


def test_layouts_and_mapping(features, values):
    assert [v and v.hex() for v in batch.layout(b"\x01\x01\x00\x00\x00", np.array([1.0, np.nan]), np.array([2.0, 3.0]))] == ["0101000000000000000000f03f0000000000000040", None]
    moved = batch.mapped(values, lambda x, y: (x + 1, y * 2))
    assert moved[-3] is None and all(shapes.write_wkb(shapes.mapped(s, lambda x, y: (x + 1, y * 2))) == m for s, m in zip(features, moved, strict=False))
