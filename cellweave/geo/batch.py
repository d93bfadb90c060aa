"""A batch of shapes as flat arrays of segments, and measures of all of them at once.

Shapes of one layout (as rectangles, straight lines, points and single rings of one length are) are read together; only others
go through the reader of single shapes. Whatever is computed for pairs is computed for all pairs of segments of a slice of rows.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np

from cellweave.geo import shapes

#: Pairs of segments that are looked at together.
SLICE = 1_000_000


class Batch:
    """Segments ``a``-``b`` sorted by row, with the ring each belongs to; ``ring_row`` and ``hole`` by ring, ``kind`` by row (0: null or empty).

    A point is a segment of no length.
    """

    def __init__(self, values: Sequence[bytes | None]):
        self.n = len(values)
        self.kind = np.zeros(self.n, np.int8)
        rows, parts_a, parts_b, ring_rows, holes, ring_of = [], [], [], [], [], []
        n_rings = 0

        def add(kind: int, row: np.ndarray, a: np.ndarray, b: np.ndarray, ring_row: np.ndarray, hole: np.ndarray, ring: np.ndarray) -> None:
            nonlocal n_rings
            self.kind[ring_row] = kind
            rows.append(row)
            parts_a.append(a)
            parts_b.append(b)
            ring_rows.append(ring_row)
            holes.append(hole)
            ring_of.append(ring + n_rings)
            n_rings += len(ring_row)

        layouts: dict[tuple[int, bytes], list[int]] = {}
        for k, v in enumerate(values):
            if v is not None and v == v and len(v) > 4:
                layouts.setdefault((len(v), bytes(v[:13])) if v[1] == 3 else (len(v), bytes(v[: 9 if v[1] == 2 else 5])), []).append(k)
        for (size, head), own in layouts.items():
            where = np.array(own)
            kind, start = head[1], len(head)
            plain = head[0] == 1 and head[2:5] == b"\0\0\0" and kind in (1, 2, 3) and (size - start) % 16 == 0
            points = (size - start) // 16
            if plain and kind != 1:
                plain = struct.unpack_from("<I", head, len(head) - 4)[0] == points and points > 0 and (kind == 2 or head[5:9] == b"\1\0\0\0")
            if not plain or kind == 1 and points != 1:
                self._single(values, own, add)
                continue
            xy = np.frombuffer(b"".join(bytes(values[k]) for k in own), np.uint8).reshape(len(own), size)[:, start:].copy().view("<f8").reshape(len(own), points, 2)
            if kind == 1:
                good = ~np.isnan(xy[:, 0]).any(axis=1)
                where, xy = where[good], xy[good]
            many = max(points - 1, 1) if kind != 1 else 1
            a, b = (xy[:, :1], xy[:, :1]) if points == 1 else (xy[:, :-1], xy[:, 1:])
            add(kind, np.repeat(where, many), a.reshape(-1, 2), b.reshape(-1, 2), where, np.zeros(len(where), bool), np.repeat(np.arange(len(where)), many))
        empty = np.zeros(0, np.int64)
        row = np.concatenate([empty, *rows])
        order = np.argsort(row, kind="stable")
        self.row = row[order]
        self.a = np.concatenate([np.empty((0, 2)), *parts_a])[order]
        self.b = np.concatenate([np.empty((0, 2)), *parts_b])[order]
        self.ring = np.concatenate([empty, *ring_of])[order]
        self.ring_row = np.concatenate([empty, *ring_rows])
        self.hole = np.concatenate([np.zeros(0, bool), *holes])
        self.start = np.searchsorted(self.row, np.arange(self.n + 1))

    @staticmethod
    def _single(values, own: list[int], add) -> None:
        for k in own:
            shape = shapes.read_wkb(bytes(values[k]))
            kind, parts = shape
            if not len(parts):
                continue
            arrays = [(p[None], False) for p in parts] if kind == shapes.POINT else [(p, False) for p in parts] if kind == shapes.LINE else [(r, j > 0) for p in parts for j, r in enumerate(p)]
            for xy, hole in arrays:
                a, b = (xy, xy) if len(xy) == 1 else (xy[:-1], xy[1:])
                add(kind, np.full(len(a), k), a, b, np.array([k]), np.array([hole]), np.zeros(len(a), np.int64))

    def take(self, rows: np.ndarray) -> Batch:
        """The batch of these rows, in this order and as often."""
        out = object.__new__(Batch)
        out.n, out.kind = len(rows), self.kind[rows]
        at, out.row = ranges(self.start[rows], self.start[rows + 1])
        out.a, out.b = self.a[at], self.b[at]
        pair = out.row * (len(self.ring_row) + 1) + self.ring[at]
        ring, out.ring = np.unique(pair, return_inverse=True)
        out.ring_row, old = np.divmod(ring, len(self.ring_row) + 1)
        out.hole = self.hole[old]
        out.start = np.searchsorted(out.row, np.arange(out.n + 1))
        return out

    def shape(self, row: int):
        """One row as a shape."""
        at = slice(self.start[row], self.start[row + 1])
        rings = np.split(np.arange(at.start, at.stop), np.flatnonzero(np.diff(self.ring[at])) + 1)
        lines = [np.vstack([self.a[r], self.b[r[-1:]]]) for r in rings if len(r)]
        kind = int(self.kind[row])
        if kind != shapes.POLYGON:
            return kind, np.concatenate([self.a[at], np.empty((0, 2))]) if kind == shapes.POINT else lines
        parts: list = []
        for line, ring in zip(lines, rings, strict=True):
            if self.hole[self.ring[ring[0]]] and parts:
                parts[-1].append(line)
            else:
                parts.append([line])
        return kind, parts

    def by_row(self, f: np.ufunc, values: np.ndarray, none: float) -> np.ndarray:
        return grouped(f, values, self.start, none)

    def boxes(self) -> np.ndarray:
        """Bounds, a row of four; nan for none."""
        low, high = np.minimum(self.a, self.b), np.maximum(self.a, self.b)
        return np.stack([self.by_row(f, v[:, i], np.nan) for f, v in ((np.minimum, low), (np.maximum, high)) for i in (0, 1)], axis=1)

    def origin(self) -> np.ndarray:
        """Each row's first vertex, about which sums are taken for precision."""
        out = np.zeros((self.n, 2))
        has = self.start[:-1] < self.start[1:]
        out[has] = self.a[self.start[:-1][has]]
        return out

    def by_rings(self, values: np.ndarray) -> np.ndarray:
        """By row: the sizes of its rings' sums, those of holes taken off."""
        sums = np.abs(np.bincount(self.ring, values, len(self.ring_row))) if len(values) else np.zeros(len(self.ring_row))
        return np.bincount(self.ring_row, np.where(self.hole, -sums, sums), self.n) if len(sums) else np.zeros(self.n)

    def areas(self) -> np.ndarray:
        o = self.origin()[self.row]
        a, b = self.a - o, self.b - o
        polygon = self.kind[self.row] == shapes.POLYGON
        return self.by_rings(np.where(polygon, a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1], 0.0)) / 2

    def lengths(self) -> np.ndarray:
        return np.bincount(self.row, np.where(self.kind[self.row] == shapes.LINE, np.hypot(*(self.b - self.a).T), 0.0), self.n) if len(self.row) else np.zeros(self.n)


def grouped(f: np.ufunc, values: np.ndarray, start: np.ndarray, none) -> np.ndarray:
    """``f`` over each stretch of ``values`` between starts; ``none`` for empty ones."""
    out = np.full(len(start) - 1, none, np.result_type(values.dtype, type(none)) if not isinstance(none, bool) else bool)
    has = np.flatnonzero(start[:-1] < start[1:])
    if len(has):
        out[has] = f.reduceat(values, start[:-1][has])
    return out


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All indexes from ``low`` to below ``high``, and the number of the range each is from."""
    many = high - low
    which = np.repeat(np.arange(len(low)), many)
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many), which


def _slices(cost: np.ndarray) -> Iterator[slice]:
    """Slices of rows whose costs come to ``SLICE`` at most, or of one row."""
    total, at = np.cumsum(cost), 0
    while at < len(cost):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + SLICE, side="right")))
        yield slice(at, end)
        at = end


def _pairs(one: Batch, other: Batch, rows: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice of rows all pairs of a segment of ``one`` and one of ``other``: their indexes, and the starts of the rows' pairs."""
    many = np.diff(other.start)[rows]
    low, high = one.start[rows.start], one.start[rows.stop]
    i = np.arange(low, high)
    row = one.row[low:high] - rows.start
    j, which = ranges(other.start[rows.start : rows.stop][row], other.start[rows.start : rows.stop][row] + many[row])
    start = np.concatenate([[0], np.cumsum(np.diff(one.start)[rows] * many)])
    return i[which], j, start, which


def _to_segment(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = b - a
    n = (d * d).sum(axis=1)
    t = np.clip(((p - a) * d).sum(axis=1) / np.where(n > 0, n, 1), 0, 1)
    return np.hypot(*(p - a - t[:, None] * d).T)


def _crossed(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a ray from a point to the right crosses a segment."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return ((a[:, 1] > p[:, 1]) != (b[:, 1] > p[:, 1])) & (p[:, 0] < a[:, 0] + (p[:, 1] - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0]))


def _any_inside(points: Batch, polygons: Batch, rows: slice) -> np.ndarray:
    """By row of the slice, whether the start of any segment of ``points`` lies in the polygons, by the even-odd rule."""
    i, j, start, which = _pairs(points, polygons, rows)
    crossed = _crossed(points.a[i], polygons.a[j], polygons.b[j]) & (polygons.kind[polygons.row[j]] == shapes.POLYGON)
    odd = np.bincount(which, crossed, points.start[rows.stop] - points.start[rows.start]) % 2 == 1 if len(which) else np.zeros(points.start[rows.stop] - points.start[rows.start], bool)
    return grouped(np.logical_or, odd, points.start[rows.start : rows.stop + 1] - points.start[rows.start], False)


def _distances(one: Batch, other: Batch) -> np.ndarray:
    out, rows = np.full(one.n, np.inf), slice(0, one.n)
    i, j, start, _ = _pairs(one, other, rows)
    a, b, c, d = one.a[i], one.b[i], other.a[j], other.b[j]
    turn = lambda p, q, r: (q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0])
    cross = (turn(a, b, c) * turn(a, b, d) < 0) & (turn(c, d, a) * turn(c, d, b) < 0)
    near = np.minimum.reduce([_to_segment(a, c, d), _to_segment(b, c, d), _to_segment(c, a, b), _to_segment(d, a, b)])
    best = grouped(np.minimum, np.where(cross, 0.0, near), start, np.inf)
    inside = (_any_inside(one, other, rows) | _any_inside(other, one, rows)) & np.isfinite(best)
    out[rows] = np.where(inside, 0.0, best)
    return out


def _sides(values: Batch, which: np.ndarray, rows: slice) -> Batch:
    return values.take(which[rows])


def distances(one: Batch, i: np.ndarray, other: Batch, j: np.ndarray) -> np.ndarray:
    """For rows that pair shape ``i`` of ``one`` with shape ``j`` of ``other`` the least distance: 0 where they meet, infinite where one is empty."""
    out = np.full(len(i), np.inf)
    a, b = np.diff(one.start)[i], np.diff(other.start)[j]
    for rows in _slices(a * b):
        if rows.stop - rows.start > 1 or a[rows.start] * b[rows.start] <= 4 * SLICE:
            out[rows] = _distances(_sides(one, i, rows), _sides(other, j, rows))
        else:  # two long outlines: in pieces, by the reader of single shapes
            out[rows] = shapes.distance(one.shape(int(i[rows.start])), other.shape(int(j[rows.start])))
    return out


def contained(polygons: Batch, which: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """For rows that pair polygon ``which`` with a point, whether the point lies strictly inside."""
    out = np.zeros(len(xy), bool)
    for rows in _slices(np.diff(polygons.start)[which]):
        own = which[rows]
        j, row = ranges(polygons.start[own], polygons.start[own + 1])
        p, n = xy[rows][row], rows.stop - rows.start
        a, b = polygons.a[j], polygons.b[j]
        odd = np.bincount(row, _crossed(p, a, b), n) % 2 == 1
        # Only points that lie in the polygon can be ruled out by lying on its edge.
        near = np.flatnonzero(odd[row])
        on = np.bincount(row[near], _to_segment(p[near], a[near], b[near]) <= shapes.EPS, n) > 0
        out[rows] = odd & ~on & (polygons.kind[own] == shapes.POLYGON)
    return out


def _windows(cells: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of convex polygons: the vertices' x in order, and the upper and lower y there; padded to the largest number of vertices."""
    most = max(1, int(np.diff(cells.start).max(initial=1)))
    at = np.minimum(cells.start[:-1, None] + np.arange(most), np.maximum(cells.start[1:, None] - 1, 0))
    a, b = cells.a[at], cells.b[at]
    x = np.sort(a[:, :, 0], axis=1)
    left, right = np.minimum(a[..., 0], b[..., 0]), np.maximum(a[..., 0], b[..., 0])
    over = (left[:, None] <= x[:, :, None]) & (x[:, :, None] <= right[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (x[:, :, None] - a[:, None, :, 0]) / (b - a)[:, None, :, 0]
    t = np.where(np.isfinite(t), t, 0.0)
    y = a[:, None, :, 1] + t * (b - a)[:, None, :, 1]
    # An upright edge gives both its ends.
    upright = (a[..., 0] == b[..., 0])[:, None] & over
    high, low = np.where(upright, np.maximum(a[..., 1], b[..., 1])[:, None], y), np.where(upright, np.minimum(a[..., 1], b[..., 1])[:, None], y)
    return x, np.where(over, high, -np.inf).max(axis=2), np.where(over, low, np.inf).min(axis=2)


def _above(u: np.ndarray, v: np.ndarray, width: np.ndarray) -> np.ndarray:
    """The integral of the positive part of a line that goes from ``u`` to ``v``."""
    high, low = np.maximum(u, v), np.minimum(u, v)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(low >= 0, (u + v) / 2, np.where(high <= 0, 0.0, high * high / (2 * (high - low))))
    return part * width


def overlaps(cells: Batch, i: np.ndarray, features: Batch, j: np.ndarray) -> np.ndarray:
    """For rows that pair cell ``i`` with feature ``j`` the area of the polygons, or the length of the lines, within the convex cell.

    The area under each edge of a polygon, held between the cell's lower and upper side, is summed stretch by stretch of the cell's vertices; the signs of
    the edges' directions leave what lies in both.
    """
    out = np.zeros(len(i))
    for rows in _slices(np.diff(features.start)[j] * max(1, int(np.diff(cells.start).max(initial=1)))):
        own, window = _sides(features, j, rows), _sides(cells, i, rows)
        o = window.origin()
        x, top, bottom = _windows(window)
        x, top, bottom = x - o[:, :1], top - o[:, 1:], bottom - o[:, 1:]
        a, b = own.a - o[own.row], own.b - o[own.row]
        if (own.kind == shapes.POLYGON).any():
            back = a[:, 0] > b[:, 0]
            p, q = np.where(back[:, None], b, a), np.where(back[:, None], a, b)
            wx, wt, wb = x[own.row], top[own.row], bottom[own.row]
            x0, x1 = np.maximum(p[:, :1], wx[:, :-1]), np.minimum(q[:, :1], wx[:, 1:])
            width = np.maximum(x1 - x0, 0.0)
            with np.errstate(divide="ignore", invalid="ignore"):
                slope = (q[:, 1] - p[:, 1]) / (q[:, 0] - p[:, 0])
                span = np.diff(wx, axis=1)
                tops, bottoms = np.diff(wt, axis=1) / span, np.diff(wb, axis=1) / span
                line = lambda at: p[:, 1:] + slope[:, None] * (at - p[:, :1])
                upper, lower = (lambda at: wt[:, :-1] + tops * (at - wx[:, :-1])), (lambda at: wb[:, :-1] + bottoms * (at - wx[:, :-1]))
                part = _above(line(x0) - lower(x0), line(x1) - lower(x1), width) - _above(line(x0) - upper(x0), line(x1) - upper(x1), width)
            part = np.where(width > 0, part, 0.0).sum(axis=1)
            out[rows] = np.maximum(own.by_rings(np.where(own.kind[own.row] == shapes.POLYGON, np.where(back, -part, part), 0.0)), 0.0)
        if (own.kind == shapes.LINE).any():
            turned = np.bincount(window.row, (window.a - o[window.row])[:, 0] * (window.b - o[window.row])[:, 1] - (window.b - o[window.row])[:, 0] * (window.a - o[window.row])[:, 1], window.n) < 0
            u, v, _, _ = _pairs(own, window, slice(0, own.n))
            n = np.stack([-(window.b - window.a)[v, 1], (window.b - window.a)[v, 0]], axis=1) * np.where(turned[window.row[v]], -1, 1)[:, None]
            d = own.b[u] - own.a[u]
            at, slope = ((own.a[u] - window.a[v]) * n).sum(axis=1), (d * n).sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                t = -at / slope
            edge = np.concatenate([[0], np.cumsum(np.diff(window.start)[own.row])])
            enter = grouped(np.maximum, np.where(slope > 0, t, np.where((slope == 0) & (at < 0), np.inf, -np.inf)), edge, -np.inf)
            leave = grouped(np.minimum, np.where(slope < 0, t, np.inf), edge, np.inf)
            inside = np.maximum(np.minimum(leave, 1.0) - np.maximum(enter, 0.0), 0.0) * np.hypot(*(own.b - own.a).T)
            out[rows] += np.bincount(own.row, np.where(own.kind[own.row] == shapes.LINE, inside, 0.0), own.n)
    return out


def unique(values: Sequence[bytes | None]) -> tuple[Batch, np.ndarray]:
    """The batch of the distinct values, and for each row the number of its own."""
    numbers: dict = {}
    which = np.array([numbers.setdefault(v if v is None or v == v else None, len(numbers)) for v in values], np.int64)
    return Batch(list(numbers)), which


def layout(head: bytes, *columns: np.ndarray) -> list[bytes | None]:
    """WKB of one layout from columns of doubles; null where one is not a number."""
    xy = np.stack(columns, axis=1).astype("<f8")
    raw = xy.tobytes()
    step = 8 * len(columns)
    bad = np.isnan(xy).any(axis=1)
    return [None if bad[k] else head + raw[k * step : (k + 1) * step] for k in range(len(xy))]


def mapped(values: Sequence[bytes | None], f: Callable) -> list[bytes | None]:
    """WKB with ``f(x, y) -> (x, y)`` applied to all vertices of the batch at once; null and empty stay null."""
    found = [shapes.read_wkb(bytes(v)) if v is not None and v == v else None for v in values]
    flat = np.concatenate([np.empty((0, 2)), *(shapes.vertices(s) for s in found if s)])
    moved, at, out = np.stack(f(flat[:, 0], flat[:, 1]), axis=1) if len(flat) else flat, 0, []

    def next_like(xy: np.ndarray) -> np.ndarray:
        nonlocal at
        at += len(xy)
        return moved[at - len(xy) : at]

    for s in found:
        if s is None:
            out.append(None)
            continue
        kind, parts = s
        out.append(shapes.write_wkb((kind, next_like(parts) if kind == shapes.POINT else [next_like(x) for x in parts] if kind == shapes.LINE else [[next_like(r) for r in p] for p in parts])))
    return out
