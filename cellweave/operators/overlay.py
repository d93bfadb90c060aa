"""Overlay of polygons as joins over their edges: union, repair, intersection and difference, at any size of a polygon.

Nothing here holds a polygon, let alone a class of them, in one place. Coordinates are whole numbers of a fine grain.

1. Edges are nodded tile by tile: pairs that meet give split points, and a grouped pass cuts each edge at its own.
2. Equal edges become one, with the sum of what they change: how many polygons more lie to the left of it than to the right.
3. The number of polygons on the right of an edge is counted along a path: from the far east to the corner of the edge's tile, a running sum
   over tiles of one row, and from there to the middle of the edge, a join within the tile. All tests are signs of whole
   numbers, so they can't contradict each other.
4. Edges with the wanted faces on one side only are the result's outline. They are walked within tiles; what runs on over the tiles'
   borders is matched by the edges that cross them, as links of chains, and only the chains of one ring ever meet.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.geo import shapes
from cellweave.operators.components import connected_components
from cellweave.operators.spatial_join import box_join, with_box
from cellweave.storage import written

#: Coordinates are whole millimetres, and tiles 500 m wide.
GRAIN = 1e-3
TILE = 500_000
#: Rings of more edges than this in one polygon are taken for tangled without a look; the result is the same.
LOOK = 1500
#: Rounds of noding: each lets edges meet in rounded points; two mostly do.
ROUNDS = 12
_XY = ("x1", "y1", "x2", "y2")


# ---- polygons to edges ----


def convex(ring: np.ndarray) -> bool:
    """Whether a closed ring turns to one side at every vertex, and goes round once."""
    d = np.diff(ring.astype(np.float64), axis=0)
    turn = d[:, 0] * np.roll(d[:, 1], -1) - d[:, 1] * np.roll(d[:, 0], -1)
    if not ((turn > 0).all() or (turn < 0).all()):
        return False
    way = np.sign(d[d[:, 0] != 0, 0])
    return int((way != np.roll(way, -1)).sum()) == 2


def tangled(rings: list[np.ndarray]) -> bool:
    """Whether edges of the closed rings meet anywhere but where one ring's neighbours do, or two rings touch in a vertex of both."""
    if len(rings) == 1 and convex(rings[0]):
        return False
    a, b = np.concatenate([r[:-1] for r in rings]).astype(np.float64), np.concatenate([r[1:] for r in rings]).astype(np.float64)
    if len(a) > LOOK or any(len(np.unique(r[:-1], axis=0)) < len(r) - 1 for r in rings):
        return True
    cross = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    p, q = a[:, None], b[:, None]
    low, high = np.minimum(a, b), np.maximum(a, b)
    near = ((low[:, None] <= high) & (low <= high[:, None])).all(axis=-1)
    c, d = cross(p, q, a), cross(p, q, b)
    proper = near & (c * d < 0) & (c * d < 0).T
    within = lambda r, side: (side == 0) & (r >= low[:, None]).all(axis=-1) & (r <= high[:, None]).all(axis=-1) & (r != p).any(axis=-1) & (r != q).any(axis=-1)
    same = (a == q).all(axis=-1) & (b == p).all(axis=-1) | ((a == p).all(axis=-1) & (b == q).all(axis=-1) & ~np.eye(len(a), dtype=bool))
    return bool(proper.any() or within(a, c).any() or within(b, d).any() or same.any())


def whole_rings(raw: bytes | None, grain: float) -> list[np.ndarray]:
    """The rings of a polygon in whole grains, without repeated points; rings of less than three points go."""
    shape = shapes.read_wkb(raw)
    out = []
    for ring in (r for part in (shape[1] if shape and shape[0] == shapes.POLYGON else []) for r in part):
        own = np.round(ring / grain).astype(np.int64)
        own = own[np.r_[True, (np.diff(own, axis=0) != 0).any(axis=1)]]
        if len(own) > 1 and (own[0] != own[-1]).any():
            own = np.vstack([own, own[:1]])
        if len(own) > 3:
            out.append(own)
    return out


def inside_left(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Untangled rings turned so that the inside by the even-odd rule is on their left."""
    out = []
    for k, ring in enumerate(rings):
        middle = (ring[:1] + ring[1:2]) / 2
        depth = sum(bool(shapes._inside_ring(r.astype(np.float64), middle)[0]) for j, r in enumerate(rings) if j != k)
        out.append(ring if (shapes._ring_sum(ring.astype(np.float64)) > 0) == (depth % 2 == 0) else ring[::-1])
    return out


def _edges(grain: float):
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, parts, knots = [], [], []
            for k, raw in enumerate(batch.column("geom").to_pylist()):
                rings = whole_rings(raw, grain)
                if rings:
                    knot = tangled(rings)
                    xy = np.concatenate([np.hstack([r[:-1], r[1:]]) for r in (rings if knot else inside_left(rings))])
                    rows += [k] * len(xy)
                    knots += [knot] * len(xy)
                    parts.append(xy)
            xy = np.concatenate([*parts, np.empty((0, 4), np.int64)])
            others = [n for n in batch.schema.names if n != "geom"]
            arrays = [batch.column(n).take(pa.array(rows, pa.int64())) for n in others] + [pa.array(xy[:, i]) for i in range(4)] + [pa.array(knots, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*others, *_XY, "tangled"])

    return edges


def _typed_names(df: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def _forward(edges: DataFrame, *weights: str) -> DataFrame:
    """Edges in the direction of growing x, of growing y where x stays; a turned edge changes the sign of its weights."""
    turn = F.struct("x1", "y1") > F.struct("x2", "y2")
    ends = {c: F.when(turn, F.col(o)).otherwise(F.col(c)) for c, o in zip(_XY, ("x2", "y2", "x1", "y1"), strict=True)}
    return edges.withColumns(ends | {w: F.when(turn, -F.col(w)).otherwise(F.col(w)) for w in weights})


def _merged(edges: DataFrame, parity: bool) -> DataFrame:
    """One edge for all equal ones; what cancels goes. With ``parity`` only odd numbers stay, as one."""
    one = edges.where("x1 <> x2 or y1 <> y2").groupBy("k", *_XY).agg(F.sum("wa").alias("wa"), F.sum("wb").alias("wb"))
    if parity:
        return one.withColumns({w: F.pmod(F.col(w), F.lit(2)) for w in ("wa", "wb")}).where("wa <> 0 or wb <> 0")
    return one.where("wa <> 0 or wb <> 0")


# ---- noding ----


def _over_tiles(edges: DataFrame, tile: int) -> DataFrame:
    """A row for each tile (``tx``, ``ty``) that an edge comes near, row of tiles by row of tiles."""
    rows = edges.withColumn("ty", F.explode(F.sequence(F.floor((F.least("y1", "y2") - 1) / tile), F.floor((F.greatest("y1", "y2") + 1) / tile))))

    def at(y: Column) -> Column:
        along = (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0))
        return F.col("x1") + F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)) * (F.col("x2") - F.col("x1"))

    low, high = at(F.col("ty") * tile - 2.0), at((F.col("ty") + 1) * tile + 2.0)
    level = F.col("y1") == F.col("y2")
    left = F.when(level, F.col("x1")).otherwise(F.least(low, high))
    right = F.when(level, F.col("x2")).otherwise(F.greatest(low, high))
    return rows.withColumn("tx", F.explode(F.sequence(F.floor((left - 2) / tile), F.floor((right + 2) / tile))))


def _cross(ax, ay, bx, by, px, py) -> Column:
    d = lambda p, q: (p - q).cast("double")
    return d(bx, ax) * d(py, ay) - d(by, ay) * d(px, ax)


def _split_points(edges: DataFrame, tile: int) -> DataFrame:
    """``k``, an edge, and a point (``px``, ``py``) at which it is cut; ``exact`` where the point lies on it precisely."""
    tiles = _over_tiles(edges.select("k", *_XY), tile)
    other = tiles.withColumnsRenamed({c: f"o{c}" for c in _XY})
    e, f = [F.col(c) for c in _XY], [F.col(f"o{c}") for c in _XY]
    (ax, ay, bx, by), (cx, cy, dx, dy) = e, f
    meet = (F.struct(*e) < F.struct(*f)) & (cx <= bx + 1) & (ax <= dx + 1) & (F.least(cy, dy) <= F.greatest(ay, by) + 1) & (F.least(ay, by) <= F.greatest(cy, dy) + 1)
    pairs = tiles.join(other.hint("merge"), ["k", "tx", "ty"]).where(meet)
    c, d, a, b = _cross(ax, ay, bx, by, cx, cy), _cross(ax, ay, bx, by, dx, dy), _cross(cx, cy, dx, dy, ax, ay), _cross(cx, cy, dx, dy, bx, by)
    pairs = pairs.withColumns({"c_": c, "d_": d, "a_": a, "b_": b})
    proper = (F.col("c_") * F.col("d_") < 0) & (F.col("a_") * F.col("b_") < 0)
    t = F.col("a_") / F.nullif(F.col("a_") - F.col("b_"), F.lit(0.0))
    px, py = F.round(ax + t * (bx - ax)).cast("long"), F.round(ay + t * (by - ay)).cast("long")
    hit = (F.abs(_cross(ax, ay, bx, by, px, py)) == 0) & (F.abs(_cross(cx, cy, dx, dy, px, py)) == 0)

    def passes(side: str, line, x, y) -> Column:
        """Whether a vertex's square of one grain is passed by a line that doesn't end there."""
        x1, y1, x2, y2 = line
        close = F.abs(F.col(side)) <= (F.abs(x2 - x1) + F.abs(y2 - y1)) / 2
        return close & (x >= x1) & (x <= x2) & (y >= F.least(y1, y2)) & (y <= F.greatest(y1, y2)) & ~((x == x1) & (y == y1)) & ~((x == x2) & (y == y2))

    def cut(line, x, y, when, exact) -> Column:
        return F.when(when, F.struct(*[v.alias(n) for v, n in zip(line, _XY, strict=True)], x.alias("px"), y.alias("py"), exact.alias("exact")))

    at_end = lambda line, x, y: ((x == line[0]) & (y == line[1])) | ((x == line[2]) & (y == line[3]))
    cuts = [
        cut(e, px, py, proper & ~at_end(e, px, py), hit),
        cut(f, px, py, proper & ~at_end(f, px, py), hit),
        cut(e, cx, cy, passes("c_", e, cx, cy), F.col("c_") == 0),
        cut(e, dx, dy, passes("d_", e, dx, dy), F.col("d_") == 0),
        cut(f, ax, ay, passes("a_", f, ax, ay), F.col("a_") == 0),
        cut(f, bx, by, passes("b_", f, bx, by), F.col("b_") == 0),
    ]
    # A crossing whose rounded point is the end of one edge still has to move the other one there, and is looked at again.
    return pairs.select("k", F.explode(F.filter(F.array(*cuts), lambda x: x.isNotNull())).alias("s")).select("k", "s.*").distinct()


def noded(edges: DataFrame, tile: int = TILE, parity: bool = False) -> DataFrame:
    """``edges`` (``k``, ends, ``wa``, ``wb``) cut so that those of one ``k`` meet in their ends only; equal ones are merged.

    Points that had to be rounded move edges by less than a grain, so noding is repeated until none is found.
    """
    now = written(_merged(edges, parity), "edges")
    for _ in range(ROUNDS):
        points = written(_split_points(now, tile), "split-points")
        state = points.agg(F.count("*").alias("n"), F.min("exact").alias("exact")).first()
        if not state["n"]:
            break
        both = now.select("k", *_XY, "wa", "wb", F.lit(None).cast("struct<px: bigint, py: bigint>").alias("p")).unionByName(points.select("k", *_XY, F.lit(None).cast("long").alias("wa"), F.lit(None).cast("long").alias("wb"), F.struct("px", "py").alias("p")))
        cut = both.groupBy("k", *_XY).agg(F.max("wa").alias("wa"), F.max("wb").alias("wb"), F.collect_set("p").alias("ps"))
        along = lambda p: (p["px"] - F.col("x1")) * (F.col("x2") - F.col("x1")).cast("double") + (p["py"] - F.col("y1")) * (F.col("y2") - F.col("y1")).cast("double")
        inner = F.transform(F.sort_array(F.transform("ps", lambda p: F.struct(along(p).alias("t"), p["px"].alias("x"), p["py"].alias("y")))), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
        chain = cut.withColumn("c", F.concat(F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y"))), inner, F.array(F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))))
        step = chain.select("k", "wa", "wb", F.explode(F.arrays_zip(F.slice("c", F.lit(1), F.size("c") - 1).alias("u"), F.slice("c", F.lit(2), F.size("c") - 1).alias("v"))).alias("s"))
        parts = step.select("k", F.col("s.u.x").alias("x1"), F.col("s.u.y").alias("y1"), F.col("s.v.x").alias("x2"), F.col("s.v.y").alias("y2"), "wa", "wb")
        now = written(_merged(_forward(parts) if parity else _forward(parts, "wa", "wb"), parity), "edges")
        if state["exact"]:
            break
    return now


# ---- which edges bound the result ----


def outline(edges: DataFrame, inside: Callable[[Column, Column], Column], tile: int = TILE) -> DataFrame:
    """The directed edges (``k``, ends) of noded ``edges`` that have ``inside(a, b)`` on their left only, a and b the numbers of polygons over a face."""
    w = ("wa", "wb")
    floor = lambda v: F.floor(v / tile)
    up = F.col("y2") > F.col("y1")
    # Where an edge crosses the bottom line of a row of tiles, which lies a quarter of a grain below whole numbers.
    line = F.explode(F.when(floor(F.least("y1", "y2")) < floor(F.greatest("y1", "y2")), F.sequence(floor(F.least("y1", "y2")) + 1, floor(F.greatest("y1", "y2")))))
    met = F.col("x1") + (F.col("ty") * tile - 0.25 - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    crossings = edges.withColumn("ty", line).select("k", "ty", F.floor((met + 0.25) / tile).alias("tx"), *[F.when(up, F.col(x)).otherwise(-F.col(x)).alias(x) for x in w])
    mids = edges.withColumns({"mx": F.col("x1") + F.col("x2"), "my": F.col("y1") + F.col("y2")}).withColumns({"tx": F.floor(F.col("mx") / (2 * tile)), "ty": F.floor(F.col("my") / (2 * tile))})
    wanted = mids.select("k", "ty", "tx").distinct().select("*", F.lit(0).cast("long").alias("wa"), F.lit(0).cast("long").alias("wb"))
    from_east = W.partitionBy("k", "ty").orderBy(F.desc("tx"))
    corner = crossings.unionByName(wanted).groupBy("k", "ty", "tx").agg(*[F.sum(x).alias(x) for x in w]).select("k", "ty", "tx", *[F.sum(x).over(from_east).alias(x) for x in w])

    # From the corner of the tile along its bottom line, then up to the middle of the edge; in quarters of a grain.
    near = _over_tiles(edges, tile).withColumns({"met": F.floor((met_at(tile) + 0.25) / tile)})
    e = [4 * F.col(c) for c in _XY]
    m = mids.select("k", "tx", "ty", *[F.col(c).alias(f"m{c}") for c in _XY], (2 * F.col("mx")).alias("mx"), (2 * F.col("my")).alias("my"))
    bottom = 4 * F.col("ty") * tile - 1
    below, above = _cross(*e, F.col("mx"), bottom), _cross(*e, F.col("mx"), F.col("my"))
    eastward = (F.least(e[1], e[3]) < bottom) & (F.greatest(e[1], e[3]) > bottom) & (F.col("met") == F.col("tx")) & F.when(up, below <= 0).otherwise(below >= 0)
    upward = (e[0] <= F.col("mx")) & (F.col("mx") < e[2]) & F.when(up, below <= 0).otherwise(below < 0) & (above > 0)
    pairs = m.join(near.hint("merge"), ["k", "tx", "ty"]).where(eastward | upward)
    step = F.when(eastward, F.when(up, -1).otherwise(1)).otherwise(0) + F.when(upward, 1).otherwise(0)
    own = [F.col(f"m{c}").alias(c) for c in _XY]
    zero = F.lit(0).cast("long")
    counted = (
        pairs.select("k", *own, *[(step * F.col(x)).cast("long").alias(f"r{x}") for x in w], zero.alias("wa"), zero.alias("wb"))
        .unionByName(m.join(corner.hint("merge"), ["k", "tx", "ty"]).select("k", *own, *[F.col(x).alias(f"r{x}") for x in w], zero.alias("wa"), zero.alias("wb")))
        .unionByName(edges.select("k", *_XY, zero.alias("rwa"), zero.alias("rwb"), "wa", "wb"))
    )
    sides = counted.groupBy("k", *_XY).agg(*[F.sum(x).alias(x) for x in ("rwa", "rwb", "wa", "wb")])
    left, right = inside(F.col("rwa") + F.col("wa"), F.col("rwb") + F.col("wb")), inside(F.col("rwa"), F.col("rwb"))
    kept = sides.where(left != right).withColumn("turn", right)
    return kept.select("k", *[F.when(F.col("turn"), F.col(o)).otherwise(F.col(c)).alias(c) for c, o in zip(_XY, ("x2", "y2", "x1", "y1"), strict=True)])


def met_at(tile: int) -> Column:
    """Where an edge crosses the bottom line of the tile row ``ty``; null for level edges."""
    return F.col("x1") + (F.col("ty") * tile - 0.25 - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0)) * (F.col("x2") - F.col("x1"))


# ---- outlines to rings ----


def walked(edges: np.ndarray, here: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Closed rings, and open chains of vertices, from directed edges of which some ends are not ``here`` (n x 2).

    A chain begins with the vertex before and ends with the vertex behind the ones that are here. Where several edges leave a vertex, the
    leftmost goes on, so that faces that touch in a corner stay apart.
    """
    leaving: dict[tuple[int, int], list[int]] = {}
    for k in np.flatnonzero(here[:, 0]):
        leaving.setdefault((edges[k, 0], edges[k, 1]), []).append(k)

    def following(k: int) -> int:
        ways = leaving[edges[k, 2], edges[k, 3]]
        if len(ways) == 1:
            return ways[0]
        came = np.arctan2(*(edges[k, :2] - edges[k, 2:])[::-1].astype(np.float64))
        return min(ways, key=lambda j: (came - np.arctan2(*(edges[j, 2:] - edges[j, :2])[::-1].astype(np.float64))) % (2 * np.pi) or 2 * np.pi)

    used, rings, chains = np.zeros(len(edges), bool), [], []
    entering = np.flatnonzero(~here[:, 0])
    for k in [*entering, *np.flatnonzero(here[:, 0] & here[:, 1])]:
        if used[k]:
            continue
        path, at = [k], k
        used[k] = True
        while here[at, 1]:
            at = following(at)
            if at == k:
                break
            used[at] = True
            path.append(at)
        own = edges[path]
        if here[at, 1]:
            rings.append(np.vstack([own[:, :2], own[:1, :2]]))
        else:
            chains.append(np.vstack([own[:, :2], own[-1:, 2:]]))
    return rings, chains


def simple_loops(ring: np.ndarray) -> list[np.ndarray]:
    """A closed ring taken apart where it comes back to a vertex."""
    out, path, place = [], [], {}
    for p in map(tuple, ring.tolist()):
        if p in place:
            start = place[p]
            loop = [*path[start:], p]
            for q in path[start + 1 :]:
                del place[q]
            del path[start + 1 :]
            if len(loop) > 3:
                out.append(np.array(loop))
        else:
            place[p] = len(path)
            path.append(p)
    return out


def _end(a: np.ndarray, b: np.ndarray) -> str:
    return f"{a[0]},{a[1]},{b[0]},{b[1]}"


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[pa.Array]]]:
    """The groups of sorted batches: their keys, the first ``n_keys`` columns, and the other columns. A group is held at a time."""
    key, held = None, []
    for batch in batches:
        keys = list(zip(*(c.to_pylist() for c in batch.columns[:n_keys]), strict=True))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
            if keys[a] != key:
                if held:
                    yield key, [pa.chunked_array(c).combine_chunks() for c in zip(*held, strict=True)]
                key, held = keys[a], []
            held.append([c.slice(a, b - a) for c in batch.columns[n_keys:]])
    if held:
        yield key, [pa.chunked_array(c).combine_chunks() for c in zip(*held, strict=True)]


def _rows(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    for part in itertools.batched(rows, size):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _grouped(df: DataFrame, keys: list[str], f: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """``f(key, *columns)`` gives the rows of each group; groups meet sorted in a task, one after the other."""
    arrow = pa.schema([(n, {"string": pa.string(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in schema.split(", "))])
    sorted_ = df.select(*keys, *[c for c in df.columns if c not in keys]).repartition(*keys).sortWithinPartitions(*keys)
    return sorted_.mapInArrow(lambda batches: _rows((row for key, columns in _groups(batches, len(keys)) for row in f(key, *columns)), arrow), schema)


def _tile_walk(tile: int):
    def walk(key: tuple, *columns: pa.Array) -> Iterator[tuple]:
        k, tx, ty = key
        xy = np.stack([c.to_numpy() for c in columns], axis=1)
        here = np.stack([(xy[:, i] // tile == tx) & (xy[:, i + 1] // tile == ty) for i in (0, 2)], axis=1)
        rings, chains = walked(xy, here)
        for r in rings:
            yield k, None, None, r.tobytes()
        for c in chains:
            yield k, _end(*c[:2]), _end(*c[-2:]), c[1:].tobytes()

    return walk


def _joined(key: tuple, heads: pa.Array, tails: pa.Array, xys: pa.Array) -> Iterator[tuple]:
    """The ring of a group of chains: each goes on with the one whose head is its tail. A chain ends with the first vertex of the next."""
    start = {h: (t, np.frombuffer(xy, np.int64).reshape(-1, 2)) for h, t, xy in zip(heads.to_pylist(), tails.to_pylist(), xys.to_pylist(), strict=True)}
    while start:
        first = at = next(iter(start))
        parts = []
        while at in start:
            at, xy = start.pop(at)
            parts.append(xy[:-1])
        if at != first:
            raise ValueError(f"an outline does not close at {at}")
        ring = np.concatenate(parts)
        yield key[0], np.vstack([ring, ring[:1]]).tobytes()


def _loops(grain: float):
    def loops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, xy in zip(batch.column("k").to_pylist(), batch.column("xy").to_pylist(), strict=True):
                for loop in simple_loops(np.frombuffer(xy, np.int64).reshape(-1, 2)):
                    twice = sum(map(int, (loop[:-1, 0] - loop[0, 0]) * (loop[1:, 1] - loop[0, 1]) - (loop[1:, 0] - loop[0, 0]) * (loop[:-1, 1] - loop[0, 1])))
                    at = int(np.lexsort((loop[:-1, 1], loop[:-1, 0]))[0])
                    loop = np.vstack([loop[at:-1], loop[:at], loop[at : at + 1]])
                    mid = (loop[0] + loop[1]) / 2 * grain
                    if twice:
                        rows.append({"k": k, "ring": _end(*loop[:2]), "size": abs(twice) * grain * grain / 2, "outer": twice > 0, "mid_x": float(mid[0]), "mid_y": float(mid[1]), "geom": shapes.write_wkb((shapes.POLYGON, [[loop * grain]]))})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("k", pa.string()), ("ring", pa.string()), ("size", pa.float64()), ("outer", pa.bool_()), ("mid_x", pa.float64()), ("mid_y", pa.float64()), ("geom", pa.binary())]))

    return loops


def _with_holes():
    def build(outer: pd.Series, holes: pd.Series) -> pd.Series:
        rings = lambda raw: shapes.read_wkb(bytes(raw))[1][0]
        return pd.Series([shapes.write_wkb((shapes.POLYGON, [[*rings(o), *(r for h in hs for r in rings(h))]])) for o, hs in zip(outer, holes, strict=True)], dtype=object)

    build.__annotations__ = {"outer": pd.Series, "holes": pd.Series, "return": pd.Series}
    return F.pandas_udf(build, "binary")


def polygons_of(edges: DataFrame, tile: int = TILE, grain: float = GRAIN) -> DataFrame:
    """``k`` and ``geom``: a row per polygon, with its holes, that the directed outline ``edges`` bound."""
    edges = written(edges, "outline")
    tiles = [F.struct(F.floor(F.col(x) / tile).alias("tx"), F.floor(F.col(y) / tile).alias("ty")) for x, y in (("x1", "y1"), ("x2", "y2"))]
    placed = edges.withColumn("t", F.explode(F.array_distinct(F.array(*tiles)))).select("k", "t.tx", "t.ty", *_XY)
    walks = written(_grouped(placed, ["k", "tx", "ty"], _tile_walk(tile), "k string, head string, tail string, xy binary"), "walks")
    chains = walks.where("head is not null")
    full = lambda c: F.concat("k", F.lit("|"), c)
    rings = connected_components(chains.select(full("head").alias("a"), full("tail").alias("b")))
    grouped = chains.withColumn("node", full("head")).join(rings.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    closed = _grouped(grouped.select("k", "component", "head", "tail", "xy"), ["k", "component"], _joined, "k string, xy binary")
    loops = written(walks.where("head is null").select("k", "xy").unionByName(closed).mapInArrow(_loops(grain), "k string, ring string, size double, outer boolean, mid_x double, mid_y double, geom binary"), "rings")
    outers, holes = loops.where("outer"), loops.where("not outer")
    spots = holes.select("k", F.col("ring").alias("hole"), "mid_x", "mid_y", F.col("geom").alias("hole_geom"), *[F.col(f"mid_{v[0]}").alias(v) for v in ("xmin", "ymin", "xmax", "ymax")])
    held = box_join(spots, with_box(outers.select("k", "ring", "size", "geom"), "geom"), 20 * tile * grain, on=["k"]).where(S.st_contains("geom", "mid_x", "mid_y"))
    own = held.groupBy("k", "hole").agg(F.min(F.struct("size", "ring"))["ring"].alias("ring"))
    parts = own.join(holes.select("k", F.col("ring").alias("hole"), F.col("geom").alias("hole_geom")), ["k", "hole"]).groupBy("k", "ring").agg(F.sort_array(F.collect_list("hole_geom")).alias("holes"))
    built = outers.select("k", "ring", "geom").join(parts, ["k", "ring"], "left")
    return built.select("k", F.when(F.col("holes").isNull(), F.col("geom")).otherwise(_with_holes()("geom", F.coalesce("holes", F.array().cast("array<binary>")))).alias("geom"))


# ---- the operations ----


def _keyed(df: DataFrame, key: list[str], geom: str, **weights: int) -> DataFrame:
    """``k`` (the key columns as JSON, so that null is a key like any other), ``geom`` and the weights."""
    return df.where(F.col(geom).isNotNull()).select(F.to_json(F.struct(*key)).alias("k"), F.col(geom).alias("geom"), *[F.lit(v).cast("long").alias(n) for n, v in weights.items()])


def _edges_of(rows: DataFrame, grain: float) -> DataFrame:
    names = [c for c in rows.columns if c != "geom"]
    return rows.mapInArrow(_edges(grain), f"{_typed_names(rows, *names)}, x1 bigint, y1 bigint, x2 bigint, y2 bigint, tangled boolean")


def _untangled(rows: DataFrame, tile: int, grain: float) -> DataFrame:
    """Edges with the inside on their left, of valid polygons or any others by the even-odd rule. ``rows``: k, geom, wa, wb."""
    numbered = rows.withColumn("row", F.sha2(F.concat_ws("|", F.sha2("geom", 256), "k", "wa", "wb"), 256))
    edges = written(_edges_of(numbered, grain), "polygon-edges")
    plain = edges.where("not tangled").select("k", *_XY, "wa", "wb")
    knots = edges.where("tangled")
    if knots.isEmpty():
        return _forward(plain, "wa", "wb")
    # Equal rows would cancel, so each distinct polygon is repaired once and its edges counted as often as it occurs.
    once = knots.select(F.col("row").alias("k"), *_XY, F.lit(1).cast("long").alias("wa"), F.lit(0).cast("long").alias("wb"))
    times = numbered.join(knots.select("row").distinct(), "row", "left_semi").groupBy("row").agg(F.first("k").alias("k"), F.sum("wa").alias("wa"), F.sum("wb").alias("wb"), F.count("*").alias("n"))
    single = once.groupBy("k", *_XY).agg(F.count("*").alias("wa"), F.lit(0).cast("long").alias("wb"))
    shares = single.join(times.select(F.col("row").alias("k"), "n"), "k").withColumn("wa", F.expr("wa div n")).drop("n")
    repaired = outline(noded(_forward(shares), tile, parity=True), lambda a, _: F.pmod(a, F.lit(2)) == 1, tile)
    fixed = repaired.withColumnRenamed("k", "row").join(times.select("row", "k", "wa", "wb"), "row").select("k", *_XY, "wa", "wb")
    return _forward(plain.unionByName(fixed), "wa", "wb")


def _overlaid(rows: DataFrame, inside: Callable[[Column, Column], Column], tile: int, grain: float) -> DataFrame:
    return polygons_of(outline(noded(_untangled(rows, tile, grain), tile), inside, tile), tile, grain)


def _named(out: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    parsed = out.withColumn("k", F.from_json("k", source.select(*key).schema))
    return parsed.select(*[F.col("k")[c].alias(c) for c in key], "geom")


def union(polygons: DataFrame, key: list[str], geom: str = "geom", tile: int = TILE, grain: float = GRAIN) -> DataFrame:
    """The union of each key's polygons, dumped: a row (key columns, ``geom``) per polygon of it.

    Polygons may overlap, contain or touch each other, and have vertices in the middle of others' edges; an invalid one counts as what
    the even-odd rule makes of it. Parts that touch in corners only stay apart. Null keys are a key, null and empty
    geometries count for nothing, and repeated rows change nothing. Coordinates are rounded to ``grain``.
    """
    return _named(_overlaid(_keyed(polygons, key, geom, wa=1, wb=0), lambda a, _: a > 0, tile, grain), polygons, key)


def make_valid(polygons: DataFrame, key: list[str], geom: str = "geom", tile: int = TILE, grain: float = GRAIN) -> DataFrame:
    """The valid polygons that each key's polygon makes by the even-odd rule, a row each: crossings become corners, spikes and doubled edges go.

    ``key`` identifies the rows; rows of one key are taken together, as parts of one polygon, equal ones once. A polygon without an area gives no row.
    """
    edges = _edges_of(_keyed(polygons, key, geom, wa=1, wb=0).dropDuplicates(["k", "geom"]), grain)
    odd = noded(_forward(edges.select("k", *_XY, "wa", "wb")).withColumn("wa", F.lit(1).cast("long")), tile, parity=True)
    return _named(polygons_of(outline(odd, lambda a, _: F.pmod(a, F.lit(2)) == 1, tile), tile, grain), polygons, key)


def _two(pairs: DataFrame, key: list[str], one: str, other: str, inside, tile: int, grain: float) -> DataFrame:
    rows = _keyed(pairs, key, one, wa=1, wb=0).unionByName(_keyed(pairs, key, other, wa=0, wb=1))
    return _named(_overlaid(rows, inside, tile, grain), pairs, key)


def intersection(pairs: DataFrame, key: list[str], one: str, other: str, tile: int = TILE, grain: float = GRAIN) -> DataFrame:
    """What both polygons of each row cover, a row (key columns, ``geom``) per polygon of it; pairs that only touch give none.

    ``key`` identifies the pairs. Rows of one key count as the union of their polygons on either side.
    """
    return _two(pairs, key, one, other, lambda a, b: (a > 0) & (b > 0), tile, grain)


def difference(pairs: DataFrame, key: list[str], one: str, other: str, tile: int = TILE, grain: float = GRAIN) -> DataFrame:
    """What the first polygon of each row covers and the second doesn't, as :func:`intersection` gives it."""
    return _two(pairs, key, one, other, lambda a, b: (a > 0) & (b == 0), tile, grain)
