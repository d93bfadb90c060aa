"""Walk catchments: the convex hull of the network nodes within a walking distance of each place.

A place can only reach edges that lie within the radius as the crow flies, so each place gets the edges near it
through a tile join, and the shortest paths are searched in that small graph; the network is never held whole.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.geo import shapes
from cellweave.operators.relational import best_per_group, distinct_on
from cellweave.operators.spatial_join import box_join
from cellweave.storage import written

#: Metres: ten minutes at five kilometres an hour.
RADIUS = 10 * 5000 / 60


def graph_edges(roads: DataFrame) -> DataFrame:
    """``u, v, length``: undirected edges of positive length; of parallel ones the shortest."""
    kept = roads.where((F.col("length") > 0) & F.col("start_node").isNotNull() & F.col("end_node").isNotNull())
    return kept.groupBy(F.least("start_node", "end_node").alias("u"), F.greatest("start_node", "end_node").alias("v")).agg(F.min("length").alias("length"))


def graph_nodes(roads: DataFrame) -> DataFrame:
    """``node, x, y`` from the ends of the links; of several positions the least."""
    ends = roads.select(F.col("start_node").alias("node"), S.st_start("geom").alias("at")).union(roads.select(F.col("end_node").alias("node"), S.st_end("geom").alias("at")))
    return distinct_on(ends.where("node is not null and at is not null").select("node", F.col("at")[0].alias("x"), F.col("at")[1].alias("y")), ["node"])


def _points(df: DataFrame, x: str, y: str, grow: float = 0.0) -> DataFrame:
    return df.withColumns({"xmin": F.col(x) - grow, "ymin": F.col(y) - grow, "xmax": F.col(x) + grow, "ymax": F.col(y) + grow})


def nearest_node(places: DataFrame, nodes: DataFrame, first: float = 500.0, rounds: int = 12) -> DataFrame:
    """``place, node``: the nearest node however far, ties by the smaller node. The search widens fourfold for places still without."""
    left, found, reach = places.select("place", "px", "py").where("px is not null and py is not null"), None, first
    for _ in range(rounds):
        pairs = box_join(_points(left, "px", "py", reach), _points(nodes, "x", "y"), tile=2 * reach)
        away = F.sqrt((F.col("px") - F.col("x")) ** 2 + (F.col("py") - F.col("y")) ** 2)
        near = pairs.withColumn("away", away).where(F.col("away") <= reach)
        own = written(best_per_group(near, ["place"], [F.asc("away"), F.asc("node")]).select("place", "node"), "snapped")
        found = own if found is None else found.union(own)
        left = written(left.join(own, "place", "left_anti"), "unsnapped")
        reach *= 4
        if left.isEmpty():
            break
    return found


def _reached(radius: float, schema_place: str):
    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        near: dict = {}
        at: dict = {}
        for u, v, w, ux, uy, vx, vy in frame[["u", "v", "length", "ux", "uy", "vx", "vy"]].itertuples(index=False):
            if isinstance(u, str) or u == u:
                near.setdefault(u, []).append((v, w))
                near.setdefault(v, []).append((u, w))
                at[u], at[v] = (ux, uy), (vx, vy)
        source = frame["node"].iloc[0]
        at.setdefault(source, (frame["nx"].iloc[0], frame["ny"].iloc[0]))
        done, queue = {}, [(0.0, str(source), source)]
        while queue:
            d, _, node = heapq.heappop(queue)
            if node in done:
                continue
            done[node] = d
            for other, w in near.get(node, []):
                if other not in done and d + w <= radius:
                    heapq.heappush(queue, (d + w, str(other), other))
        hull = shapes.convex_hull([at[n] for n in done])
        return pd.DataFrame({"place": [frame["place"].iloc[0]], "isochrone": [shapes.write_wkb(hull)], "n_nodes": [len(done)]})

    return walk


def isochrones(places: DataFrame, edges: DataFrame, nodes: DataFrame, radius: float = RADIUS) -> DataFrame:
    """``place, isochrone, n_nodes, area_km2`` for places ``place, px, py``; an isolated node gives a point of area zero."""
    snapped = nearest_node(places, nodes).join(nodes.select("node", F.col("x").alias("nx"), F.col("y").alias("ny")), "node")
    ends = edges.join(nodes.select(F.col("node").alias("u"), F.col("x").alias("ux"), F.col("y").alias("uy")), "u").join(nodes.select(F.col("node").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy")), "v")
    boxed = ends.withColumns({"xmin": F.least("ux", "vx"), "ymin": F.least("uy", "vy"), "xmax": F.greatest("ux", "vx"), "ymax": F.greatest("uy", "vy")})
    around = box_join(_points(snapped.select("place", F.col("nx").alias("sx"), F.col("ny").alias("sy")), "sx", "sy", radius), boxed).drop("sx", "sy")
    local = snapped.join(around, "place", "left")
    kind = places.schema["place"].dataType.simpleString()
    hulls = local.groupBy("place").applyInPandas(_reached(radius, kind), f"place {kind}, isochrone binary, n_nodes long")
    return hulls.withColumn("area_km2", S.st_area("isochrone") / 1e6)
