"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.storage import written

#: Links between numbers up to which the least neighbours (a row per node, two numbers each) are broadcast. Texts are joined by a shuffle: rounds of
#: broadcasts of wide rows add up on the driver.
FEW_LINKS = 200_000


def _lowest(arcs: DataFrame, few: bool) -> DataFrame:
    """Each node's smallest neighbour or itself. The minimum combines map-side, so a hub costs one row a task.

    Of many links the result is written: a join with a written table has no aggregation in its stage, so Spark may split a
    hub's partition.
    """
    low = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return F.broadcast(low) if few else written(low, "least-neighbours").hint("merge")


def _large_star(edges: DataFrame, few: bool) -> DataFrame:
    arcs = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return arcs.join(_lowest(arcs, few), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, few: bool) -> DataFrame:
    arcs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(arcs, few)
    return arcs.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns ``node`` and ``component`` (the smallest node reachable) of every node that occurs in ``links``.

    ``links`` holds one row per undirected link between nodes of any orderable type; loops, repeats and
    rows with a null end are ignored. Each round rewires nodes to smaller neighbours and is written to
    the shared folder; rounds grow with the logarithm of the longest chain, not with its length. An
    empty link table gives an empty result. Further columns are ignored.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = None
    narrow = not {"string", "binary"} & {kind for _, kind in edges.dtypes}
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or (now["n"], now["h"]) == state:
            break
        state = (now["n"], now["h"])
        few = narrow and now["n"] <= FEW_LINKS
        large = _large_star(edges, few).distinct()
        edges = written(_small_star(large if few else written(large, "links"), few).distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
