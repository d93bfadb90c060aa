"""Spatial joins as equi-joins on grid tiles, refined exactly.

Each side's bounding box is cut into square tiles; the sides meet tile by tile. A pair whose boxes share several
tiles is kept in one of them, the tile of the lower left corner of the boxes' intersection, so no distinct is
needed. Crowded tiles are split by Spark's adaptive skew join, for both sides are exchanged by the join alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.operators.relational import best_per_group

#: Metres; about twice the diameter of a cell at the coarsest resolution.
TILE = 2000.0


def with_box(df: DataFrame, geom: str, grow: float = 0.0) -> DataFrame:
    """``df`` with the bounds of ``geom``, grown on all sides; rows with a null or empty geometry go."""
    boxed = df.withColumn("box_", S.st_box(geom)).where("box_.xmin is not null")
    grown = {"xmin": F.col("box_.xmin") - grow, "ymin": F.col("box_.ymin") - grow, "xmax": F.col("box_.xmax") + grow, "ymax": F.col("box_.ymax") + grow}
    return boxed.withColumns(grown).drop("box_")


def _span(low: str, high: str, tile: float) -> Column:
    return F.sequence(F.floor(F.col(low) / tile), F.floor(F.col(high) / tile))


def box_join(left: DataFrame, right: DataFrame, tile: float = TILE, on: list[str] | None = None, keep: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """All pairs whose boxes (``xmin, ymin, xmax, ymax`` on both sides) meet, each once; the boxes go.

    Columns in ``on`` must be equal, too; the names of all others must differ between the sides. ``keep`` is a further condition
    on the gaps between the boxes in x and y, negative where they overlap.
    """
    box = ("xmin", "ymin", "xmax", "ymax")
    a = left.withColumnsRenamed({c: f"{c}_a_" for c in box})
    b = right.withColumnsRenamed({c: f"{c}_b_" for c in box})
    a = a.withColumn("tx_", F.explode(_span("xmin_a_", "xmax_a_", tile))).withColumn("ty_", F.explode(_span("ymin_a_", "ymax_a_", tile)))
    b = b.withColumn("tx_", F.explode(_span("xmin_b_", "xmax_b_", tile))).withColumn("ty_", F.explode(_span("ymin_b_", "ymax_b_", tile)))
    meet = "xmin_a_ <= xmax_b_ and xmin_b_ <= xmax_a_ and ymin_a_ <= ymax_b_ and ymin_b_ <= ymax_a_"
    own_tile = (F.floor(F.greatest("xmin_a_", "xmin_b_") / tile) == F.col("tx_")) & (F.floor(F.greatest("ymin_a_", "ymin_b_") / tile) == F.col("ty_"))
    pairs = a.join(b, [*(on or ()), "tx_", "ty_"]).where(meet).where(own_tile)
    if keep is not None:
        gap = lambda v: F.greatest(F.col(f"{v}min_a_") - F.col(f"{v}max_b_"), F.col(f"{v}min_b_") - F.col(f"{v}max_a_"))
        pairs = pairs.where(keep(gap("x"), gap("y")))
    return pairs.drop("tx_", "ty_", *[f"{c}_{s}_" for c in box for s in "ab"])


def with_shape(df: DataFrame, geom: str, shape: str) -> DataFrame:
    """``df`` with a text that stands for its geometry, equal for equal ones; rows with a null geometry go."""
    return df.where(F.col(geom).isNotNull()).withColumn(shape, F.md5(geom))


def shape_pairs(left: DataFrame, right: DataFrame, left_geom: str, right_geom: str, left_shape: str, right_shape: str, tile: float = TILE) -> DataFrame:
    """Both shapes and geometries of all pairs of distinct geometries whose boxes meet, of sides as ``with_shape`` gives them."""
    sides = (with_box(df.select(shape, geom).distinct(), geom) for df, geom, shape in ((left, left_geom, left_shape), (right, right_geom, right_shape)))
    return box_join(*sides, tile)


def intersecting(cells: DataFrame, features: DataFrame, cell_geom: str, geom: str, measure: str, tile: float = TILE, digits: int | None = None) -> DataFrame:
    """Pairs of convex cells and features that meet, touching included, with the feature's area or length in the cell, rounded if ``digits`` says so.

    A positive measure proves that they meet; only the rest are tested for touching. Equal cells and equal features are measured once, and
    the pairs of shapes that meet are then joined with the rows of either side: the rows grow with those of the result alone.
    """
    a, b = with_shape(cells, cell_geom, "shape_a_"), with_shape(features, geom, "shape_b_")
    measured = shape_pairs(a, b, cell_geom, geom, "shape_a_", "shape_b_", tile).withColumn(measure, S.st_overlap(cell_geom, geom))
    met = measured.where((F.col(measure) > 0) | S.st_intersects(cell_geom, geom)).select("shape_a_", "shape_b_", measure if digits is None else F.round(measure, digits).alias(measure))
    # Rows by cell and feature's shape may be many, so the last join is never by broadcast.
    return met.join(a, "shape_a_").join(b.drop(geom).hint("merge"), "shape_b_").select(*cells.columns, *[c for c in features.columns if c != geom], measure)


def best_overlap(cells: DataFrame, features: DataFrame, cell_geom: str, geom: str, code: str, tile: float = TILE) -> DataFrame:
    """``spatial_id, code``: for each cell the feature with the largest part in it, ties by the smaller code; cells without any go.

    Equal cells are measured once, with the smallest code of equal features.
    """
    own = cells.select("spatial_id", cell_geom)
    order = [F.desc("part_"), F.asc(code)]
    pairs = intersecting(own.select(cell_geom).distinct(), _least_of_equal(features, geom, code), cell_geom, geom, "part_", tile)
    best = best_per_group(pairs, [cell_geom], order)
    return best_per_group(own.join(best, cell_geom).drop(cell_geom), ["spatial_id"], order).select("spatial_id", code)


def _least_of_equal(features: DataFrame, geom: str, key: str) -> DataFrame:
    """``geom, key``: a row per distinct geometry with its smallest key, null before all others as in a sort."""
    return features.groupBy(geom).agg(F.min(F.struct(key))[key].alias(key))


def nearest_within(cells: DataFrame, features: DataFrame, cell_geom: str, geom: str, key: str, radius: float, tile: float = TILE) -> DataFrame:
    """``spatial_id, key, distance``: the nearest feature within ``radius`` (inclusive), a row per cell, nulls where there is none.

    Equal cells are measured once, to the smallest key of equal features.
    """
    # The features' boxes are grown by the radius, so a gap of less than minus the radius is that of the boxes themselves.
    away = lambda gap: F.greatest(gap + radius, F.lit(0.0))
    own, order = cells.select("spatial_id", cell_geom), [F.asc_nulls_last("distance"), F.asc(key)]
    pairs = box_join(with_box(own.select(cell_geom).distinct(), cell_geom), with_box(_least_of_equal(features, geom, key), geom, radius), tile, keep=lambda x, y: away(x) * away(x) + away(y) * away(y) <= radius * radius * (1 + 1e-12))
    near = pairs.withColumn("distance", S.st_distance(cell_geom, geom)).where(F.col("distance") <= radius).select(cell_geom, key, "distance")
    best = best_per_group(own.join(best_per_group(near, [cell_geom], order), cell_geom).select("spatial_id", key, "distance"), ["spatial_id"], order)
    return cells.select("spatial_id").distinct().join(best, "spatial_id", "left")


def containing(points: DataFrame, polygons: DataFrame, x: str, y: str, geom: str, key: str, tile: float = TILE) -> DataFrame:
    """``points`` with the ``key`` of the polygon that strictly holds each, null where none does; of several the smallest key.

    Places are looked up once, whatever the number of points there and their ids: every row of ``points`` stays as it is.
    """
    spots = points.select(x, y, F.col(x).alias("xmin"), F.col(y).alias("ymin"), F.col(x).alias("xmax"), F.col(y).alias("ymax")).where(F.col(x).isNotNull() & F.col(y).isNotNull()).distinct()
    pairs = box_join(spots, with_box(polygons.select(key, geom), geom), tile).where(S.st_contains(geom, x, y))
    held = pairs.groupBy(x, y).agg(F.min(key).alias(key))
    return points.join(held, [x, y], "left").select(*points.columns, key)
