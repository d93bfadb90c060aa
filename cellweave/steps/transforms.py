"""The transform steps: counts, look-ups of geographies, overlapping features and nearest centres, and the wide table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.operators import relational as R
from cellweave.operators.spatial_join import best_overlap, intersecting, nearest_within
from cellweave.steps.base import Relations, Step
from cellweave.storage import written

#: Relation of boundaries by the name of its code column, in the order of the wide table's columns.
GEOGRAPHIES = {"pfa23cd": "police_force_areas", "lad24cd": "local_authority_districts", "msoa21cd": "msoa_2021", "lsoa21cd": "lsoa_2021", "oa21cd": "output_areas_2021"}
EXCLUDED_FORCE = "British Transport Police"
CENTRES, CENTRE_RADIUS = "retail_centres", 2000.0


@dataclass(frozen=True)
class Layer:
    """A layer of features of which every one that meets a cell is kept, with its area or length there."""

    table: str
    name: str
    id_col: str
    prefix: str
    extra: tuple[str, str] | None = None
    where: Callable[[], Column] | None = None
    geom: str = "geom"
    measure: str = "overlap_area"
    how: str = "max"


#: The names of the layers, their tables and columns.
LAYERS = (
    Layer("open_greenspace", "greenspace", "id", "greenspace", ("function", "function")),
    Layer("land_cover", "urban", "gid", "urban", where=lambda: F.col("urban")),
    Layer("land_cover", "suburban", "gid", "suburban", where=lambda: ~F.col("urban")),
    Layer("open_roads", "road_network", "id", "road", ("road_function", "type"), measure="overlap_length", how="sum"),
    Layer("schools", "schools", "urn", "school", ("establishmentname", "school_name"), geom="isochrone"),
)


def crime_counts(relations: Relations, resolutions: tuple[int, ...]) -> dict[str, DataFrame]:
    """Events per cell, type and month, without those of the excluded force, of no force or of no place."""
    kept = R.countable_events(relations["crime_data"], "latitude", "longitude", "falls_within", EXCLUDED_FORCE)
    return {f"crime_counts_h3_{r}": R.group_counts(kept.select(S.cell_of("latitude", "longitude", r).alias("spatial_id"), "crime_type", F.col("_month").alias("month")), ["spatial_id", "crime_type", "month"]) for r in resolutions}


def streetlight_counts(relations: Relations, resolutions: tuple[int, ...]) -> dict[str, DataFrame]:
    if "streetlights" not in relations:
        return {}
    lights = relations["streetlights"].where("h3_9_id is not null").withColumnRenamed("h3_9_id", "spatial_id")
    return {"streetlight_counts_h3_9": R.group_counts(lights, ["spatial_id"], "streetlight_count")}


def building_counts(relations: Relations, resolutions: tuple[int, ...]) -> dict[str, DataFrame]:
    if "buildings" not in relations or "crime_counts_h3_9" not in relations:
        return {}
    return {"building_counts_h3_9": R.counts_within(relations["buildings"], "h3_9_id", relations["crime_counts_h3_9"], ["map_simple_use"], "building_count")}


def cells_of(relations: Relations, res: int) -> DataFrame:
    """The distinct cells of a resolution with their polygon in metres; distinct first, for the polygon is the dear part.

    They are written once, and all layers are joined with the written ones.
    """
    if (name := f"_cells_{res}") not in relations:
        relations.put(name, written(_cells(relations, res), "cells"), replace=False)
    return relations[name]


def _cells(relations: Relations, res: int) -> DataFrame:
    return relations[f"crime_counts_h3_{res}"].select("spatial_id").where("spatial_id is not null").distinct().withColumn("cell_geom", S.cell_boundary("spatial_id", on_grid=True))


def geo_lookups(relations: Relations, resolutions: tuple[int, ...]) -> dict[str, DataFrame]:
    """Per cell the code of the boundary with the largest part in it."""
    out = {}
    for res in resolutions:
        cells = cells_of(relations, res)
        for code, table in GEOGRAPHIES.items():
            out[f"h3_{res}_{code}_lookup"] = best_overlap(cells, relations[table].select(F.col("spatial_id").alias(code), "geom"), "cell_geom", "geom", code)
    return out


def overlap_lookups(relations: Relations, resolutions: tuple[int, ...]) -> dict[str, DataFrame]:
    out = {}
    for layer in (x for x in LAYERS if x.table in relations):
        rows = relations[layer.table] if layer.where is None else relations[layer.table].where(layer.where())
        extra = [F.col(layer.extra[0]).alias(layer.extra[1])] if layer.extra else []
        features = rows.select(F.col(layer.id_col).alias(f"{layer.prefix}_id"), *extra, F.col(layer.geom).alias("geom"))
        for res in resolutions:
            out[f"h3_{res}_{layer.name}_lookup"] = intersecting(cells_of(relations, res), features, "cell_geom", "geom", layer.measure).drop("cell_geom")
    return out


def retail_centre_lookups(relations: Relations, resolutions: tuple[int, ...]) -> dict[str, DataFrame]:
    if CENTRES not in relations:
        return {}
    centres = relations[CENTRES].select(F.col("rc_id").alias("retail_centre_id"), "geom")
    return {f"h3_{res}_retail_centre_lookup": nearest_within(cells_of(relations, res), centres, "cell_geom", "geom", "retail_centre_id", CENTRE_RADIUS) for res in resolutions}


def geogs(relations: Relations, resolutions: tuple[int, ...], base_key: str = "pfa23cd") -> dict[str, DataFrame]:
    """One wide row per cell that has a code of ``base_key``: area, codes, folded layers, nearest centre."""
    out = {}
    for res in resolutions:
        base = relations[f"h3_{res}_{base_key}_lookup"]
        others = [relations[f"h3_{res}_{k}_lookup"] for k in GEOGRAPHIES if k != base_key]
        folds = [R.fold(relations[f"h3_{res}_{x.name}_lookup"], x.prefix, x.measure, x.how) for x in LAYERS if f"h3_{res}_{x.name}_lookup" in relations]
        centre = f"h3_{res}_retail_centre_lookup"
        near = [relations[centre].select("spatial_id", "retail_centre_id", F.col("distance").alias("retail_centre_distance"))] if centre in relations else []
        joined = R.wide(base, *others, *folds, *near)
        codes = [base_key, *(k for k in GEOGRAPHIES if k != base_key)]
        out[f"h3_{res}_geogs"] = joined.select("spatial_id", S.cell_area("spatial_id").alias("cell_area"), *codes, *[c for c in joined.columns if c not in ("spatial_id", *codes)])
    return out


def _named(pattern: str, table: str | None = None) -> Callable[[Relations, tuple[int, ...]], list[str]]:
    return lambda relations, resolutions: [pattern.format(res=r) for r in resolutions] if table is None or table in relations else []


STEPS = (
    Step("crime_counts", crime_counts, _named("crime_counts_h3_{res}"), inputs=("crime_data",)),
    Step("streetlight_counts", streetlight_counts, lambda c, _: ["streetlight_counts_h3_9"] if "streetlights" in c else [], inputs=("streetlights",)),
    Step("building_counts", building_counts, lambda c, _: ["building_counts_h3_9"] if "buildings" in c else [], ("crime_counts",), ("buildings",)),
    Step("geo_lookups", geo_lookups, lambda _, rs: [f"h3_{r}_{k}_lookup" for r in rs for k in GEOGRAPHIES], ("crime_counts",), tuple(GEOGRAPHIES.values())),
    Step("overlap_lookups", overlap_lookups, lambda c, rs: [f"h3_{r}_{x.name}_lookup" for x in LAYERS if x.table in c for r in rs], ("crime_counts",), tuple(dict.fromkeys(x.table for x in LAYERS))),
    Step("retail_centre_lookups", retail_centre_lookups, _named("h3_{res}_retail_centre_lookup", CENTRES), ("crime_counts",), (CENTRES,)),
    Step("geogs", geogs, _named("h3_{res}_geogs"), ("geo_lookups", "overlap_lookups", "retail_centre_lookups")),
)
