"""The extracts: each brings one source to a tidy table with BNG geometry as WKB in ``geom`` and, for points, a cell id.

``Context.source`` gives the path of a source's files by the extract's name; fetching them there is the business of
``cellweave.sources.fetch``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.operators import overlay
from cellweave.operators import relational as R
from cellweave.operators.isochrone import graph_edges, graph_nodes, isochrones
from cellweave.operators.spatial_join import containing
from cellweave.sources import files
from cellweave.sources.features import read_features


@dataclass
class Context:
    spark: SparkSession
    source: Callable[[str], str]
    extract: Callable[[str], DataFrame] | None = None
    options: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Dataset:
    name: str
    table: str
    extract: Callable[[Context], DataFrame]
    optional: bool = True
    geometry: bool = True
    depends_on: tuple[str, ...] = ()
    #: Sources by name, if not one of the dataset's own; and a column whose nulls are counted as rows without a place.
    sources: tuple[str, ...] = ()
    placed_by: str | None = None


#: The stop types of the national stop register by category.
STOP_TYPES = {
    "BCT": "bus",
    "BCS": "bus",
    "BCQ": "bus",
    "BCE": "bus",
    "BST": "bus",
    "MKD": "bus",
    "RLY": "rail",
    "RPL": "rail",
    "RSE": "rail",
    "MET": "tram_metro",
    "PLT": "tram_metro",
    "TMU": "tram_metro",
    "FER": "ferry",
    "FBT": "ferry",
    "FTD": "ferry",
    "TXR": "taxi",
    "STR": "taxi",
    "AIR": "air",
    "GAT": "air",
}
#: England and Wales in degrees, the wanted basic categories of places, and the food outlets' business types.
BOX = (-5.86, 49.75, 1.81, 56.0)
PLACE_CATEGORIES = (
    "adult_entertainment_venue",
    "alcoholic_beverage_venue",
    "atm",
    "bar",
    "casino",
    "casual_eatery",
    "emergency_department",
    "fast_food_restaurant",
    "food_service",
    "hospital",
    "inn",
    "lounge",
    "parking",
    "police station",
    "restaurant",
)
BUSINESS_TYPES = ("1", "7844", "7843", "7841", "7846", "7842")
#: The columns of England's deprivation file, and of Wales's sheet, by the output's names.
ENGLAND = {
    "LSOA code (2021)": "spatial_id", "Local Authority District code (2024)": "lad24cd", "Local Authority District name (2024)": "lad24nm",
    "Index of Multiple Deprivation (IMD) Score": "imd_score", "Index of Multiple Deprivation (IMD) Rank (where 1 is most deprived)": "imd_rank",
    "Income Score (rate)": "income", "Employment Score (rate)": "employment", "Education, Skills and Training Score": "est", "Health Deprivation and Disability Score": "hdd",
    "Crime Score": "crime", "Barriers to Housing and Services Score": "bhs", "Living Environment Score": "le",
}
SCORES = ("income", "employment", "est", "hdd", "crime", "bhs", "le")


def _points(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Grid geometry and the cell id at resolution 9 for points in degrees."""
    placed = S.with_grid(df, lon, lat, "x_", "y_")
    return placed.withColumns({"geom": S.st_point(F.col("x_"), F.col("y_")), "h3_9_id": S.cell_of(lat, lon, 9)}).drop("x_", "y_")


def crime(ctx: Context) -> DataFrame:
    """Monthly street files in one archive; points without coordinates keep a null geometry."""
    df = files.read_zipped_csv(ctx.spark, ctx.source("crime_data"), "????-??/*-street.csv")
    df = df.withColumns({c: R.numeric_text(c) for c in ("longitude", "latitude")})
    return S.with_grid(df, "longitude", "latitude", "x_", "y_").withColumn("geom", S.st_point(F.col("x_"), F.col("y_"))).drop("x_", "y_")


def boundaries(name: str, code: str) -> Callable[[Context], DataFrame]:
    """A layer of boundaries from a paged service, from what was fetched of it, or from a GeoPackage."""

    def extract(ctx: Context) -> DataFrame:
        path = ctx.source(name)
        raw = read_features(ctx.spark, path) if path.startswith("http") else ctx.spark.read.parquet(path) if path.endswith(".parquet") else files.read_geopackage(ctx.spark, path)
        return raw.withColumnRenamed(code, "spatial_id")

    return extract


def greenspace(ctx: Context) -> DataFrame:
    return files.read_shapefile(ctx.spark, ctx.source("open_greenspace"), "GB_GreenspaceSite.shp")


def land_cover(ctx: Context) -> DataFrame:
    """Built-up classes (over 19) repaired and united into urban (20) and suburban (all others), dumped, with ids in a fixed order."""
    from pyspark.sql import Window as W

    raw = files.read_geopackage(ctx.spark, ctx.source("land_cover"))
    built = raw.where(F.col("_mode").cast("int") > 19).select((F.col("_mode").cast("int") == 20).alias("urban"), "geom")
    parts = overlay.union(built, ["urban"])
    least = parts.withColumn("box_", S.st_box("geom"))
    numbered = least.withColumn("gid", F.row_number().over(W.partitionBy("urban").orderBy("box_.xmin", "box_.ymin", F.hex("geom"))).cast("long"))
    # Odd ids for suburban, even ones for urban parts: unique without one global sort.
    return numbered.select((2 * F.col("gid") + F.when(F.col("urban"), 0).otherwise(1)).alias("gid"), "urban", "geom")


def buildings(ctx: Context) -> DataFrame:
    """Buildings once per premise, with their cell and the output area that holds their centroid."""
    keep = ["verisk_premise_id", "premise_use", "premise_type", "uprn", "toid", "map_use", "map_simple_use"]
    once = R.distinct_on(files.read_geopackages(ctx.spark, ctx.source("buildings").split(",")).select(*keep, "geom"), ["verisk_premise_id"])
    x, y = S.st_centroid("geom")
    placed = S.with_lonlat(once.withColumns({"x_": x, "y_": y}), "x_", "y_", "lon_", "lat_").withColumn("h3_9_id", S.cell_of("lat_", "lon_", 9))
    areas = ctx.extract("output_areas_2021").select(F.col("spatial_id").alias("oa21cd"), F.col("geom").alias("area_geom"))
    return containing(placed, areas, "x_", "y_", "area_geom", "oa21cd").select(*keep, "oa21cd", "h3_9_id", "geom")


def retail_centres(ctx: Context) -> DataFrame:
    raw = files.read_geopackage(ctx.spark, ctx.source("retail_centres"))
    names = ("RC_ID", "RC_Name", "Classification", "Country", "Region_NM", "H3_count", "Retail_N", "Area_km2")
    return raw.select(*[F.col(n).alias(n.lower()) for n in names], S.st_to_grid("geom").alias("geom"))


def open_roads(ctx: Context) -> DataFrame:
    return files.read_geopackage(ctx.spark, ctx.source("open_roads"), "road_link")


def poi(ctx: Context) -> DataFrame:
    """Places of the wanted basic categories, from nested records with the point as WKB in degrees."""
    raw = files.read_places(ctx.spark, ctx.source("poi"), ctx.options.get("box", BOX))
    raw = raw.where(F.col("basic_category").isin(*ctx.options.get("categories", PLACE_CATEGORIES)))
    c = S.st_centroid("geometry")
    flat = raw.select(F.col("id").alias("poi_id"), c[0].alias("lon_"), c[1].alias("lat_"), F.col("names.primary").alias("name"), R.first_of_list("addresses", "postcode").alias("postcode"), "basic_category", F.col("categories.primary").alias("primary_category"), F.col("categories.alternate").alias("alternate_category"))
    return _points(flat, "lon_", "lat_").select("poi_id", "geom", "h3_9_id", "name", "postcode", "basic_category", "primary_category", "alternate_category")


def streetlights(ctx: Context) -> DataFrame:
    raw = files.read_places(ctx.spark, ctx.source("streetlights"), ctx.options.get("box", BOX)).where((F.col("subtype") == "transportation") & (F.col("class") == "street_lamp"))
    c = S.st_centroid("geometry")
    return _points(raw.select(F.col("id").alias("streetlight_id"), c[0].alias("lon_"), c[1].alias("lat_")), "lon_", "lat_").select("streetlight_id", "geom", "h3_9_id")


def cctv(ctx: Context) -> DataFrame:
    nodes = files.read_json_nodes(ctx.spark, ctx.source("cctv"))
    return _points(nodes, "lon", "lat").select(F.col("id").alias("cctv_id"), "geom", "h3_9_id")


def naptan(ctx: Context) -> DataFrame:
    """Active stops with grid coordinates; longitude and latitude come from these, for many rows lack their own."""
    raw = files.read_csv_text(ctx.spark, ctx.source("naptan"))
    kept = raw.where((F.col("Status") == "active") & (R.numeric_text("Easting") > 0) & (R.numeric_text("Northing") > 0))
    names = {"ATCOCode": "atco_code", "NaptanCode": "naptan_code", "CommonName": "name", "Street": "street", "Indicator": "indicator", "Bearing": "bearing", "LocalityName": "locality_name", "Town": "town", "StopType": "stop_type"}
    flat = kept.select(*[F.col(a).alias(b) for a, b in names.items()], R.category(F.col("StopType"), STOP_TYPES, "other").alias("stop_category"), R.numeric_text("Easting").alias("x_"), R.numeric_text("Northing").alias("y_"))
    return S.with_lonlat(flat, "x_", "y_", "lon_", "lat_").withColumns({"geom": S.st_point(F.col("x_"), F.col("y_")), "h3_9_id": S.cell_of("lat_", "lon_", 9)}).drop("x_", "y_", "lon_", "lat_")


def food_outlets(ctx: Context) -> DataFrame:
    """Rated outlets of the wanted business types outside Northern Ireland that have coordinates."""
    raw = files.read_csv_text(ctx.spark, ctx.source("food_outlets"))
    types = ctx.options.get("business_types", BUSINESS_TYPES)
    kept = raw.where(F.col("BusinessTypeID").isin(*types) & (F.col("SchemeType") == "FHRS") & R.without_prefix("PostCode", "BT") & R.numeric_text("Longitude").isNotNull() & R.numeric_text("Latitude").isNotNull())
    flat = kept.select(F.col("FHRSID").try_cast("long").alias("fhrsid"), F.col("BusinessName").alias("business_name"), F.col("BusinessType").alias("business_type"), F.col("PostCode").alias("postcode"), F.col("RatingValue").alias("rating_value"), F.col("LocalAuthorityName").alias("local_authority_name"), R.numeric_text("Longitude").alias("lon_"), R.numeric_text("Latitude").alias("lat_"))
    return _points(flat, "lon_", "lat_").drop("lon_", "lat_")


#: The columns of the schools table, in its order.
SCHOOL_COLUMNS = ("urn", "establishmentnumber", "establishmentname", "typeofestablishment_code", "typeofestablishment_name", "establishmentstatus_code", "phaseofeducation_code", "phaseofeducation_name", "statutorylowage", "statutoryhighage", "schoolcapacity", "postcode", "urbanrural_code", "districtadministrative_code", "msoa_code", "lsoa_code")


def schools(ctx: Context) -> DataFrame:
    """Open schools with cells at four resolutions and their walk catchment over the road network."""
    raw = files.normalize_names(files.read_csv_text(ctx.spark, ctx.source("schools"), "windows-1252"))
    kept = raw.withColumns({"x_": R.numeric_text("easting"), "y_": R.numeric_text("northing")}).where(F.col("establishmentstatus_code").try_cast("int").isin(1, 3) & (F.col("x_") > 0) & (F.col("y_") > 0))
    placed = S.with_lonlat(kept, "x_", "y_", "lon_", "lat_")
    cells = {f"h3_{r}_id": S.cell_of("lat_", "lon_", r) for r in (8, 9, 10, 11)}
    out = placed.withColumns(cells | {"geom": S.st_point(F.col("x_"), F.col("y_"))})
    roads = ctx.extract("open_roads")
    walks = isochrones(out.select(F.col("urn").alias("place"), F.col("x_").alias("px"), F.col("y_").alias("py")), graph_edges(roads), graph_nodes(roads))
    joined = out.join(walks.select(F.col("place").alias("urn"), "isochrone", F.col("area_km2").alias("isochrone_area_km2")), "urn", "left")
    return joined.select(*[c for c in SCHOOL_COLUMNS if c in joined.columns], *cells, "geom", "isochrone", "isochrone_area_km2")


def _wales_sheet(ctx: Context) -> DataFrame | None:
    """Wales's sheet; None if there is no such file. A file that can't be read, or lacks the sheet, is an error."""
    try:
        return files.read_ods(ctx.spark, ctx.source("imd_wales"), "Data", 3)
    except (KeyError, AnalysisException) as missing:
        if isinstance(missing, AnalysisException) and missing.getCondition() != "PATH_NOT_FOUND":
            raise
        logging.getLogger("cellweave").warning("Wales left out: %s", missing)
        return None


def imd(ctx: Context) -> DataFrame:
    """Deprivation percentiles within each country; Wales's own index is turned to the same columns.

    Where Wales's sheet isn't there or lacks a score, England stands alone.
    """
    raw = files.read_csv_text(ctx.spark, ctx.source("imd_england"))
    england = raw.select(*[F.col(f"`{a}`").alias(b) for a, b in ENGLAND.items()]).withColumns({c: R.numeric_text(c) for c in ("imd_score", *SCORES)}).withColumn("imd_rank", R.numeric_text("imd_rank").cast("long"))
    both = england.withColumn("country", F.lit("E"))
    if (sheet := _wales_sheet(ctx)) is not None and sheet.where("`WIMD 2025` is null").isEmpty():
        both = both.unionByName(wales_scores(sheet, ctx.extract("local_authority_districts") if ctx.extract else None))
    ranked = both.withColumns({f"{c}_": R.pct_rank(c, ["country"]) for c in ("imd_score", *SCORES)})
    return ranked.select("spatial_id", "lad24cd", "lad24nm", F.col("imd_score_").alias("imd_score"), "imd_rank", *[F.col(f"{c}_").alias(c) for c in SCORES])


def wales_scores(sheet: DataFrame, lads: DataFrame | None) -> DataFrame:
    """Wales's sheet in England's columns: rank 1 is the most deprived; housing and access make one score."""
    parts = {"Income": "income", "Employment": "employment", "Education": "est", "Health": "hdd", "Community Safety": "crime", "Physical Environment": "le"}
    named = sheet.select(F.col("`LSOA code`").alias("spatial_id"), F.col("`Local Authority name`").alias("lad24nm"), F.col("`WIMD 2025`").alias("imd_score"), *[F.col(f"`{a}`").alias(b) for a, b in parts.items()], ((F.col("`Access to Services`") + F.col("Housing")) / 2).alias("bhs"))
    ranked = named.withColumn("country", F.lit("W")).withColumn("imd_rank", R.min_rank_desc("imd_score", ["country"]))
    coded = R.code_by_name(ranked, lads.select("lad24nm", F.col("spatial_id").alias("lad24cd")), "lad24nm", "lad24cd") if lads is not None else ranked.withColumn("lad24cd", F.lit(None).cast("string"))
    return coded.select("spatial_id", "lad24cd", "lad24nm", "imd_score", "imd_rank", *SCORES, "country")


def oac(ctx: Context) -> DataFrame:
    raw = files.read_csv_text(ctx.spark, ctx.source("oac"))
    return raw.select(R.trimmed(F.col("oa21cd")).alias("spatial_id"), R.trimmed(F.col("subgroup")).alias("code"))


def oac_classification(ctx: Context) -> DataFrame:
    raw = files.read_csv_text(ctx.spark, ctx.source("oac_classification"))
    return R.decode_hierarchy(raw.select(F.col("`Classification Code`").alias("c"), F.col("`Level Code`").alias("l"), F.col("`Classification Name`").alias("n")), "c", "l", "n").orderBy("code")


DATASETS = (
    Dataset("crime_data", "crime_data", crime, optional=False, placed_by="geom"),
    *[Dataset(t, t, boundaries(t, c), optional=False) for t, c in (("police_force_areas", "PFA23CD"), ("local_authority_districts", "LAD24CD"), ("msoa_2021", "MSOA21CD"), ("lsoa_2021", "LSOA21CD"), ("output_areas_2021", "OA21CD"))],
    Dataset("open_greenspace", "open_greenspace", greenspace),
    Dataset("land_cover", "land_cover", land_cover),
    Dataset("buildings", "buildings", buildings, depends_on=("output_areas_2021",), placed_by="oa21cd"),
    Dataset("retail_centres", "retail_centres", retail_centres),
    Dataset("open_roads", "open_roads", open_roads),
    Dataset("poi", "poi", poi),
    Dataset("naptan", "naptan", naptan),
    Dataset("food_outlets", "food_outlets", food_outlets),
    Dataset("streetlights", "streetlights", streetlights),
    Dataset("cctv", "cctv", cctv),
    Dataset("schools", "schools", schools, depends_on=("open_roads",)),
    Dataset("imd_scores_pct", "imd_scores_pct", imd, geometry=False, depends_on=("local_authority_districts",), sources=("imd_england", "imd_wales")),
    Dataset("oac", "oac", oac, geometry=False),
    Dataset("oac_classification", "oac_classification", oac_classification, geometry=False),
)
