"""The registered queries of the place-analytics operators, and their SQL.

The driver's tables hold no coordinates, so both sides derive the same ones by integer arithmetic on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions import spatial as S
from cellweave.functions.wkt import from_text, to_text
from cellweave.geo import crs
from cellweave.operators import overlay
from cellweave.operators import relational as R
from cellweave.operators.isochrone import isochrones
from cellweave.operators.spatial_join import best_overlap, containing, intersecting, nearest_within, shape_pairs, with_shape
from cellweave.storage import read_table, spread, written

SQL: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# Counts by cell ---------------------------------------------------------------------------------------------------

#: Events as points on a plane of 100 km: some without a coordinate, some of the excluded force, some of none.
_EVENTS_SQL = """(SELECT *, CASE WHEN event_id % 13 = 0 THEN NULL ELSE (user_id * 7919) % 100000 END AS px,
  CASE WHEN event_id % 17 = 0 THEN NULL ELSE (user_id * 104729) % 100000 END AS py,
  nullif(CASE WHEN event_id % 11 = 0 THEN 'transport' WHEN event_id % 7 = 0 THEN 'none' ELSE 'county' END, 'none') AS force FROM events)"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, k = read_table(spark, sf_dir, "events"), F.col("event_id")
    return e.withColumns({
        "px": F.when(k % 13 != 0, F.col("user_id") * 7919 % 100000),
        "py": F.when(k % 17 != 0, F.col("user_id") * 104729 % 100000),
        "force": F.when(k % 11 == 0, "transport").when(k % 7 != 0, "county"),
    })


def _square(size: int):
    return F.concat(F.floor(F.col("px") / size).cast("string"), F.lit("_"), F.floor(F.col("py") / size).cast("string"))


def _square_sql(size: int) -> str:
    return f"CAST(px // {size} AS VARCHAR) || '_' || CAST(py // {size} AS VARCHAR)"


def _event_counts(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    kept = R.countable_events(_events(spark, sf_dir), "px", "py", "force", "transport")
    return R.group_counts(kept.select(_square(size).alias("spatial_id"), F.col("event_type").alias("crime_type"), F.date_format("ts", "yyyy-MM-dd").alias("month")), ["spatial_id", "crime_type", "month"])


def _event_counts_sql(size: int) -> str:
    return f"""SELECT {_square_sql(size)} AS spatial_id, event_type AS crime_type, strftime(ts, '%Y-%m-%d') AS month, count(*) AS count
      FROM {_EVENTS_SQL} WHERE px IS NOT NULL AND py IS NOT NULL AND force <> 'transport' GROUP BY 1, 2, 3"""


@query(_event_counts_sql(1000))
def cell_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_counts(spark, sf_dir, 1000)


@query(" UNION ALL ".join(f"SELECT {r} AS res, * FROM ({_event_counts_sql(s)})" for r, s in ((8, 4000), (9, 1500), (10, 500))))
def res_counts_8_9_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [_event_counts(spark, sf_dir, s).select(F.lit(r).alias("res"), "*") for r, s in ((8, 4000), (9, 1500), (10, 500))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_ORDER_CELL_SQL = "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST((o_custkey * 31) % 500 AS VARCHAR) END"


def _order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").withColumn("h3_9_id", F.when(F.col("o_orderkey") % 19 != 0, (F.col("o_custkey") * 31 % 500).cast("string")))


@query(f"SELECT {_ORDER_CELL_SQL} AS spatial_id, count(*) AS streetlight_count FROM orders WHERE {_ORDER_CELL_SQL} IS NOT NULL GROUP BY 1")
def point_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.group_counts(_order_cells(spark, sf_dir).where("h3_9_id is not null").withColumnRenamed("h3_9_id", "spatial_id"), ["spatial_id"], "streetlight_count")


@query(f"""SELECT cell AS spatial_id, o_orderpriority AS map_simple_use, count(*) AS building_count FROM (SELECT *, {_ORDER_CELL_SQL} AS cell FROM orders)
  WHERE cell IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase') GROUP BY 1, 2""")
def class_counts_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = read_table(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("spatial_id"))
    return R.counts_within(_order_cells(spark, sf_dir).withColumn("map_simple_use", F.col("o_orderpriority")), "h3_9_id", cells, ["map_simple_use"], "building_count")


@query("SELECT count(*) FILTER (WHERE o_custkey % 10 = 3 ) AS unplaced, count(*) AS total FROM orders")
def count_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = F.when(F.col("o_custkey") % 10 != 3, F.col("o_custkey"))
    return read_table(spark, sf_dir, "orders").agg(F.count_if(placed.isNull()).alias("unplaced"), F.count("*").alias("total"))


# Projections and predicates --------------------------------------------------------------------------------------

_STOPS = {"1-URGENT": "rail", "2-HIGH": "bus", "3-MEDIUM": "ferry"}


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'rail' WHEN '2-HIGH' THEN 'bus' WHEN '3-MEDIUM' THEN 'ferry' ELSE 'other' END AS stop_category FROM orders")
def stop_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select("o_orderkey", R.category(F.col("o_orderpriority"), _STOPS, "other").alias("stop_category"))


@query("""SELECT event_id, TRY_CAST(raw AS DOUBLE) AS easting FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'n/a' ELSE CAST(event_id % 1000 AS VARCHAR) END AS raw FROM events)
  WHERE TRY_CAST(raw AS DOUBLE) > 0""")
def try_cast_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    raw = read_table(spark, sf_dir, "events").select("event_id", F.when(k % 4 == 0, "").when(k % 4 == 1, "n/a").otherwise((k % 1000).cast("string")).alias("raw"))
    return raw.where(R.numeric_text("raw") > 0).select("event_id", R.numeric_text("raw").alias("easting"))


@query("SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS postcode FROM customer WHERE nullif(c_mktsegment, 'MACHINERY') IS NULL OR nullif(c_mktsegment, 'MACHINERY') NOT LIKE 'BU%'")
def not_like_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("postcode"))
    return rows.where(R.without_prefix("postcode", "BU"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = ANY(['1-URGENT', '5-LOW']) AND o_orderstatus IN ('F', 'O')")
def any_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & F.col("o_orderstatus").isin("F", "O")).select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS postcode FROM customer")
def struct_list_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = read_table(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_name").alias("primary")).alias("names"), F.when(F.col("c_custkey") % 5 == 0, F.array().cast("array<struct<postcode: string>>")).otherwise(F.array(F.struct(F.col("c_mktsegment").alias("postcode")))).alias("addresses"))
    return nested.select("c_custkey", F.col("names.primary").alias("name"), R.first_of_list("addresses", "postcode").alias("postcode"))


# Survivors, look-ups, ranks ----------------------------------------------------------------------------------------


@query("SELECT DISTINCT ON (l_orderkey) l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey")
def distinct_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.distinct_on(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), ["l_orderkey"])


@query("""SELECT node, min(x) AS x FROM (SELECT l_partkey AS node, l_partkey * 3 % 1000 AS x FROM lineitem UNION ALL SELECT l_suppkey, l_suppkey * 7 % 1000 FROM lineitem) GROUP BY node""")
def union_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    ends = [lines.select(F.col(c).alias("node"), (F.col(c) * k % 1000).alias("x")) for c, k in (("l_partkey", 3), ("l_suppkey", 7))]
    return R.distinct_on(ends[0].union(ends[1]), ["node"])


_CODES_SQL = """(SELECT DISTINCT sub, sub || '' AS k FROM (SELECT CAST(p_size % 9 + 1 AS VARCHAR) || chr(CAST(97 + p_partkey % 3 AS INTEGER)) || CAST(p_partkey % 4 + 1 AS VARCHAR) AS sub FROM part))"""


@query(f"""WITH codes AS {_CODES_SQL}, g AS (SELECT DISTINCT left(sub, 2) AS c FROM codes WHERE left(sub, 2) <> '2b'), sg AS (SELECT DISTINCT left(sub, 1) AS c FROM codes)
  SELECT sub AS code, 'sub ' || sub AS subgroup_name, 'group ' || g.c AS group_name, 'super ' || sg.c AS supergroup_name FROM codes LEFT JOIN g ON g.c = left(sub, 2) LEFT JOIN sg ON sg.c = left(sub, 1)""")
def hierarchy_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    letter = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("p_partkey") % 3 + 1).cast("int"))
    subs = read_table(spark, sf_dir, "part").select(F.concat((F.col("p_size") % 9 + 1).cast("string"), letter, (F.col("p_partkey") % 4 + 1).cast("string")).alias("code")).distinct()
    level = lambda n, name, label: subs.select(F.left("code", F.lit(n)).alias("c")).distinct().select(F.concat(F.lit(" "), "c", F.lit(" ")).alias("code"), F.lit(f"{name} ").alias("level"), F.concat(F.lit(f"{label} "), "c", F.lit("  ")).alias("name"))
    codes = level(3, "subg", "sub").union(level(2, "g", "group").where(R.trimmed(F.col("code")) != "2b")).union(level(1, "sg", "super"))
    return R.decode_hierarchy(codes, "code", "level", "name")


@query("""SELECT c_custkey, c_nationkey, v AS score, CASE WHEN v IS NULL THEN NULL ELSE (rank() OVER (PARTITION BY c_nationkey ORDER BY v NULLS LAST) + (count(*) OVER (PARTITION BY c_nationkey, v) - 1) / 2.0) / count(v) OVER (PARTITION BY c_nationkey) END AS pct
  FROM (SELECT c_custkey, c_nationkey, nullif(CAST(c_custkey % 50 AS INTEGER), 7) AS v FROM customer)""")
def pct_rank_within_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.nullif((F.col("c_custkey") % 50).cast("int"), F.lit(7)).alias("score"))
    return rows.withColumn("pct", R.pct_rank("score", ["c_nationkey"]))


@query("SELECT s_suppkey, s_nationkey, CAST(rank() OVER (PARTITION BY s_nationkey ORDER BY CAST(s_acctbal AS INTEGER) // 1000 DESC NULLS LAST) AS BIGINT) AS imd_rank FROM supplier")
def desc_min_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "supplier").withColumn("v", F.expr("cast(bround(s_acctbal) as int) div 1000"))
    return rows.select("s_suppkey", "s_nationkey", R.min_rank_desc("v", ["s_nationkey"]).alias("imd_rank"))


@query("SELECT c_custkey, n_name AS lad24nm, n_regionkey AS lad24cd FROM (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'nowhere' ELSE n_name END AS name FROM customer JOIN nation ON c_nationkey = n_nationkey) LEFT JOIN nation ON name = n_name".replace("n_name AS lad24nm", "name AS lad24nm"))
def code_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    named = read_table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.when(F.col("c_custkey") % 9 == 0, "nowhere").otherwise(F.col("n_name")).alias("lad24nm"))
    return R.code_by_name(named, nation.select(F.col("n_name").alias("lad24nm"), F.col("n_regionkey").alias("lad24cd")), "lad24nm", "lad24cd").select("c_custkey", "lad24nm", "lad24cd")


@query("""WITH e AS (SELECT o_custkey AS spatial_id, o_totalprice, o_orderkey FROM orders WHERE o_orderstatus = 'F'), w AS (SELECT o_custkey AS spatial_id, o_totalprice, o_orderkey FROM orders WHERE o_orderstatus = 'P'),
  a AS (SELECT spatial_id, list_sort(list(o_orderkey)) AS greenspace_ids, round(max(o_totalprice), 4) AS greenspace_overlap_area FROM e GROUP BY 1),
  b AS (SELECT spatial_id, list_sort(list(o_orderkey)) AS road_ids, round(sum(o_totalprice), 4) AS road_overlap_length FROM w GROUP BY 1)
  SELECT c_custkey AS spatial_id, greenspace_ids, greenspace_overlap_area, road_ids, road_overlap_length FROM customer LEFT JOIN a ON a.spatial_id = c_custkey LEFT JOIN b ON b.spatial_id = c_custkey""")
def fold_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "spatial_id")
    green = R.fold(orders.where("o_orderstatus = 'F'").select("spatial_id", F.col("o_orderkey").alias("greenspace_id"), F.col("o_totalprice").alias("overlap_area")), "greenspace", "overlap_area", "max")
    road = R.fold(orders.where("o_orderstatus = 'P'").select("spatial_id", F.col("o_orderkey").alias("road_id"), F.col("o_totalprice").alias("overlap_length")), "road", "overlap_length", "sum")
    base = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("spatial_id"))
    return R.wide(base, green, road).withColumns({c: F.round(c, 4) for c in ("greenspace_overlap_area", "road_overlap_length")})


# Projection ------------------------------------------------------------------------------------------------------

_LONLAT = "(SELECT c_custkey, -5.0 + (c_custkey * 7919 % 6000) / 1000.0 AS lon, 50.5 + (c_custkey * 104729 % 6000) / 1000.0 AS lat FROM customer)"
_BNG = "(SELECT c_custkey, 200000.0 + c_custkey * 7919 % 400000 AS x, 50000.0 + c_custkey * 104729 % 600000 AS y FROM customer)"


def _crs_sql(made: tuple[str, str, str], names: tuple[str, str], digits: int) -> str:
    source, a, b = made
    return f"SELECT c_custkey, round({a}, {digits}) AS {names[0]}, round({b}, {digits}) AS {names[1]} FROM ({source})"


@query(_crs_sql(crs.grid_sql(_LONLAT, "lon", "lat"), ("x", "y"), 3))
def crs_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = read_table(spark, sf_dir, "customer").select(k, (F.lit(-5.0) + k * 7919 % 6000 / F.lit(1000.0)).alias("lon"), (F.lit(50.5) + k * 104729 % 6000 / F.lit(1000.0)).alias("lat"))
    return crs.with_grid(rows, "lon", "lat").select("c_custkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query(_crs_sql(crs.lonlat_sql(_BNG, "x", "y"), ("lon", "lat"), 7))
def crs_inverse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = read_table(spark, sf_dir, "customer").select(k, (F.lit(200000.0) + k * 7919 % 400000).alias("x"), (F.lit(50000.0) + k * 104729 % 600000).alias("y"))
    return crs.with_lonlat(rows, "x", "y").select("c_custkey", F.round("lon", 7).alias("lon"), F.round("lat", 7).alias("lat"))


# Spatial joins on rectangles, whose overlaps and distances have closed forms ------------------------------------------

#: A grid of square cells from suppliers, and rectangles from parts; all coordinates are whole metres.
_CELLS_SQL = "(SELECT s_suppkey AS spatial_id, (s_suppkey * 7919 % 100) * 500 AS ax, (s_suppkey * 104729 % 100) * 500 AS ay, (s_suppkey * 7919 % 100) * 500 + 500 AS bx, (s_suppkey * 104729 % 100) * 500 + 500 AS ey FROM supplier)"
_RECTS_SQL = "(SELECT p_partkey AS code, p_partkey * 3571 % 50000 AS cx, p_partkey * 7727 % 50000 AS cy, p_partkey * 3571 % 50000 + 250 * (p_partkey % 7 + 1) AS dx, p_partkey * 7727 % 50000 + 250 * (p_partkey % 5 + 1) AS dy, p_partkey % 2 = 0 AS urban FROM part)"
_OVERLAP_SQL = "CAST(greatest(least(bx, dx) - greatest(ax, cx), 0) * greatest(least(ey, dy) - greatest(ay, cy), 0) AS DOUBLE)"
_MEET_SQL = "ax <= dx AND cx <= bx AND ay <= dy AND cy <= ey"


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    x, y = k * 7919 % 100 * 500, k * 104729 % 100 * 500
    rows = read_table(spark, sf_dir, "supplier").select(k.alias("spatial_id"), x.alias("ax"), y.alias("ay"), (x + 500).alias("bx"), (y + 500).alias("by"))
    return rows.withColumn("cell_geom", S.st_rectangle("ax", "ay", "bx", "by"))


def _rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    x, y = k * 3571 % 50000, k * 7727 % 50000
    rows = read_table(spark, sf_dir, "part").select(k.alias("code"), x.alias("cx"), y.alias("cy"), (x + 250 * (k % 7 + 1)).alias("dx"), (y + 250 * (k % 5 + 1)).alias("dy"), (k % 2 == 0).alias("urban"))
    return rows.withColumn("geom", S.st_rectangle("cx", "cy", "dx", "dy"))


@query(f"SELECT spatial_id, code AS oa21cd FROM (SELECT spatial_id, code, row_number() OVER (PARTITION BY spatial_id ORDER BY {_OVERLAP_SQL} DESC, code) AS nth FROM {_CELLS_SQL} JOIN {_RECTS_SQL} ON {_MEET_SQL}) WHERE nth = 1")
def cell_best_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_overlap(_cells(spark, sf_dir), _rects(spark, sf_dir).withColumnRenamed("code", "oa21cd"), "cell_geom", "geom", "oa21cd")


@query(f"SELECT spatial_id, code AS urban_id, round({_OVERLAP_SQL}, 3) AS overlap_area FROM {_CELLS_SQL} JOIN {_RECTS_SQL} ON {_MEET_SQL} WHERE urban")
def overlap_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = intersecting(_cells(spark, sf_dir).select("spatial_id", "cell_geom"), _rects(spark, sf_dir).where("urban").select(F.col("code").alias("urban_id"), "geom"), "cell_geom", "geom", "overlap_area", digits=3)
    return pairs.select("spatial_id", "urban_id", "overlap_area")


_LINES_SQL = "(SELECT p_partkey AS code, p_partkey * 3571 % 50000 AS cx, p_partkey * 7727 % 50000 AS cy, p_partkey * 3571 % 50000 + 3000 * (p_partkey % 2) AS dx, p_partkey * 7727 % 50000 + 3000 * (1 - p_partkey % 2) AS dy FROM part)"


@query(f"SELECT spatial_id, code AS road_id, round(CAST(greatest(least(bx, dx) - greatest(ax, cx), 0) + greatest(least(ey, dy) - greatest(ay, cy), 0) AS DOUBLE), 3) AS overlap_length FROM {_CELLS_SQL} JOIN {_LINES_SQL} ON {_MEET_SQL}")
def overlap_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    x, y = k * 3571 % 50000, k * 7727 % 50000
    lines = read_table(spark, sf_dir, "part").select(k.alias("road_id"), S.st_line(x.cast("double"), y.cast("double"), (x + 3000 * (k % 2)).cast("double"), (y + 3000 * (1 - k % 2)).cast("double")).alias("geom"))
    pairs = intersecting(_cells(spark, sf_dir).select("spatial_id", "cell_geom"), lines, "cell_geom", "geom", "overlap_length", digits=3)
    return pairs.select("spatial_id", "road_id", "overlap_length")


_AWAY_SQL = "sqrt(power(greatest(ax - dx, cx - bx, 0), 2) + power(greatest(ay - dy, cy - ey, 0), 2))"


@query(f"""WITH near AS (SELECT spatial_id, code, {_AWAY_SQL} AS away FROM {_CELLS_SQL} JOIN {_RECTS_SQL} ON {_AWAY_SQL} <= 2000),
  best AS (SELECT spatial_id, code, away, row_number() OVER (PARTITION BY spatial_id ORDER BY away, code) AS nth FROM near)
  SELECT c.spatial_id, code AS retail_centre_id, round(away, 6) AS distance FROM {_CELLS_SQL} c LEFT JOIN best b ON b.spatial_id = c.spatial_id AND nth = 1""")
def nearest_within_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    centres = _rects(spark, sf_dir).withColumnRenamed("code", "retail_centre_id")
    return nearest_within(_cells(spark, sf_dir), centres, "cell_geom", "geom", "retail_centre_id", 2000.0).withColumn("distance", F.round("distance", 6))


@query(f"""WITH pts AS (SELECT o_orderkey, (o_orderkey * 613 % 50000) // 250 * 250 AS x, (o_orderkey * 409 % 50000) AS y FROM orders)
  SELECT o_orderkey, min(code) AS oa21cd FROM pts LEFT JOIN {_RECTS_SQL} ON x > cx AND x < dx AND y > cy AND y < dy GROUP BY o_orderkey""")
def contains_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    pts = read_table(spark, sf_dir, "orders").select("o_orderkey", (F.floor(k * 613 % 50000 / 250) * 250).cast("double").alias("x"), (k * 409 % 50000).cast("double").alias("y"))
    return containing(pts, _rects(spark, sf_dir).withColumnRenamed("code", "oa21cd"), "x", "y", "geom", "oa21cd").select("o_orderkey", "oa21cd")


# Overlays ----------------------------------------------------------------------------------------------------------

#: A square of side 100 for each part, in rows of 40; neighbours of one class are dissolved.
_SQUARES_SQL = "(SELECT DISTINCT p_partkey AS k, (p_partkey * 7919) % 5 < 3 AS urban FROM part)"
#: The least label of each node over links, spread until nothing changes.
_LABELS_SQL = """labels AS (SELECT * FROM (WITH RECURSIVE spread(k, label) USING KEY (k) AS (SELECT k, k FROM node
  UNION SELECT l.b, min(s.label) FROM spread s JOIN link l ON l.a = s.k JOIN recurring.spread r ON r.k = l.b WHERE s.label < r.label GROUP BY l.b) SELECT k, label FROM spread))"""


@query(f"SELECT urban, CAST(100.0 * 100.0 * count(*) AS DOUBLE) AS area FROM {_SQUARES_SQL} GROUP BY urban")
def dissolved_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dissolved(spark, sf_dir).groupBy("urban").agg(F.round(F.sum("area"), 3).alias("area"))


@query(f"""WITH node AS {_SQUARES_SQL}, link AS (SELECT a.k AS a, b.k AS b FROM node a JOIN node b ON a.urban = b.urban AND (b.k = a.k + 40 OR b.k = a.k - 40 OR (b.k = a.k + 1 AND b.k % 40 <> 0) OR (b.k = a.k - 1 AND a.k % 40 <> 0))), {_LABELS_SQL},
  parts AS (SELECT urban, label, count(*) * 10000.0 AS area, min(k % 40) * 100.0 AS xmin, min(k // 40) * 100.0 AS ymin, max(k % 40) * 100.0 + 100 AS xmax, max(k // 40) * 100.0 + 100 AS ymax FROM node JOIN labels USING (k) GROUP BY urban, label)
  SELECT urban, CAST(row_number() OVER (PARTITION BY urban ORDER BY area DESC, xmin, ymin, xmax, ymax) AS INT) AS gid, area::DOUBLE AS area, xmin::DOUBLE AS xmin, ymin::DOUBLE AS ymin, xmax::DOUBLE AS xmax, ymax::DOUBLE AS ymax FROM parts""")
def dissolve_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single outlines' areas and bounds, with a surrogate id in a fixed order."""
    return _numbered_parts(_dissolved(spark, sf_dir))


def _numbered_parts(parts: DataFrame) -> DataFrame:
    from pyspark.sql import Window as W

    found = parts.withColumn("area", F.round("area", 3)).withColumn("box", S.st_box("geom")).select("urban", "area", "box.*")
    return found.withColumn("gid", F.row_number().over(W.partitionBy("urban").orderBy(F.desc("area"), "xmin", "ymin", "xmax", "ymax")))


def _dissolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = spread(read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")).distinct())
    i, j = F.col("k") % 40 * 100, F.floor(F.col("k") / 40) * 100
    squares = cells.select("k", (F.col("k") * 7919 % 5 < 3).alias("urban"), S.st_rectangle(i, j, i + 100, j + 100).alias("geom"))
    return overlay.union(squares, ["urban"]).withColumn("area", S.st_area("geom"))


#: Rectangles of two classes that overlap, contain and touch each other, on a raster of 50 m; their vertices lie anywhere on others' edges.
_RASTER_SQL = """(SELECT DISTINCT p_partkey AS k, p_partkey % 2 = 0 AS urban, (p_partkey * 3571 % 50000) // 50 AS i, (p_partkey * 7727 % 50000) // 50 AS j, 2 * (p_partkey % 7 + 1) AS w, 2 * (p_partkey % 5 + 1) AS h FROM part)"""


@query(f"""WITH node AS MATERIALIZED {_RASTER_SQL}, raster AS (SELECT k, urban, i + u AS i, j + v AS j FROM node, LATERAL (SELECT unnest(range(w)) AS u), LATERAL (SELECT unnest(range(h)) AS v)),
  link AS MATERIALIZED (SELECT a.k AS a, b.k AS b FROM node a JOIN node b ON a.urban = b.urban AND a.k <> b.k AND a.i <= b.i + b.w AND b.i <= a.i + a.w AND a.j <= b.j + b.h AND b.j <= a.j + a.h
    AND least(a.i + a.w, b.i + b.w) - greatest(a.i, b.i) + least(a.j + a.h, b.j + b.h) - greatest(a.j, b.j) > 0), {_LABELS_SQL},
  parts AS (SELECT urban, label, count(DISTINCT i * 1000000 + j) * 2500.0 AS area, min(i) * 50.0 AS xmin, min(j) * 50.0 AS ymin, max(i) * 50.0 + 50 AS xmax, max(j) * 50.0 + 50 AS ymax FROM raster JOIN labels USING (k) GROUP BY urban, label)
  SELECT urban, CAST(row_number() OVER (PARTITION BY urban ORDER BY area DESC, xmin, ymin, xmax, ymax) AS INT) AS gid, area::DOUBLE AS area, xmin::DOUBLE AS xmin, ymin::DOUBLE AS ymin, xmax::DOUBLE AS xmax, ymax::DOUBLE AS ymax FROM parts""")
def union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of overlapping rectangles by class, dumped."""
    k = F.col("p_partkey")
    x, y = F.floor(k * 3571 % 50000 / 50) * 50, F.floor(k * 7727 % 50000 / 50) * 50
    rects = spread(read_table(spark, sf_dir, "part").select(k)).select((k % 2 == 0).alias("urban"), S.st_rectangle(x, y, x + 100 * (k % 7 + 1), y + 100 * (k % 5 + 1)).alias("geom"))
    return _numbered_parts(overlay.union(rects, ["urban"]).withColumn("area", S.st_area("geom")))


@query("""SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 2 ELSE 1 END AS parts, CASE p_partkey % 4 WHEN 0 THEN (p_partkey % 9 + 1) * 10.0 * 50 WHEN 1 THEN 10000.0 WHEN 2 THEN 10000.0 - 900 ELSE (p_partkey % 9 + 1) * 1000.0 END::DOUBLE AS area,
  CASE WHEN p_partkey % 4 = 2 THEN 1 ELSE 0 END AS holes FROM part""")
def make_valid_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each part's polygon, a bow-tie, one with a spike, one whose hole is drawn the wrong way round, or one drawn twice in part, what is valid."""
    k = F.col("p_partkey")
    ring = lambda *p: F.array(*[F.struct(F.lit(a).cast("double").alias("x"), F.lit(b).cast("double").alias("y")) for a, b in p])
    x, y, w = k * 3571 % 50000, k * 7727 % 50000, (k % 9 + 1) * 10
    at = lambda *p: ring(*[(x + a, y + b) for a, b in p])
    rings = (
        F.when(k % 4 == 0, F.array(at((0, 0), (w, 100), (w, 0), (0, 100), (0, 0))))
        .when(k % 4 == 1, F.array(at((0, 0), (100, 0), (100, 100), (50, 100), (50, 180), (50, 100), (0, 100), (0, 0))))
        .when(k % 4 == 2, F.array(at((0, 0), (100, 0), (100, 100), (0, 100), (0, 0)), at((30, 30), (60, 30), (60, 60), (30, 60), (30, 30))))
        .otherwise(F.array(at((0, 0), (w, 0), (w, 100), (0, 100), (0, 0)), at((0, 0), (200, 0), (200, 50), (0, 50), (0, 0)), at((200, 0), (0, 0), (0, 50), (200, 50), (200, 0))))
    )
    raw = spread(read_table(spark, sf_dir, "part").select(k)).select(k.alias("id"), S.st_polygon(rings).alias("geom"))
    valid = overlay.make_valid(raw, ["id"])
    return valid.withColumns({"area": S.st_area("geom"), "holes": S.st_rings("geom") - 1}).groupBy("id").agg(F.count("*").cast("int").alias("parts"), F.round(F.sum("area"), 3).alias("area"), F.sum("holes").cast("int").alias("holes"))


@query(f"""WITH pair AS (SELECT spatial_id, code, greatest(ax, cx) AS x1, least(bx, dx) AS x2, greatest(ay, cy) AS y1, least(ey, dy) AS y2, (3 * cx + 2 * dx) / 5.0 AS u, (2 * cx + 3 * dx) / 5.0 AS v, (cy + dy) / 2.0 AS h FROM {_CELLS_SQL} JOIN {_RECTS_SQL} ON ax < dx AND cx < bx AND ay < dy AND cy < ey WHERE urban),
  cut AS (SELECT *, greatest(least(x2, v) - greatest(x1, u), 0) AS gap, greatest(y2 - greatest(y1, h), 0) AS deep FROM pair)
  SELECT spatial_id, code, round((x2 - x1) * (y2 - y1) - gap * deep, 1) AS area, CASE WHEN y1 >= h AND gap > 0 THEN (x1 < u)::INT + (x2 > v)::INT ELSE 1 END AS parts FROM cut WHERE (x2 - x1) * (y2 - y1) - gap * deep > 0.001""")
def intersection_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cells share with concave features, a rectangle with a notch of a fifth of its width down to half its height: in one part or in two."""
    k = F.col("p_partkey")
    ring = lambda *p: F.array(*[F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in p])
    x, y, w, h = k * 3571 % 50000, k * 7727 % 50000, 250 * (k % 7 + 1), 250 * (k % 5 + 1)
    notched = ring((x, y), (x + w, y), (x + w, y + h), (x + 3 * w / 5, y + h), (x + 3 * w / 5, y + h / 2), (x + 2 * w / 5, y + h / 2), (x + 2 * w / 5, y + h), (x, y + h), (x, y))
    features = spread(read_table(spark, sf_dir, "part").where(k % 2 == 0).select(k)).select(k.alias("code"), S.st_polygon(F.array(notched)).alias("geom"))
    # Equal cells and equal features are overlaid once; what they share is then joined with the rows of either side.
    cells = with_shape(_cells(spark, sf_dir).select("spatial_id", "cell_geom"), "cell_geom", "cell")
    features = written(with_shape(features, "geom", "feature"), "features")
    shared = overlay.intersection(shape_pairs(cells, features, "cell_geom", "geom", "cell", "feature"), ["cell", "feature"], "cell_geom", "geom")
    parts = shared.groupBy("cell", "feature").agg(F.round(F.sum(S.st_area("geom")), 1).alias("area"), F.count("*").cast("int").alias("parts")).where("area > 0.001")
    return parts.join(cells, "cell").join(features.hint("merge"), "feature").select("spatial_id", "code", "area", "parts")


@query("""WITH base AS (SELECT p_partkey AS id, p_partkey % 5 AS form, p_partkey * 3571 % 50000 AS x, p_partkey * 7727 % 50000 AS y, 10 * (p_partkey % 9 + 1) AS w FROM part),
  box AS (SELECT *, '(' || x || ' ' || y || ', ' || x + w || ' ' || y || ', ' || x + w || ' ' || y + w || ', ' || x || ' ' || y + w || ', ' || x || ' ' || y || ')' AS ring, '(' || x + 1 || ' ' || y + 1 || ', ' || x + 3 || ' ' || y + 1 || ', ' || x + 3 || ' ' || y + 4 || ', ' || x + 1 || ' ' || y + 1 || ')' AS inner_ring FROM base)
  SELECT id, CASE form WHEN 0 THEN 'POLYGON (' || ring || ')' WHEN 1 THEN 'POLYGON (' || ring || ', ' || inner_ring || ')' WHEN 2 THEN 'MULTIPOLYGON ((' || ring || '), ((0 0, -7 0, -7 -6.5, 0 0)))' WHEN 3 THEN 'LINESTRING ' || ring ELSE 'POLYGON EMPTY' END AS text,
    CASE form WHEN 0 THEN w * w WHEN 1 THEN w * w - 3 WHEN 2 THEN w * w + 22.75 ELSE 0 END::DOUBLE AS area, CASE form WHEN 3 THEN 4 * w ELSE 0 END::DOUBLE AS length FROM box""")
def well_known_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of each part's polygon, one with a hole, two, their outline or none, in loose spelling: read, measured and written again."""
    k = F.col("p_partkey")
    x, y, w = k * 3571 % 50000, k * 7727 % 50000, 10 * (k % 9 + 1)
    ring = lambda *points: F.concat(F.lit("( "), F.concat_ws(" , ", *[F.concat(a.cast("string"), F.lit("  "), b.cast("string")) for a, b in points]), F.lit(")"))
    box = ring((x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y))
    hole = ring((x + 1, y + 1), (x + 3, y + 1), (x + 3, y + 4), (x + 1, y + 1))
    text = (
        F.when(k % 5 == 0, F.concat(F.lit("Polygon("), box, F.lit(")")))
        .when(k % 5 == 1, F.concat(F.lit("POLYGON ("), box, F.lit(","), hole, F.lit(")")))
        .when(k % 5 == 2, F.concat(F.lit("SRID=27700;multipolygon(("), box, F.lit("),(( 0 0,-7 0,-7 -6.5,0 0)))")))
        .when(k % 5 == 3, F.concat(F.lit("LINESTRING"), box))
        .otherwise("POLYGON  EMPTY")
    )
    read = spread(read_table(spark, sf_dir, "part").select(k)).select(k.alias("id"), from_text(text).alias("geom"))
    return read.select("id", to_text(F.col("geom")).alias("text"), S.st_area("geom").alias("area"), S.st_length("geom").alias("length"))


#: A street of 30 nodes, 100 m apart, for each supplier, and streets across; some pieces are left out. Walks of at most 300 m.
_NODES = 30


def _network(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    streets = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(_NODES - 1))).alias("i"))
    nodes = streets.select((F.col("s") * _NODES + F.col("i")).alias("node"), (F.col("i") * 100.0).alias("x"), (F.col("s") * 100.0).alias("y"), "s", "i")
    along = nodes.where(f"i < {_NODES - 1} and node % 7 <> 0").select(F.col("node").alias("u"), (F.col("node") + 1).alias("v"), F.lit(100.0).alias("length"))
    last = streets.agg(F.max("s")).first()[0]
    up = nodes.where((F.col("s") < F.lit(last)) & (F.col("node") % 5 != 0)).select(F.col("node").alias("u"), (F.col("node") + _NODES).alias("v"), F.lit(100.0).alias("length"))
    return along.union(up), nodes.select("node", "x", "y")


@query(f"""WITH RECURSIVE node AS (SELECT s_suppkey AS s, i, s_suppkey * {_NODES} + i AS node FROM supplier, range({_NODES}) AS r(i)),
  edge AS (SELECT node AS u, node + 1 AS v FROM node WHERE i < {_NODES - 1} AND node % 7 <> 0 UNION ALL SELECT node, node + {_NODES} FROM node WHERE s < (SELECT max(s_suppkey) FROM supplier) AND node % 5 <> 0),
  both_ways AS (SELECT u, v FROM edge UNION ALL SELECT v, u FROM edge),
  walk AS (SELECT s_suppkey AS place, s_suppkey * {_NODES} + (s_suppkey * 13) % {_NODES} AS node, 0 AS d FROM supplier UNION SELECT place, v, d + 100 FROM walk JOIN both_ways ON u = node WHERE d + 100 <= 300)
  SELECT place AS urn, count(DISTINCT node) AS n_nodes FROM walk GROUP BY 1""")
def isochrone_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _isochrones(spark, sf_dir).select(F.col("place").alias("urn"), "n_nodes")


@query()
def isochrone_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _isochrones(spark, sf_dir)


def _isochrones(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, nodes = _network(spark, sf_dir)
    s = F.col("s_suppkey")
    places = read_table(spark, sf_dir, "supplier").select(s.alias("place"), (s * 13 % _NODES * 100.0 + 20.0).alias("px"), (s * 100.0 - 30.0).alias("py"))
    return isochrones(places, edges, nodes, 300.0)


# The hexagonal grid and the wide table ---------------------------------------------------------------------------


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return spread(read_table(spark, sf_dir, "customer").select(k)).select(k, (F.lit(-5.0) + k * 7919 % 6000 / F.lit(1000.0)).alias("lon"), (F.lit(50.5) + k * 104729 % 6000 / F.lit(1000.0)).alias("lat"))


@query()
def h3_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).select("c_custkey", *[S.cell_of("lat", "lon", r).alias(f"h3_{r}_id") for r in (8, 9, 10, 11)])


@query()
def h3_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h3_cells(spark, sf_dir).select("c_custkey", S.cell_area("h3_8_id").alias("area_8"), S.cell_area("h3_10_id").alias("area_10"))


@query()
def h3_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h3_cells(spark, sf_dir).select("c_custkey", S.cell_boundary("h3_8_id").alias("boundary"), S.st_area(S.cell_boundary("h3_8_id", on_grid=True)).alias("planar_area"))


def _place_relations(spark: SparkSession, sf_dir: str):
    """Crimes from events around one town, square boundaries of five sizes; each part is a greenspace, road or centre by its type."""
    from cellweave.steps.base import Relations

    e, u = _events(spark, sf_dir), F.col("user_id")
    crimes = e.select(F.when(F.col("px").isNotNull(), F.lit(-1.6) + u * 7919 % 1000 / F.lit(8000.0)).alias("longitude"), F.when(F.col("py").isNotNull(), F.lit(53.75) + u * 104729 % 1000 / F.lit(12000.0)).alias("latitude"), F.when(F.col("force") == "transport", "British Transport Police").otherwise(F.col("force")).alias("falls_within"), F.col("event_type").alias("crime_type"), F.date_format("ts", "yyyy-MM").alias("_month"))
    found = {"crime_data": crimes}
    for table, size in (("police_force_areas", 40000), ("local_authority_districts", 9000), ("msoa_2021", 3000), ("lsoa_2021", 1500), ("output_areas_2021", 700)):
        n = 22000 // size + 2
        x, y = F.col("id") % n * size + 418000, F.floor(F.col("id") / n) * size + 425000
        found[table] = spark.range(n * n).select(F.concat(F.lit(table[0].upper()), F.lpad(F.col("id").cast("string"), 8, "0")).alias("spatial_id"), S.st_rectangle(x, y, x + size, y + size).alias("geom"))
    k = F.col("p_partkey")
    x, y = k * 3571 % 22000 + 418000, k * 7727 % 22000 + 425000
    parts = read_table(spark, sf_dir, "part")
    found["open_greenspace"] = parts.where("p_type in ('SMALL', 'MEDIUM', 'LARGE')").select(k.cast("string").alias("id"), F.col("p_type").alias("function"), S.st_rectangle(x, y, x + 200, y + 150).alias("geom"))
    found["open_roads"] = parts.where("p_type in ('STANDARD', 'ECONOMY')").select(k.cast("string").alias("id"), F.col("p_type").alias("road_function"), S.st_line(x.cast("double"), y.cast("double"), (x + 900).cast("double"), (y + 400).cast("double")).alias("geom"))
    found["retail_centres"] = parts.where("p_type = 'PROMO'").select(k.cast("string").alias("rc_id"), S.st_rectangle(x, y, x + 300, y + 300).alias("geom"))
    return Relations(found)


@query()
def geogs_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain at resolution 8: counts, look-ups, folds, wide table. What cells share is written once."""
    from cellweave.steps.transforms import STEPS
    from cellweave.storage import written

    relations = _place_relations(spark, sf_dir)
    for step in STEPS:
        for name, df in step.build(relations, (8,)).items():
            relations.put(name, df if step.name == "geogs" else written(df, name))
    return relations["h3_8_geogs"]


@query()
def h3_crime_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellweave.steps.transforms import crime_counts

    return crime_counts(_place_relations(spark, sf_dir), (9,))["crime_counts_h3_9"]
