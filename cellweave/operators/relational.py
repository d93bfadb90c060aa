"""Relational operators of the place pipeline: counts, folds, ranks, look-ups and survivors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key combination; the partial counts combine before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def counts_within(df: DataFrame, cell: str, cells: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Counts by ``cell`` and ``keys`` of the rows whose cell occurs in ``cells`` (one column ``spatial_id``)."""
    kept = df.join(cells.select(F.col("spatial_id").alias(cell)).distinct(), cell, "left_semi")
    return group_counts(kept.withColumnRenamed(cell, "spatial_id"), ["spatial_id", *keys], name)


def countable_events(df: DataFrame, lat: str, lon: str, force: str, excluded: str) -> DataFrame:
    """Rows with coordinates and a force other than ``excluded``; a null force is dropped, as SQL's ``<>`` does."""
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & (F.col(force) != excluded))


def category(column: Column, mapping: Mapping[str, str], default: str) -> Column:
    """A fixed code list as one map literal; unknown and null codes give ``default``."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(default))


def numeric_text(column: str) -> Column:
    """A text column as double, null where it holds no number."""
    return F.col(column).try_cast("double")


def without_prefix(column: str, prefix: str) -> Column:
    """True where the text doesn't start with ``prefix``; nulls are kept."""
    return F.col(column).isNull() | ~F.col(column).startswith(prefix)


def first_of_list(column: str, field: str) -> Column:
    """A field of the first struct of an array, null for an empty or null array."""
    return F.try_element_at(F.col(column), F.lit(1))[field]


def trimmed(column: Column) -> Column:
    """Without space separators of any kind at both ends, the no-break space included."""
    return F.regexp_replace(column, r"^\p{Zs}+|\p{Zs}+$", "")


def distinct_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the least by all other columns in order, so that reruns keep the same one; null keys are one key."""
    rest = [c for c in df.columns if c not in keys]
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row_"))
    return least.select(*keys, *[F.col(f"row_.{c}").alias(c) for c in rest]).select(*df.columns)


def best_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group; Spark limits the groups before the shuffle."""
    nth = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("nth_", nth).where(F.col("nth_") == 1).drop("nth_")


def pct_rank(value: str, within: Sequence[str]) -> Column:
    """Percentile rank with average ranks for ties, over the non-null values of each group; null stays null."""
    rows = W.partitionBy(*within)
    ties = F.count("*").over(W.partitionBy(*within, value))
    place = F.rank().over(rows.orderBy(F.col(value).asc_nulls_last()))
    return F.when(F.col(value).isNotNull(), (place + (ties - 1) / F.lit(2.0)) / F.count(value).over(rows))


def min_rank_desc(value: str, within: Sequence[str]) -> Column:
    """Rank from the largest value, ties sharing the least rank."""
    return F.rank().over(W.partitionBy(*within).orderBy(F.col(value).desc_nulls_last())).cast("long")


def decode_hierarchy(codes: DataFrame, code: str, level: str, name: str) -> DataFrame:
    """``code, subgroup_name, group_name, supergroup_name`` for three-level codes such as ``1a1``.

    Levels are ``subg``, ``g`` and ``sg``; a group's code is the first two characters, a supergroup's the first; a
    missing parent gives null. The code list is a dimension of a few dozen rows.
    """
    tidy = codes.select(trimmed(F.col(code)).alias("code"), trimmed(F.col(level)).alias("level"), trimmed(F.col(name)).alias("name"))
    subs = tidy.where("level = 'subg'").select("code", F.col("name").alias("subgroup_name"))
    groups = tidy.where("level = 'g'").select(F.col("code").alias("g"), F.col("name").alias("group_name"))
    supers = tidy.where("level = 'sg'").select(F.col("code").alias("sg"), F.col("name").alias("supergroup_name"))
    found = subs.join(groups, F.left("code", F.lit(2)) == F.col("g"), "left").join(supers, F.left("code", F.lit(1)) == F.col("sg"), "left")
    return found.select("code", "subgroup_name", "group_name", "supergroup_name")


def code_by_name(df: DataFrame, lookup: DataFrame, name: str, code: str) -> DataFrame:
    """``df`` with the look-up's code for each name: null where unmatched; a name with several codes gets the largest."""
    return df.join(lookup.groupBy(name).agg(F.max(code).alias(code)), name, "left")


def fold(lookup: DataFrame, prefix: str, measure: str, how: str) -> DataFrame:
    """Per cell the sorted list of ids and one measure: ``max`` for areas, which may overlap, ``sum`` for lengths."""
    agg = {"max": F.max, "sum": F.sum}[how]
    return lookup.groupBy("spatial_id").agg(F.sort_array(F.collect_list(f"{prefix}_id")).alias(f"{prefix}_ids"), agg(measure).alias(f"{prefix}_{measure}"))


def wide(base: DataFrame, *others: DataFrame) -> DataFrame:
    """Left joins on ``spatial_id``; all sides are partitioned by it once."""
    return reduce(lambda left, right: left.join(right, "spatial_id", "left"), others, base)
