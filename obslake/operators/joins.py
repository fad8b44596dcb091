"""Lookups, differences and matrix indexes.

A side is broadcast by hint only when its rows are limited by the calendar or a
top-n; otherwise Spark's own size check decides, at run time too, and a shuffle join is the other way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.session import settle

# Coordinates used for a city the catalogue does not know.
CITY_COORDS = {
    "Paris": (48.8566, 2.3522),
    "Lyon": (45.7640, 4.8357),
    "Marseille": (43.2965, 5.3698),
    "Bordeaux": (44.8378, -0.5792),
    "Lille": (50.6292, 3.0573),
}


def union_all(frames: list[DataFrame | None]) -> DataFrame | None:
    """Union by name of the frames that exist; None when none does."""
    found = [f for f in frames if f is not None]
    return reduce(DataFrame.unionByName, found) if found else None


def pending(keys: DataFrame, done: DataFrame, key: str = "key", order: str | None = None) -> DataFrame:
    """Keys not done yet, each once; with ``order`` the first position is kept."""
    todo = keys.join(done.select(key), key, "left_anti")
    if order is None:
        return todo.select(key).distinct()
    return todo.groupBy(key).agg(F.min(order).alias(order))


def batch_plan(departments: DataFrame, periods: DataFrame, done: DataFrame) -> DataFrame:
    """Every department with every period that is not done.

    The periods are at most two, so they are spread as an array, not joined.
    """
    wanted = periods.agg(F.collect_set("period").alias("periods"))
    listed = wanted.select(F.array_sort("periods")).scalar()
    units = departments.withColumn("period", F.explode(listed)).withColumn(
        "key", F.concat_ws(":", "department", "period")
    )
    return units.join(done.select("key"), "key", "left_anti")


def semi(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_semi")


def encode(df: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """Index of each value from ``labels``; an unknown value gives -1."""
    mapping = labels.select(F.col("label").alias(column), F.col("idx").alias(out))
    return df.join(mapping, column, "left").withColumn(out, F.coalesce(out, F.lit(-1)))


def dense_index(df: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """The distinct values of a column with their rank from 0.

    The values are range-partitioned, ranked within their part, and each part's
    offset is the number of values in the parts before it: one row per part is all that is brought together.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    # fixed, so that both uses see the same parts
    placed = settle(values.repartitionByRange(column).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(column))
    ranked = placed.withColumn("_row", inside).join(F.broadcast(offsets), "_part")
    return ranked.select(column, (F.col("_before") + F.col("_row") - 1).cast("int").alias(name))


def label_index(df: DataFrame, column: str) -> DataFrame:
    """Labels of a text column with their rank from 0."""
    return dense_index(df.select(F.col(column).cast("string").alias("label")), "label")


def heat_matrix(df: DataFrame, row: str, step: str, value: str) -> DataFrame:
    """``x`` = index of the step, ``y`` = index of the row name, for each known value."""
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))
    rows, steps = dense_index(df.where(F.col(row) != ""), row, "y"), dense_index(df, step, "x")
    return known.join(rows, row).join(steps, step).select("x", "y", F.col(value).alias("value"))


def _fallback(position: int) -> Column:
    pairs = [F.lit(v) for city, at in CITY_COORDS.items() for v in (city, at[position])]
    return F.try_element_at(F.create_map(*pairs), F.col("city"))


def with_coordinates(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds ``lat`` and ``lon``; rows without known coordinates are dropped."""
    return (
        df.join(catalog.select("city", "lat", "lon"), "city", "left")
        .withColumns({"lat": F.coalesce("lat", _fallback(0)), "lon": F.coalesce("lon", _fallback(1))})
        .where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    )
