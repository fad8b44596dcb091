"""One row per key, chosen by a fixed rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.schemas import MEASURES

OBSERVATION_KEY = ["station_id", "timestamp"]


def keep_first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one row per key and task before the shuffle, so a key with
    many copies does not travel whole.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def fullest_first(columns: list[str]) -> list[Column]:
    """Order for copies of an observation: most measures first, then by value."""
    present = [c for c in MEASURES if c in columns]
    filled = sum((F.col(c).isNotNull().cast("int") for c in present), F.lit(0))
    rest = [c for c in columns if c not in (*OBSERVATION_KEY, "source", "dt")]
    return [filled.desc(), *[F.asc_nulls_last(c) for c in ["source", *rest]]]


def known_stations(rows: DataFrame) -> DataFrame:
    """Rows that name their station."""
    return rows.where(F.trim("station_id") != "")


def unknown_stations(rows: DataFrame) -> DataFrame:
    """The other rows, with a reason: they share no key, so none of them is a copy of another."""
    unnamed = rows.where(F.col("station_id").isNull() | (F.trim("station_id") == ""))
    return unnamed.withColumn("reason", F.lit("station unknown"))


def dedup_observations(rows: DataFrame) -> DataFrame:
    """One row per station and time; the survivor does not depend on input order."""
    return keep_first(rows, OBSERVATION_KEY, fullest_first(rows.columns))


def preferred_source(rows: DataFrame, key: list[str], preferred: str = "OPENMETEO") -> DataFrame:
    """Per key the row of the preferred source, else of the first other source."""
    other = F.upper(F.coalesce("source", F.lit(""))) != preferred
    rest = [F.asc_nulls_last(c) for c in rows.columns if c not in (*key, "source")]
    return keep_first(rows, key, [other.cast("int"), F.asc_nulls_last("source"), *rest])
