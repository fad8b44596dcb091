"""Compact JSON export of the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.formats import clean_values
from obslake.operators.aggregates import annual_trend, kpi_summary, station_catalog, table_counts
from obslake.operators.joins import CITY_COORDS
from obslake.operators.views import map_points
from obslake.sources.sinks import write_json


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one compact JSON text."""
    cleaned = clean_values(df)
    return cleaned.select(F.to_json(F.struct(*cleaned.columns), {"ignoreNullFields": "false"}).alias("json"))


def known_stations(obs: DataFrame | None, spark: SparkSession) -> DataFrame:
    """The station catalogue, or the fixed cities when there are no observations."""
    if obs is not None:
        return station_catalog(obs)
    rows = [(city, *at) for city, at in CITY_COORDS.items()]
    return spark.createDataFrame(rows, "city string, lat double, lon double")


def exported_cities(daily: DataFrame) -> DataFrame:
    return daily.where(F.coalesce("city", F.lit("")) != "").select("city").distinct().orderBy("city")


def require_rows(counts: DataFrame, allow_empty: bool = False) -> DataFrame:
    """Raises when every exported table is empty, unless that is allowed."""
    if not allow_empty:
        total = counts.where("table_name = 'total'").first()["n"]
        if not total:
            raise ValueError("every exported table is empty")
    return counts


def export_snapshot(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    weekly: DataFrame,
    obs: DataFrame | None,
    path: str,
    allow_empty: bool = False,
) -> DataFrame:
    """Writes each table, the trend, the map, the stations and the figures; returns the counts."""
    counts = require_rows(table_counts({**tables, "weekly_trends": weekly}), allow_empty)
    daily, catalog = tables["daily_aggregates"], known_stations(obs, spark)
    parts = {
        **tables,
        "trend": annual_trend(weekly),
        "map": map_points(daily, catalog),
        "stations": catalog,
        "meta": kpi_summary(daily),
        "cities": exported_cities(daily),
        "rows": counts,
    }
    for name, df in parts.items():
        write_json(clean_values(df), f"{path}/{name}")
    return counts
