"""Frames behind the report views: latest day, series, top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import contains_text
from obslake.functions.weather import day_symbol, event_group, temperature_band, weather_icon
from obslake.operators.dedup import keep_first, preferred_source
from obslake.operators.filters import last_days, newest_day, of_source
from obslake.operators.joins import with_coordinates


def top_locations(obs: DataFrame, n: int = 200) -> DataFrame:
    """The ``n`` locations with most observations; equal counts in name order."""
    counts = obs.groupBy("location").agg(F.count(F.lit(1)).alias("n_obs"))
    return counts.orderBy(F.desc("n_obs"), "location").limit(n)


def latest_events(events: DataFrame, n: int = 10) -> DataFrame:
    order = [F.desc("dt"), "city", "source", "event_type"]
    return events.orderBy(*order).limit(n)


def latest_forecasts(forecasts: DataFrame, n: int = 5) -> DataFrame:
    return forecasts.orderBy(F.desc("dt"), "city", "source", "temp_predicted").limit(n)


def last_points(series: DataFrame, n: int = 30) -> DataFrame:
    """The newest ``n`` points in time order."""
    return series.orderBy(F.desc("dt")).limit(n).orderBy("dt")


def station_series(daily: DataFrame, city: str, field: str = "temp_avg") -> DataFrame:
    """One city's values with a month-day label, in time order."""
    return (
        daily.where(F.col("city") == city)
        .select("dt", "source", F.date_format("dt", "MM-dd").alias("label"), F.col(field).alias("value"))
        .orderBy("dt", "source")
    )


def recent_events(events: DataFrame, daily: DataFrame, days: int = 7) -> DataFrame:
    """Events of the last days before the newest daily row, newest first."""
    newest = daily.select(F.max("dt")).scalar()
    return (
        events.where(F.col("dt") >= F.date_sub(newest, days))
        .withColumn("kind", event_group(F.col("event_type")))
        .orderBy(F.desc("dt"), "city", "source", "event_type")
    )


def temperature_trend(daily: DataFrame, days: int = 30, source: str = "OPENMETEO") -> DataFrame:
    """Daily means of one source per city over the last days."""
    return of_source(last_days(daily, days), source).select("dt", "city", "temp_avg").orderBy("dt", "city")


def city_cards(daily: DataFrame) -> DataFrame:
    """Latest-day figures per city from its preferred source, with an icon class."""
    cards = preferred_source(newest_day(daily), ["city", "dt"])
    icon = weather_icon(*[F.col(c) for c in ("snow_sum", "precip_sum", "wind_avg", "temp_avg")])
    return cards.select(
        "dt", "city", "source", "temp_avg", "temp_min", "temp_max", icon.alias("icon")
    )


def map_points(daily: DataFrame, catalog: DataFrame) -> DataFrame:
    """Latest temperature per city with coordinates, for every city that has some."""
    named = newest_day(daily).where(F.coalesce("city", F.lit("")) != "")
    latest = keep_first(named, ["city"], [F.asc_nulls_last("source"), F.asc_nulls_last("temp_avg")])
    return with_coordinates(latest.select("city", "temp_avg"), catalog).select(
        "city", "lat", "lon", F.round("temp_avg", 3).alias("temperature")
    )


def card_points(daily: DataFrame, catalog: DataFrame) -> DataFrame:
    """Map points from the preferred source, without cities lacking a temperature."""
    cards = city_cards(daily).where(F.col("temp_avg").isNotNull())
    return with_coordinates(cards.select("city", "temp_avg"), catalog)


def search_points(points: DataFrame, part: str) -> DataFrame:
    return points.where(contains_text(F.col("city"), part))


def display_classes(daily: DataFrame) -> DataFrame:
    """Temperature band and day symbol of each daily row."""
    return daily.select(
        "dt", "city", "source",
        temperature_band(F.col("temp_avg")).alias("band"),
        day_symbol(F.col("temp_avg"), F.col("precip_sum")).alias("symbol"),
    )


def forecast_series(forecasts: DataFrame) -> DataFrame:
    """Actual and predicted values as one long series per city."""
    long = forecasts.select("dt", "city", "source", "temp_actual", "temp_predicted").unpivot(
        ["dt", "city", "source"], ["temp_actual", "temp_predicted"], "series", "value"
    )
    return long.where(F.col("value").isNotNull()).orderBy("city", "series", "dt")
