"""Queries for unified, deduplicated observations and their indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.operators import dedup, filters, joins, windows
from obslake.plans import silver
from obslake.registry.adapters import ctes, ev, feed, raw
from obslake.registry.base import query

EV = ctes("ev")
UNIFIED = (
    "station_id:s station_name:s city:s country:s latitude:f longitude:f elevation:f timestamp:t "
    "temperature:f precipitation:f wind_speed:f snow:f source:s dt:d"
)
INDICATORS = "station_id:s timestamp:t temperature:f temp_ma3:f temp_ma7:f temp_std7:f temp_anomaly:f"

TRAILING = """SELECT *, temperature - temp_ma7 AS temp_anomaly FROM (SELECT station_id, "timestamp", temperature,
  avg(temperature) OVER (PARTITION BY station_id ORDER BY "timestamp" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS temp_ma3,
  avg(temperature) OVER w AS temp_ma7, stddev_samp(temperature) OVER w AS temp_std7 FROM ev
  WINDOW w AS (PARTITION BY station_id ORDER BY "timestamp" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS t"""


def unified_frames(spark, sf):
    return [silver.normalise_archive(raw(spark, sf)), silver.normalise_feed(feed(spark, sf))]


@query("p08_normalise_archive", UNIFIED, "SELECT * FROM archive", ctes("archive"))
def normalise_archive(spark, sf):
    return silver.normalise_archive(raw(spark, sf))


@query("p09_normalise_feed", UNIFIED, "SELECT * FROM feed", ctes("feed"))
def normalise_feed(spark, sf):
    return silver.normalise_feed(feed(spark, sf))


@query(
    "p10_with_time", UNIFIED, """SELECT * FROM feed WHERE "timestamp" IS NOT NULL""", ctes("feed")
)
def with_time(spark, sf):
    return filters.with_time(silver.normalise_feed(feed(spark, sf)))


@query(
    "p11_date_range", INDICATORS + " dt:d",
    "SELECT * FROM silver WHERE dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'", ctes("silver"),
)
def date_range(spark, sf):
    return silver.build_silver(unified_frames(spark, sf), "2024-01-10", "2024-01-20")


@query(
    "p12_listed_partitions", "station_id:s dt:d temperature:f",
    """SELECT station_id, dt, temperature FROM ev WHERE dt IN (SELECT CAST(ts AS DATE) FROM events
    WHERE value > 300)""", EV,
)
def listed_partitions(spark, sf):
    rows = ev(spark, sf)
    return filters.partitions(rows, "dt", rows.where(F.col("wind_speed") > 30))


@query("u01_union_sources", UNIFIED, "SELECT * FROM unified", ctes("unified"))
def union_sources(spark, sf):
    return joins.union_all(unified_frames(spark, sf))


@query(
    "u02_union_present", "source:s n:l",
    "SELECT source, count(*) AS n FROM unified GROUP BY source", ctes("unified"),
)
def union_present(spark, sf):
    first, second = unified_frames(spark, sf)
    return joins.union_all([None, first, None, second]).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("u03_distinct_days", "dt:d", "SELECT DISTINCT dt FROM ev", EV)
def distinct_days(spark, sf):
    return ev(spark, sf).select("dt").distinct()


@query("w01_dedup_observations", UNIFIED, "SELECT * FROM silver_rows", ctes("silver_rows"))
def dedup_observations(spark, sf):
    return dedup.dedup_observations(filters.with_time(joins.union_all(unified_frames(spark, sf))))


@query("w02_w05_indicators", INDICATORS, TRAILING, EV)
def indicators(spark, sf):
    return windows.trailing_indicators(ev(spark, sf))


@query("w02_w05_indicators_hot_station", INDICATORS, TRAILING, EV)
def indicators_hot_station(spark, sf):
    """The same with series cut every half day."""
    return windows.trailing_indicators(ev(spark, sf), days=0.5)


@query(
    "w02_w05_indicators_by_days", INDICATORS,
    """SELECT station_id, "timestamp", temperature, temp_ma3, temp_ma7, temp_std7, temperature - temp_ma7 AS temp_anomaly
    FROM (SELECT station_id, "timestamp", temperature, avg(temperature) OVER three AS temp_ma3,
    avg(temperature) OVER week AS temp_ma7, stddev_samp(temperature) OVER week AS temp_std7 FROM ev WINDOW
    three AS (PARTITION BY station_id ORDER BY dt RANGE BETWEEN INTERVAL 2 DAY PRECEDING AND CURRENT ROW),
    week AS (PARTITION BY station_id ORDER BY dt RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)) AS t""", EV,
)
def indicators_by_days(spark, sf):
    return windows.trailing_days(ev(spark, sf))


@query(
    "silver_table", UNIFIED + " temp_ma3:f temp_ma7:f temp_std7:f temp_anomaly:f",
    "SELECT * FROM silver", ctes("silver"),
)
def silver_table(spark, sf):
    return silver.build_silver(unified_frames(spark, sf))


@query(
    "silver_table_hot_station", UNIFIED + " temp_ma3:f temp_ma7:f temp_std7:f temp_anomaly:f",
    "SELECT * FROM silver", ctes("silver"),
)
def silver_table_hot_station(spark, sf):
    """The whole job with series cut every second day."""
    return silver.build_silver(unified_frames(spark, sf), days=2)
