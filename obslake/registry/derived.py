"""Queries for the derived tables and the report views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from obslake.functions.text import department_code
from obslake.operators import aggregates, dedup, joins, views
from obslake.plans import reports, snapshot
from obslake.registry.adapters import (
    EVENT_LIMITS, ctes, daily, ev, forecasts, found_events, li, li_daily, table,
)
from obslake.registry.base import query
from obslake.sources.storage import periods_for_years

EV, LI, DAILY, LI_DAILY = ctes("ev"), ctes("li"), ctes("daily"), ctes("li_daily")
WEEKLY, FOUND, FORECASTS = ctes("weekly"), ctes("found"), ctes("forecasts")

DAILY_SHAPE = (
    "dt:d city:s source:s n_obs:l temp_avg:f temp_min:f temp_max:f precip_sum:f wind_avg:f snow_sum:f temp_std:f"
)
WEEKLY_SHAPE = (
    "year:l week:l city:s source:s temp_avg:f temp_min:f temp_max:f precip_sum:f n_days:l "
    "trend_slope:f temp_vs_prev_week:f"
)
PREVIOUS = """SELECT *, temp_avg - lag(temp_avg) OVER (PARTITION BY city, source ORDER BY year, week)
  AS temp_vs_prev_week FROM weekly"""
EVENT_SHAPE = "dt:d city:s source:s event_type:s severity:s value:f threshold:f detail:s"


@query("a01_daily_aggregates", DAILY_SHAPE, "SELECT * FROM daily", DAILY)
def daily_aggregates(spark, sf):
    return daily(spark, sf)


@query("a01_daily_aggregates_years", DAILY_SHAPE, "SELECT * FROM li_daily", LI_DAILY)
def daily_aggregates_years(spark, sf):
    return li_daily(spark, sf)


@query("a02_weekly_trends", WEEKLY_SHAPE, PREVIOUS, WEEKLY)
def weekly_trends(spark, sf):
    return aggregates.weekly_trends(li_daily(spark, sf))


@query(
    "a02_weekly_trends_iso", WEEKLY_SHAPE, PREVIOUS,
    WEEKLY.replace("year(dt) AS year, week(dt)", "isoyear(dt) AS year, week(dt)"),
)
def weekly_trends_iso(spark, sf):
    return aggregates.weekly_trends(li_daily(spark, sf), week_year="iso")


@query(
    "a03_slope_pairs", "year:l week:l city:s source:s trend_slope:f",
    """SELECT year(dt) AS year, week(dt) AS week, city, source, coalesce(CASE WHEN count(temp_avg) >= 2
    THEN regr_slope(temp_avg, CAST(dt - DATE '2024-01-01' AS DOUBLE)) END, 0.0) AS trend_slope
    FROM daily GROUP BY 1, 2, 3, 4""", DAILY,
)
def slope_pairs(spark, sf):
    return aggregates.weekly_trends(daily(spark, sf), slope="pairs")


CLIMATE_SHAPE = (
    "city:s month:l season:s temp_normal:f temp_min_record:f temp_max_record:f temp_amplitude_avg:f "
    "precip_avg:f rain_days:l rain_day_ratio:f wind_avg:f n_days:l n_years:l"
)
CLIMATE = """SELECT city, month(dt) AS month, CASE WHEN month(dt) IN (12, 1, 2) THEN 'hiver'
  WHEN month(dt) <= 5 THEN 'printemps' WHEN month(dt) <= 8 THEN 'ete' ELSE 'automne' END AS season,
  avg(temp_avg) AS temp_normal, min(temp_min) AS temp_min_record, max(temp_max) AS temp_max_record,
  avg(temp_max - temp_min) AS temp_amplitude_avg, avg(precip_sum) AS precip_avg,
  count(*) FILTER (precip_sum > 1.0) AS rain_days,
  {ratio} AS rain_day_ratio,
  avg(wind_avg) AS wind_avg, count(DISTINCT dt) AS n_days, count(DISTINCT year(dt)) AS n_years
  FROM li_daily GROUP BY city, month(dt)"""
RATIO = "round(count(*) FILTER (precip_sum > 1.0) / count(DISTINCT dt), 3)"


@query("a04_climate_profile", CLIMATE_SHAPE, CLIMATE.format(ratio=RATIO), LI_DAILY)
def climate_profile(spark, sf):
    return aggregates.climate_profile(li_daily(spark, sf))


@query(
    "a05_rain_days", "city:s source:s rain_days:l",
    "SELECT city, source, count(*) FILTER (precip_sum > 1.0) AS rain_days FROM li_daily GROUP BY 1, 2", LI_DAILY,
)
def rain_days(spark, sf):
    wet = F.count_if(F.col("precip_sum") > aggregates.RAIN_DAY_MM)
    return li_daily(spark, sf).groupBy("city", "source").agg(wet.alias("rain_days"))


@query("a06_rain_ratio_clamped", CLIMATE_SHAPE, CLIMATE.format(ratio=f"least(1.0, {RATIO})"), LI_DAILY)
def rain_ratio_clamped(spark, sf):
    return aggregates.climate_profile(li_daily(spark, sf), clamp=True)


@query(
    "a07_distinct_counts", "stations:l days:l years:l",
    "SELECT count(DISTINCT station_id) AS stations, count(DISTINCT dt) AS days, count(DISTINCT year(dt)) AS years FROM li",
    LI,
)
def distinct_counts(spark, sf):
    return li(spark, sf).agg(
        F.countDistinct("station_id").alias("stations"),
        F.countDistinct("dt").alias("days"),
        F.countDistinct(F.year("dt")).alias("years"),
    )


@query(
    "a08_annual_trend", "year:l avg:f min:f max:f band:f",
    """SELECT year, round(avg(temp_avg), 2) AS avg, round(min(temp_avg), 2) AS min, round(max(temp_avg), 2) AS max,
    round(max(temp_avg), 2) - round(min(temp_avg), 2) AS band FROM weekly GROUP BY year""", WEEKLY,
)
def annual_trend(spark, sf):
    return aggregates.annual_trend(aggregates.weekly_trends(li_daily(spark, sf)))


@query(
    "a09_kpi_summary", "cities:l observations:l temp_avg:f precip_total:f last_day:s",
    """SELECT count(DISTINCT city) FILTER (dt = last) AS cities, sum(n_obs) AS observations,
    round(avg(temp_avg) FILTER (dt = last), 1) AS temp_avg, round(sum(precip_sum) FILTER (dt = last), 1) AS precip_total,
    CAST(max(dt) AS VARCHAR) AS last_day FROM daily, (SELECT max(dt) AS last FROM daily) AS m""", DAILY,
)
def kpi_summary(spark, sf):
    return aggregates.kpi_summary(daily(spark, sf))


@query(
    "a10_network_daily", "dt:d value:f",
    "SELECT dt, avg(temp_avg) AS value FROM daily WHERE temp_avg IS NOT NULL GROUP BY dt ORDER BY dt DESC LIMIT 30",
    DAILY,
)
def network_daily(spark, sf):
    return views.last_points(aggregates.network_daily(daily(spark, sf)), 30)


@query(
    "a11_event_shares", "event_type:s n:l share:f",
    "SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM found) AS share FROM found GROUP BY 1", FOUND,
)
def event_shares(spark, sf):
    return aggregates.shares(found_events(spark, sf), "event_type")


@query(
    "a12_forecast_scores", "rmse:f mae:f n_pending:l",
    """SELECT sqrt(avg((temp_predicted - temp_actual) ** 2)) AS rmse, avg(abs(temp_predicted - temp_actual)) AS mae,
    count(*) FILTER (temp_actual IS NULL) AS n_pending FROM forecasts
    WHERE dt >= (SELECT max(dt) FROM forecasts) - INTERVAL 14 DAY""", FORECASTS,
)
def forecast_scores(spark, sf):
    rows = forecasts(spark, sf).withColumn("dt", F.col("dt").cast("date"))
    return aggregates.forecast_scores(rows)


@query("a13_mean_error", "mae:f", "SELECT avg(error_abs) AS mae FROM forecasts", FORECASTS)
def mean_error(spark, sf):
    return aggregates.mean_error(forecasts(spark, sf))


@query(
    "a14_split_scores", "split:s n:l rmse:f mae:f r2:f",
    """SELECT split, count(*) AS n, sqrt(avg((y - p) ** 2)) AS rmse, avg(abs(y - p)) AS mae,
    1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2 FROM (SELECT temp_actual AS y, temp_predicted AS p,
    CASE WHEN dt < DATE '2024-01-15' THEN 'train' WHEN dt < DATE '2024-01-22' THEN 'val' ELSE 'test' END AS split
    FROM forecasts WHERE temp_actual IS NOT NULL AND temp_predicted IS NOT NULL) AS f GROUP BY split""", FORECASTS,
)
def split_scores(spark, sf):
    split = F.when(F.col("dt") < "2024-01-15", "train").when(F.col("dt") < "2024-01-22", "val").otherwise("test")
    return aggregates.split_scores(
        forecasts(spark, sf).select(
            F.col("temp_actual").alias("target"), F.col("temp_predicted").alias("prediction"), split.alias("split")
        )
    )


@query(
    "a15_mean_confidence", "city:s confidence:f",
    "SELECT city, avg(confidence) AS confidence FROM forecasts GROUP BY city", FORECASTS,
)
def mean_confidence(spark, sf):
    percent = F.when(F.col("city") == "view", F.col("confidence") * 100).otherwise(F.col("confidence"))
    return aggregates.mean_confidence(forecasts(spark, sf).withColumn("confidence", percent))


@query("a16_rows_per_location", "location:s n:l", "SELECT city AS location, count(*) AS n FROM ev GROUP BY 1", EV)
def rows_per_location(spark, sf):
    return aggregates.count_by(ev(spark, sf).withColumnRenamed("city", "location"), "location")


CATALOG = """SELECT city, latitude AS lat, longitude AS lon FROM (SELECT *, row_number() OVER (PARTITION BY city
  ORDER BY "timestamp", latitude, longitude) AS n FROM ev WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS e
  WHERE n = 1"""


@query("a17_station_catalog", "city:s lat:f lon:f", CATALOG, EV)
def station_catalog(spark, sf):
    return aggregates.station_catalog(ev(spark, sf))


@query("a18_exported_cities", "city:s", "SELECT DISTINCT city FROM daily", DAILY)
def exported_cities(spark, sf):
    return snapshot.exported_cities(daily(spark, sf))


@query(
    "a19_value_range", "low:f high:f", "SELECT min(temp_avg) AS low, max(temp_avg) AS high FROM daily", DAILY
)
def value_range(spark, sf):
    return aggregates.value_range(daily(spark, sf), "temp_avg")


@query(
    "a20_error_histogram", "bin:l n:l",
    """SELECT least(29, CAST(floor((error_abs - lo) / (hi - lo) * 30) AS BIGINT)) AS bin, count(*) AS n
    FROM forecasts, (SELECT min(error_abs) AS lo, max(error_abs) AS hi FROM forecasts) AS m
    WHERE error_abs IS NOT NULL GROUP BY 1""", FORECASTS,
)
def error_histogram(spark, sf):
    return aggregates.histogram(forecasts(spark, sf), "error_abs")


@query(
    "a21_table_counts", "table_name:s n:l",
    """SELECT 'daily' AS table_name, count(*) AS n FROM daily UNION ALL SELECT 'events', count(*) FROM found
    UNION ALL SELECT 'total', (SELECT count(*) FROM daily) + (SELECT count(*) FROM found)""", FOUND,
)
def table_counts(spark, sf):
    return aggregates.table_counts({"daily": daily(spark, sf), "events": found_events(spark, sf)})


@query(
    "a22_run_counters", "batches_ingested:l batches_failed:l batches_total:l status:s",
    """SELECT count(*) FILTER (o_orderstatus <> 'P') AS batches_ingested, count(*) FILTER (o_orderstatus = 'P')
    AS batches_failed, count(*) AS batches_total, 'partial' AS status FROM orders""",
)
def run_counters(spark, sf):
    done = (F.col("o_orderstatus") != "P").alias("ok")
    return aggregates.run_counters(table(spark, sf, "orders").select(done))


@query("a23_max_date", "last_day:d", "SELECT max(dt) AS last_day FROM li", LI)
def max_date(spark, sf):
    return li(spark, sf).agg(F.max("dt").alias("last_day"))


@query("f10_extreme_events", EVENT_SHAPE, "SELECT * FROM found", FOUND)
def extreme_events(spark, sf):
    return aggregates.extreme_event_rows(daily(spark, sf), EVENT_LIMITS)


@query(
    "w06_previous_week", "year:l week:l city:s source:s temp_vs_prev_week:f",
    PREVIOUS, ctes("daily_weekly").replace("daily_weekly AS", "weekly AS"),
)
def previous_week(spark, sf):
    return aggregates.weekly_trends(daily(spark, sf))


@query(
    "w14_preferred_source", "dt:d city:s source:s temp_avg:f",
    """SELECT dt, city, source, temp_avg FROM (SELECT *, row_number() OVER (PARTITION BY city, dt
    ORDER BY CASE WHEN source = 'OPENMETEO' THEN 0 ELSE 1 END, source) AS n FROM daily) AS d WHERE n = 1""", DAILY,
)
def preferred_source(spark, sf):
    return dedup.preferred_source(daily(spark, sf), ["city", "dt"])


@query(
    "w16_first_occurrence", "l_suppkey:l l_orderkey:l l_linenumber:l l_quantity:f",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS n FROM lineitem) AS l WHERE n = 1""",
)
def first_occurrence(spark, sf):
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")]
    return dedup.keep_first(table(spark, sf, "lineitem"), ["l_suppkey"], order)


@query(
    "t01_top_locations", "location:s n_obs:l",
    "SELECT station_id AS location, count(*) AS n_obs FROM ev GROUP BY 1 ORDER BY n_obs DESC, location LIMIT 20", EV,
)
def top_locations(spark, sf):
    return views.top_locations(ev(spark, sf).withColumnRenamed("station_id", "location"), 20)


@query(
    "t02_latest_events", EVENT_SHAPE,
    "SELECT * FROM found ORDER BY dt DESC, city, source, event_type LIMIT 10", FOUND,
)
def latest_events(spark, sf):
    return views.latest_events(found_events(spark, sf))


@query(
    "t03_latest_forecasts", "dt:d city:s source:s temp_predicted:f",
    """SELECT * FROM forecasts ORDER BY dt DESC, city, source, temp_predicted NULLS FIRST LIMIT 5""", FORECASTS,
)
def latest_forecasts(spark, sf):
    return views.latest_forecasts(forecasts(spark, sf))


@query(
    "t04_last_points", "dt:d value:f",
    "SELECT dt, avg(precip_sum) AS value FROM li_daily WHERE precip_sum IS NOT NULL GROUP BY dt ORDER BY dt DESC LIMIT 30",
    LI_DAILY,
)
def last_points(spark, sf):
    return views.last_points(aggregates.network_daily(li_daily(spark, sf), "precip_sum"))


@query(
    "t05_station_series", "dt:d source:s label:s value:f",
    "SELECT dt, source, strftime(dt, '%m-%d') AS label, temp_avg AS value FROM daily WHERE city = 'click'", DAILY,
)
def station_series(spark, sf):
    return views.station_series(daily(spark, sf), "click")


@query(
    "t06_recent_events", EVENT_SHAPE + " kind:s",
    """SELECT *, CASE event_type WHEN 'canicule' THEN 'Chaleur' WHEN 'fortes_pluies' THEN 'Pluie'
    WHEN 'vents_violents' THEN 'Vent' ELSE 'Froid' END AS kind FROM found
    WHERE dt >= (SELECT max(dt) FROM daily) - INTERVAL 7 DAY""", FOUND,
)
def recent_events(spark, sf):
    return views.recent_events(found_events(spark, sf), daily(spark, sf))


@query(
    "t07_temperature_trend", "dt:d city:s temp_avg:f",
    """SELECT dt, city, temp_avg FROM daily WHERE source = 'OPENMETEO'
    AND dt >= (SELECT max(dt) FROM daily) - INTERVAL 30 DAY""", DAILY,
)
def temperature_trend(spark, sf):
    return views.temperature_trend(daily(spark, sf))


MAP_CTES = DAILY + f",\ncatalog AS ({CATALOG})"


@query(
    "t08_map_points", "city:s lat:f lon:f temperature:f",
    """SELECT d.city, lat, lon, round(temp_avg, 3) AS temperature FROM (SELECT *, row_number() OVER (PARTITION BY city
    ORDER BY source, temp_avg) AS n FROM daily WHERE dt = (SELECT max(dt) FROM daily)) AS d
    JOIN catalog AS c ON c.city = d.city WHERE n = 1""", MAP_CTES,
)
def map_points(spark, sf):
    return views.map_points(daily(spark, sf), aggregates.station_catalog(ev(spark, sf)))


@query(
    "t08_card_points", "city:s temp_avg:f lat:f lon:f",
    """SELECT d.city, temp_avg, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY city
    ORDER BY CASE WHEN source = 'OPENMETEO' THEN 0 ELSE 1 END, source) AS n FROM daily
    WHERE dt = (SELECT max(dt) FROM daily)) AS d JOIN catalog AS c ON c.city = d.city
    WHERE n = 1 AND temp_avg IS NOT NULL""", MAP_CTES,
)
def card_points(spark, sf):
    return views.card_points(daily(spark, sf), aggregates.station_catalog(ev(spark, sf)))


@query(
    "t09_city_cards", "dt:d city:s source:s temp_avg:f temp_min:f temp_max:f icon:s",
    """SELECT dt, city, source, temp_avg, temp_min, temp_max, CASE WHEN precip_sum >= 5 THEN 'rain'
    WHEN precip_sum > 0 THEN 'showers' WHEN wind_avg >= 20 THEN 'wind' WHEN temp_avg >= 30 THEN 'sun'
    WHEN temp_avg <= 2 THEN 'cold' ELSE 'cloud' END AS icon FROM (SELECT *, row_number() OVER (PARTITION BY city
    ORDER BY CASE WHEN source = 'OPENMETEO' THEN 0 ELSE 1 END, source) AS n FROM daily
    WHERE dt = (SELECT max(dt) FROM daily)) AS d WHERE n = 1""", DAILY,
)
def city_cards(spark, sf):
    return views.city_cards(daily(spark, sf))


@query(
    "t10_forecast_series", "dt:d city:s source:s series:s value:f",
    """SELECT dt, city, source, 'temp_actual' AS series, temp_actual AS value FROM forecasts WHERE temp_actual IS NOT NULL
    UNION ALL SELECT dt, city, source, 'temp_predicted', temp_predicted FROM forecasts
    WHERE temp_predicted IS NOT NULL""", FORECASTS,
)
def forecast_series(spark, sf):
    return views.forecast_series(forecasts(spark, sf))


@query(
    "j01_first_day_of_week", "year:l week:l city:s source:s dt:d day_in_week:l",
    """SELECT year, week, city, source, dt, dt - min(dt) OVER (PARTITION BY year, week, city, source) AS day_in_week
    FROM (SELECT *, year(dt) AS year, week(dt) AS week FROM li_daily) AS d""", LI_DAILY,
)
def first_day_of_week(spark, sf):
    keyed = li_daily(spark, sf).withColumns({"year": F.year("dt"), "week": F.weekofyear("dt")})
    group = Window.partitionBy("year", "week", "city", "source")
    return keyed.withColumn("day_in_week", F.datediff("dt", F.min("dt").over(group)))


UNITS = """SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS department, p AS period,
  lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || ':' || p AS key
  FROM nation, (SELECT unnest(['previous-1950-2024', 'latest-2025-2026']) AS p) AS periods"""


def units(spark, sf):
    """Departments from the nations, and the periods of all order years moved by 27."""
    departments = table(spark, sf, "nation").select(
        department_code(F.col("n_nationkey")).alias("department")
    )
    years = table(spark, sf, "orders").agg(
        F.min(F.year("o_orderdate") + 27).alias("a"), F.max(F.year("o_orderdate") + 27).alias("b")
    )
    periods = years.select(F.explode(periods_for_years(F.col("a"), F.col("b"))).alias("period"))
    return departments, periods


@query(
    "j02_pending_units", "o_custkey:l",
    """SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))""",
)
def pending_units(spark, sf):
    done = table(spark, sf, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return joins.pending(
        table(spark, sf, "orders"), done.select(F.col("c_custkey").alias("o_custkey")), "o_custkey"
    )


@query(
    "j02_pending_in_order", "o_custkey:l o_orderkey:l",
    """SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer
    WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey""",
)
def pending_in_order(spark, sf):
    done = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return joins.pending(
        table(spark, sf, "orders"), done.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "o_orderkey"
    )


@query(
    "j03_batch_plan", "department:s period:s key:s",
    f"SELECT * FROM ({UNITS}) AS u WHERE NOT (CAST(department AS INTEGER) % 3 = 0 AND period LIKE 'prev%')",
)
def batch_plan(spark, sf):
    departments, periods = units(spark, sf)
    done = departments.where(F.col("department").cast("int") % 3 == 0).select(
        F.concat_ws(":", "department", F.lit("previous-1950-2024")).alias("key")
    )
    return joins.batch_plan(departments, periods, done)


@query(
    "j04_top_location_rows", "station_id:s timestamp:t temperature:f",
    """SELECT station_id, "timestamp", temperature FROM ev WHERE station_id IN (SELECT station_id FROM ev
    GROUP BY station_id ORDER BY count(*) DESC, station_id LIMIT 10)""", EV,
)
def top_location_rows(spark, sf):
    rows = ev(spark, sf).withColumn("location", F.col("station_id"))
    return joins.semi(rows, F.broadcast(views.top_locations(rows, 10)), "location")


@query(
    "j05_city_coordinates", "dt:d city:s source:s lat:f lon:f",
    "SELECT dt, d.city, source, lat, lon FROM daily AS d JOIN catalog AS c ON c.city = d.city", MAP_CTES,
)
def city_coordinates(spark, sf):
    return joins.with_coordinates(daily(spark, sf), aggregates.station_catalog(ev(spark, sf)))


@query(
    "j06_apply_encoding", "station_id:s timestamp:t code:l",
    """SELECT station_id, "timestamp", CASE city WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'view' THEN 2 ELSE -1 END
    AS code FROM ev""", EV,
)
def apply_encoding(spark, sf):
    rows = ev(spark, sf)
    known = rows.where(F.col("city").isin("click", "error", "view"))
    return joins.encode(rows, joins.label_index(known, "city"), "city", "code")


HEAT = """SELECT x, y, {value} AS value FROM {src} AS d
  JOIN (SELECT {row}, row_number() OVER (ORDER BY {row}) - 1 AS y FROM (SELECT DISTINCT {row} FROM {src}) AS r) AS r USING ({row})
  JOIN (SELECT {step}, row_number() OVER (ORDER BY {step}) - 1 AS x FROM (SELECT DISTINCT {step} FROM {src}) AS s) AS s
  USING ({step}) WHERE {value} IS NOT NULL"""


@query(
    "j07_heat_matrix", "x:l y:l value:f",
    HEAT.format(src="daily", row="city", step="dt", value="temp_avg"), DAILY,
)
def heat_matrix(spark, sf):
    return joins.heat_matrix(daily(spark, sf), "city", "dt", "temp_avg")


@query(
    "j07_climate_matrix", "x:l y:l value:f",
    HEAT.format(src="profile", row="city", step="month", value="temp_normal"),
    LI_DAILY + ",\nprofile AS (SELECT city, month(dt) AS month, avg(temp_avg) AS temp_normal FROM li_daily GROUP BY 1, 2)",
)
def climate_matrix(spark, sf):
    profile = aggregates.climate_profile(li_daily(spark, sf))
    return joins.heat_matrix(profile, "city", "month", "temp_normal")


@query(
    "j08_day_context", "dt:d n_observed:l n_events:l n_forecasts:l",
    """SELECT dt, coalesce(n_observed, 0) AS n_observed, coalesce(n_events, 0) AS n_events,
    coalesce(n_forecasts, 0) AS n_forecasts FROM (SELECT dt, count(*) AS n_observed FROM daily GROUP BY dt) AS a
    FULL JOIN (SELECT dt, count(*) AS n_events FROM found GROUP BY dt) AS b USING (dt)
    FULL JOIN (SELECT dt, count(*) AS n_forecasts FROM forecasts GROUP BY dt) AS c USING (dt)""",
    ctes("found", "forecasts"),
)
def day_context(spark, sf):
    return reports.day_context(daily(spark, sf), found_events(spark, sf), forecasts(spark, sf))


@query(
    "u04_keys_minus_done", "o_custkey:l",
    "SELECT c_custkey AS o_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000",
)
def keys_minus_done(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    done = table(spark, sf, "orders").where("o_orderstatus = 'F' AND o_totalprice > 300000")
    return joins.pending(keys, done.select("o_custkey").distinct(), "o_custkey")
