"""Queries for single column functions and column checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.functions import calendar, formats, text, weather
from obslake.operators import filters
from obslake.registry.adapters import (
    EVENT_LIMITS, ctes, daily, ev, feed, feed_json, forecasts, found_events, raw, sql_city, sql_day, sql_fixed,
    sql_number, table,
)
from obslake.registry.base import query
from obslake.schemas import FEED_MESSAGE
from obslake.sources import storage
from obslake.streaming import feed as live

RAW, EV, DAILY, FOUND = ctes("raw"), ctes("ev"), ctes("daily"), ctes("found")


@query(
    "p01_required_columns", "n:l absent:s",
    "SELECT count(*) AS n, 'snow' AS absent FROM events",
)
def required_columns(spark, sf):
    rows = ev(spark, sf).drop("snow")
    absent = filters.missing_columns(rows.columns, ["station_id", "temperature", "snow"])
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("absent", F.lit(",".join(absent)))


@query(
    "p02_optional_column", "dt:d snow_depth:f wind:f",
    "SELECT dt, CAST(NULL AS DOUBLE) AS snow_depth, wind_speed AS wind FROM ev", EV,
)
def optional_column(spark, sf):
    rows = ev(spark, sf)
    return rows.select(
        "dt",
        filters.optional(rows, "snow_depth", "double").alias("snow_depth"),
        filters.optional(rows, "wind_speed", "double").alias("wind"),
    )


@query(
    "p03_parse_number", "rain:f low:f high:f",
    f"SELECT {sql_number('rr')} AS rain, {sql_number('tn')} AS low, {sql_number('tx')} AS high FROM raw", RAW,
)
def parse_number(spark, sf):
    cols = {"rain": "RR", "low": "TN", "high": "TX"}
    return raw(spark, sf).select(*[text.parse_number(F.col(c)).alias(n) for n, c in cols.items()])


@query(
    "p04_parse_date", "given:s day:d", f"SELECT aaaammjj AS given, {sql_day('aaaammjj')} AS day FROM raw", RAW
)
def parse_date(spark, sf):
    return raw(spark, sf).select(
        F.col("AAAAMMJJ").alias("given"), text.parse_date(F.col("AAAAMMJJ")).alias("day")
    )


@query(
    "p05_station_id", "num:s station_id:s",
    "SELECT num_poste AS num, 'MF_' || lpad(num_poste, 8, '0') AS station_id FROM raw", RAW,
)
def station_id(spark, sf):
    return raw(spark, sf).select(
        F.col("NUM_POSTE").alias("num"), text.station_id(F.col("NUM_POSTE")).alias("station_id")
    )


@query(
    "p06_city_name", "station_name:s city:s",
    f"SELECT nom_usuel AS station_name, {sql_city('nom_usuel')} AS city FROM raw", RAW,
)
def city_name(spark, sf):
    return raw(spark, sf).select(
        F.col("NOM_USUEL").alias("station_name"), text.city_name(F.col("NOM_USUEL")).alias("city")
    )


@query(
    "p07_mean_temperature", "mean:f",
    f"""SELECT round(coalesce({sql_number('tm')}, ({sql_number('tn')} + {sql_number('tx')}) / 2,
    {sql_number('tn')}, {sql_number('tx')}), 2) AS mean FROM raw""", RAW,
)
def mean_temperature(spark, sf):
    texts = ("TM", "TN", "TX")
    numbers = raw(spark, sf).select(*[text.parse_number(F.col(c)).alias(c) for c in texts])
    return numbers.select(weather.mean_temperature(*[F.col(c) for c in texts]).alias("mean"))


@query(
    "p13_bounds_check", "city:s temperature:f windspeed:f winddirection:f weathercode:l precipitation:f",
    """SELECT city, CASE WHEN temperature BETWEEN -95 AND 65 THEN temperature END AS temperature,
    CASE WHEN windspeed BETWEEN 0 AND 130 THEN windspeed END AS windspeed,
    CASE WHEN winddirection BETWEEN 0 AND 360 THEN winddirection END AS winddirection,
    CASE WHEN weathercode BETWEEN 0 AND 100 THEN weathercode END AS weathercode,
    CASE WHEN precipitation BETWEEN 0 AND 2000 THEN precipitation END AS precipitation FROM messages""",
    ctes("messages"),
)
def bounds_check(spark, sf):
    return filters.within_bounds(feed(spark, sf), weather.FEED_BOUNDS)


@query(
    "p14_usable_records", "city:s temperature:f windspeed:f precipitation:f",
    """SELECT city, temperature, windspeed, precipitation FROM messages
    WHERE temperature IS NOT NULL OR windspeed IS NOT NULL OR precipitation IS NOT NULL""",
    ctes("messages"),
)
def usable_records(spark, sf):
    return filters.usable(feed(spark, sf))


@query(
    "p15_record_flatten", "city:s latitude:f longitude:f temperature:f windspeed:f weathercode:l source:s",
    """SELECT city, latitude, longitude, temperature, windspeed, weathercode, 'OPENMETEO' AS source
    FROM messages""",
    ctes("messages"),
)
def record_flatten(spark, sf):
    current = F.struct(
        F.col("timestamp").alias("time"),
        F.col("temperature").alias("temperature_2m"),
        F.col("windspeed").alias("wind_speed_10m"),
        F.col("winddirection").alias("wind_direction_10m"),
        F.col("weathercode").alias("weather_code"),
        "precipitation",
    )
    calls = feed(spark, sf).select("city", "latitude", "longitude", current.alias("current"))
    return live.flatten_record(calls)


@query(
    "p16_city_match", "station_id:s city:s temperature:f",
    "SELECT station_id, city, temperature FROM ev WHERE lower(trim(city)) = 'purchase'", EV,
)
def city_match(spark, sf):
    return filters.of_city(ev(spark, sf), "  PURCHASE ")


@query(
    "p17_last_days", "station_id:s timestamp:t temperature:f",
    """SELECT station_id, "timestamp", temperature FROM ev
    WHERE dt >= (SELECT max(dt) FROM ev) - INTERVAL 7 DAY""", EV,
)
def last_days(spark, sf):
    return filters.last_days(ev(spark, sf), 7)


@query(
    "p18_day_and_before", "dt:d city:s source:s n_obs:l",
    "SELECT dt, city, source, n_obs FROM daily WHERE dt IN (DATE '2024-01-14', DATE '2024-01-15')", DAILY,
)
def day_and_before(spark, sf):
    return filters.day_and_before(daily(spark, sf), "2024-01-15")


@query(
    "p19_pending_forecasts", "date:s city:s source:s temp_predicted:f model_version:l confidence:f horizon:s",
    """SELECT strftime(dt, '%d/%m/%Y') AS date, city, source, temp_predicted, model_version, confidence,
    'J+1' AS horizon FROM forecasts WHERE temp_actual IS NULL""", ctes("forecasts"),
)
def pending_forecasts(spark, sf):
    return filters.pending_forecasts(forecasts(spark, sf))


@query(
    "p20_source_filter", "station_id:s source:s temperature:f",
    "SELECT station_id, source, temperature FROM ev WHERE source = 'OPENMETEO'", EV,
)
def source_filter(spark, sf):
    rows = ev(spark, sf).withColumn("source", F.lower("source"))
    return filters.of_source(rows).withColumn("source", F.upper("source"))


@query(
    "p21_station_search", "name:s",
    "SELECT DISTINCT c_name AS name FROM customer WHERE lower(c_name) LIKE '%er#0000012%'",
)
def station_search(spark, sf):
    names = table(spark, sf, "customer").select(F.col("c_name").alias("name")).distinct()
    return names.where(text.contains_text(F.col("name"), "ER#0000012"))


@query("p22_present_columns", "city:s temp_avg:f", "SELECT city, temp_avg FROM daily", DAILY)
def present_columns(spark, sf):
    return filters.present(daily(spark, sf), ["city", "humidity", "temp_avg"])


@query(
    "f01_department_code", "given:s code:s",
    """SELECT given, CASE WHEN length(given) = 1 AND given BETWEEN '0' AND '9' THEN '0' || given
    ELSE upper(given) END AS code FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN c_nationkey || 'a'
    ELSE CAST(c_nationkey AS VARCHAR) END AS given FROM customer) AS c""",
)
def department_code(spark, sf):
    number = F.col("c_nationkey").cast("string")
    given = F.when(F.col("c_custkey") % 3 == 0, F.concat(number, F.lit("a"))).otherwise(number)
    rows = table(spark, sf, "customer").select(given.alias("given"))
    return rows.withColumn("code", text.department_code(F.concat(F.lit(" "), "given", F.lit(" "))))


@query(
    "f02_periods_for_years", "first_year:l last_year:l periods:s",
    """SELECT first_year, last_year, concat_ws(',', CASE WHEN first_year < 2025 THEN 'previous-1950-2024' END,
    CASE WHEN last_year >= 2025 THEN 'latest-2025-2026' END) AS periods
    FROM (SELECT year(o_orderdate) + 24 AS first_year, year(o_orderdate) + 24 + o_custkey % 4 AS last_year
    FROM orders) AS o""",
)
def periods_for_years(spark, sf):
    start = F.year("o_orderdate") + 24
    rows = table(spark, sf, "orders").select(
        start.alias("first_year"), (start + F.col("o_custkey") % 4).alias("last_year")
    )
    periods = storage.periods_for_years(F.col("first_year"), F.col("last_year"))
    return rows.withColumn("periods", F.array_join(periods, ","))


@query(
    "f03_batch_names", "department:s period:s key:s file:s source_url:s partition:s target:s",
    """SELECT d AS department, p AS period, d || ':' || p AS key, f AS file, 'https://data.example/' || f AS source_url,
    'year=2026/month=03' AS partition, '/bronze/year=2026/month=03/' || f AS target
    FROM (SELECT *, 'Q_' || d || '_' || p || '_RR-T-Vent.csv.gz' AS f
    FROM (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS d,
    CASE WHEN s_suppkey % 2 = 0 THEN 'previous-1950-2024' ELSE 'latest-2025-2026' END AS p FROM supplier) AS a) AS b""",
)
def batch_names(spark, sf):
    period = F.when(F.col("s_suppkey") % 2 == 0, storage.PERIOD_PREVIOUS).otherwise(storage.PERIOD_LATEST)
    units = table(spark, sf, "supplier").select(
        F.col("s_nationkey").cast("string").alias("department"), period.alias("period")
    )
    return storage.batch_names(units, "https://data.example/", "/bronze", "2026-03-09")


@query(
    "f05_hour_dir", "hour:s dir:s",
    """SELECT strftime(ts, '%Y-%m-%d %H') AS hour, strftime(ts, '/live/year=%Y/month=%m/day=%d/hour=%H') AS dir
    FROM events""",
)
def hour_dir(spark, sf):
    hours = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd HH").alias("hour"))
    return hours.withColumn("dir", calendar.hour_dir(F.col("hour"), "/live"))


@query(
    "f06_season_of_month", "month:s season:s season_accent:s",
    """SELECT month, CASE WHEN month IN ('12', '1', '2') THEN 'hiver' WHEN month IN ('3', '4', '5') THEN 'printemps'
    WHEN month IN ('6', '7', '8') THEN 'ete' WHEN month IN ('9', '10', '11') THEN 'automne' ELSE '' END AS season,
    CASE WHEN month IN ('12', '1', '2') THEN 'hiver' WHEN month IN ('3', '4', '5') THEN 'printemps'
    WHEN month IN ('6', '7', '8') THEN 'été' WHEN month IN ('9', '10', '11') THEN 'automne' ELSE '' END AS season_accent
    FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'juillet' WHEN o_orderkey % 11 = 0 THEN '0'
    ELSE CAST(month(o_orderdate) AS VARCHAR) END AS month FROM orders) AS o""",
)
def season_of_month(spark, sf):
    month = (
        F.when(F.col("o_orderkey") % 10 == 0, "juillet").when(F.col("o_orderkey") % 11 == 0, "0")
        .otherwise(F.month("o_orderdate").cast("string"))
    )
    rows = table(spark, sf, "orders").select(month.alias("month"))
    return rows.withColumns(
        {
            "season": calendar.season_of_month(F.col("month")),
            "season_accent": calendar.season_of_month(F.col("month"), "été"),
        }
    )


@query(
    "f07_calendar_parts", "day:d year:l week:l month:l dayofyear:l dayofweek:l is_weekend:l week_year:l",
    """SELECT day, year(day) AS year, week(day) AS week, month(day) AS month, dayofyear(day) AS dayofyear,
    isodow(day) - 1 AS dayofweek, CASE WHEN isodow(day) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    isoyear(day) AS week_year FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders) AS o""",
)
def calendar_parts(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    parts = calendar.calendar_parts(F.col("day"))
    return days.select("day", *[c.alias(n) for n, c in parts.items()], calendar.iso_year(F.col("day")).alias("week_year"))


@query(
    "f08_day_shift", "day:d next_day:d days_in:l",
    """SELECT day, day + INTERVAL 1 DAY AS next_day, day - DATE '1995-01-01' AS days_in
    FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders) AS o""",
)
def day_shift(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("day"),
        F.date_add("o_orderdate", 1).alias("next_day"),
        F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")).alias("days_in"),
    )


@query(
    "f09_hour_parts", "year:s month:s day:s hour:s",
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
    strftime(ts, '%H') AS hour FROM events""",
)
def hour_parts(spark, sf):
    return table(spark, sf, "events").select(
        *[c.alias(n) for n, c in calendar.hour_parts(F.col("ts")).items()]
    )


@query(
    "f11_weather_icon", "dt:d city:s source:s icon:s",
    """SELECT dt, city, source, CASE WHEN coalesce(snow_sum, 0) > 0 THEN 'snow' WHEN coalesce(precip_sum, 0) >= 1200 THEN 'rain'
    WHEN coalesce(precip_sum, 0) > 1000 THEN 'showers' WHEN coalesce(wind_avg, 0) >= 5 THEN 'wind'
    WHEN temp_avg >= 30 THEN 'sun' WHEN temp_avg <= 2 THEN 'cold' ELSE 'cloud' END AS icon FROM daily""", DAILY,
)
def weather_icon(spark, sf):
    # scaled so that the classes of this table differ: rain above 1000 and wind times 4
    rain = F.when(F.col("precip_sum") >= 1200, 5.0).when(F.col("precip_sum") > 1000, 1.0).otherwise(0.0)
    icon = weather.weather_icon(F.col("snow_sum"), rain, F.col("wind_avg") * 4, F.col("temp_avg"))
    return daily(spark, sf).select("dt", "city", "source", icon.alias("icon"))


@query(
    "f12_event_groups", "event_type:s kind:s symbol:s n:l",
    """SELECT event_type, CASE event_type WHEN 'canicule' THEN 'Chaleur' WHEN 'fortes_pluies' THEN 'Pluie'
    WHEN 'vents_violents' THEN 'Vent' ELSE 'Froid' END AS kind, CASE event_type WHEN 'canicule' THEN 'hot'
    WHEN 'fortes_pluies' THEN 'rain' WHEN 'vents_violents' THEN 'wind' ELSE 'cold' END AS symbol, count(*) AS n
    FROM found GROUP BY 1, 2, 3""", FOUND,
)
def event_groups(spark, sf):
    kind = F.col("event_type")
    groups = found_events(spark, sf).groupBy(
        kind, weather.event_group(kind).alias("kind"), weather.event_symbol(kind).alias("symbol")
    )
    return groups.agg(F.count(F.lit(1)).alias("n"))


@query(
    "f13_temperature_band", "band:s n:l",
    """SELECT CASE WHEN temperature IS NULL THEN 'unknown' WHEN temperature < 0 THEN 'below_0'
    WHEN temperature < 8 THEN '0_8' WHEN temperature < 14 THEN '8_14' WHEN temperature < 20 THEN '14_20'
    WHEN temperature < 26 THEN '20_26' WHEN temperature < 32 THEN '26_32' ELSE '32_up' END AS band,
    count(*) AS n FROM ev GROUP BY 1""", EV,
)
def temperature_band(spark, sf):
    band = weather.temperature_band(F.col("temperature")).alias("band")
    return ev(spark, sf).groupBy(band).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f14_day_symbol", "symbol:s n:l",
    """SELECT CASE WHEN precipitation > 90 THEN 'rain' WHEN temperature >= 28 THEN 'hot' WHEN temperature >= 20 THEN 'sun'
    WHEN temperature <= 0 THEN 'cold' ELSE 'cloud' END AS symbol, count(*) AS n FROM ev GROUP BY 1""", EV,
)
def day_symbol(spark, sf):
    symbol = weather.day_symbol(F.col("temperature"), F.col("precipitation") - 85)
    return ev(spark, sf).groupBy(symbol.alias("symbol")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f15_clean_export", "dt:s city:s temp_avg:f ratio:f n_obs:l",
    """SELECT CAST(dt AS VARCHAR) AS dt, city, round(temp_avg + 1e-9, 3) AS temp_avg,
    CASE WHEN n_obs % 2 = 0 THEN NULL ELSE n_obs / 8.0 END AS ratio, n_obs FROM daily""", DAILY,
)
def clean_export(spark, sf):
    broken = F.when(F.col("n_obs") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("n_obs") / 8.0)
    rows = daily(spark, sf).withColumn("temp_avg", F.col("temp_avg") + 1e-9)
    return formats.clean_values(rows.select("dt", "city", "temp_avg", broken.alias("ratio"), "n_obs"))


@query(
    "f16_number_text", "one:s two:s dash:s",
    f"""SELECT CASE WHEN temperature IS NULL THEN 'N/A' ELSE {sql_fixed('temperature', 1)} END AS one,
    CASE WHEN wind_speed IS NULL THEN 'N/A' ELSE {sql_fixed('wind_speed', 2)} END AS two,
    CASE WHEN temperature IS NULL THEN '-' ELSE {sql_fixed('temperature', 1)} END AS dash FROM ev""", EV,
)
def number_text(spark, sf):
    temp = F.col("temperature")
    return ev(spark, sf).select(
        formats.number_text(temp).alias("one"),
        formats.number_text(F.col("wind_speed"), 2).alias("two"),
        formats.number_text(temp, 1, "-").alias("dash"),
    )


@query(
    "f17_byte_size", "bytes:l size:s",
    f"""SELECT bytes, CASE WHEN bytes < 1024 THEN bytes || ' o'
    WHEN bytes < 1048576 THEN {sql_fixed('(bytes / 1024.0::DOUBLE)', 1)} || ' Ko'
    WHEN bytes < 1073741824 THEN {sql_fixed('(bytes / 1048576.0::DOUBLE)', 1)} || ' Mo'
    WHEN bytes < 1099511627776 THEN {sql_fixed('(bytes / 1073741824.0::DOUBLE)', 1)} || ' Go'
    ELSE {sql_fixed('(bytes / 1099511627776.0::DOUBLE)', 1)} || ' To' END AS size
    FROM (SELECT l_partkey * l_partkey * l_partkey * (l_linenumber * 300) AS bytes FROM lineitem) AS b""",
)
def byte_size(spark, sf):
    """The product is exact beyond a long's range; there ``bytes`` is NULL and only the text has the size."""
    part = F.col("l_partkey").cast("decimal(19, 0)")
    exact = part * part * part * (F.col("l_linenumber") * 300)
    return table(spark, sf, "lineitem").select(exact.try_cast("long").alias("bytes"), formats.byte_size(exact).alias("size"))


@query(
    "f18_french_date", "day:d shown:s",
    """SELECT day, strftime(day, '%d') || ' ' || ['janv.', 'févr.', 'mars', 'avr.', 'mai', 'juin', 'juil.', 'août',
    'sept.', 'oct.', 'nov.', 'déc.'][month(day)] || ' ' || year(day) AS shown
    FROM (SELECT CAST(o_orderdate AS DATE) AS day FROM orders) AS o""",
)
def french_date(spark, sf):
    days = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return days.withColumn("shown", calendar.french_date(F.col("day")))


@query(
    "f19_error_and_confidence", "location:s dt:d error_abs:f confidence:f",
    "SELECT location, dt, error_abs, confidence FROM forecasts", ctes("forecasts"),
)
def error_and_confidence(spark, sf):
    return forecasts(spark, sf)


@query(
    "f20_json_parse", "city:s temperature:f windspeed:f weathercode:l source:s",
    "SELECT city, temperature, windspeed, weathercode, 'OPENMETEO' AS source FROM messages", ctes("messages"),
)
def json_parse(spark, sf):
    return feed_json(spark, sf).select(F.from_json("value", FEED_MESSAGE).alias("m")).select("m.*")


@query(
    "f21_event_detail", "detail:s event_type:s", "SELECT detail, event_type FROM found", FOUND
)
def event_detail(spark, sf):
    return found_events(spark, sf)


@query(
    "f22_thresholds_applied", "hot_days:l wet_days:l windy_days:l cold_days:l",
    """SELECT count(*) FILTER (temp_max >= 100) AS hot_days, count(*) FILTER (precip_sum >= 1500) AS wet_days,
    count(*) FILTER (wind_avg >= 5) AS windy_days, count(*) FILTER (temp_min <= -31) AS cold_days FROM daily""", DAILY,
)
def thresholds_applied(spark, sf):
    limits = weather.thresholds_frame(spark, EVENT_LIMITS)

    def limit(name):
        return limits.select(name).scalar()

    return daily(spark, sf).agg(
        F.count_if(F.col("temp_max") >= limit("heatwave")).alias("hot_days"),
        F.count_if(F.col("precip_sum") >= limit("heavy_rain")).alias("wet_days"),
        F.count_if(F.col("wind_avg") >= limit("strong_wind")).alias("windy_days"),
        F.count_if(F.col("temp_min") <= limit("cold_snap")).alias("cold_days"),
    )


@query(
    "f23_city_list", "city:s latitude:f longitude:f",
    """SELECT 'CITY ' || n_nationkey AS city, n_nationkey / 2.0 AS latitude, n_regionkey * 1.5 AS longitude FROM nation""",
)
def city_list(spark, sf):
    item = F.struct(
        F.concat(F.lit("CITY "), "n_nationkey").alias("city"),
        (F.col("n_nationkey") / 2.0).alias("latitude"),
        (F.col("n_regionkey") * 1.5).alias("longitude"),
    )
    rows = table(spark, sf, "nation").select(F.to_json(F.array(item)).alias("cities"))
    return live.city_list(rows, "cities")
