"""The given tables seen as observations, archive text and feed messages.

Each adapter has a Spark form and the same as a SQL common table expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.text import station_id
from obslake.operators.aggregates import daily_aggregates, extreme_event_rows
from obslake.plans.silver import unify
from obslake.plans.forecast import forecast_table
from obslake.operators.windows import series_features
from obslake.sources.readers import read_spread

# Alert limits that give both severities on the events table.
EVENT_LIMITS = {"heatwave": 100.0, "heavy_rain": 1500.0, "strong_wind": 5.0, "cold_snap": -31.0}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, spread for the parsing that follows; rows of one moment, copies of a message above all, stay together."""
    return read_spread(spark, f"{sf_dir}/events.parquet", "ts")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of one station per user and one city per event type."""
    source = F.when(F.col("event_id") % 2 == 0, "METEOFRANCE").otherwise("OPENMETEO")
    return unify(
        events(spark, sf_dir),
        {
            "station_id": station_id(F.col("user_id")),
            "station_name": F.concat(F.lit("STATION "), F.col("user_id")),
            "city": F.col("event_type"),
            "country": F.lit("FR"),
            "latitude": F.when(F.col("event_type") != "error", 40.5 + F.col("user_id") % 10),
            "longitude": 0.5 + F.col("user_id") % 7,
            "timestamp": F.col("ts"),
            "temperature": F.when(F.col("event_id") % 17 != 0, F.col("value") - 40),
            "precipitation": _k(),
            "wind_speed": F.col("value") / 10,
            "source": source,
            "dt": F.col("ts"),
        },
    )


def li(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as several years of observations."""
    return unify(
        table(spark, sf_dir, "lineitem"),
        {
            "station_id": F.col("l_suppkey"),
            "city": F.col("l_returnflag"),
            "timestamp": F.col("l_shipdate"),
            "temperature": F.col("l_quantity"),
            "precipitation": F.col("l_discount") * 100,
            "wind_speed": F.col("l_tax") * 100,
            "source": F.col("l_linestatus"),
            "dt": F.col("l_shipdate"),
        },
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as archive rows, all text, with blanks, commas and broken values."""
    i, kind, value = F.col("event_id"), F.upper("event_type"), F.floor(F.col("value") * 10) / 10
    name = (
        F.when(F.col("user_id") % 4 == 0, F.concat(F.lit("SAINT-"), kind, F.lit("-SITE")))
        .when(F.col("user_id") % 4 == 1, F.concat(F.lit("LE "), kind))
        .when(F.col("user_id") % 4 == 2, F.concat(kind, F.lit("-BRON")))
        .otherwise(F.concat(kind, F.lit(" LESQUIN")))
    )
    day = (
        F.when(i % 50 == 0, "20240231")
        .when(i % 3 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyyMMdd"))
    )

    def comma(number: Column) -> Column:
        return F.replace(number.cast("string"), F.lit("."), F.lit(","))

    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("NUM_POSTE"),
        name.alias("NOM_USUEL"),
        comma(40.5 + F.col("user_id") % 10).alias("LAT"),
        (0.5 + F.col("user_id") % 7).cast("string").alias("LON"),
        (F.col("user_id") * 3).cast("string").alias("ALTI"),
        day.alias("AAAAMMJJ"),
        F.when(i % 7 == 0, "").when(i % 11 == 0, "n/a")
        .otherwise(F.concat(F.lit(" "), _k().cast("int"), F.lit(",5"))).alias("RR"),
        F.when(i % 5 == 0, "").otherwise(comma(value)).alias("TN"),
        F.when(i % 13 == 0, "").otherwise((value + 10).cast("string")).alias("TX"),
        F.when(i % 3 == 0, comma(value + 5)).otherwise("").alias("TM"),
        F.when(i % 9 != 0, F.col("value").cast("string")).alias("FFM"),
    )


def feed(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """Events as feed messages; some lack a time or hold impossible measures. ``more`` are fields of the events to add."""
    i = F.col("event_id")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = events(spark, sf_dir).select(
        F.col("event_type").alias("city"),
        (40.5 + F.col("user_id") % 10).alias("latitude"),
        (0.5 + F.col("user_id") % 7).alias("longitude"),
        F.when(i % 23 == 0, "n/a").otherwise(at).alias("timestamp"),
        F.when(i % 17 != 0, F.col("value") - 40).alias("temperature"),
        F.when(i % 34 != 0, F.col("value") / 2).alias("windspeed"),
        ((i * 7) % 720).cast("double").alias("winddirection"),
        (i % 150).alias("weathercode"),
        F.when(i % 51 != 0, _k()).alias("precipitation"),
        F.lit("OPENMETEO").alias("source"),
        *more,
    )
    return fields


def feed_json(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """The messages as JSON text."""
    messages = feed(spark, sf_dir, *more)
    return messages.select(F.to_json(F.struct(*messages.columns)).alias("value"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_aggregates(ev(spark, sf_dir))


def li_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_aggregates(li(spark, sf_dir))


def found_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extreme_event_rows(daily(spark, sf_dir), EVENT_LIMITS)


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast rows of a stand-in predictor: the value before is the forecast."""
    rows = ev(spark, sf_dir).withColumn("location", F.col("station_id"))
    lagged = series_features(rows, "station_id", ["source"])
    return forecast_table(lagged.withColumn("temp_predicted", F.col("temp_lag1")), 3)


def _num(text: str) -> str:
    value = f"replace(trim({text}), ',', '.')"
    pattern = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    return f"CASE WHEN regexp_matches({value}, '{pattern}') THEN TRY_CAST({value} AS DOUBLE) END"


def _day(text: str) -> str:
    return rf"TRY_CAST(regexp_replace(trim({text}), '^(\d{{4}})-?(\d{{2}})-?(\d{{2}})$', '\1-\2-\3') AS DATE)"


def _city(text: str) -> str:
    head = rf"regexp_extract(upper({text}), '^((?:(?:SAINT|SAINTE|ST|STE|LE|LA|LES)[- ])*[^- ]*)', 1)"
    return f"array_to_string([upper(w[1]) || lower(w[2:]) for w in regexp_extract_all({head}, '[^- ]+[- ]?')], '')"


def sql_fixed(value: str, digits: int) -> str:
    """Fixed decimals, ties away from zero on the shortest decimal form."""
    exact = f"round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)), {digits})"
    zero = f"CAST(CAST({exact} AS DECIMAL(38, {digits})) AS VARCHAR)"
    return f"(CASE WHEN {value} < 0 AND {exact} = 0 THEN '-' ELSE '' END || {zero})"


_FEED_FIELDS = """
  event_type AS city, 40.5 + user_id % 10 AS latitude, 0.5 + user_id % 7 AS longitude,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS "timestamp",
  CASE WHEN event_id % 17 <> 0 THEN value - 40 END AS temperature,
  CASE WHEN event_id % 34 <> 0 THEN value / 2 END AS windspeed,
  CAST((event_id * 7) % 720 AS DOUBLE) AS winddirection, event_id % 150 AS weathercode,
  CASE WHEN event_id % 51 <> 0 THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) END AS precipitation
"""

_ORDER = """
  (CASE WHEN temperature IS NULL THEN 0 ELSE 1 END + CASE WHEN precipitation IS NULL THEN 0 ELSE 1 END
   + CASE WHEN wind_speed IS NULL THEN 0 ELSE 1 END + CASE WHEN snow IS NULL THEN 0 ELSE 1 END) DESC,
  source NULLS LAST, station_name NULLS LAST, city NULLS LAST, country NULLS LAST, latitude NULLS LAST,
  longitude NULLS LAST, elevation NULLS LAST, temperature NULLS LAST, precipitation NULLS LAST,
  wind_speed NULLS LAST, snow NULLS LAST
"""

CTES = {
    "ev": """
SELECT 'MF_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS station_id, 'STATION ' || user_id AS station_name,
  event_type AS city, 'FR' AS country,
  CASE WHEN event_type <> 'error' THEN 40.5 + user_id % 10 END AS latitude, 0.5 + user_id % 7 AS longitude,
  CAST(NULL AS DOUBLE) AS elevation, ts AS "timestamp",
  CASE WHEN event_id % 17 <> 0 THEN value - 40 END AS temperature,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS precipitation, value / 10 AS wind_speed,
  CAST(NULL AS DOUBLE) AS snow,
  CASE WHEN event_id % 2 = 0 THEN 'METEOFRANCE' ELSE 'OPENMETEO' END AS source, CAST(ts AS DATE) AS dt
FROM events""",
    "li": """
SELECT CAST(l_suppkey AS VARCHAR) AS station_id, l_returnflag AS city, l_shipdate AS "timestamp",
  l_quantity AS temperature, l_discount * 100 AS precipitation, l_tax * 100 AS wind_speed,
  CAST(NULL AS DOUBLE) AS snow, l_linestatus AS source, CAST(l_shipdate AS DATE) AS dt
FROM lineitem""",
    "raw": """
SELECT CAST(user_id AS VARCHAR) AS num_poste,
  CASE user_id % 4 WHEN 0 THEN 'SAINT-' || upper(event_type) || '-SITE' WHEN 1 THEN 'LE ' || upper(event_type)
    WHEN 2 THEN upper(event_type) || '-BRON' ELSE upper(event_type) || ' LESQUIN' END AS nom_usuel,
  replace(CAST(40.5 + user_id % 10 AS VARCHAR), '.', ',') AS lat, CAST(0.5 + user_id % 7 AS VARCHAR) AS lon,
  CAST(user_id * 3 AS VARCHAR) AS alti,
  CASE WHEN event_id % 50 = 0 THEN '20240231' WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d')
    ELSE strftime(ts, '%Y%m%d') END AS aaaammjj,
  CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 = 0 THEN 'n/a'
    ELSE ' ' || regexp_extract(props, '([0-9]+)', 1) || ',5' END AS rr,
  CASE WHEN event_id % 5 = 0 THEN '' ELSE replace(CAST(floor(value * 10) / 10 AS VARCHAR), '.', ',') END AS tn,
  CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(floor(value * 10) / 10 + 10 AS VARCHAR) END AS tx,
  CASE WHEN event_id % 3 = 0 THEN replace(CAST(floor(value * 10) / 10 + 5 AS VARCHAR), '.', ',') ELSE '' END AS tm,
  CASE WHEN event_id % 9 <> 0 THEN CAST(value AS VARCHAR) END AS ffm
FROM events""",
    "archive": f"""
SELECT 'MF_' || lpad(num_poste, 8, '0') AS station_id, nom_usuel AS station_name, {_city('nom_usuel')} AS city,
  'FR' AS country, {_num('lat')} AS latitude, {_num('lon')} AS longitude, {_num('alti')} AS elevation,
  CAST({_day('aaaammjj')} AS TIMESTAMP) AS "timestamp",
  round(coalesce({_num('tm')}, ({_num('tn')} + {_num('tx')}) / 2, {_num('tn')}, {_num('tx')}), 2) AS temperature,
  {_num('rr')} AS precipitation, {_num('ffm')} AS wind_speed, CAST(NULL AS DOUBLE) AS snow,
  'METEOFRANCE' AS source, {_day('aaaammjj')} AS dt
FROM raw""",
    "messages": f"SELECT {_FEED_FIELDS} FROM events",
    "feed": """
SELECT 'OPENMETEO_' || upper(city) AS station_id, city AS station_name, city, 'FR' AS country,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
  CAST(NULL AS DOUBLE) AS elevation, "timestamp", temperature, precipitation, windspeed AS wind_speed,
  CAST(NULL AS DOUBLE) AS snow, 'OPENMETEO' AS source, CAST("timestamp" AS DATE) AS dt
FROM messages""",
    "unified": """
SELECT * FROM archive UNION ALL SELECT * FROM feed""",
    "silver_rows": f"""
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY {_ORDER}) AS n
  FROM unified WHERE "timestamp" IS NOT NULL) AS u WHERE n = 1""",
    "silver": """
SELECT *, temperature - temp_ma7 AS temp_anomaly FROM (
  SELECT *,
    avg(temperature) OVER (PARTITION BY station_id ORDER BY "timestamp" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS temp_ma3,
    avg(temperature) OVER w AS temp_ma7, stddev_samp(temperature) OVER w AS temp_std7
  FROM silver_rows
  WINDOW w AS (PARTITION BY station_id ORDER BY "timestamp" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS s""",
    "daily": """
SELECT dt, city, source, count(*) AS n_obs, avg(temperature) AS temp_avg, min(temperature) AS temp_min,
  max(temperature) AS temp_max, sum(precipitation) AS precip_sum, avg(wind_speed) AS wind_avg,
  sum(snow) AS snow_sum, stddev_samp(temperature) AS temp_std
FROM ev GROUP BY dt, city, source""",
    "li_daily": """
SELECT dt, city, source, count(*) AS n_obs, avg(temperature) AS temp_avg, min(temperature) AS temp_min,
  max(temperature) AS temp_max, sum(precipitation) AS precip_sum, avg(wind_speed) AS wind_avg,
  sum(snow) AS snow_sum, stddev_samp(temperature) AS temp_std
FROM li GROUP BY dt, city, source""",
    "weekly": """
SELECT year, week, city, source, avg(temp_avg) AS temp_avg, min(temp_min) AS temp_min, max(temp_max) AS temp_max,
  sum(precip_sum) AS precip_sum, count(DISTINCT dt) AS n_days,
  CASE WHEN count(*) * sum(x * x) - sum(x) * sum(x) <> 0
    THEN (count(*) * sum(x * temp_avg) - sum(x) * sum(temp_avg)) / (count(*) * sum(x * x) - sum(x) * sum(x))
    ELSE 0.0 END AS trend_slope
FROM (SELECT *, CAST(dt - min(dt) OVER (PARTITION BY year, week, city, source) AS DOUBLE) AS x
      FROM (SELECT *, year(dt) AS year, week(dt) AS week FROM li_daily) AS a) AS b
GROUP BY year, week, city, source""",
    "found": f"""
SELECT dt, city, source, 'canicule' AS event_type, CASE WHEN temp_max >= 125 THEN 'extreme' ELSE 'alerte' END AS severity,
  temp_max AS value, 100.0 AS threshold, city || ' : ' || {sql_fixed('temp_max', 1)} || '°C le ' || dt AS detail
FROM daily WHERE temp_max >= 100
UNION ALL
SELECT dt, city, source, 'fortes_pluies', CASE WHEN precip_sum >= 1875 THEN 'extreme' ELSE 'alerte' END,
  precip_sum, 1500.0, city || ' : ' || {sql_fixed('precip_sum', 1)} || ' mm de pluie le ' || dt
FROM daily WHERE precip_sum >= 1500
UNION ALL
SELECT dt, city, source, 'vents_violents', CASE WHEN wind_avg >= 6.25 THEN 'extreme' ELSE 'alerte' END,
  wind_avg, 5.0, city || ' : ' || {sql_fixed('wind_avg', 1)} || ' m/s de vent le ' || dt
FROM daily WHERE wind_avg >= 5
UNION ALL
SELECT dt, city, source, 'vague_de_froid', CASE WHEN temp_min <= -38.75 THEN 'extreme' ELSE 'alerte' END,
  temp_min, -31.0, city || ' : ' || {sql_fixed('temp_min', 1)} || '°C le ' || dt
FROM daily WHERE temp_min <= -31""",
    "forecasts": """
SELECT *, greatest(0.0, least(1.0, 1 - coalesce(error_abs, 2.0) / 10)) AS confidence, 3 AS model_version FROM (
  SELECT CAST(dt + INTERVAL 1 DAY AS DATE) AS dt, station_id AS location, city, source,
    lead(temperature) OVER w AS temp_actual, lag(temperature) OVER w AS temp_predicted,
    abs(lead(temperature) OVER w - lag(temperature) OVER w) AS error_abs
  FROM ev WINDOW w AS (PARTITION BY station_id ORDER BY "timestamp", source)) AS f""",
}
CTES["daily_weekly"] = CTES["weekly"].replace("FROM li_daily", "FROM daily")
_NEEDS = {
    "daily_weekly": ["daily"],
    "archive": ["raw"], "feed": ["messages"], "unified": ["archive", "feed"], "silver_rows": ["unified"],
    "silver": ["silver_rows"], "daily": ["ev"], "li_daily": ["li"], "weekly": ["li_daily"],
    "found": ["daily"], "forecasts": ["ev"],
}


def ctes(*names: str) -> str:
    """A WITH clause of the named expressions and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in ordered)


sql_number, sql_day, sql_city = _num, _day, _city
