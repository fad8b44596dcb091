"""Queries for features, time split and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.operators import joins, windows
from obslake.plans import forecast
from obslake.registry.adapters import ctes, ev, forecasts, table
from obslake.registry.base import query
from obslake.session import scratch_path

EV = ctes("ev")


def _features_sql(key: str, order: str, centered: bool, where: str) -> str:
    """The feature table; a rolling value needs a full frame without NULLs."""
    three = "BETWEEN 1 PRECEDING AND 1 FOLLOWING" if centered else "BETWEEN 2 PRECEDING AND CURRENT ROW"
    seven = "BETWEEN 3 PRECEDING AND 3 FOLLOWING" if centered else "BETWEEN 6 PRECEDING AND CURRENT ROW"
    return f"""SELECT *, temperature - temp_ma7 AS temp_anomaly, month("timestamp") AS month,
    dayofyear("timestamp") AS dayofyear, isodow("timestamp") - 1 AS dayofweek,
    CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend, year("timestamp") AS year, 'hiver' AS season
    FROM (SELECT dense_rank() OVER (ORDER BY city) - 1 AS city_encoded, station_id, city, source, "timestamp", dt, temperature,
    lag(temperature, 1) OVER w AS temp_lag1, lag(temperature, 2) OVER w AS temp_lag2,
    lag(temperature, 7) OVER w AS temp_lag7, lead(temperature, 1) OVER w AS target,
    CASE WHEN count(temperature) OVER w3 = 3 THEN avg(temperature) OVER w3 END AS temp_ma3,
    CASE WHEN count(temperature) OVER w7 = 7 THEN avg(temperature) OVER w7 END AS temp_ma7,
    CASE WHEN count(temperature) OVER w7 = 7 THEN stddev_samp(temperature) OVER w7 END AS temp_std7,
    CASE WHEN count(precipitation) OVER b3 = 3 THEN sum(precipitation) OVER b3 END AS precip_sum3,
    CASE WHEN count(wind_speed) OVER b7 = 7 THEN avg(wind_speed) OVER b7 END AS wind_ma7 FROM ev WINDOW
    w AS (PARTITION BY {key} ORDER BY {order}), w3 AS (PARTITION BY {key} ORDER BY {order} ROWS {three}),
    w7 AS (PARTITION BY {key} ORDER BY {order} ROWS {seven}),
    b3 AS (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
    b7 AS (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) AS s WHERE {where}"""


BY_CITY = ("city", '"timestamp", station_id, source')
BY_STATION = ("station_id", '"timestamp", source')
TRAIN = "temp_lag7 IS NOT NULL AND target IS NOT NULL"
SCORE = "temp_lag7 IS NOT NULL"
LAGS = "station_id:s timestamp:t temp_lag1:f temp_lag2:f temp_lag7:f"
ROLLING = "station_id:s timestamp:t temp_ma3:f temp_ma7:f temp_std7:f temp_anomaly:f precip_sum3:f wind_ma7:f"
FEATURES = (
    ROLLING + " temp_lag1:f temp_lag2:f temp_lag7:f target:f month:l dayofyear:l dayofweek:l is_weekend:l "
    "year:l season:s city_encoded:l"
)


def _series(spark, sf, centered=False):
    rows = ev(spark, sf)
    return windows.series_features(rows, "station_id", ["source"], centered)


@query("w07_lags", LAGS, _features_sql(*BY_STATION, False, "true"), EV)
def lags(spark, sf):
    return _series(spark, sf)


@query("w08_next_value", "station_id:s timestamp:t target:f", _features_sql(*BY_STATION, False, "true"), EV)
def next_value(spark, sf):
    return _series(spark, sf)


@query("w09_centered_full_frames", ROLLING, _features_sql(*BY_STATION, True, "true"), EV)
def centered_full_frames(spark, sf):
    return _series(spark, sf, centered=True)


@query("w10_trailing_full_frames", ROLLING, _features_sql(*BY_STATION, False, "true"), EV)
def trailing_full_frames(spark, sf):
    return _series(spark, sf)


@query("w11_complete_rows", FEATURES, _features_sql(*BY_STATION, False, TRAIN), EV)
def complete_rows(spark, sf):
    return forecast.build_features(ev(spark, sf), key="station_id")


@query("m01_features_causal", FEATURES, _features_sql(*BY_CITY, False, TRAIN), EV)
def features_causal(spark, sf):
    return forecast.build_features(ev(spark, sf))


@query("m01_features_centered", FEATURES, _features_sql(*BY_CITY, True, TRAIN), EV)
def features_centered(spark, sf):
    return forecast.build_features(ev(spark, sf), centered=True)


@query("m01_features_scoring", FEATURES, _features_sql(*BY_CITY, False, SCORE), EV)
def features_scoring(spark, sf):
    return forecast.build_features(ev(spark, sf), drop_missing_target=False)


@query("m01_features_hot_city", FEATURES, _features_sql(*BY_CITY, True, TRAIN), EV)
def features_hot_city(spark, sf):
    """Centred features with every city treated as hot."""
    return forecast.build_features(ev(spark, sf), centered=True, days=1)


@query(
    "x08_group_features", FEATURES, _features_sql(*BY_STATION, True, SCORE), EV
)
def group_features(spark, sf):
    return forecast.build_features(ev(spark, sf), drop_missing_target=False, centered=True, key="station_id")


@query(
    "m02_history_window", "station_id:s city:s timestamp:t temperature:f",
    """SELECT station_id, city, "timestamp", temperature FROM ev WHERE dt >= (SELECT max(dt) FROM ev) - INTERVAL 20 DAY
    AND city IN (SELECT city FROM ev WHERE dt >= (SELECT max(dt) FROM ev) - INTERVAL 20 DAY GROUP BY city
    ORDER BY count(*) DESC, city LIMIT 2)""", EV,
)
def history_window(spark, sf):
    return forecast.history(ev(spark, sf), 20, 2)


@query(
    "w12_time_split", "dt:d split:s n:l",
    """SELECT dt, CASE WHEN pos <= floor(total * (1 - 2 * 0.15)) - 1 THEN 'train'
    WHEN pos <= floor(total * (1 - 0.15)) - 1 THEN 'val' ELSE 'test' END AS split, n
    FROM (SELECT dt, row_number() OVER (ORDER BY dt) - 1 AS pos, count(*) OVER () AS total, n
    FROM (SELECT dt, count(*) AS n FROM ev GROUP BY dt) AS d) AS e""", EV,
)
def time_split(spark, sf):
    rows = forecast.with_split(ev(spark, sf))
    return rows.groupBy("dt", "split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "w13_label_encode", "c_custkey:l c_mktsegment:s code:l",
    """SELECT c_custkey, c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code FROM customer""",
)
def label_encode(spark, sf):
    rows = table(spark, sf, "customer")
    return joins.encode(rows, joins.label_index(rows, "c_mktsegment"), "c_mktsegment", "code")


@query("m03_feature_names", "name:s rows:l", """SELECT unnest(['country', 'latitude', 'longitude', 'elevation',
    'temperature', 'precipitation', 'wind_speed', 'snow', 'temp_lag1', 'temp_lag2', 'temp_lag7', 'temp_ma3', 'temp_ma7',
    'temp_std7', 'precip_sum3', 'wind_ma7', 'temp_anomaly', 'month', 'dayofyear', 'dayofweek', 'is_weekend', 'year',
    'season', 'city_encoded']) AS name, (SELECT count(*) FROM (""" + _features_sql(*BY_CITY, False, TRAIN) + ") AS f) AS rows", EV)
def feature_names(spark, sf):
    features = forecast.build_features(ev(spark, sf))
    names = F.array(*[F.lit(c) for c in forecast.feature_names(features)])
    return features.agg(F.count(F.lit(1)).alias("rows")).select(F.explode(names).alias("name"), "rows")


FORECAST_SHAPE = (
    "dt:s location:s city:s source:s temp_actual:f temp_predicted:f error_abs:f model_version:l confidence:f"
)


@query(
    "m07_forecast_table", FORECAST_SHAPE,
    "SELECT * REPLACE (CAST(dt AS VARCHAR) AS dt) FROM forecasts", ctes("forecasts"),
)
def forecast_table(spark, sf):
    return forecasts(spark, sf)


_MODELS: dict[tuple[str, str], str] = {}


def _published(spark, sf):
    """The folder of a published model, found by the whole search of ``forecast.GRID`` and trained once per session and data set."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        base = scratch_path(spark, "models")
        if forecast.needs_training(spark, base):
            features = forecast.build_features(forecast.history(ev(spark, sf)))
            model, ranks, scores, best = forecast.train_model(features)
            metrics = forecast.metrics_row(scores, features, best, 1, forecast.model_features(model))
            forecast.publish_model(spark, base, model, ranks, metrics)
        _MODELS[key] = base
    return _MODELS[key]


@query(
    "m04_m05_trained_metrics", "rmse_test:f mae_test:f r2_test:f rmse_train:f rmse_val:f n_samples:l model_version:l goal_met:b"
)
def trained_metrics(spark, sf):
    return forecast.versions(spark, _published(spark, sf))


@query("m06_m08_s10_s11_published_forecast", FORECAST_SHAPE)
def published_forecast(spark, sf):
    """Scores the last 30 days with the latest published model and writes them by day."""
    out = scratch_path(spark, "forecasts")
    forecast.run_forecast(spark, ev(spark, sf), _published(spark, sf), out)
    return spark.read.parquet(out)
