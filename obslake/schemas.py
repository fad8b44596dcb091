"""Column contracts of the raw inputs and of the tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

# Column names and orders of the input and table contracts.
ARCHIVE_REQUIRED = ["NUM_POSTE", "NOM_USUEL", "LAT", "LON", "ALTI", "AAAAMMJJ", "RR", "TN", "TX"]
ARCHIVE_OPTIONAL = ["TM", "FFM", "NEIGETOT"]
FEED_REQUIRED = [
    "city", "latitude", "longitude", "timestamp", "temperature", "windspeed", "precipitation",
]
FEED_MESSAGE = _struct(
    city=_S, latitude=_D, longitude=_D, timestamp=_S, temperature=_D, windspeed=_D,
    winddirection=_D, weathercode=_L, precipitation=_D, source=_S,
)
OBSERVATION = _struct(
    station_id=_S, station_name=_S, city=_S, country=_S, latitude=_D, longitude=_D, elevation=_D,
    timestamp=T.TimestampType(), temperature=_D, precipitation=_D, wind_speed=_D, snow=_D,
    source=_S, dt=T.DateType(),
)
OBSERVATION_COLUMNS = OBSERVATION.names
INDICATORS = ["temp_ma3", "temp_ma7", "temp_std7", "temp_anomaly"]
MEASURES = ["temperature", "precipitation", "wind_speed", "snow"]
FEATURE_INPUT = [
    "city", "station_id", "timestamp", "temperature", "precipitation", "wind_speed", "source", "dt",
]
NOT_FEATURES = [
    "target", "timestamp", "dt", "location", "city", "station_id", "station_name", "source",
]
WEEKLY_COLUMNS = [
    "year", "week", "city", "source", "temp_avg", "temp_min", "temp_max", "precip_sum", "n_days", "trend_slope",
    "temp_vs_prev_week",
]
CLIMATE_COLUMNS = [
    "city", "month", "season", "temp_normal", "temp_min_record", "temp_max_record", "temp_amplitude_avg", "precip_avg",
    "rain_days", "rain_day_ratio", "wind_avg", "n_days", "n_years",
]
LEDGER = _struct(stage=_S, key=_S, action=_S, at=T.TimestampType(), run_id=_S, seen=T.TimestampType())
JOURNAL = _struct(
    stage=_S, run_id=_S, status=_S, at=T.TimestampType(),
    counters=T.MapType(T.StringType(), T.LongType()),
)
BULLETIN = _struct(dt=_S, part=T.IntegerType(), bulletin=_S, model=_S, source=_S, generated_at=_S)
HEALTH = _struct(
    layer=_S, path=_S, required=T.BooleanType(), expect_success=T.BooleanType(),
    expect_data=T.BooleanType(),
)
