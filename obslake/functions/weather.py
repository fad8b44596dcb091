"""Weather rules as column expressions."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Alert limits, with the environment variable that replaces each.
THRESHOLDS = {
    "heatwave": ("THRESHOLD_HEATWAVE_C", 35.0),
    "heavy_rain": ("THRESHOLD_HEAVY_RAIN_MM", 20.0),
    "strong_wind": ("THRESHOLD_STRONG_WIND_MS", 20.0),
    "cold_snap": ("THRESHOLD_COLD_SNAP_C", -10.0),
}
EXTREME_FACTOR = 1.25
RAIN_DAY_MM = 1.0

# One rule per event type: limit, measure, direction, detail text.
EVENT_RULES = [
    ("canicule", "heatwave", "temp_max", "up", "%s : %.1f°C le %s"),
    ("fortes_pluies", "heavy_rain", "precip_sum", "up", "%s : %.1f mm de pluie le %s"),
    ("vents_violents", "strong_wind", "wind_avg", "up", "%s : %.1f m/s de vent le %s"),
    ("vague_de_froid", "cold_snap", "temp_min", "down", "%s : %.1f°C le %s"),
]

# Physical limits of each measure, by the feed's and by our names.
BOUNDS = {
    "temperature_2m": (-95.0, 65.0),
    "wind_speed_10m": (0.0, 130.0),
    "wind_direction_10m": (0.0, 360.0),
    "precipitation": (0.0, 2000.0),
    "weather_code": (0.0, 100.0),
}
FEED_BOUNDS = {
    "temperature": BOUNDS["temperature_2m"],
    "windspeed": BOUNDS["wind_speed_10m"],
    "winddirection": BOUNDS["wind_direction_10m"],
    "precipitation": BOUNDS["precipitation"],
    "weathercode": BOUNDS["weather_code"],
}

# Event groups by keyword, first match wins.
EVENT_GROUPS = [
    ("Chaleur", ["heat", "chaleur", "canicule"]),
    ("Froid", ["cold", "froid", "freeze", "gel"]),
    ("Neige", ["snow", "neige"]),
    ("Vent", ["wind", "vent", "storm", "tempete"]),
    ("Pluie", ["rain", "pluie", "precip", "flood", "inondation"]),
]
# Event symbol by keyword.
EVENT_SYMBOLS = [("hot", "canicule"), ("rain", "pluie"), ("wind", "vent"), ("cold", "froid")]
# Upper limits of the temperature bands.
TEMPERATURE_BANDS = [
    (0, "below_0"), (8, "0_8"), (14, "8_14"), (20, "14_20"), (26, "20_26"), (32, "26_32"),
]


def thresholds(overrides: dict[str, float] | None = None) -> dict[str, float]:
    """Alert limits: defaults, then the environment, then ``overrides``."""
    values = {name: float(os.environ.get(env, limit)) for name, (env, limit) in THRESHOLDS.items()}
    return {**values, **(overrides or {})}


def thresholds_frame(spark: SparkSession, overrides: dict[str, float] | None = None) -> DataFrame:
    """The limits as one row."""
    limits = thresholds(overrides)
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in limits.items()])


def mean_temperature(mean: Column, low: Column, high: Column) -> Column:
    """The given mean, else half of low + high, else the one present (two decimals).

    Takes numbers; texts are parsed first, in a projection of their own.
    """
    return F.round(F.coalesce(mean, (low + high) / 2, low, high), 2)


def bounded(value: Column, low: float, high: float) -> Column:
    """``value`` unless it is no number, NaN or outside ``[low, high]``: then NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number) & number.between(low, high), value)


def extreme_events(limits: dict[str, float]) -> Column:
    """Array of the event structs of one daily row; use with ``F.inline``.

    A missing measure or a missing limit gives no event.
    """
    found = []
    for kind, limit_name, measure, direction, detail in EVENT_RULES:
        limit = limits.get(limit_name)
        if limit is None:
            continue
        value, far = F.col(measure), F.lit(EXTREME_FACTOR * limit)
        over = value >= limit if direction == "up" else value <= limit
        beyond = value >= far if direction == "up" else value <= far
        event = F.struct(
            F.lit(kind).alias("event_type"),
            F.when(beyond, "extreme").otherwise("alerte").alias("severity"),
            value.alias("value"),
            F.lit(float(limit)).alias("threshold"),
            F.format_string(
                detail, F.coalesce("city", F.lit("None")), value, F.date_format("dt", "yyyy-MM-dd")
            ).alias("detail"),
        )
        found.append(F.when(over, event))
    return F.array_compact(F.array(*found))


def within(value: Column, low: float, high: float) -> Column:
    """The value moved into ``[low, high]``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def rain_day_ratio(rain_days: Column, days: Column) -> Column:
    """Share of rain days, kept within [0, 1]; 0.0 when it cannot be computed."""
    total = days.try_cast("double")
    share = F.try_divide(rain_days.try_cast("double"), F.when(total > 0, total))
    return F.round(within(F.coalesce(share, F.lit(0.0)), 0.0, 1.0), 3)


def weather_icon(snow: Column, precip: Column, wind: Column, temp: Column) -> Column:
    """Class of the day from snow, then rain, then wind, then temperature."""
    rain = F.coalesce(precip, F.lit(0.0))
    return (
        F.when(F.coalesce(snow, F.lit(0.0)) > 0, "snow")
        .when(rain >= 5, "rain")
        .when(rain > 0, "showers")
        .when(F.coalesce(wind, F.lit(0.0)) >= 20, "wind")
        .when(temp >= 30, "sun")
        .when(temp <= 2, "cold")
        .otherwise("cloud")
    )


def event_group(kind: Column) -> Column:
    """Group of an event type by keyword; an unknown type stays as it is."""
    text = F.lower(kind)
    out = kind
    for name, words in reversed(EVENT_GROUPS):
        out = F.when(text.rlike("|".join(words)), name).otherwise(out)
    return out


def event_symbol(kind: Column) -> Column:
    """Symbol name of an event type."""
    out = F.lit("cloud")
    for name, word in reversed(EVENT_SYMBOLS):
        out = F.when(kind.contains(word), name).otherwise(out)
    return out


def temperature_band(temp: Column) -> Column:
    """One of eight bands; a missing value is its own band."""
    out = F.when(temp.isNull(), "unknown")
    for limit, name in TEMPERATURE_BANDS:
        out = out.when(temp < limit, name)
    return out.otherwise("32_up")


def day_symbol(temp: Column, precip: Column) -> Column:
    """Symbol name of a day by rain, then temperature."""
    return (
        F.when(precip > 5, "rain")
        .when(temp >= 28, "hot")
        .when(temp >= 20, "sun")
        .when(temp <= 0, "cold")
        .otherwise("cloud")
    )


def absolute_error(actual: Column, predicted: Column) -> Column:
    """Distance of forecast and actual; NULL while there is no actual."""
    return F.abs(actual - predicted)


def confidence(error: Column, test_rmse: Column) -> Column:
    """``1 - error / 10`` within [0, 1]; from the model's test error when none is known."""
    return within(1 - F.coalesce(error, test_rmse) / 10, 0.0, 1.0)
