"""Series indicators per station or location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from obslake.operators.skew import over_key


def full_frame(aggregate: Column, value: str, window: WindowSpec, size: int) -> Column:
    """``aggregate`` only where the frame holds ``size`` values that are not NULL."""
    return F.when(F.count(value).over(window) == size, aggregate)


def _trailing(rows: DataFrame, window: WindowSpec) -> DataFrame:
    week, three = window.rowsBetween(-6, 0), window.rowsBetween(-2, 0)
    return rows.withColumns(
        {
            "temp_ma3": F.avg("temperature").over(three),
            "temp_ma7": F.avg("temperature").over(week),
            "temp_std7": F.stddev("temperature").over(week),
        }
    ).withColumn("temp_anomaly", F.col("temperature") - F.col("temp_ma7"))


def trailing_indicators(
    rows: DataFrame, ties: list[str] | None = None, days: float | None = None, sample: DataFrame | None = None
) -> DataFrame:
    """Means of the last 3 and 7 rows of a station, deviation of 7, and the anomaly."""
    return over_key(rows, "station_id", "timestamp", ties or [], _trailing, before=6, days=days, sample=sample)


def trailing_days(rows: DataFrame) -> DataFrame:
    """The same indicators over the last 3 and 7 calendar days instead of rows.

    Days are pre-aggregated per station, so the window sees one row per
    station and day however many observations the day holds.
    """
    value = F.col("temperature")
    moments = rows.groupBy("station_id", "dt").agg(
        F.count(value).alias("_n"), F.sum(value).alias("_s"), F.avg(value).alias("_m"),
        F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("_q"),
    )
    days = Window.partitionBy("station_id").orderBy(F.unix_date("dt"))
    week, three = days.rangeBetween(-6, 0), days.rangeBetween(-2, 0)
    n, s = (F.sum(c).over(week) for c in ("_n", "_s"))
    # squares within each day plus those of the day's mean around the week's mean, so that no digits cancel
    parts = F.collect_list(F.struct("_n", "_m", "_q")).over(week)
    mean = F.try_divide(s, n)
    square = F.aggregate(
        parts, F.lit(0.0),
        lambda total, day: total + day["_q"] + F.coalesce(day["_n"] * (day["_m"] - mean) * (day["_m"] - mean), F.lit(0.0)),
    )
    spread = F.when(n > 1, square / (n - 1))
    daily = moments.select(
        "station_id",
        "dt",
        F.try_divide(F.sum("_s").over(three), F.sum("_n").over(three)).alias("temp_ma3"),
        F.try_divide(s, n).alias("temp_ma7"),
        F.sqrt(F.when(spread < 0, 0.0).otherwise(spread)).alias("temp_std7"),
    )
    return rows.join(daily, ["station_id", "dt"], "left").withColumn(
        "temp_anomaly", F.col("temperature") - F.col("temp_ma7")
    )


def series_features(
    rows: DataFrame,
    key: str = "location",
    ties: list[str] | None = None,
    centered: bool = False,
    days: float | None = None,
) -> DataFrame:
    """Lags, rolling values and the next value of each series.

    Rolling values are NULL unless their frame is full. ``centered`` frames
    look as far ahead as back; the default looks back only.
    """

    def build(frame: DataFrame, window: WindowSpec) -> DataFrame:
        temp = F.col("temperature")
        if centered:
            three, seven = window.rowsBetween(-1, 1), window.rowsBetween(-3, 3)
        else:
            three, seven = window.rowsBetween(-2, 0), window.rowsBetween(-6, 0)
        back3, back7 = window.rowsBetween(-2, 0), window.rowsBetween(-6, 0)

        def roll(fn, column: str, over: WindowSpec, size: int) -> Column:
            return full_frame(fn(column).over(over), column, over, size)

        return frame.withColumns(
            {
                "temp_lag1": F.lag(temp, 1).over(window),
                "temp_lag2": F.lag(temp, 2).over(window),
                "temp_lag7": F.lag(temp, 7).over(window),
                "target": F.lead(temp, 1).over(window),
                "temp_ma3": roll(F.avg, "temperature", three, 3),
                "temp_ma7": roll(F.avg, "temperature", seven, 7),
                "temp_std7": roll(F.stddev, "temperature", seven, 7),
                "precip_sum3": roll(F.sum, "precipitation", back3, 3),
                "wind_ma7": roll(F.avg, "wind_speed", back7, 7),
            }
        ).withColumn("temp_anomaly", temp - F.col("temp_ma7"))

    return over_key(
        rows, key, "timestamp", ties or [], build, before=7, after=3 if centered else 1, days=days
    )
