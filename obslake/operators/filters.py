"""Row filters and column checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import same_text
from obslake.functions.weather import bounded


def missing_columns(columns: list[str], required: list[str]) -> list[str]:
    """Required names that are absent, in the order required."""
    return [name for name in required if name not in columns]


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    absent = missing_columns(df.columns, required)
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column if present, else a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def present(df: DataFrame, names: list[str]) -> DataFrame:
    """Those of the named columns that exist, in the order named."""
    return df.select(*[name for name in names if name in df.columns])


def with_time(df: DataFrame) -> DataFrame:
    return df.where(F.col("timestamp").isNotNull())


def date_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Days from ``start`` to ``end``, both included; prunes ``year`` partitions too."""
    for bound, op in ((start, "__ge__"), (end, "__le__")):
        if bound is None:
            continue
        day = F.lit(bound).cast("date")
        df = df.where(getattr(F.col("dt"), op)(day))
        if "year" in df.columns:
            df = df.where(getattr(F.col("year"), op)(F.year(day)))
    return df


def partitions(df: DataFrame, column: str, values: DataFrame, few: bool = False) -> DataFrame:
    """Rows whose partition is listed; Spark prunes the scan by the join.

    Lists of any column are allowed, so Spark's own size check chooses between a broadcast and a shuffle. ``few`` is for lists
    bounded by the calendar: they are broadcast, since a shuffle would bring all rows of a year to one task.
    """
    listed = values.select(column).distinct()
    return df.join(F.broadcast(listed) if few else listed, column, "left_semi")


def last_days(df: DataFrame, days: int, column: str = "dt") -> DataFrame:
    """Rows from ``days`` before the newest day on, in one plan."""
    newest = df.select(F.max(column)).scalar()
    return df.where(F.col(column) >= F.date_sub(newest, days))


def newest_day(df: DataFrame, column: str = "dt") -> DataFrame:
    """Rows of the newest day."""
    return df.where(F.col(column) == df.select(F.max(column)).scalar())


def day_and_before(df: DataFrame, day: str) -> DataFrame:
    """Rows of a day and of the day before it."""
    last = F.lit(day).cast("date")
    return df.where(F.col("dt").isin(last, F.date_sub(last, 1)))


def of_city(df: DataFrame, city: str) -> DataFrame:
    return df.where(same_text(F.col("city"), F.lit(city)))


def of_source(df: DataFrame, source: str = "OPENMETEO") -> DataFrame:
    return df.where(F.upper("source") == source)


def within_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Impossible measures made NULL; other columns are left alone."""
    return df.withColumns(
        {name: bounded(F.col(name), *limits) for name, limits in bounds.items() if name in df.columns}
    )


def usable(df: DataFrame, wind: str = "windspeed") -> DataFrame:
    """Rows with at least one of temperature, wind and precipitation."""
    return df.where(F.coalesce("temperature", wind, "precipitation").isNotNull())


def pending_forecasts(df: DataFrame) -> DataFrame:
    """Forecasts whose actual is not known yet, as the report shows them."""
    return df.where(F.col("temp_actual").isNull()).select(
        F.date_format("dt", "dd/MM/yyyy").alias("date"),
        "city",
        "source",
        "temp_predicted",
        "model_version",
        "confidence",
        F.lit("J+1").alias("horizon"),
    )
