"""Daily, weekly, monthly and network aggregates.

All groupings combine rows before their shuffle, so a large group costs no
more than its number of input tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake.functions.calendar import iso_year, season_of_month
from obslake.functions.weather import RAIN_DAY_MM, extreme_events, rain_day_ratio, within
from obslake.operators.filters import last_days
from obslake.schemas import CLIMATE_COLUMNS, WEEKLY_COLUMNS

SERIES_KEY = ["city", "source"]


def daily_aggregates(obs: DataFrame) -> DataFrame:
    """Count, temperature, rain, wind and snow figures per day, city and source."""
    temp = F.col("temperature")
    return obs.groupBy("dt", *SERIES_KEY).agg(
        F.count(F.lit(1)).alias("n_obs"),
        *[fn(temp).alias(f"temp_{name}") for name, fn in (("avg", F.avg), ("min", F.min), ("max", F.max))],
        F.sum("precipitation").alias("precip_sum"),
        F.avg("wind_speed").alias("wind_avg"),
        F.sum("snow").alias("snow_sum"),
        F.stddev_samp(temp).alias("temp_std"),
    )


def slope_from_sums(n: Column, sx: Column, sy: Column, sxy: Column, sxx: Column) -> Column:
    """Least-squares slope; 0.0 with fewer than two distinct x."""
    spread = n * sxx - sx * sx
    return F.when(spread != 0, F.try_divide(n * sxy - sx * sy, spread)).otherwise(0.0)


def week_states(daily: DataFrame, week_year: str = "calendar", *more: str) -> DataFrame:
    """Sums from which the weekly figures follow, per week, city and source (and further columns).

    States of one week add up (see ``merged_weeks``), whatever rows each was made of. x is the day number within the
    year. Distinct days are bits: a group holds days of one ISO week at either end of a year, so weekday and
    half-year tell them apart.
    """
    year = F.year("dt") if week_year == "calendar" else iso_year(F.col("dt"))
    keyed = daily.withColumns({"year": year, "week": F.weekofyear("dt")}).withColumn(
        "_d", F.datediff("dt", F.make_date("year", F.lit(1), F.lit(1))).cast("long")
    )
    d, y = F.col("_d"), F.col("temp_avg")
    paired = F.when(y.isNotNull(), d)
    late = F.when(F.month("dt") > 6, 7).otherwise(0)
    day_bit = F.call_function("shiftleft", F.lit(1), F.weekday("dt") + late)
    return keyed.groupBy("year", "week", *SERIES_KEY, *more).agg(
        F.min("temp_min").alias("temp_min"),
        F.max("temp_max").alias("temp_max"),
        F.sum("precip_sum").alias("precip_sum"),
        F.bit_or(day_bit).alias("days"),
        F.count("dt").alias("n"),
        F.min(d).alias("d0"),
        F.sum(d).alias("sd"),
        F.sum(d * d).alias("sdd"),
        F.sum(y).alias("sy"),
        F.sum(d * y).alias("sdy"),
        F.count(y).alias("n_pairs"),
        F.sum(paired).alias("sd_pairs"),
        F.sum(paired * paired).alias("sdd_pairs"),
    )


#: how each sum of a week's states merges with another one's
_MERGES = {"temp_min": F.min, "temp_max": F.max, "days": F.bit_or, "d0": F.min}


def merged_weeks(states: DataFrame) -> DataFrame:
    """One state per week, city and source."""
    sums = ["temp_min", "temp_max", "precip_sum", "days", "n", "d0", "sd", "sdd", "sy", "sdy", "n_pairs", "sd_pairs", "sdd_pairs"]
    return states.groupBy("year", "week", *SERIES_KEY).agg(*[_MERGES.get(name, F.sum)(name).alias(name) for name in sums])


def week_figures(states: DataFrame, slope: str = "rows") -> DataFrame:
    """The weekly figures of states, one each; sums are moved to the first day of the week."""
    n, d0, sd, sy = (F.col(c) for c in ("n", "d0", "sd", "sy"))
    by_rows = slope_from_sums(n, sd - n * d0, sy, F.col("sdy") - d0 * sy, F.col("sdd") - 2 * d0 * sd + n * d0 * d0)
    by_pairs = slope_from_sums(F.col("n_pairs"), F.col("sd_pairs"), sy, F.col("sdy"), F.col("sdd_pairs"))
    known = F.col("week").isNotNull() & F.col("city").isNotNull() & F.col("source").isNotNull()
    trend = by_rows if slope == "rows" else F.coalesce(by_pairs, F.lit(0.0))
    figures = states.withColumns({
        "temp_avg": F.try_divide("sy", "n_pairs"),
        "n_days": F.coalesce(F.bit_count("days"), F.lit(0)).cast("long"),
        "trend_slope": F.when(known, trend).otherwise(0.0),
    })
    return figures.select(*[name for name in WEEKLY_COLUMNS if name != "temp_vs_prev_week"])


def weekly_trends(daily: DataFrame, week_year: str = "calendar", slope: str = "rows") -> DataFrame:
    """Weekly figures with the slope of the daily mean and the change to the week before.

    ``week_year``: ``calendar`` pairs the ISO week with the calendar year, as
    the tables in use do; ``iso`` uses the year the week belongs to.
    ``slope``: ``rows`` counts every day in n and x, ``pairs`` only days with a
    mean. Both take one aggregation and one shuffle.
    """
    return previous_change(week_figures(week_states(daily, week_year), slope))


def previous_change(weekly: DataFrame) -> DataFrame:
    """Change of the mean against the previous week that has data.

    A series holds one row per week, so its window stays small.
    """
    weeks = Window.partitionBy(*SERIES_KEY).orderBy("year", "week")
    return weekly.withColumn("temp_vs_prev_week", F.col("temp_avg") - F.lag("temp_avg").over(weeks))


_MEANS = ("temp_normal", "temp_amplitude_avg", "precip_avg", "wind_avg")


def month_states(daily: DataFrame, *more: str) -> DataFrame:
    """Sums from which the monthly normals follow, per city and month (and further columns that a day decides).

    A first grouping by day folds the sources of a day, so distinct days are
    plain rows afterwards; states that share no day add up.
    """
    amplitude = F.col("temp_max") - F.col("temp_min")
    means = dict(zip(_MEANS, (F.col("temp_avg"), amplitude, F.col("precip_sum"), F.col("wind_avg")), strict=True))
    per_day = daily.groupBy("city", F.month("dt").alias("month"), "dt", *more).agg(
        F.min("temp_min").alias("low"),
        F.max("temp_max").alias("high"),
        F.count_if(F.col("precip_sum") > RAIN_DAY_MM).alias("wet"),
        *[F.sum(col).alias(f"s_{name}") for name, col in means.items()],
        *[F.count(col).alias(f"n_{name}") for name, col in means.items()],
    )
    return per_day.groupBy("city", "month", *more).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("wet").alias("wet"),
        *[F.sum(f"{kind}_{name}").alias(f"{kind}_{name}") for kind in "sn" for name in means],
        F.count("dt").alias("n_days"), F.countDistinct(F.year("dt")).alias("n_years"),
    )


def merged_months(states: DataFrame) -> DataFrame:
    """One state per city and month, of states that share no year."""
    sums = ["wet", *[f"{kind}_{name}" for kind in "sn" for name in _MEANS], "n_days", "n_years"]
    return states.groupBy("city", "month").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(name).alias(name) for name in sums]
    )


def month_figures(states: DataFrame, clamp: bool = False) -> DataFrame:
    """The monthly normals of states, one each. ``clamp`` keeps the rain ratio within [0, 1]."""
    ratio = (
        rain_day_ratio(F.col("wet"), F.col("n_days"))
        if clamp
        else F.coalesce(F.round(F.try_divide("wet", "n_days"), 3), F.lit(0.0))
    )
    figures = states.withColumns({
        "season": season_of_month(F.col("month")),
        "temp_min_record": F.col("low"),
        "temp_max_record": F.col("high"),
        "rain_days": F.col("wet"),
        "rain_day_ratio": ratio,
        **{name: F.try_divide(f"s_{name}", f"n_{name}") for name in _MEANS},
    })
    return figures.select(*CLIMATE_COLUMNS)


def climate_profile(daily: DataFrame, clamp: bool = False) -> DataFrame:
    """Monthly normals per city over all years."""
    return month_figures(month_states(daily), clamp)


def extreme_event_rows(daily: DataFrame, limits: dict[str, float]) -> DataFrame:
    """One row per event found in the daily figures; no shuffle."""
    found = daily.select("dt", *SERIES_KEY, extreme_events(limits).alias("found"))
    return found.select("dt", *SERIES_KEY, F.inline("found"))


def annual_trend(weekly: DataFrame) -> DataFrame:
    """Yearly mean, lowest and highest of the weekly means, and the band between them."""
    figures = weekly.where(F.col("temp_avg").isNotNull() & F.col("year").isNotNull())
    yearly = figures.groupBy("year").agg(
        *[F.round(fn("temp_avg"), 2).alias(n) for n, fn in (("avg", F.avg), ("min", F.min), ("max", F.max))]
    )
    return yearly.withColumn("band", F.col("max") - F.col("min"))


def kpi_summary(daily: DataFrame) -> DataFrame:
    """One row: last day, its cities, mean temperature and rain, and all observations."""
    last = daily.select(F.max("dt")).scalar()
    on_last = F.col("dt") == last

    def pick(name: str) -> Column:
        return F.when(on_last, F.col(name))

    return daily.agg(
        F.countDistinct(F.nullif(pick("city"), F.lit(""))).alias("cities"),
        F.coalesce(F.sum("n_obs"), F.lit(0)).alias("observations"),
        F.round(F.avg(pick("temp_avg")), 1).alias("temp_avg"),
        F.round(F.sum(pick("precip_sum")), 1).alias("precip_total"),
        F.date_format(F.max("dt"), "yyyy-MM-dd").alias("last_day"),
    )


def network_daily(daily: DataFrame, field: str = "temp_avg") -> DataFrame:
    """Mean over all cities per day; days without a value are left out."""
    return daily.where(F.col(field).isNotNull()).groupBy("dt").agg(F.avg(field).alias("value"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def forecast_scores(forecasts: DataFrame, days: int | None = 14) -> DataFrame:
    """RMSE and MAE of the scored forecasts of the last days, and how many wait for an actual."""
    recent = forecasts if days is None else last_days(forecasts, days)
    error = F.col("temp_predicted") - F.col("temp_actual")
    return recent.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count_if(F.col("temp_actual").isNull()).alias("n_pending"),
    )


def mean_error(forecasts: DataFrame) -> DataFrame:
    return forecasts.agg(F.avg("error_abs").alias("mae"))


def split_scores(scored: DataFrame) -> DataFrame:
    """RMSE, MAE and R2 per split from sums."""
    y, p = F.col("target"), F.col("prediction")
    both = scored.where(y.isNotNull() & p.isNotNull())
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        (1 - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y))).alias("r2"),
    )


def mean_confidence(forecasts: DataFrame) -> DataFrame:
    """Mean confidence per city as a share; means above 1 are read as percent."""
    mean = F.avg("confidence")
    share = F.when(mean > 1, mean / 100).otherwise(mean)
    return (
        forecasts.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(within(share, 0.0, 1.0).alias("confidence"))
        .where(F.col("confidence").isNotNull())
    )


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def station_catalog(obs: DataFrame) -> DataFrame:
    """Coordinates of each city from its earliest located observation.

    The places of a city are first reduced to one row each, by hash.
    """
    located = obs.where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        & F.col("city").isNotNull() & (F.col("city") != "")
    )
    places = located.groupBy("city", "latitude", "longitude").agg(F.min("timestamp").alias("seen"))
    return (
        places.groupBy("city").agg(F.min(F.struct("seen", "latitude", "longitude")).alias("f"))
        .select("city", F.col("f.latitude").alias("lat"), F.col("f.longitude").alias("lon"))
    )


def value_range(df: DataFrame, column: str) -> DataFrame:
    """Lowest and highest value; 0 and 1 when there is none."""
    return df.agg(
        F.coalesce(F.min(column), F.lit(0)).alias("low"),
        F.coalesce(F.max(column), F.lit(1)).alias("high"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins from the lowest to the highest value, which joins the last bin."""
    known = df.where(F.col(column).isNotNull())
    low, high = known.select(F.min(column)).scalar(), known.select(F.max(column)).scalar()
    bucket = F.floor((F.col(column) - low) / F.nullif(high - low, F.lit(0.0)) * bins)
    bin_no = F.least(F.coalesce(bucket, F.lit(0)), F.lit(bins - 1))
    return known.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table and of all together."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, rows)
    total = counts.agg(F.sum("n").alias("n")).select(F.lit("total").alias("table_name"), "n")
    return counts.unionByName(total)


def run_counters(results: DataFrame) -> DataFrame:
    """Batches done, failed and in all of an ingest run, with its status."""
    return results.agg(
        F.count_if(F.col("ok")).alias("batches_ingested"),
        F.count_if(~F.col("ok")).alias("batches_failed"),
        F.count(F.lit(1)).alias("batches_total"),
    ).withColumn("status", F.when(F.col("batches_failed") == 0, "success").otherwise("partial"))
