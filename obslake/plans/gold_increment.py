"""Derived tables kept up to date by mergeable states: years that did not change are not read again.

All tables lie below the versioned root of the observations and change together by one commit:

- ``daily_aggregates``, ``extreme_events``: by calendar year
- ``week_states``: sums per week, city and source, by the calendar year of their days
- ``month_states``: sums per city and month, by calendar year
- ``series``: weeks of each city and source per year of the weekly table
- ``weekly_trends`` by year, ``climate_profile`` by month: made of the states

A run takes the years that the ledger says were written after their daily figures, replaces their
states, and merges: a week with the states of the neighbouring year (only with ISO years do two have a part of it), a month with the states of
all years, of which there are as many as cities, months and years. Weekly rows also change in the next year that a
series has, whose first week compares with the last one of a changed year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.weather import thresholds
from obslake.operators.aggregates import (
    daily_aggregates, extreme_event_rows, merged_months, merged_weeks, month_figures, month_states, previous_change,
    week_figures, week_states,
)
from obslake.operators.joins import union_all
from obslake.plans import ledger
from obslake.plans.gold import CLIMATE, DAILY, EVENTS, WEEKLY, by_year
from obslake.plans.increment import SILVER
from obslake.plans.reach import years_before, years_behind
from obslake.session import staged_for
from obslake.sources import versions
from obslake.sources.readers import read_table

WEEK_STATES, MONTH_STATES, SERIES = "week_states", "month_states", "series"
#: the calendar year of a state's days; ``year`` is the year of the weekly row
DAYS_YEAR = "days_year"


def _names(column: str, values) -> set[str]:
    return {f"{column}={value}" for value in values}


def _series() -> Column:
    """City and source as one key, unknown ones too."""
    return F.to_json(F.struct("city", "source"))


def pending_years(spark: SparkSession, ledger_path: str) -> list[int]:
    """Years whose observations were written after their derived figures; bounded by the calendar."""
    book = ledger.read_ledger(spark, ledger_path)
    source = ledger.changes(book, SILVER)
    moved = source.withColumn("key", ledger.work_key(DAILY, F.col("key")))
    keys = ledger.pending(moved.select("key"), book, "gold", moved)
    return sorted(int(row["key"].split(":")[1]) for row in keys.collect())


def refresh_gold(
    spark: SparkSession,
    root: str,
    ledger_path: str,
    limits: dict[str, float] | None = None,
    week_year: str = "calendar",
    slope: str = "rows",
    journal_path: str | None = None,
) -> list[int]:
    """Brings the derived tables below ``root`` up to date with ``silver`` there; returns the years taken."""
    seen = ledger.now()
    with ledger.journaled(spark, journal_path, "gold") as counters:
        years = pending_years(spark, ledger_path)
        counters["years"] = len(years)
        if not years:
            return []
        rows = versions.read_version(spark, f"{root}/{SILVER}", _names("year", years))
        if rows is None:  # none of the years has rows any more
            rows = read_table(spark, f"{root}/{SILVER}")
            if rows is None:
                raise RuntimeError(f"no observations at {root}/{SILVER}: nothing is marked")
            rows = rows.where(F.lit(False))
        with staged_for(by_year(daily_aggregates(rows)), "daily") as daily:
            _replace(spark, root, daily, years, thresholds(limits), week_year, slope)
        keys = spark.createDataFrame([(f"{DAILY}:{year}",) for year in years], "key string")
        ledger.mark(spark, ledger_path, "gold", keys, seen=seen)
        versions.expire(spark, root)
    return years


def _replace(spark, root, daily, years, limits, week_year, slope) -> None:
    def kept(table: str, column: str, only=None) -> DataFrame | None:
        """Stored rows of other partitions, all or only some of them."""
        mine = {versions.partition_of(f) for f in versions.live_folders(spark, f"{root}/{table}")}
        mine -= _names(column, years)
        return versions.read_version(spark, f"{root}/{table}", mine if only is None else mine & _names(column, only))

    fresh = week_states(daily.drop("year").withColumn(DAYS_YEAR, F.year("dt")), week_year, DAYS_YEAR)
    months = month_states(daily.withColumn(DAYS_YEAR, F.year("dt")).drop("year"), DAYS_YEAR)
    with staged_for(fresh, "weeks") as fresh, staged_for(months, "months") as months:
        # labels of the weekly rows that the changed days had or have
        before = versions.read_version(spark, f"{root}/{WEEK_STATES}", _names(DAYS_YEAR, years))
        labels = union_all([part.select("year") for part in (fresh, before) if part is not None]).distinct()
        touched = sorted(row["year"] for row in labels.where("year IS NOT NULL").collect())
        reach = 0 if week_year == "calendar" else 1

        def states(of: list[int]) -> DataFrame:
            """Merged weeks of some years of the weekly table."""
            near = {year + shift for year in of for shift in range(-reach, reach + 1)}
            parts = [fresh, kept(WEEK_STATES, DAYS_YEAR, near)]
            return merged_weeks(union_all([part.where(F.col("year").isin(of)) for part in parts if part is not None]))

        counts = states(touched).groupBy(_series().alias("station_id"), "year").agg(F.count("*").alias("n"))
        stored = read_table(spark, f"{root}/{SERIES}")
        if stored is not None:
            stored = stored.where(~F.col("year").isin(touched)).select("station_id", "year", "n")
        with staged_for(union_all([counts, stored]), "series") as all_counts:
            behind = [row["year"] for row in years_behind(all_counts, touched, 1).collect()]
            written = sorted({*touched, *behind})
            earlier = years_before(all_counts, written, 1)
            needed = sorted({row["year"] for row in earlier.select("year").distinct().collect()})
            weeks = states([*written, *needed]).withColumn("station_id", _series())
            mine = weeks.where(F.col("year").isin(written))
            last = weeks.where(F.col("year").isin(needed)).join(earlier, ["station_id", "year"], "left_semi")
            weekly = previous_change(week_figures(union_all([mine, last]).drop("station_id"), slope))
            climate = month_figures(merged_months(union_all([months, kept(MONTH_STATES, DAYS_YEAR)])))
            gone = _names("year", years)
            with versions.Change(spark, root) as change:
                change.replace(DAILY, daily, ["year"], gone)
                change.replace(EVENTS, by_year(extreme_event_rows(daily, limits)), ["year"], gone)
                change.replace(WEEK_STATES, fresh, [DAYS_YEAR], _names(DAYS_YEAR, years))
                change.replace(MONTH_STATES, months, [DAYS_YEAR], _names(DAYS_YEAR, years))
                change.replace(SERIES, all_counts.where(F.col("year").isin(touched)), ["year"], _names("year", touched))
                change.replace(WEEKLY, weekly.where(F.col("year").isin(written)), ["year"], _names("year", touched))
                change.replace(CLIMATE, climate, ["month"], _names("month", range(1, 13)))
