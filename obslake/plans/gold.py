"""Observations to the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.weather import thresholds
from obslake.operators.aggregates import (
    climate_profile, daily_aggregates, extreme_event_rows, weekly_trends,
)
from obslake.operators.filters import partitions
from obslake.plans import ledger
from obslake.session import settle
from obslake.sources.readers import read_table
from obslake.sources.sinks import drop_partitions, write_partitions

DAILY, WEEKLY = "daily_aggregates", "weekly_trends"
EVENTS, CLIMATE = "extreme_events", "climate_profile"


def by_year(df: DataFrame) -> DataFrame:
    return df.withColumn("year", F.year("dt"))


def years_after(daily: DataFrame, years: DataFrame) -> DataFrame:
    """``year`` of each city's next year after the given ones: its first week compares with them."""
    present = daily.select("city", F.year("dt").alias("year")).distinct()
    given = F.broadcast(years.select(F.col("year").alias("given")))  # bounded by the calendar
    later = present.join(given, F.col("year") > F.col("given"))
    return later.groupBy("city", "given").agg(F.min("year").alias("year")).select("year").distinct()


def _replace(spark: SparkSession, df: DataFrame, path: str, column: str, wanted: DataFrame) -> None:
    """Writes the wanted partitions and removes those of them that no row is left for."""
    write_partitions(df, path, [column])
    table = read_table(spark, path)
    if table is None:
        return
    # wanted values and partitions are bounded by the calendar
    empty = table.select(column).distinct().join(wanted, column, "left_semi").join(df.select(column).distinct(), column, "left_anti")
    drop_partitions(spark, path, column, [row[0] for row in empty.collect()])


def write_gold(
    spark: SparkSession,
    silver: DataFrame,
    root: str,
    ledger_path: str,
    start: str | None = None,
    end: str | None = None,
    only_new: bool = False,
    limits: dict[str, float] | None = None,
    week_year: str = "calendar",
    journal_path: str | None = None,
) -> dict[str, str]:
    """Writes the four tables; the daily one is computed once and read back by the others.

    ``start`` and ``end`` choose years, which are always written whole. An incremental run rewrites the years
    without a ledger row and those whose observations were written after the run that marked them began, the weeks of
    each city's next year, which compare with them, and the months. Partitions that no row is left for go.
    """
    seen = ledger.now()
    paths = {name: f"{root}/{name}" for name in (DAILY, WEEKLY, EVENTS, CLIMATE)}
    rows = silver if "year" in silver.columns else by_year(silver)
    for day, inside in ((start, F.col("year").__ge__), (end, F.col("year").__le__)):
        if day:
            rows = rows.where(inside(F.year(F.lit(day).cast("date"))))
    with ledger.journaled(spark, journal_path, "gold") as counters:
        years = rows.where("year IS NOT NULL").select(F.col("year").cast("string").alias("year")).distinct()
        keys = years.withColumn("key", ledger.work_key(DAILY, F.col("year")))
        if only_new:
            done = ledger.read_ledger(spark, ledger_path)
            source = ledger.changes(done, "silver")
            moved = source.withColumn("key", ledger.work_key(DAILY, F.col("key")))
            keys = ledger.pending(keys, done, "gold", moved)
        keys = settle(keys)
        counters["years"] = keys.count()
        wanted = keys.select(F.col("year").cast("int").alias("year"))
        fresh = by_year(daily_aggregates(partitions(rows, "year", wanted, few=True)))
        _replace(spark, fresh, paths[DAILY], "year", wanted)

        daily = read_table(spark, paths[DAILY])
        if daily is None and counters["years"]:
            raise RuntimeError(f"no daily table at {paths[DAILY]}: nothing is marked")
        if daily is not None:
            weeks = settle(wanted.unionByName(years_after(daily, wanted)).distinct())
            # the change to the previous week needs the series before the year
            weekly = partitions(weekly_trends(daily.drop("year"), week_year), "year", weeks, few=True)
            _replace(spark, weekly, paths[WEEKLY], "year", weeks)
            found = extreme_event_rows(partitions(daily, "year", wanted, few=True), thresholds(limits))
            _replace(spark, by_year(found), paths[EVENTS], "year", wanted)
            climate = climate_profile(daily)
            _replace(spark, climate, paths[CLIMATE], "month", spark.range(1, 13).select(F.col("id").cast("int").alias("month")))
        ledger.mark(spark, ledger_path, "gold", keys, seen=seen)
    return paths
