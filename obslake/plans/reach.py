"""Which years' windows look into other years, from the rows that a series has per year.

Counts are rows of ``station_id`` (the series), ``year`` and ``n``. Lists of years are bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows before a row that its indicators look at
LOOK_BACK = 6


def _per_station(counts: DataFrame) -> DataFrame:
    """Rows per year of each station as one row; its years are bounded by the calendar."""
    years = F.array_sort(F.collect_list(F.struct("year", "n")))
    return counts.groupBy("station_id").agg(years.alias("years"))


def _between(after: Column, before: Column) -> Column:
    """The station's rows in the years between two years."""
    inside = F.filter("years", lambda y: (y["year"] > after) & (y["year"] < before))
    return F.aggregate(inside, F.lit(0).cast("long"), lambda total, y: total + y["n"])


def _years(values: list[int]) -> Column:
    return F.array(*[F.lit(value) for value in values]).cast("array<int>")


def years_behind(counts: DataFrame, given: list[int], look_back: int = LOOK_BACK) -> DataFrame:
    """``year`` of the other years whose indicators look back into the given ones.

    Of the given years before a year only the last one matters: it has the fewest rows in between.
    """
    last = F.array_max(F.filter(_years(given), lambda g: g < F.col("year")))
    rows = _per_station(counts).select("years", F.explode("years.year").alias("year"))
    near = last.isNotNull() & (_between(last, F.col("year")) < look_back)
    return rows.where(~F.array_contains(_years(given), F.col("year")) & near).select("year").distinct()


def years_before(counts: DataFrame, written: list[int], look_back: int = LOOK_BACK) -> DataFrame:
    """``station_id`` and ``year`` of the other years that hold the rows before a station's written years."""
    rows = _per_station(counts).select("station_id", "years", F.explode("years.year").alias("year"))
    own = F.transform(F.filter("years", lambda y: F.array_contains(_years(written), y["year"])), lambda y: y["year"])
    next_ = F.array_min(F.filter(own, lambda w: w > F.col("year")))
    needed = next_.isNotNull() & (_between(F.col("year"), next_) < look_back)
    return rows.where(~F.array_contains(_years(written), F.col("year")) & needed).select("station_id", "year")
