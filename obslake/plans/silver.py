"""Raw inputs to one table of unified observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.text import city_name, parse_date, parse_number, station_id
from obslake.functions.weather import mean_temperature
from obslake.operators.dedup import dedup_observations, known_stations, unknown_stations
from obslake.operators.filters import date_range, optional, partitions, require_columns, with_time
from obslake.operators.joins import union_all
from obslake.operators.windows import trailing_indicators
from obslake.plans import ledger
from obslake.plans.reach import years_behind
from obslake.schemas import (
    ARCHIVE_REQUIRED, FEED_REQUIRED, INDICATORS, OBSERVATION, OBSERVATION_COLUMNS,
)
from obslake.session import settle, staged_for
from obslake.sources.readers import read_archives, read_feed
from obslake.sources.sinks import write_partitions, write_table


#: the file that a row was read from and the id that its sender gave it, where they are asked for
FILE, MESSAGE_ID = "file", "message_id"


def unify(df: DataFrame, columns: dict) -> DataFrame:
    """The observation columns in their order and types; those not given are NULL. A row's file and message id stay with it."""
    kinds = {f.name: f.dataType for f in OBSERVATION.fields}
    return df.select(
        *[columns.get(name, F.lit(None)).cast(kinds[name]).alias(name) for name in OBSERVATION_COLUMNS],
        *[name for name in (FILE, MESSAGE_ID) if name in df.columns],
    )


def normalise_archive(raw: DataFrame) -> DataFrame:
    """Archive rows, all text, as unified observations."""
    require_columns(raw, ARCHIVE_REQUIRED)
    numbers = {
        "latitude": F.col("LAT"),
        "longitude": F.col("LON"),
        "elevation": F.col("ALTI"),
        "precipitation": F.col("RR"),
        "wind_speed": optional(raw, "FFM"),
        "snow": optional(raw, "NEIGETOT"),
        "mean": optional(raw, "TM"),
        "low": F.col("TN"),
        "high": F.col("TX"),
    }
    parsed = raw.select(
        "NUM_POSTE",
        "NOM_USUEL",
        parse_date(F.col("AAAAMMJJ")).alias("day"),
        *[parse_number(col).alias(name) for name, col in numbers.items()],
        *[name for name in (FILE,) if name in raw.columns],
    )
    measured = [n for n in numbers if n not in ("mean", "low", "high")]
    return unify(
        parsed,
        {
            "station_id": station_id(F.col("NUM_POSTE")),
            "station_name": F.col("NOM_USUEL"),
            "city": city_name(F.col("NOM_USUEL")),
            "country": F.lit("FR"),
            "timestamp": F.col("day"),
            "dt": F.col("day"),
            "temperature": mean_temperature(F.col("mean"), F.col("low"), F.col("high")),
            "source": F.lit("METEOFRANCE"),
            **{name: F.col(name) for name in measured},
        },
    )


def normalise_feed(messages: DataFrame) -> DataFrame:
    """Feed messages as unified observations; no elevation or snow is known."""
    require_columns(messages, FEED_REQUIRED)
    at = F.try_to_timestamp("timestamp")
    return unify(
        messages,
        {
            "station_id": F.concat(F.lit("OPENMETEO_"), F.upper("city")),
            "station_name": F.col("city"),
            "city": F.col("city"),
            "country": F.lit("FR"),
            "latitude": F.col("latitude"),
            "longitude": F.col("longitude"),
            "timestamp": at,
            "dt": at.cast("date"),
            "temperature": F.col("temperature"),
            "precipitation": F.col("precipitation"),
            "wind_speed": F.col("windspeed"),
            "source": F.lit("OPENMETEO"),
        },
    )


def build_silver(
    frames: list[DataFrame | None],
    start: str | None = None,
    end: str | None = None,
    days: float | None = None,
) -> DataFrame | None:
    """Unified frames to deduplicated observations with indicators.

    Copies are removed within each task before they travel. The first day is applied last, so that the windows of
    the first days still see the rows before them. No window looks ahead, so rows whose day and time are both after the last
    day go before they are parsed in full.
    """
    union = union_all(frames)
    if union is None:
        return None
    rows = known_stations(with_time(union))
    if end:
        last = F.lit(end).cast("date")
        rows = rows.where((F.col("dt") <= last) | (F.col("timestamp").cast("date") <= last))
    return date_range(trailing_indicators(dedup_observations(rows), days=days, sample=rows), start, end)


def read_inputs(
    spark: SparkSession, archive_path: str | None, feed_path: str | None
) -> list[DataFrame | None]:
    """The unified frames of those inputs that exist."""
    raw = read_archives(spark, archive_path) if archive_path else None
    messages = read_feed(spark, feed_path) if feed_path else None
    return [
        normalise_archive(raw) if raw is not None else None,
        normalise_feed(messages) if messages is not None else None,
    ]


def write_silver(
    spark: SparkSession,
    frames: list[DataFrame | None],
    path: str,
    ledger_path: str,
    start: str | None = None,
    end: str | None = None,
    only_new: bool = False,
    changed_at: DataFrame | None = None,
    quarantine_path: str | None = None,
    journal_path: str | None = None,
) -> DataFrame | None:
    """Builds and writes the table by year and marks the years in the ledger.

    The unified rows are staged first, so compressed archives are parsed once; the list of years is then a
    narrow scan. ``start`` and ``end`` choose years, which are always written whole. With ``only_new`` a
    year is written when it has no ledger row, when ``changed_at`` (key, changed_at) or the live feed's hours in
    the same ledger are newer than the start of the run that wrote it, or when its indicators look back
    into such a year. Rows without a station go to ``quarantine_path`` with a reason.
    """
    seen = ledger.now()
    union = union_all(frames)
    if union is None:
        return None
    with (
        ledger.journaled(spark, journal_path, "silver") as counters,
        staged_for(with_time(union), "unified") as everything,
    ):
        rows = known_stations(everything)
        bounds = [F.year(F.lit(day).cast("date")) for day in (start, end)]
        wanted = rows.select("dt")
        if start:
            wanted = wanted.where(F.year("dt") >= bounds[0])
        if end:
            wanted = wanted.where(F.year("dt") <= bounds[1])
        years = wanted.select(F.year("dt").cast("string").alias("key")).where("key IS NOT NULL").distinct()
        written = years
        if only_new:
            book = ledger.read_ledger(spark, ledger_path)
            moved = ledger.feed_changes(book)
            if changed_at is not None:
                moved = moved.unionByName(changed_at.select(F.col("key").cast("string").alias("key"), "changed_at"))
            moved = moved.groupBy("key").agg(F.max("changed_at").alias("changed_at"))
            years = settle(ledger.pending(years, book, "silver", moved))
            known = ledger.done_keys(book, "silver").select("key")
            counts = rows.groupBy("station_id", F.year("dt").alias("year")).agg(F.count("*").alias("n"))
            given = [int(row["key"]) for row in years.collect()]  # bounded by the calendar
            behind = years_behind(counts, given).select(F.col("year").cast("string").alias("key"))
            reached = behind.join(known, "key", "left_semi")
            written = years.unionByName(reached).distinct()
        written = settle(written)
        silver = build_silver([rows]).withColumn("year", F.year("dt"))
        silver = partitions(silver, "year", written.select(F.col("key").cast("int").alias("year")), few=True)
        write_partitions(silver.select(*OBSERVATION_COLUMNS, *INDICATORS, "year"), path, ["year"])
        if quarantine_path:
            write_table(unknown_stations(everything), quarantine_path)
        ledger.mark(spark, ledger_path, "silver", written, seen=seen)
        counters["years"] = written.count()
    return written
