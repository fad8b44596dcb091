"""Incremental observation table, driven by files: only new, changed and vanished ones cause work.

Tables below one versioned root, changed together by one commit:

- ``files``: what each file held when it was read (size, time, years, rows); the newest entry of a file counts
- ``silver``: the observations with their indicators, by year, each with the file it came from
- ``copies``: rows that lost against a copy in another file, by year
- ``quarantine``: rows without a station, by year, with a reason
- ``stations``: rows per station and year

A run lists the files and compares sizes and times with ``files``: without a difference it ends there. Otherwise it
opens only the new and changed files. ``silver`` and ``copies`` together hold every row that may ever
survive, so the rows of other files come from there, and a file that changes or goes takes its rows along and brings back the
copies that they had beaten. Only years of such files are deduplicated anew. The rows before a year, which its first
indicators look at, come from the written table; ``stations`` says in which years they lie and which later years look
back into a changed one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake.operators.dedup import OBSERVATION_KEY, fullest_first, keep_first, known_stations, unknown_stations
from obslake.operators.filters import with_time
from obslake.operators.joins import union_all
from obslake.operators.windows import trailing_indicators
from obslake.plans import ledger
from obslake.plans.reach import years_before, years_behind
from obslake.plans.silver import FILE, normalise_archive, normalise_feed
from obslake.schemas import INDICATORS, OBSERVATION_COLUMNS
from obslake.session import staged_for
from obslake.sources import versions
from obslake.sources.readers import read_archive_files, read_feed_files, read_table
from obslake.sources.storage import file_states

SILVER, COPIES, QUARANTINE, STATIONS, FILES = "silver", "copies", "quarantine", "stations", "files"
ARCHIVE, FEED = "archive", "feed"
READ, GONE = "read", "gone"
FILE_ENTRY = "kind string, file string, length long, modified timestamp, year int, rows long, action string, at timestamp"
#: appended entries of ``files`` after which they are compacted
FILE_COMMITS = 20


def current_files(entries: DataFrame) -> DataFrame:
    """The newest entries of each file that is not gone: one row per year it holds, year NULL without rows."""
    newest = Window.partitionBy(FILE)
    rows = entries.withColumn("_newest", F.max("at").over(newest))
    return rows.where((F.col("at") == F.col("_newest")) & (F.col("action") == READ)).drop("_newest")


def newest_entries(entries: DataFrame) -> DataFrame:
    """What ``files`` can do with: the current entries."""
    return current_files(entries).select(*entries.columns)


def file_differences(listed: DataFrame, known: DataFrame) -> DataFrame:
    """``file``, ``kind``, ``path``, ``length``, ``modified`` and ``change``: ``new``, ``changed`` or ``gone``."""
    held = known.select(FILE, F.col("kind").alias("_kind"), F.col("length").alias("_length"), F.col("modified").alias("_modified")).distinct()
    both = listed.join(held, FILE, "full_outer")
    unlike = (F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified"))
    change = F.when(F.col("path").isNull(), GONE).when(F.col("_kind").isNull(), "new").when(unlike, "changed")
    return both.select(
        FILE, F.coalesce("kind", "_kind").alias("kind"), "path", "length", "modified", change.alias("change")
    ).where("change IS NOT NULL")


def _listed(spark: SparkSession, archive_path: str | None, feed_path: str | None) -> DataFrame:
    found = [
        states.withColumn("kind", F.lit(kind))
        for kind, path in ((ARCHIVE, archive_path), (FEED, feed_path))
        if (states := file_states(spark, path)) is not None
    ]
    return union_all(found) if found else spark.createDataFrame([], "file string, path string, length long, modified timestamp, kind string")


def _parsed(spark: SparkSession, paths: dict[str, list[str]]) -> DataFrame | None:
    """Unified rows of the named files."""
    archive, feed = paths[ARCHIVE], paths[FEED]
    return union_all([
        normalise_archive(read_archive_files(spark, archive)) if archive else None,
        normalise_feed(read_feed_files(spark, feed)) if feed else None,
    ])


def refresh_silver(
    spark: SparkSession,
    archive_path: str | None,
    feed_path: str | None,
    root: str,
    ledger_path: str,
    journal_path: str | None = None,
) -> list[int]:
    """Brings the tables below ``root`` up to date with the files; returns the years written.

    The result is that of a full build over the files that are there now.
    """
    seen = ledger.now()
    versions.create_root(spark, root)
    table = {name: f"{root}/{name}" for name in (SILVER, COPIES, QUARANTINE, STATIONS, FILES)}
    entries = read_table(spark, table[FILES])
    known = current_files(spark.createDataFrame([], FILE_ENTRY) if entries is None else entries)
    found = file_differences(_listed(spark, archive_path, feed_path), known)
    with ledger.journaled(spark, journal_path, SILVER) as counters:
        # one row per file of the run, as Spark's own listing of a scan has
        changes = found.collect()
        counters["files"] = len(changes)
        if not changes:
            counters["years"] = 0
            return []
        touched = spark.createDataFrame([(row[FILE],) for row in changes if row["change"] != "new"], "file string")
        old_years = known.join(touched, FILE, "left_semi").select("year").distinct()
        paths = {kind: [r["path"] for r in changes if r["kind"] == kind and r["change"] != GONE] for kind in (ARCHIVE, FEED)}
        parsed = _parsed(spark, paths)
        if parsed is None:
            parsed = spark.createDataFrame([], _silver_schema(spark, table[SILVER])).drop(*INDICATORS, "year")
        with staged_for(with_time(parsed).withColumn("year", F.year("dt")), "parsed") as fresh:
            years = {r["year"] for r in fresh.select("year").distinct().collect()} | {r["year"] for r in old_years.collect()}
            written = _rewrite(spark, root, table, fresh, touched, sorted(years - {None}), changes, seen, counters)
        keys = spark.createDataFrame([(str(year),) for year in written], "key string")
        ledger.mark(spark, ledger_path, SILVER, keys, seen=seen)
        if len(versions.live_folders(spark, table[FILES])) > FILE_COMMITS:
            versions.compact(spark, table[FILES], transform=newest_entries)
        versions.expire(spark, root)
    return written


def _silver_schema(spark: SparkSession, path: str):
    return read_table(spark, path).schema


def _rewrite(spark, root, table, fresh, touched, years, changes, seen, counters) -> list[int]:
    partitions = {f"year={year}" for year in years}

    def held(name: str) -> DataFrame | None:
        """The rows of the years that came from files which are as they were."""
        rows = versions.read_version(spark, table[name], partitions)
        return None if rows is None else rows.join(touched, FILE, "left_anti")

    old = [rows.drop(*INDICATORS) for name in (SILVER, COPIES) if (rows := held(name)) is not None]
    columns = [*OBSERVATION_COLUMNS, FILE, "year"]
    visible = fullest_first(OBSERVATION_COLUMNS)
    # within a file only its best row of a key can ever survive, so copies inside a file do not travel
    own = keep_first(known_stations(fresh), [*OBSERVATION_KEY, FILE], visible)
    order = Window.partitionBy(*OBSERVATION_KEY).orderBy(*visible, FILE)
    ranked = union_all([rows.select(*columns) for rows in (own, *old)]).withColumn("_n", F.row_number().over(order))
    with staged_for(ranked, "ranked") as rows:
        best = rows.where("_n = 1").drop("_n")
        counts = best.groupBy("station_id", "year").agg(F.count("*").alias("n"))
        others = read_table(spark, table[STATIONS])
        if others is not None:
            others = others.where(~F.col("year").isin(years)).select("station_id", "year", "n")
        all_counts = union_all([counts, others])
        behind = [r["year"] for r in years_behind(all_counts, years).collect()]  # bounded by the calendar
        written = sorted({*years, *behind})
        before = years_before(all_counts, written)
        needed = {f"year={r['year']}" for r in before.select("year").distinct().collect()}
        parts = [best, versions.read_version(spark, table[SILVER], {f"year={year}" for year in behind})]
        if needed:
            parts.append(versions.read_version(spark, table[SILVER], needed).join(before, ["station_id", "year"], "left_semi"))
        series = union_all([part.select(*columns) for part in parts if part is not None])
        silver = trailing_indicators(series).where(F.col("year").isin(written))
        unnamed = [unknown_stations(fresh).select(*columns, "reason")]
        if (aside := held(QUARANTINE)) is not None:
            unnamed.append(aside.select(*columns, "reason"))
        with versions.Change(spark, root) as change:
            change.replace(SILVER, silver.select(*OBSERVATION_COLUMNS, *INDICATORS, FILE, "year"), ["year"], partitions)
            change.replace(COPIES, rows.where("_n > 1").drop("_n"), ["year"], partitions)
            change.replace(QUARANTINE, union_all(unnamed), ["year"], partitions)
            change.replace(STATIONS, counts, ["year"], partitions)
            change.append(FILES, _entries(spark, fresh, changes, seen))
        counters["years"] = len(written)
    return written


def _entries(spark: SparkSession, fresh: DataFrame, changes: list, seen) -> DataFrame:
    """What the run found in its files."""
    rows = [(r["kind"], r[FILE], r["length"], r["modified"], GONE if r["change"] == GONE else READ) for r in changes]
    files = spark.createDataFrame(rows, "kind string, file string, length long, modified timestamp, action string")
    held = fresh.groupBy(FILE, "year").agg(F.count("*").alias("rows"))
    return files.join(held, FILE, "left").select(
        "kind", FILE, "length", "modified", "year", F.coalesce("rows", F.lit(0)).alias("rows"), "action",
        F.lit(seen).cast("timestamp").alias("at"),
    )


def read_silver(spark: SparkSession, root: str) -> DataFrame | None:
    """The observations without their files."""
    rows = read_table(spark, f"{root}/{SILVER}")
    return None if rows is None else rows.drop(FILE)
