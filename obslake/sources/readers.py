"""Scans of archives, feed files and Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.functions.text import parse_date
from obslake.operators.filters import date_range, present
from obslake.schemas import FEED_MESSAGE
from obslake.sources import versions


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or a glob names anything."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def read_archives(spark: SparkSession, path: str, spread: bool = True) -> DataFrame | None:
    """Semicolon CSV archives (gzip allowed), every column as text; None if there are none.

    A gzip file is one task when read, so its rows are spread before the
    parsing; adaptive execution picks the number of tasks.
    """
    if not path_exists(spark, path):
        return None
    rows = (
        spark.read.option("header", True).option("sep", ";").option("inferSchema", False)
        .option("recursiveFileLookup", False).csv(path)
    )
    return rows.hint("rebalance") if spread else rows


def read_archive_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The named archives and no others; each row with its ``file``."""
    rows = spark.read.option("header", True).option("sep", ";").option("inferSchema", False).csv(paths)
    return rows.select("*", F.col("_metadata.file_path").alias("file")).hint("rebalance")


def read_feed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The messages of the named feed files and no others; each with its ``file``."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"))
    return lines.select(F.from_json("value", FEED_MESSAGE).alias("m"), "file").select("m.*", "file")


def archive_changes(spark: SparkSession, path: str) -> DataFrame | None:
    """When the archive files of each year last changed: ``key`` (the year), ``changed_at``."""
    raw = read_archives(spark, path, spread=False)
    if raw is None:
        return None
    rows = raw.select(
        F.year(parse_date(F.col("AAAAMMJJ"))).cast("string").alias("key"),
        F.col("_metadata.file_modification_time").alias("at"),
    )
    return rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("at").alias("changed_at"))


def read_feed(spark: SparkSession, path: str, complete: DataFrame | None = None) -> DataFrame | None:
    """Feed messages, one JSON object per line, below an hour tree; None if there are none.

    The tree is read whatever the extension of its files. With ``complete``
    (ledger keys ``year/month/day/hour``) only those hours are read.
    """
    if versions.is_versioned(spark, path):
        lines = read_table(spark, path)
        if lines is None:
            return None
        lines = lines.withColumnRenamed("json_value", "value")
    elif path_exists(spark, path):
        lines = spark.read.text(path)
    else:
        return None
    if complete is not None:
        parts = [F.col(name).cast("int") for name in ("year", "month", "day", "hour")]
        hours = F.broadcast(complete.select("key").distinct())  # bounded by the calendar
        keyed = lines.withColumn("key", F.format_string("%04d/%02d/%02d/%02d", *parts))
        lines = keyed.join(hours, "key", "left_semi")
    return lines.select(F.from_json("value", FEED_MESSAGE).alias("m")).select("m.*")


def read_table(
    spark: SparkSession, path: str, columns: list[str] | None = None
) -> DataFrame | None:
    """A Parquet table with its partition columns; None if absent or still empty.

    Below a root with pointers, the live folders of the table.
    """
    if versions.is_versioned(spark, path):
        table = versions.read_version(spark, path)
        return table if table is None or columns is None else present(table, columns)
    if not path_exists(spark, path):
        return None
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without any data file yet
            return None
        raise
    return table if columns is None else present(table, columns)


def read_gold(
    spark: SparkSession,
    path: str,
    date_from: str | None = None,
    date_to: str | None = None,
    columns: list[str] | None = None,
) -> DataFrame | None:
    """A derived table, limited to days when a bound is given.

    Unreadable days are dropped only then; a table without days comes whole.
    """
    table = read_table(spark, path)
    if table is None:
        return None
    if "dt" in table.columns and (date_from or date_to):
        table = date_range(_with_days(table), date_from, date_to)
    return table if columns is None else present(table, columns)


def _with_days(table: DataFrame) -> DataFrame:
    """Rows with a readable day, as a date."""
    if isinstance(table.schema["dt"].dataType, T.StringType):
        table = table.withColumn("dt", F.col("dt").try_cast("date"))
    return table.where(F.col("dt").isNotNull())


def recent_table(spark: SparkSession, path: str, days: int) -> DataFrame | None:
    """The last ``days`` days before today of a derived table."""
    table = read_table(spark, path)
    if table is None or "dt" not in table.columns:
        return table
    return _with_days(table).where(F.col("dt") >= F.date_sub(F.current_date(), days))


def read_partitioned(
    spark: SparkSession, path: str, partition: str | None = None, columns: list[str] | None = None
) -> DataFrame | None:
    """A table with a projection that keeps the partition column restored from the path."""
    wanted = None if columns is None else [*columns, *([partition] if partition else [])]
    return read_table(spark, path, wanted)


def latest_document(documents: DataFrame) -> DataFrame:
    """The document of the newest day, all parts of it."""
    return documents.where(F.col("dt") == documents.select(F.max("dt")).scalar())


#: bytes of a compressed file that a task parses at least
SPREAD_BYTES = 1 << 18


def read_spread(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A Parquet table whose rows are dealt by ``key`` to four tasks a core at most, before costly columns are made of them.

    A scan has no more tasks than row groups, so a small file of many rows would be parsed by one. Tables too small for
    two tasks stay as they are.
    """
    rows = spark.read.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    length = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    tasks = min(4 * spark.sparkContext.defaultParallelism, length // SPREAD_BYTES)
    return rows.repartition(tasks, key) if tasks > 1 else rows
