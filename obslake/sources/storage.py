"""File sizes, manifests and completeness of table partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.text import department_code, path_value
from obslake.sources.readers import path_exists

# Layout of the archive file names and of their address.
ARCHIVE_FILE = "Q_%s_%s_RR-T-Vent.csv.gz"
ARCHIVE_FILE_PATTERN = r"Q_([^_]+)_([^_]+)_RR-T-Vent\.csv\.gz$"
PERIOD_PREVIOUS, PERIOD_LATEST = "previous-1950-2024", "latest-2025-2026"
LATEST_FIRST_YEAR = 2025


def files(spark: SparkSession, path: str) -> DataFrame:
    """Path, length and modification time of every data file below ``path``; contents unread."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def file_states(spark: SparkSession, path: str | None) -> DataFrame | None:
    """``file`` (as rows name it), ``path``, ``length`` and ``modified`` of every data file; contents unread."""
    if not path or not path_exists(spark, path):
        return None
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(F.col("_metadata.file_path").alias("file"), "path", "length", F.col("modificationTime").alias("modified"))


def storage_size(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Bytes per existing path; an absent path has no row."""
    found = [p for p in paths if path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], "path string, bytes long")
    sizes = [
        files(spark, p).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        .select(F.lit(p).alias("path"), "bytes")
        for p in found
    ]
    out = sizes[0]
    for more in sizes[1:]:
        out = out.unionByName(more)
    return out


def quota_reached(size: Column, quota: int) -> Column:
    """Whether the size has reached the quota; a quota of 0 or less is off."""
    return F.lit(quota > 0) & (size >= quota)


def archive_file(department: Column, period: Column) -> Column:
    return F.format_string(ARCHIVE_FILE, department_code(department), period)


def batch_names(units: DataFrame, base_url: str, root: str, day: str) -> DataFrame:
    """Key, file, address and target path of each (department, period) unit."""
    file, at = archive_file(F.col("department"), F.col("period")), F.lit(day).cast("date")
    part = F.format_string("year=%s/month=%s", F.date_format(at, "yyyy"), F.date_format(at, "MM"))
    return units.select(
        department_code(F.col("department")).alias("department"),
        "period",
        F.concat_ws(":", department_code(F.col("department")), "period").alias("key"),
        file.alias("file"),
        F.concat_ws("/", F.lit(base_url.rstrip("/")), file).alias("source_url"),
        part.alias("partition"),
        F.concat_ws("/", F.lit(root), part, file).alias("target"),
    )


def periods_for_years(start: Column, end: Column) -> Column:
    """The archive periods that cover the years; a reversed range raises when read."""
    periods = F.array_compact(
        F.array(
            F.when(start < LATEST_FIRST_YEAR, PERIOD_PREVIOUS),
            F.when(end >= LATEST_FIRST_YEAR, PERIOD_LATEST),
        )
    )
    return F.when(end >= start, periods).otherwise(
        F.raise_error(F.lit("the last year is before the first")).cast("array<string>")
    )


def manifest(listed: DataFrame, base_url: str) -> DataFrame:
    """One row per archive file: what it holds, its size, address and partition."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return listed.select(
        F.regexp_extract(name, ARCHIVE_FILE_PATTERN, 1).alias("department"),
        F.regexp_extract(name, ARCHIVE_FILE_PATTERN, 2).alias("period"),
        name.alias("file"),
        F.col("length").alias("bytes"),
        F.concat_ws("/", F.lit(base_url.rstrip("/")), name).alias("source_url"),
        F.concat_ws(
            "/",
            F.concat(F.lit("year="), path_value(F.col("path"), "year")),
            F.concat(F.lit("month="), path_value(F.col("path"), "month")),
        ).alias("partition"),
        F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("ingested_at"),
    ).where(F.col("department") != "")


def complete_partitions(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Partition values of a foreign table that carry a ``_SUCCESS`` marker.

    Spark's own listing hides such names, so the markers come from one glob
    call; there is one per partition.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}=*/_SUCCESS")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    rows = [(str(status.getPath()),) for status in (found or [])]
    marks = spark.createDataFrame(rows, "path string")
    return marks.select(path_value(F.col("path"), column).alias(column)).where(
        F.col(column).isNotNull()
    )


def has_marker(spark: SparkSession, path: str, name: str = "_SUCCESS") -> bool:
    """Whether a marker file lies anywhere below a path."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(top):
        return False
    files = system.listFiles(top, True)
    while files.hasNext():
        if files.next().getPath().getName() == name:
            return True
    return False
