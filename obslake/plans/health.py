"""Completeness of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.formats import byte_size
from obslake.schemas import HEALTH
from obslake.sources.readers import path_exists
from obslake.sources.storage import has_marker, storage_size

# Verdict texts.
OK, EMPTY, ABSENT, UNMARKED, IGNORED = "OK", "VIDE", "ABSENT", "SANS _SUCCESS", "IGNORÉ"


def expected_tables(
    spark: SparkSession, root: str, stream_may_be_empty: bool = False, with_forecasts: bool = False
) -> DataFrame:
    """What a complete lake holds; forecasts and bulletins only on request."""
    live, extra = not stream_may_be_empty, with_forecasts
    # Layer, path below the root, required, needs a marker, needs data.
    expected = [
        ("BRONZE", "bronze/meteo/batch/source=meteofrance", True, True, True),
        ("BRONZE", "bronze/meteo/stream/source=openmeteo", live, live, live),
        ("SILVER", "silver/meteo", True, True, True),
        ("GOLD", "gold/meteo/daily_aggregates", True, True, True),
        ("GOLD", "gold/meteo/weekly_trends", True, True, True),
        ("GOLD", "gold/meteo/extreme_events", True, True, True),
        ("GOLD", "gold/meteo/climate_profile", True, True, True),
        ("GOLD", "gold/meteo/ml_predictions", extra, extra, extra),
        ("GOLD", "gold/meteo/ai_insights", extra, False, extra),
    ]
    rows = [(layer, f"{root}/{path}", *flags) for layer, path, *flags in expected]
    return spark.createDataFrame(rows, HEALTH)


def verdict() -> Column:
    """State of a table row with ``exists``, ``has_success`` and ``bytes``."""
    return (
        F.when(~F.col("exists") & F.col("required"), ABSENT)
        .when(~F.col("exists"), IGNORED)
        .when(F.col("expect_success") & ~F.col("has_success"), UNMARKED)
        .when(F.col("expect_data") & (F.coalesce("bytes", F.lit(0)) == 0), EMPTY)
        .otherwise(OK)
    )


def judged(checks: DataFrame) -> DataFrame:
    """Adds the verdict and whether it fails the run; an optional table never does."""
    return checks.withColumn("verdict", verdict()).withColumn(
        "failure", F.col("required") & (F.col("verdict") != OK)
    )


def table_health(spark: SparkSession, expected: DataFrame) -> DataFrame:
    """Expected tables with their size, marker and verdict.

    The expected tables are a fixed short list, so their paths may be read here.
    """
    paths = [row["path"] for row in expected.select("path").collect()]
    marked = []
    for path in paths:
        marked.append((path, path_exists(spark, path), has_marker(spark, path)))
    found = spark.createDataFrame(marked, "path string, exists boolean, has_success boolean")
    sizes = storage_size(spark, paths)
    joined = expected.join(found, "path", "left").join(sizes, "path", "left")
    return judged(joined.withColumn("bytes", F.coalesce("bytes", F.lit(0))))


def health_report(health: DataFrame) -> DataFrame:
    """One row: number of failures and whether all is well."""
    return health.agg(
        F.count(F.lit(1)).alias("tables"), F.count_if("failure").alias("failures")
    ).withColumn("passed", F.col("failures") == 0)


def report_lines(health: DataFrame) -> DataFrame:
    """The report as aligned text lines."""
    # Column widths of the text report.
    line = F.format_string(
        "%-7s %-45s %10s  %s", "layer", "path", byte_size(F.col("bytes")), "verdict"
    )
    return health.select("path", line.alias("line"))
