"""Partitioned writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.sources import versions
from obslake.sources.readers import path_exists, read_table
from obslake.sources.storage import storage_size

ZSTD_LEVEL = "3"
ROWS_PER_FILE = 20_000_000


def write_partitions(
    df: DataFrame, path: str, columns: list[str], rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Replaces only the partitions present in ``df``.

    The rebalance hint brings rows of a partition together, splits a large
    partition over several tasks and merges small ones, by size at run time.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .partitionBy(*columns)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def drop_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Removes whole partitions, as those that no row is left for."""
    for value in values:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def write_table(df: DataFrame, path: str) -> None:
    """Replaces a table that has no partitions."""
    df.hint("rebalance").write.mode("overwrite").option("compression", "zstd").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Adds rows to a table; below a root with pointers, as one commit."""
    if versions.is_versioned(df.sparkSession, path):
        root, table = versions.split(path)
        with versions.Change(df.sparkSession, root) as change:
            change.append(table, df)
        return
    df.write.mode("append").option("compression", "zstd").parquet(path)


def append_text(df: DataFrame, path: str, columns: list[str]) -> None:
    """Appends raw text lines below their partition folders."""
    df.hint("rebalance", *columns).write.mode("append").partitionBy(*columns).text(path)


def write_json(df: DataFrame, path: str) -> None:
    """One compact JSON object per line."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def compact_table(
    spark: SparkSession, path: str, target: str, columns: list[str]
) -> DataFrame | None:
    """Rewrites a table with larger zstd files at ``target``; sizes before and after.

    The source stays as it is until the caller points readers to the new
    path, so a lost executor or a failed job leaves a readable table.
    """
    table = read_table(spark, path)
    if table is None:
        return None
    if path_exists(spark, target):
        raise ValueError(f"target exists already: {target}")
    write_partitions(table, target, columns)
    after = storage_size(spark, [target]).select("bytes").scalar()
    return storage_size(spark, [path]).select(
        F.col("path").alias("source"), F.lit(target).alias("target"),
        F.col("bytes").alias("bytes_before"), after.alias("bytes_after"),
    )
