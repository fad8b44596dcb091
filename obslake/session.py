"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "obslake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and zstd Parquet.

    Shuffle partitions are left to the cluster's setting; adaptive execution
    merges them when they turn out small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # the JVM leaves larger methods uncompiled, so wide projections must not become one
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.streaming.schemaInference": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session on one machine without the setting (a test) gets a temporary folder of its
    own; on a cluster, executors would write to their own disks, so it has to be set there.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if context.getCheckpointDir() is None:
        if not folder and not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} is unset: name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="obslake-"))
    return (folder or context.getCheckpointDir()).rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Cuts the plan at a reliable checkpoint, so that all later uses see the same rows."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows as a Parquet table in the shared folder and reads them back.

    For rows that several branches read: the source is parsed once, and each
    branch then reads only its own columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def staged_for(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A staged table that is removed when the job that reads it is over, failed or not."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.parquet(path)
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
