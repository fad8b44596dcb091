"""Registration and the common output form of both engines."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}

# Both engines add this before rounding, so that values exactly between two
# roundings do not depend on the order of a sum.
NUDGE = 1e-9


def _fields(shape: str) -> list[tuple[str, str]]:
    return [tuple(item.split(":")) for item in shape.split()]


def to_output(df: DataFrame, shape: str) -> DataFrame:
    """Days as text, times as microseconds, numbers as long or as rounded double."""
    kinds = {
        "d": lambda c: F.date_format(c.cast("date"), "yyyy-MM-dd"),
        "t": lambda c: F.unix_micros(c),
        "l": lambda c: c.cast("long"),
        "f": lambda c: F.round(c.cast("double") + NUDGE, 6) + F.lit(0.0),
        "s": lambda c: c.cast("string"),
        "b": lambda c: c.cast("boolean"),
    }
    return df.select(*[kinds[kind](F.col(name)).alias(name) for name, kind in _fields(shape)])


def to_output_sql(body: str, shape: str, ctes: str = "") -> str:
    kinds = {
        "d": 'CAST(CAST("{0}" AS DATE) AS VARCHAR)',
        "t": 'epoch_us("{0}")',
        "l": 'CAST("{0}" AS BIGINT)',
        "f": 'round(CAST("{0}" AS DOUBLE) + 1e-9, 6) + 0.0',
        "s": 'CAST("{0}" AS VARCHAR)',
        "b": 'CAST("{0}" AS BOOLEAN)',
    }
    cols = ", ".join(f'{kinds[kind].format(name)} AS "{name}"' for name, kind in _fields(shape))
    return f"{ctes} SELECT {cols} FROM ({body}) AS q"


def query(name: str, shape: str, body: str | None = None, ctes: str = ""):
    """Registers a function (spark, folder) -> DataFrame under ``name``."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_output(fn(spark, sf_dir), shape)

        sql = None if body is None else to_output_sql(body, shape, ctes)
        QUERIES[name] = Query(run, sql)
        return fn

    return register
