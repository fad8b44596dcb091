"""Values made ready for people and for JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Byte units, each 1024 times the one before.
BYTE_UNITS = ["o", "Ko", "Mo", "Go", "To"]


def finite(value: Column) -> Column:
    """The value, or NULL for NaN and the infinities."""
    return F.when(F.abs(value) < float("inf"), value)


def clean_values(df: DataFrame) -> DataFrame:
    """Every column made safe for JSON: finite doubles with three decimals, dates as text."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(finite(col.cast("double")), 3)
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            col = F.round(col.cast("double"), 3)
        out.append(col.alias(field.name))
    return df.select(*out)


def number_text(value: Column, digits: int = 1, missing: str = "N/A") -> Column:
    """Number with fixed decimals, or the text for a missing one."""
    text = F.format_string(f"%.{digits}f", value)
    return F.when(value.isNull() | F.isnan(value), missing).otherwise(text)


def byte_size(value: Column) -> Column:
    """Byte count with a unit; ``-`` when missing."""
    last = len(BYTE_UNITS) - 1
    out = F.when(value.isNull(), "-").when(value < 1024, F.format_string("%d o", value.cast("long")))
    for power, unit in enumerate(BYTE_UNITS[1:], start=1):
        text = F.format_string(f"%.1f {unit}", value.cast("double") / float(1024**power))
        out = out.otherwise(text) if power == last else out.when(value < 1024 ** (power + 1), text)
    return out
