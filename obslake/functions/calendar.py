"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season names by month; the accent of summer is a parameter.
SEASONS = {"hiver": [12, 1, 2], "printemps": [3, 4, 5], "ete": [6, 7, 8], "automne": [9, 10, 11]}
# Short month names of the French locale.
SHORT_MONTHS = [
    "janv.", "févr.", "mars", "avr.", "mai", "juin",
    "juil.", "août", "sept.", "oct.", "nov.", "déc.",
]


def season_of_month(month: Column, summer: str = "ete") -> Column:
    """Season of a month number (or its text); anything else gives an empty text."""
    number = month.try_cast("int")
    out = F.lit("")
    for name, months in SEASONS.items():
        out = F.when(number.isin(months), F.lit(summer if name == "ete" else name)).otherwise(out)
    return out


def calendar_parts(day: Column) -> dict[str, Column]:
    """Year, ISO week, month, day of year, weekday (Monday = 0) and weekend flag."""
    weekday = F.weekday(day)
    return {
        "year": F.year(day),
        "week": F.weekofyear(day),
        "month": F.month(day),
        "dayofyear": F.dayofyear(day),
        "dayofweek": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
    }


def iso_year(day: Column) -> Column:
    """The year the ISO week of ``day`` belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def hour_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month, day and hour texts of a timestamp."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(ts, pattern) for name, pattern in patterns.items()}


def hour_dir(hour: Column, root: str) -> Column:
    """Directory of an hour given as ``YYYY-MM-DD HH``."""
    layout = f"{root}/year=$1/month=$2/day=$3/hour=$4"
    return F.regexp_replace(hour, r"^(\d+)-(\d+)-(\d+) (\d+)$", layout)


def french_date(day: Column) -> Column:
    """``02 janv. 2024``; ``-`` when missing."""
    names = F.array(*[F.lit(name) for name in SHORT_MONTHS])
    text = F.concat_ws(
        " ", F.date_format(day, "dd"), F.get(names, F.month(day) - 1), F.date_format(day, "yyyy")
    )
    return F.when(day.isNull(), F.lit("-")).otherwise(text)
