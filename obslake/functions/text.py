"""Parsing of raw text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stay joined to the word after them in a place name.
PLACE_PREFIXES = ["SAINT", "SAINTE", "ST", "STE", "LE", "LA", "LES"]
CITY_PATTERN = rf"^((?:(?:{'|'.join(PLACE_PREFIXES)})[- ])*[^- ]*)"

DIGITS = "0123456789"
BLANKS = " \t\n\r\f\x0b"


def strip(text: Column) -> Column:
    """Outer blanks of any kind removed."""
    return F.btrim(text.cast("string"), F.lit(BLANKS))


def only(text: Column, characters: str) -> Column:
    """Whether the text is not empty and holds none but these characters.

    Cheaper than a pattern or a translation, and a failing cast costs far more than this test.
    """
    return (text != "") & (F.btrim(text, F.lit(characters)) == "")


def squeeze(text: Column) -> Column:
    """Outer blanks removed, inner runs of blanks made one space."""
    return F.regexp_replace(strip(text), r"\s+", " ")


def parse_number(value: Column) -> Column:
    """Text to double; decimal comma allowed; anything else, NaN included, is NULL."""
    text = strip(F.replace(value.cast("string"), F.lit(","), F.lit(".")))
    return F.when(only(text, DIGITS + "+-.eE"), text).try_cast("double")


def parse_date(value: Column) -> Column:
    """``YYYYMMDD`` or ``YYYY-MM-DD`` to date; an impossible day is NULL."""
    text = strip(value)
    dashed = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    digits = F.when(dashed, F.replace(text, F.lit("-"), F.lit(""))).otherwise(text)
    parts = [F.substring(digits, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    whole = (F.length(digits) == 8) & only(digits, DIGITS)
    return F.when(whole, F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2])).try_cast("date")


def station_id(code: Column) -> Column:
    """``MF_`` and the code, digits padded to eight; no code gives an empty text."""
    text = F.trim(code.cast("string"))
    padded = F.lpad(text, F.greatest(F.lit(8), F.length(text)), F.lit("0"))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", F.lit(""))
        .when(only(text, DIGITS), F.concat(F.lit("MF_"), padded))
        .otherwise(F.concat(F.lit("MF_"), text))
    )


def city_name(station_name: Column) -> Column:
    """The place in a station name, each word capitalised.

    ``initcap`` sees words only after a space, so hyphens get one for its sake.
    """
    head = F.regexp_extract(F.upper(squeeze(station_name)), CITY_PATTERN, 1)
    spaced = F.initcap(F.replace(head, F.lit("-"), F.lit("- ")))
    return F.coalesce(F.replace(spaced, F.lit("- "), F.lit("-")), F.lit(""))


def same_text(left: Column, right: Column) -> Column:
    """Equal apart from case and outer blanks."""
    return F.lower(F.trim(left)) == F.lower(F.trim(right))


def contains_text(text: Column, part: str) -> Column:
    """Substring test that ignores case."""
    return F.lower(text).contains(part.lower())


def department_code(value: Column) -> Column:
    """Upper-cased code, one digit padded to two; an empty code raises when read."""
    text = F.upper(F.trim(value.cast("string")))
    padded = F.when(text.rlike(r"^\d$"), F.lpad(text, 2, "0")).otherwise(text)
    return F.when(F.coalesce(text, F.lit("")) != "", padded).otherwise(
        F.raise_error(F.lit("empty department code")).cast("string")
    )


def path_value(path: Column, name: str) -> Column:
    """The value of ``name=value`` in a path; missing or empty is NULL."""
    return F.nullif(F.trim(F.regexp_extract(path, rf"(?:^|/){name}=([^/]*)", 1)), F.lit(""))
