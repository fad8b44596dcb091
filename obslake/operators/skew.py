"""Row windows over a key that may hold a large share of all rows.

A window partitioned by station sends each station to one task. Here series are cut into ranges of time, and each
range is given the few rows before and after it which its frames reach into. The result is that of the plain window.

The cuts are quantiles of all rows in the order of (hash of the key, time), found by a narrow aggregation inside the same
plan. So a range holds about one part in ``parts`` of all rows at most, however dense a key is: a hot key's day is
cut many times, a quiet key's years not at all. Only rows of a key with the very same time stay together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: parts of all rows at least; four for each shuffle partition if that is more
LEAST_PARTS = 256
#: keys are dealt to so many groups, which are cut one after the other
_GROUP_BITS = 10
#: microseconds of 285 years from 1850 on; earlier and later times share the first and the last cut
_TIME_BITS, _FIRST_TIME = 53, -3_786_825_600_000_000
_BUCKET, _GUEST = "_bucket", "_guest"
#: bucket of rows without a time, which come first
_NO_TIME = -(2**63)


def _place(key: str, ts: str) -> Column:
    """A number in time order within a key; rows without a time come first."""
    group = F.pmod(F.xxhash64(key), F.lit(1 << _GROUP_BITS))
    at = F.col(ts).cast("timestamp")
    inside = F.greatest(F.lit(1), F.least(F.unix_micros(at) - _FIRST_TIME, F.lit((1 << _TIME_BITS) - 1)))
    inside = F.when(at.isNull(), 0).otherwise(inside)
    return F.call_function("shiftleft", group, F.lit(_TIME_BITS)) + inside


def with_row_ranges(rows: DataFrame, key: str, ts: str, parts: int | None = None, sample: DataFrame | None = None) -> DataFrame:
    """Adds the number of a row's range; ``sample`` holds the rows that the cuts are found on, if not ``rows``."""
    if parts is None:
        parts = max(LEAST_PARTS, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = F.split(F.lit(" ".join(str(i / parts) for i in range(1, parts))), " ").cast("array<double>")  # one constant
    places = (rows if sample is None else sample).select(_place(key, ts).alias("place"))
    cuts = places.agg(F.coalesce(F.percentile_approx("place", shares, F.lit(20 * parts)), F.array().cast("array<bigint>")))
    steps = [1 << bit for bit in reversed(range((parts - 1).bit_length()))]
    # binary search: how many cuts are not above the row's place
    found = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda found, step: F.when(F.get("_cuts", found + step - 1) <= F.col("_place"), found + step).otherwise(found),
    )
    placed = rows.withColumns({"_cuts": cuts.scalar(), "_place": _place(key, ts)})
    return placed.withColumn(_BUCKET, found.cast("long")).drop("_cuts", "_place")


def day_ranges(ts: str, days: float) -> Column:
    """The number of a row's calendar range of ``days``."""
    found = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(int(days * 86_400_000_000))).cast("long")
    return F.coalesce(found, F.lit(_NO_TIME))


def _guests(rows: DataFrame, key: str, outward: list[Column], reach: int) -> DataFrame:
    """The rows that other buckets' frames reach into, once for each such bucket.

    ``outward`` is time order seen from the bucket that needs the rows: newest
    first for rows before it. Only the ``reach`` rows nearest to each cut
    matter, so a key has ``reach`` rows per bucket of the calendar here. Among those alone, a row is in
    the frame of another bucket exactly when that bucket has one of the
    ``reach`` rows next to it.
    """
    edge = Window.partitionBy(key, _BUCKET).orderBy(*outward)
    near = Window.partitionBy(key).orderBy(*outward).rowsBetween(-reach, -1)
    others = F.array_except(F.collect_set(_BUCKET).over(near), F.array(_BUCKET))
    return (
        rows.withColumn("_pos", F.row_number().over(edge))
        .where(F.col("_pos") <= reach)
        .drop("_pos")
        .withColumn("_others", others)
        .withColumn(_BUCKET, F.explode("_others"))
        .drop("_others")
    )


def over_key(
    rows: DataFrame,
    key: str,
    ts: str,
    ties: list[str],
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int = 0,
    after: int = 0,
    days: float | None = None,
    parts: int | None = None,
    sample: DataFrame | None = None,
) -> DataFrame:
    """``build(frame, window)`` over each key's rows in time order.

    ``build`` adds columns whose frames reach at most ``before`` rows back and
    ``after`` rows ahead of a row. Series are cut by rows (see ``with_row_ranges``), or every ``days`` if given. Rows
    are spread by key and range once; the branches that look for guests read the same shuffle.
    """
    order = [F.col(c) for c in [ts, *ties]]
    cut = with_row_ranges(rows, key, ts, parts, sample) if days is None else rows.withColumn(_BUCKET, day_ranges(ts, days))
    spread = cut.repartition(key, _BUCKET)
    framed = spread.withColumn(_GUEST, F.lit(False))
    for reach, outward in ((before, [c.desc_nulls_last() for c in order]), (after, order)):
        if reach:
            # dealt like the rows they visit, so that the union needs no shuffle of its own
            guests = _guests(spread, key, outward, reach).repartition(key, _BUCKET)
            framed = framed.unionByName(guests.withColumn(_GUEST, F.lit(True)))
    window = Window.partitionBy(key, _BUCKET).orderBy(*order)
    return build(framed, window).where(~F.col(_GUEST)).drop(_GUEST, _BUCKET)
