"""Links within buckets and connected components, both without emitting all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import staged

#: rounds in which every bucket measures its members against one pivot
PIVOT_ROUNDS = 2


def bucket_links(
    members: DataFrame,
    distance: Callable[[DataFrame], DataFrame],
    radius: float,
    hints: Callable[[DataFrame], DataFrame] | None = None,
    possible: Callable[[str, str], Column] | None = None,
) -> DataFrame:
    """Links (a, b) that connect exactly the ids that the links of all pairs within a bucket connect.

    members: key, id. distance: adds `d`, a metric, to distinct pairs (a, b), where more than 2 * radius may stand
    for any such value. A link has d <= radius. hints: id and more of the given ids.
    possible: from the hints of two aliases, false only where no link can be.

    In the first rounds a bucket measures its members against one pivot: its smallest id, then the member
    nearest to that, which is the middle of a group of copies. By the triangle inequality, a member
    farther than 2 * radius from the pivot cannot be linked to one that the pivot is linked to, and one at d
    only to those at d - radius or more; so the pivot and the linked members out of all others' reach are done. The
    members left may still be linked where their components differ: those outside their bucket's largest component
    are measured against the bucket's other components, as far as all pivots and the hints allow it.
    """
    live = staged(members.select("key", "id").distinct(), "members")
    links: list[DataFrame] = []
    seen: list[str] = []

    def measure(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = staged(distance(ordered), "measured")
        links.append(found.where(F.col("d") <= radius).select("a", "b"))
        return found

    for number in range(PIVOT_ROUNDS):
        middle = F.min(F.struct(*seen[-1:], "id"))["id"]
        pivots = live.groupBy("key").agg(F.count("*").alias("n"), middle.alias("pivot")).where("n > 1")
        dealt = live.join(pivots.select("key", "pivot"), "key").where("id <> pivot")
        measured = measure(dealt.select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        dealt = dealt.withColumns({"a": F.least("id", "pivot"), "b": F.greatest("id", "pivot")})
        told = dealt.join(measured, ["a", "b"]).select("key", "id", *seen, "d")
        far = F.min(F.when((F.col("d") > radius) & (F.col("d") <= 2 * radius), F.col("d")))
        reach = told.groupBy("key").agg(far.alias("far"), F.max("d").alias("most")).where(F.col("most") > radius)
        kept = (F.col("d") > radius) | (F.col("d") >= F.col("far") - radius)
        seen.append(f"d{number}")
        live = told.join(reach.select("key", "far"), "key").where(kept).withColumnRenamed("d", seen[-1])
        live = staged(live.select("key", "id", *seen), "members")
        if live.isEmpty():
            return staged(reduce(DataFrame.unionByName, links).distinct(), "links")

    found = components(reduce(DataFrame.unionByName, links))
    live = live.join(found, live["id"] == found["node"], "left")
    live = live.select("key", "id", *seen, F.coalesce("class", "id").alias("class"))
    parts = live.groupBy("key", "class").agg(F.count("*").alias("n"))
    largest = parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "class"))["class"].alias("largest"))
    live = staged(live.join(largest.where("parts > 1").select("key", "largest"), "key"), "members")
    if hints is not None:
        live = live.join(staged(hints(live.select("id").distinct()), "hints"), "id")
    one, other = live.where(F.col("class") != F.col("largest")).alias("x"), live.alias("y")
    apart = F.expr("x.key = y.key AND x.class <> y.class AND (y.class = y.largest OR x.id < y.id)")
    for name in seen:
        # min(d, 2 * radius) differs by no more than d does, and is known exactly
        x, y = (F.least(F.col(f"{side}.{name}"), F.lit(2 * radius)) for side in ("x", "y"))
        apart &= F.abs(x - y) <= radius
    if possible is not None:
        apart &= possible("x", "y")
    measure(one.join(other, apart).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")))
    return staged(reduce(DataFrame.unionByName, links).distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """node and class (its component's smallest node) for every node of the links (a, b).

    Alternating large-star and small-star steps: each shuffles the links once and halves the
    longest path, and a node's links are never gathered.
    """
    edges = staged(links.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            small.select("a", F.col("m").alias("b"))
        )
        edges = staged(small.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("class"))
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("class")).distinct())
