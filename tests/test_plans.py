"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from obslake.operators import aggregates, dedup, filters, windows
from obslake.plans import silver
from obslake.registry import QUERIES
from obslake.registry.adapters import ev, feed, raw
from obslake.session import scratch_path, settle
from obslake.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def shuffles(df) -> int:
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(r"\bExchange\b", tree))


def test_silver_is_one_plan_whatever_the_stations(spark):
    """No job runs while the plan is built, copies go before rows travel, and no task needs a whole station."""
    frames = [silver.normalise_archive(raw(spark, SF)), silver.normalise_feed(feed(spark, SF))]
    spark.sparkContext.setJobGroup("building", "silver")
    built = silver.build_silver(frames)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    text = plan(built)
    assert "WindowGroupLimit" in text and "Partial" in text
    keyed = re.findall(r"Arguments: hashpartitioning\((.*?), \d+\)", text)
    assert sum("_bucket" in keys for keys in keyed) >= 2 and sum("timestamp" in keys for keys in keyed) >= 1


def test_windows_take_one_exchange_of_all_rows(spark):
    """Rows are spread once; the guests of other ranges are dealt alike, so the union of both is not shuffled again."""
    text = plan(windows.series_features(ev(spark, SF), "station_id", ["source"]))
    tree = text.split("\n\n")[0]
    above = tree[: tree.index("Union")]
    assert "Exchange" not in above and "Window" in above
    assert "percentile_approx" in text  # ranges are bounded by rows


def test_copies_are_removed_before_the_shuffle(spark):
    text = plan(dedup.dedup_observations(ev(spark, SF)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_daily_and_weekly_shuffles(spark):
    daily = aggregates.daily_aggregates(ev(spark, SF))
    assert shuffles(daily) == 1
    assert shuffles(aggregates.extreme_event_rows(daily, {"heatwave": 1.0})) == 1


def test_range_read_prunes_partitions_and_columns(spark):
    path = scratch_path(spark, "daily")
    daily = aggregates.daily_aggregates(ev(spark, SF)).withColumn("year", F.year("dt"))
    sinks.write_partitions(daily, path, ["year"])
    text = plan(readers.read_gold(spark, path, "2024-01-02", "2024-01-05", ["dt", "city"]))
    assert re.search(r"PartitionFilters: .*year.*>=", text)
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(dt", text)
    assert "ReadSchema: struct<dt:date,city:string>" in text


def test_relative_window_is_one_plan(spark):
    assert "Subquery" in plan(filters.last_days(ev(spark, SF), 7))


@pytest.mark.parametrize("name", ["p08_normalise_archive", "f10_extreme_events", "m01_features_causal", "b02_bulletin_text"])
def test_no_python_workers(spark, name):
    text = plan(QUERIES[name].run(spark, SF))
    assert "Python" not in text and "ArrowEval" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_listed_years_do_not_bring_a_year_to_one_task(spark):
    rows = ev(spark, SF).withColumn("year", F.year("dt"))
    text = plan(filters.partitions(rows, "year", settle(rows.select("year").distinct()), few=True))
    tree = text.split("\n\n")[0]
    assert "BroadcastHashJoin" in tree and "SortMergeJoin" not in tree
