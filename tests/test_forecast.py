"""The search of the forecast's parameters."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from obslake.plans import forecast
from obslake.registry import QUERIES, models, series


def test_equal_rows_are_learnt_from_once_by_their_weight(spark):
    """Nine rows of ten are alike and without noise, so errors that leave the weights out are several times too large."""
    rows = spark.range(6000).selectExpr(
        "CAST(id % 3 AS INT) AS fold", "CASE WHEN id % 10 < 9 THEN 1.0D ELSE double(id % 100) END AS x",
        "CASE WHEN id % 10 < 9 THEN 5.0D ELSE double(id % 7 * 10) END AS target",
    )
    counted = forecast.counted_rows(rows)
    assert counted.count() == rows.distinct().count() < 300
    assert counted.agg(F.sum("weight")).first()[0] == 6000
    assert counted.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    whole, known = (VectorAssembler(inputCols=["x"], outputCol="features").transform(df) for df in (rows, counted))
    grid = {"maxIter": [1, 3], "maxDepth": [2], "stepSize": [0.1]}
    few, many = forecast.search_grid(known, grid), forecast.search_grid(whole, grid)
    assert [f["maxIter"] for f in few] == [1, 3]
    assert [f["rmse"] for f in few] == pytest.approx([f["rmse"] for f in many], rel=0.1)
    model = forecast._trees({"maxIter": 3, "maxDepth": 2, "stepSize": 0.1, "weightCol": "weight"}).fit(known)
    errors = (model.evaluateEachIteration(df, "squared") for df in (known, whole.withColumn("weight", F.lit(1.0))))
    assert next(errors) == pytest.approx(next(errors))


def test_queries_search_the_whole_grid(spark, monkeypatch):
    """Neither the published model nor the query of the points is learnt from fewer or shorter models than GRID names."""
    asked = []

    def trained(features, test_size=0.15, grid=None, folds=forecast.FOLDS):
        asked.append((grid or forecast.GRID, folds))
        raise InterruptedError

    def searched(known, grid, folds=forecast.FOLDS):
        asked.append((grid, folds))
        return [{"maxDepth": 4, "maxIter": n, "stepSize": 0.1, "rmse": 1.0} for n in grid["maxIter"]]

    monkeypatch.setattr(forecast, "train_model", trained)
    monkeypatch.setattr(forecast, "search_grid", searched)
    monkeypatch.setattr(series, "_MODELS", {})
    with pytest.raises(InterruptedError):
        series._published(spark, "/root/testdata/sf0.001")
    assert {r["maxIter"] for r in models.search_points(spark, "/root/testdata/sf0.001").collect()} == {100, 200}
    assert asked == [({"maxIter": [100, 200], "maxDepth": [4, 6], "stepSize": [0.05, 0.1]}, 3)] * 2
    assert "(100), (200)" in QUERIES["m04_search_points"].sql


def test_few_rows_are_learnt_from_in_few_tasks(spark, monkeypatch):
    rows = spark.range(0, 100, numPartitions=8)
    few = forecast.in_long_tasks(rows)
    assert few.rdd.getNumPartitions() == 1 and few.count() == 100
    monkeypatch.setattr(forecast, "ROWS_A_TASK", 30)
    assert forecast.in_long_tasks(rows).rdd.getNumPartitions() == 4
    assert forecast.in_long_tasks(rows.where("id < 0")).rdd.getNumPartitions() <= 1
