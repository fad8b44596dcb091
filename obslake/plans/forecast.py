"""Features, time split, model training and next-day forecasts."""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslake.functions.calendar import calendar_parts, season_of_month
from obslake.functions.weather import absolute_error, confidence
from obslake.operators.aggregates import split_scores
from obslake.operators.filters import last_days, missing_columns, require_columns
from obslake.operators.joins import dense_index, encode, label_index, semi
from obslake.operators.views import top_locations
from obslake.operators.windows import series_features
from obslake.schemas import FEATURE_INPUT, NOT_FEATURES
from obslake.session import settle, staged_for
from obslake.sources.readers import read_table
from obslake.sources.sinks import append_rows, write_partitions, write_table

# Search grid, folds and quality goal of the model.
GRID = {"maxIter": [100, 200], "maxDepth": [4, 6], "stepSize": [0.05, 0.1]}
FOLDS, SEED, SUBSAMPLE, COLUMN_SAMPLE, RMSE_GOAL = 3, 42, 0.9, 0.9, 2.0
PARALLEL_FITS = 4
#: rows that a task of the learner passes over at least, since a fit is some thousand passes
ROWS_A_TASK = 20_000
HISTORY_DAYS, SCORING_DAYS = 730, 30


def history(obs: DataFrame, days: int = HISTORY_DAYS, locations: int | None = None) -> DataFrame:
    """The last ``days`` of all locations, or of the ``locations`` with most observations."""
    recent = last_days(obs, days).withColumn("location", F.col("city").cast("string"))
    return recent if locations is None else semi(recent, F.broadcast(top_locations(recent, locations)), "location")


def build_features(
    obs: DataFrame,
    drop_missing_target: bool = True,
    centered: bool = False,
    key: str = "location",
    days: float | None = None,
) -> DataFrame:
    """The feature table.

    Rows without a value seven rows back are dropped, and for training those
    without a next value. ``key`` is the series a lag runs along: the city
    (``location``) or ``station_id``.
    """
    require_columns(obs, FEATURE_INPUT)
    rows = obs.withColumns(
        {"location": F.col("city").cast("string"), "source": F.upper(F.col("source").cast("string"))}
    )
    ties = [c for c in ("station_id", "source") if c != key]
    series = series_features(rows, key, ties, centered, days=days)
    parts = calendar_parts(F.col("timestamp"))
    featured = series.withColumns(
        {name: parts[name] for name in ("month", "dayofyear", "dayofweek", "is_weekend", "year")}
    ).withColumn("season", season_of_month(F.col("month"), summer="été"))
    needed = ["temp_lag7", "target"] if drop_missing_target else ["temp_lag7"]
    cities = label_index(obs, "city")
    return encode(featured, cities, "city", "city_encoded").dropna(subset=needed)


def write_features(features: DataFrame, path: str) -> None:
    write_table(features, path)


def date_splits(df: DataFrame, test_size: float = 0.15) -> DataFrame:
    """``train``, ``val`` or ``test`` of each distinct day, cut by position in time.

    Only the distinct days are ordered.
    """
    days = dense_index(df, "dt", "_at")
    total = days.select(F.count(F.lit(1))).scalar()
    last_train = F.floor(total * (1 - 2 * test_size)) - 1
    last_val = F.floor(total * (1 - test_size)) - 1
    split = F.when(F.col("_at") <= last_train, "train").when(F.col("_at") <= last_val, "val")
    return days.select("dt", split.otherwise("test").alias("split"))


def with_split(features: DataFrame, test_size: float = 0.15, check: bool = True) -> DataFrame:
    """Each row with its split; raises when a part would be empty.

    There is one lookup row per calendar day, so it is broadcast.
    """
    days = date_splits(features, test_size)
    if check:
        found = days.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("split").alias("parts")).first()
        if found["n"] < 3 or found["parts"] < 3:
            raise ValueError(f"{found['n']} distinct days are too few for a time split")
    return features.join(F.broadcast(days), "dt")


def feature_names(df: DataFrame) -> list[str]:
    """All columns but the fixed identifiers and the target."""
    return [c for c in df.columns if c not in (*NOT_FEATURES, "split")]


def encoders(train: DataFrame) -> DataFrame:
    """Label ranks of every text feature, learnt on the training rows only."""
    texts = [
        f.name for f in train.select(*feature_names(train)).schema.fields
        if isinstance(f.dataType, T.StringType)
    ]
    out = train.sparkSession.createDataFrame([], "feature string, label string, idx int")
    for name in texts:
        ranks = label_index(train, name).select(F.lit(name).alias("feature"), "label", "idx")
        out = out.unionByName(ranks)
    return settle(out)


def apply_encoders(df: DataFrame, ranks: DataFrame) -> DataFrame:
    """Text features as ranks; a label unseen in training gives -1."""
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType) and field.name in feature_names(df):
            own = ranks.where(F.col("feature") == field.name)
            coded = encode(df.withColumn(field.name, F.col(field.name).cast("string")), own, field.name, "_code")
            df = coded.withColumn(field.name, F.col("_code")).drop("_code")
    return df


def train_model(
    features: DataFrame,
    test_size: float = 0.15,
    grid: dict[str, list] | None = None,
    folds: int = FOLDS,
) -> tuple[PipelineModel, DataFrame, DataFrame, dict]:
    """Grid search of boosted trees on train and val days; scores per split.

    Returns the model, the encoders, the scores and the best parameters. The features are written once, since
    splits, encoders and the search for empty columns read them, and so are the prepared rows, since every
    fold reads them again.
    """
    with staged_for(features, "features") as written:
        prepared = with_split(written, test_size)
        ranks = encoders(prepared.where("split = 'train'"))
        empty = _empty_columns(prepared)
        names = [c for c in feature_names(written) if c not in empty]
        numeric = apply_encoders(prepared, ranks).select(
            "dt", "split", F.col("target").cast("double").alias("target"),
            *[F.col(c).cast("double").alias(c) for c in names],
            F.pmod(F.xxhash64("location", "timestamp", "station_id", "source"), F.lit(folds)).cast("int").alias("fold"),
        )
        with staged_for(numeric, "training") as rows:
            filled = [f"{c}_filled" for c in names]
            prepare = Pipeline(
                stages=[
                    Imputer(inputCols=names, outputCols=filled, strategy="mean"),
                    VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep"),
                ]
            ).fit(rows.where("split = 'train'"))
            with staged_for(prepare.transform(rows.where("split != 'test'")).select("fold", "features", "target"), "vectors") as known:
                tried = search_grid(known, grid or GRID, folds)
                best = min(tried, key=lambda found: found["rmse"])
                best = {name: value for name, value in best.items() if name != "rmse"}
                chosen = _trees(best).fit(in_long_tasks(known))
            model = PipelineModel(stages=[*prepare.stages, chosen])
            return model, ranks, settle(split_scores(model.transform(rows))), best


def _trees(params: dict) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol="target", subsamplingRate=SUBSAMPLE,
        featureSubsetStrategy=str(COLUMN_SAMPLE), seed=SEED, **params
    )


def counted_rows(rows: DataFrame) -> DataFrame:
    """Each distinct row once, with the number of its copies as ``weight``.

    Every level of every tree passes over all rows, and readings of few decimals repeat. The learner counts a row by its
    weight; only its subsample draws a row's copies together. The rows are dealt to all cores, however few are left.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    return counted.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def in_long_tasks(known: DataFrame) -> DataFrame:
    """The same rows in no more tasks than ROWS_A_TASK asks for."""
    return known.coalesce(max(1, -(-known.count() // ROWS_A_TASK)))


def search_grid(known: DataFrame, grid: dict[str, list], folds: int = FOLDS) -> list[dict]:
    """The mean RMSE over the folds of every point of the grid.

    A boosted model begins with the shorter one of the same other parameters, so points that differ in the number of
    trees only take one fit per fold: the longest is fitted, and its error is read off after each number. Fits run
    side by side; each sees the same written table of vectors, which holds ``fold``, ``features`` and ``target``, and
    ``weight`` where a row stands for so many equal ones (see ``counted_rows``); errors are weighted then.
    """
    known = in_long_tasks(known)
    weighted = {"weightCol": "weight"} if "weight" in known.columns else {}
    lengths = sorted(grid.get("maxIter", [20]))
    names = [name for name in grid if name != "maxIter"]
    points = [dict(zip(names, values, strict=True)) for values in itertools.product(*(grid[name] for name in names))]

    def errors(job: tuple[dict, int]) -> dict[int, float]:
        point, fold = job
        model = _trees({**point, **weighted, "maxIter": lengths[-1]}).fit(known.where(F.col("fold") != fold))
        squared = model.evaluateEachIteration(known.where(F.col("fold") == fold), "squared")
        return {length: squared[length - 1] ** 0.5 for length in lengths}

    jobs = [(point, fold) for point in points for fold in range(folds)]
    # fits of few tasks leave cores to more fits
    side = max(PARALLEL_FITS, known.sparkSession.sparkContext.defaultParallelism // known.rdd.getNumPartitions())
    with ThreadPoolExecutor(side) as pool:
        found = dict(zip([(tuple(point.items()), fold) for point, fold in jobs], pool.map(inheritable_thread_target(known.sparkSession)(errors), jobs), strict=True))
    return [
        {**point, "maxIter": length, "rmse": sum(found[tuple(point.items()), fold][length] for fold in range(folds)) / folds}
        for point in points for length in lengths
    ]


def model_features(model: PipelineModel) -> list[str]:
    """The feature columns a trained model reads."""
    return list(model.stages[0].getInputCols())


def _empty_columns(df: DataFrame) -> list[str]:
    """Feature columns without any value, which no model can use."""
    seen = df.agg(*[F.count(c).alias(c) for c in feature_names(df)]).first()
    return [c for c in feature_names(df) if seen[c] == 0]


def metrics_row(
    scores: DataFrame, features: DataFrame, best: dict, version: int, names: list[str]
) -> DataFrame:
    """The metrics record as one row."""
    spark = scores.sparkSession

    def of(split: str, name: str):
        return F.round(F.max(F.when(F.col("split") == split, F.col(name))), 4)

    row = scores.agg(
        of("test", "rmse").alias("rmse_test"), of("test", "mae").alias("mae_test"),
        of("test", "r2").alias("r2_test"), of("train", "rmse").alias("rmse_train"),
        of("val", "rmse").alias("rmse_val"), F.sum("n").alias("n_samples"),
    )
    params = [F.lit(x) for k, v in best.items() for x in (k, str(v))]
    return row.withColumns(
        {
            "best_params": F.create_map(*params),
            "model_version": F.lit(version),
            "trained_at": F.lit(datetime.now(timezone.utc).isoformat(timespec="seconds")),
            "feature_names": F.array(*[F.lit(n) for n in names]),
            "goal_met": F.col("rmse_test") < RMSE_GOAL,
        }
    )


def versions(spark: SparkSession, base: str) -> DataFrame | None:
    """The model registry: one row per published version."""
    return read_table(spark, f"{base}/registry")


def latest_version(spark: SparkSession, base: str) -> int | None:
    registry = versions(spark, base)
    return None if registry is None else registry.select(F.max("model_version")).first()[0]


def publish_model(
    spark: SparkSession, base: str, model: PipelineModel, ranks: DataFrame, metrics: DataFrame,
    version: int | None = None,
) -> int:
    """Saves model, encoders and metrics as the next or the given version; the registry row comes last."""
    version = version or (latest_version(spark, base) or 0) + 1
    home = f"{base}/v{version}"
    model.write().overwrite().save(f"{home}/model")
    write_table(ranks, f"{home}/encoders")
    append_rows(metrics.withColumn("model_version", F.lit(version)), f"{base}/registry")
    return version


def load_model(spark: SparkSession, base: str, version: int | None = None):
    """Model, encoders and metrics of a version (the latest by default); None without one."""
    chosen = version or latest_version(spark, base)
    if chosen is None:
        return None
    home = f"{base}/v{chosen}"
    metrics = versions(spark, base).where(F.col("model_version") == chosen)
    return PipelineModel.load(f"{home}/model"), spark.read.parquet(f"{home}/encoders"), metrics


def predictions(features: DataFrame, model: PipelineModel, ranks: DataFrame, names: list[str]) -> DataFrame:
    """Feature rows with ``temp_predicted``; raises when a model feature is absent."""
    absent = missing_columns(features.columns, names)
    if absent:
        raise ValueError(f"missing features: {', '.join(absent)}")
    keep = ["dt", "location", "city", "source", "target"]
    # as one struct, so that its texts are not taken for features and encoded
    rows = apply_encoders(features.withColumn("_kept", F.struct(*keep)), ranks)
    scored = model.transform(rows.select("_kept", *[F.col(c).cast("double").alias(c) for c in names]))
    return scored.select("_kept.*", F.col("prediction").alias("temp_predicted"))


def forecast_table(predicted: DataFrame, version: int, test_rmse: float = RMSE_GOAL) -> DataFrame:
    """The forecast rows of the day after each feature row."""
    error = absolute_error(F.col("target"), F.col("temp_predicted"))
    return predicted.select(
        F.date_format(F.date_add("dt", 1), "yyyy-MM-dd").alias("dt"),
        "location",
        "city",
        "source",
        F.col("target").alias("temp_actual"),
        "temp_predicted",
        error.alias("error_abs"),
        F.lit(version).alias("model_version"),
        confidence(error, F.lit(test_rmse)).alias("confidence"),
    )


def run_forecast(
    spark: SparkSession, obs: DataFrame | None, base: str, path: str, days: int = SCORING_DAYS
) -> DataFrame | None:
    """Scores the last days and writes the forecasts by day.

    Without a model or without rows nothing is written and None is returned:
    forecasts are an extra and must not fail the run.
    """
    found = load_model(spark, base)
    if found is None or obs is None or obs.isEmpty():
        return None
    model, ranks, metrics = found
    chosen = metrics.first()
    features = build_features(history(obs, days, None), drop_missing_target=False)
    predicted = predictions(features, model, ranks, list(chosen["feature_names"]))
    table = forecast_table(predicted, chosen["model_version"], chosen["rmse_test"] or RMSE_GOAL)
    write_partitions(table, path, ["dt"])
    return table


def needs_training(spark: SparkSession, base: str) -> bool:
    """Training runs only while there is no model yet."""
    return latest_version(spark, base) is None
