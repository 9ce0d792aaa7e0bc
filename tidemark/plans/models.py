"""Registered training and scoring queries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import train_test_split
from tidemark.models.expressions import create_function, trees_of
from tidemark.models.regression import (
    PackagedModel,
    append_inference_log,
    fit_regression,
    grouped_mean_predictor,
    inference_log,
    linear_pipeline,
    rmse_of,
)
from tidemark.operators.training import FeatureLookup, add_features, create_training_set
from tidemark.plans.common import fare_training_set, table_lookups, written_tables
from tidemark.session import scratch_database, scratch_path
from tidemark.sources.trips import trips

LABEL = "fare_amount"
# Fixed value: the fields of a scoring request, in request order.
REQUEST = [
    "trip_distance",
    "pickup_zip",
    "dropoff_zip",
    "mean_fare_window_1h_pickup_zip",
    "count_trips_window_1h_pickup_zip",
    "count_trips_window_30m_dropoff_zip",
    "dropoff_is_weekend",
]

_PACKAGES: dict[tuple[str, str], str] = {}


def _package(spark: SparkSession, folder: str) -> PackagedModel:
    """Train once per application and data folder; later queries load the stored model."""
    slot = (spark.sparkContext.applicationId, folder)
    if slot not in _PACKAGES:
        lookups = table_lookups(*written_tables(spark, folder))
        train, _ = train_test_split(trips(spark, folder), ["trip_id"])
        rows = fare_training_set(train, lookups)  # test trips are split off first and not looked up
        model = fit_regression(rows.load_df(), REQUEST, LABEL)
        path = scratch_path(spark, "package")
        PackagedModel(model, tuple(REQUEST), rows.lookups).save(spark, path)
        _PACKAGES[slot] = path
    return PackagedModel.load(spark, _PACKAGES[slot])


def _with_baseline(spark: SparkSession, train: DataFrame, test: DataFrame) -> DataFrame:
    """Test rows with the mean training fare of their pickup ZIP (overall mean if unknown)."""
    overall = train.agg(F.avg(LABEL)).first()[0]
    means = grouped_mean_predictor(train, "pickup_zip", LABEL)
    joined = test.join(means, "pickup_zip", "left")
    return joined.withColumn("prediction", F.coalesce(F.col("prediction"), F.lit(overall)))


def baseline_rmse(spark: SparkSession, folder: str) -> DataFrame:
    train, test = train_test_split(trips(spark, folder), ["trip_id"])
    scored = _with_baseline(spark, train, test)
    return scored.agg(
        F.round(rmse_of(LABEL, "prediction"), 6).alias("rmse"), F.count(F.lit(1)).alias("n_rows")
    )


def fare_model_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Test error of the boosted trees beside the grouped mean."""
    package = _package(spark, folder)
    train, test = train_test_split(trips(spark, folder), ["trip_id"])
    scored = package.score_batch(test)
    model = scored.agg(rmse_of(LABEL, "prediction").alias("rmse"), F.count(F.lit(1)).alias("n_rows"))
    base = _with_baseline(spark, train, test).agg(
        rmse_of(LABEL, "prediction").alias("rmse"), F.count(F.lit(1)).alias("n_rows")
    )
    return model.select(F.lit("boosted_trees").alias("predictor"), "*").unionByName(
        base.select(F.lit("mean_by_pickup_zip").alias("predictor"), "*")
    )


def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    fresh = trips(spark, folder)
    return _package(spark, folder).score_batch(fresh.drop(LABEL)).select("trip_id", *REQUEST, "prediction")


def _requests(spark: SparkSession, folder: str, package: PackagedModel) -> DataFrame:
    rows = add_features(trips(spark, folder).drop(LABEL), package.lookups)
    return rows.select("trip_id", "pickup_ts", F.struct(*REQUEST).alias("request"))


def score_struct(spark: SparkSession, folder: str) -> DataFrame:
    package = _package(spark, folder)
    scored = package.score_struct(_requests(spark, folder, package), "request")
    return scored.select("trip_id", "prediction")


def inference_log_daily(spark: SparkSession, folder: str) -> DataFrame:
    package = _package(spark, folder)
    scored = package.score_batch(trips(spark, folder).drop(LABEL))
    path = scratch_path(spark, "inference_log")
    append_inference_log(inference_log(scored, REQUEST, "1", F.col("pickup_ts")), path, "first")
    return (
        spark.read.parquet(path)
        .groupBy("day", "model_version")
        .agg(F.count(F.lit(1)).alias("n_requests"), F.avg("response").alias("mean_response"))
    )


COUNT = "count_trips_window_1h_pickup_zip"


def _linear_package(spark: SparkSession, folder: str) -> tuple[PackagedModel, DataFrame]:
    """A line through one looked-up feature, packaged, stored and loaded again, and the trips."""
    facts = trips(spark, folder)
    pickups, _ = written_tables(spark, folder)
    rows = create_training_set(facts, [FeatureLookup([COUNT], ["pickup_zip"], "pickup_ts", pickups.name)], LABEL)
    model = linear_pipeline([COUNT], LABEL).fit(rows.load_df().select(COUNT, LABEL))
    path = scratch_path(spark, "line")
    PackagedModel(model, (COUNT,), rows.lookups).save(spark, path)
    return PackagedModel.load(spark, path), facts.drop(LABEL)


def linear_score_batch(spark: SparkSession, folder: str) -> DataFrame:
    package, facts = _linear_package(spark, folder)
    return package.score_batch(facts).select("trip_id", F.round("prediction", 6).alias("prediction"))


def linear_score_struct(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as one struct each, scored through a view for SQL users."""
    package, facts = _linear_package(spark, folder)
    requests = add_features(facts, package.lookups).select("trip_id", F.struct(COUNT).alias("request"))
    requests.createOrReplaceTempView("line_requests")
    package.create_view(spark, "line_requests", "request", "line_scores")
    return spark.sql("SELECT trip_id, round(prediction, 6) AS prediction FROM line_scores")


def linear_inference_log(spark: SparkSession, folder: str) -> DataFrame:
    """All trips scored and logged, one batch of them twice as by a retry."""
    package, facts = _linear_package(spark, folder)
    path = scratch_path(spark, "line_log")
    cut = F.col("pickup_ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for batch_id, rows in (("a", facts.where(cut)), ("b", facts.where(~cut)), ("a", facts.where(cut))):
        log = inference_log(package.score_batch(rows), [COUNT], "1", F.col("pickup_ts"))
        append_inference_log(log, path, batch_id)
    daily = spark.read.parquet(path).groupBy("day", "model_version")
    return daily.agg(F.count(F.lit(1)).alias("n_requests"), F.round(F.avg("response"), 6).alias("mean_response"))


#: Inputs of few values, all of which become thresholds, so that SQL can try every split.
STUMP = {"zip_group": "pickup_zip % 16", "dropoff_group": "dropoff_zip % 8", "whole_miles": "cast(floor(trip_distance) AS int)"}


def _stump(spark: SparkSession, folder: str) -> tuple[PipelineModel, DataFrame]:
    """One round of boosting, one split deep."""
    rows = trips(spark, folder).selectExpr("trip_id", LABEL, *[f"{e} AS {n}" for n, e in STUMP.items()])
    return fit_regression(rows, list(STUMP), LABEL, rounds=1, depth=1), rows


def boosted_stump(spark: SparkSession, folder: str) -> DataFrame:
    """The split that training found, and the mean label on both sides of it."""
    model, _ = _stump(spark, folder)
    ((weight, tree),) = trees_of(model)
    feature = list(STUMP)[tree.feature // 2]  # every second input tells whether the value is missing
    found = [(feature, tree.threshold, weight * tree.low, weight * tree.high)]
    rows = spark.createDataFrame(found, "feature string, threshold double, low double, high double")
    return rows.withColumns({c: F.round(c, 6) for c in ("low", "high")})


def sql_function_score(spark: SparkSession, folder: str) -> DataFrame:
    """Trips scored by a function in SQL, on a view it was not made for."""
    model, rows = _stump(spark, folder)
    name = f"{scratch_database(spark, 'scores')}.fare_score"
    create_function(spark, name, model, list(STUMP), rows.schema)
    rows.createOrReplaceTempView("stump_rows")
    return spark.sql(
        f"SELECT trip_id, round({name}(struct({', '.join(STUMP)})), 6) AS prediction FROM stump_rows"
    )


QUERIES = {
    "boosted_stump": boosted_stump,
    "sql_function_score": sql_function_score,
    "linear_score_batch": linear_score_batch,
    "linear_score_struct": linear_score_struct,
    "linear_inference_log": linear_inference_log,
    "baseline_rmse": baseline_rmse,
    "fare_model_metrics": fare_model_metrics,
    "score_batch": score_batch,
    "score_struct": score_struct,
    "inference_log_daily": inference_log_daily,
}
