"""Pieces shared by the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lookup import PitOptions
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, TrainingSet, create_training_set
from tidemark.operators.windows import (
    DROPOFF_MEASURES,
    PICKUP_MEASURES,
    dropoff_features,
    pickup_features,
)
from tidemark.session import scratch_database
from tidemark.sources.trips import trips

Query = Callable[[SparkSession, str], DataFrame]

PICKUP_NAMES = list(PICKUP_MEASURES)
DROPOFF_NAMES = [*DROPOFF_MEASURES, "dropoff_is_weekend"]
PICKUP_SCHEMA = (
    "zip int, ts timestamp_ntz, mean_fare_window_1h_pickup_zip float, "
    "count_trips_window_1h_pickup_zip int"
)
DROPOFF_SCHEMA = (
    "zip int, ts timestamp_ntz, count_trips_window_30m_dropoff_zip int, dropoff_is_weekend int"
)


def in_utc(query: Query) -> Query:
    """Run a query with the session zone the test tables are written in."""

    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    return run


# Fixed values in the two functions below: the table names that jobs and scoring ask for.
def pickup_table(spark: SparkSession, database: str) -> FeatureTable:
    return FeatureTable.define(
        f"{database}.trip_pickup_time_series_features",
        ["zip"],
        PICKUP_SCHEMA,
        "ts",
        "Fare and trip count of the last hour, per pickup ZIP",
    ).create(spark)


def dropoff_table(spark: SparkSession, database: str) -> FeatureTable:
    return FeatureTable.define(
        f"{database}.trip_dropoff_time_series_features",
        ["zip"],
        DROPOFF_SCHEMA,
        "ts",
        "Trip count per half hour and weekend flag, per drop-off ZIP",
    ).create(spark)


def online_table(spark: SparkSession, database: str) -> FeatureTable:
    return FeatureTable.define(
        f"{database}.trip_pickup_latest", ["zip"], PICKUP_SCHEMA, comment="Newest row per ZIP", buckets=8
    ).create(spark)


def written_tables(spark: SparkSession, folder: str) -> tuple[FeatureTable, FeatureTable]:
    """Both feature tables, stored."""
    database = scratch_database(spark, "features")
    facts = trips(spark, folder)
    pickups, dropoffs = pickup_table(spark, database), dropoff_table(spark, database)
    pickups.write(pickup_features(facts), "overwrite")
    dropoffs.write(dropoff_features(facts), "overwrite")
    return pickups, dropoffs


def frame_lookups(facts: DataFrame, options: PitOptions = PitOptions()) -> list[FeatureLookup]:
    """Lookups in features computed on the fly."""
    return [
        FeatureLookup(
            PICKUP_NAMES,
            ["pickup_zip"],
            "pickup_ts",
            frame=pickup_features(facts),
            frame_keys=["zip"],
            options=options,
        ),
        FeatureLookup(
            DROPOFF_NAMES,
            ["dropoff_zip"],
            "dropoff_ts",
            frame=dropoff_features(facts),
            frame_keys=["zip"],
            options=options,
        ),
    ]


def table_lookups(pickups: FeatureTable, dropoffs: FeatureTable) -> list[FeatureLookup]:
    return [
        FeatureLookup(PICKUP_NAMES, ["pickup_zip"], "pickup_ts", table_name=pickups.name),
        FeatureLookup(DROPOFF_NAMES, ["dropoff_zip"], "dropoff_ts", table_name=dropoffs.name),
    ]


def fare_training_set(facts: DataFrame, lookups: list[FeatureLookup]) -> TrainingSet:
    return create_training_set(facts, lookups, "fare_amount", ["pickup_ts", "dropoff_ts"])


def with_lookup_time(facts: DataFrame) -> DataFrame:
    """Trips with their time cut to the quarter hour, so it can equal a feature time."""
    return facts.select(
        "trip_id", "pickup_zip", F.window("pickup_ts", "15 minutes")["start"].alias("lookup_ts")
    )
