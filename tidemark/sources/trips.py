"""The trip facts, as a view over the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scan import read_table


def trips_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("trip_id"),
        F.col("user_id").cast("int").alias("pickup_zip"),
        ((F.col("user_id") * 7 + F.col("event_id") * 13) % 97).cast("int").alias("dropoff_zip"),
        F.col("ts").alias("pickup_ts"),
        (
            F.col("ts")
            + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 56 + 5).cast("int"))
        ).alias("dropoff_ts"),
        ((F.col("event_id") % 200).cast("double") / 10).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_from_events(read_table(spark, folder, "events"))
