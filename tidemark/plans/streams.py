"""Registered streaming queries.

Each one lands the trips in time order, in slices, and runs the stream once per
slice with the same checkpoint, as a scheduled job does: every run takes all
files of its slice as one micro-batch, however many there are.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timefilter import aggregated_times, ts_range
from tidemark.operators.windows import dropoff_features, pickup_features
from tidemark.plans.common import dropoff_table, pickup_table, table_lookups, written_tables
from tidemark.session import scratch_database, scratch_path
from tidemark.sources.trips import trips
from tidemark.streaming import features as stream

SLICES = 3


def edges_of(facts: DataFrame, ts: str, slices: int) -> list[tuple[datetime, datetime]]:
    """Half-open time slices of equal length that hold all rows."""
    low, high = aggregated_times(facts, facts.schema[ts].dataType, F.min(ts), F.max(ts))
    edges = [low + (high - low) * i / slices for i in range(slices)] + [high + timedelta(seconds=1)]
    return list(zip(edges, edges[1:]))


def run_in_slices(
    spark: SparkSession, facts: DataFrame, ts: str, run: Callable[[str], object], slices: int = SLICES
) -> None:
    """Append ``facts`` to a landing folder slice by slice, calling ``run`` after each."""
    landing = scratch_path(spark, "landing")
    for low, high in edges_of(facts, ts, slices):
        ts_range(facts, ts, low, high).write.mode("append").parquet(landing)
        run(landing)


def stream_pickup_features(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "stream_pickup"))
    checkpoint = scratch_path(spark, "checkpoint")

    def run(landing: str) -> None:
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_features(source, pickup_features, "pickup_ts", table, checkpoint)

    run_in_slices(spark, facts, "pickup_ts", run)
    return table.read(spark)


def stream_dropoff_features(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    table = dropoff_table(spark, scratch_database(spark, "stream_dropoff"))
    checkpoint = scratch_path(spark, "checkpoint")

    def run(landing: str) -> None:
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_features(source, dropoff_features, "dropoff_ts", table, checkpoint)

    run_in_slices(spark, facts, "dropoff_ts", run)
    return table.read(spark)


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    loaded, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "checkpoint")

    def run(landing: str) -> None:
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_ingest(source, loaded, checkpoint)

    run_in_slices(spark, facts, "pickup_ts", run)
    return (
        spark.read.parquet(loaded)
        .groupBy(F.to_date("pickup_ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("pickup_ts").alias("min_ts"),
            F.max("pickup_ts").alias("max_ts"),
        )
    )


def stream_pit_enrich(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    lookups = table_lookups(*written_tables(spark, folder))
    enriched, checkpoint = scratch_path(spark, "enriched"), scratch_path(spark, "checkpoint")

    def run(landing: str) -> None:
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_enrich(source, lookups, enriched, checkpoint)

    run_in_slices(spark, facts, "pickup_ts", run)
    return spark.read.parquet(enriched).drop("batch_id", "pickup_ts", "dropoff_ts")


QUERIES = {
    "stream_pickup_features": stream_pickup_features,
    "stream_dropoff_features": stream_dropoff_features,
    "stream_ingest": stream_ingest,
    "stream_pit_enrich": stream_pit_enrich,
}
