"""Registered queries on carry folders and logged tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import carry
from tidemark.operators.lookup import PitOptions
from tidemark.operators.training import FeatureLookup, add_features
from tidemark.operators.versions import LoggedTable
from tidemark.operators.windows import pickup_features
from tidemark.plans.common import PICKUP_NAMES, PICKUP_SCHEMA, online_table, pickup_table
from tidemark.plans.streams import run_in_slices
from tidemark.session import scratch_database, scratch_path
from tidemark.sources.trips import trips
from tidemark.streaming import features as stream

#: Batches that overlap, so that windows at the cuts are computed from part of their rows and replaced.
FIRST, SECOND, THIRD, LAST = (None, "2024-01-16"), ("2024-01-11", None), ("2024-01-21 10:07:00", None), ("2024-01-13 10:07:00", None)


def _batch(facts: DataFrame, bounds: tuple) -> DataFrame:
    return pickup_features(facts, "pickup_ts", *bounds)


def _logged(spark: SparkSession, label: str) -> LoggedTable:
    return LoggedTable.create(spark, f"{scratch_database(spark, label)}.pickups", ["zip"], PICKUP_SCHEMA, "ts")


def pit_lookup_carry(spark: SparkSession, folder: str) -> DataFrame:
    """The last days looked up in one carry folder and their own days; the folders were kept by a merge."""
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "carry"))
    table.write(_batch(facts, FIRST), "overwrite")
    carry.enable(spark, table)
    table.write(pickup_features(facts))
    options = PitOptions(matched_ts="feature_ts", small_input_bytes=0)
    lookup = FeatureLookup(PICKUP_NAMES, ["pickup_zip"], "pickup_ts", table.name, options=options)
    return add_features(facts.where(F.col("pickup_ts") >= F.lit("2024-01-28").cast("timestamp_ntz")), [lookup])


def feature_merge_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Two merges, read from change rows, and again after they were folded into the base."""
    facts = trips(spark, folder)
    table = _logged(spark, "delta")
    table.write(_batch(facts, FIRST))
    version = table.write(_batch(facts, SECOND))
    held = scratch_path(spark, "before")  # compaction ends reading this version
    table.read(spark, version).write.parquet(held)
    table.compact(spark)
    before, after = spark.read.parquet(held), table.read(spark)
    return before.withColumn("form", F.lit("changes")).unionByName(after.withColumn("form", F.lit("base")))


def change_feed_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Change rows of three merges and an overwrite, read by a range of versions."""
    facts = trips(spark, folder)
    table = _logged(spark, "feed")
    for bounds in (FIRST, SECOND, THIRD):
        table.write(_batch(facts, bounds))
    table.write(_batch(facts, LAST), "overwrite")
    return table.changes(spark, 1, 4)


def feature_overwrite_versioned(spark: SparkSession, folder: str) -> DataFrame:
    """A merge, an overwrite and a merge, each version read afterwards."""
    facts = trips(spark, folder)
    table = _logged(spark, "versioned")
    table.write(_batch(facts, FIRST))
    table.write(_batch(facts, LAST), "overwrite")
    table.write(_batch(facts, THIRD))
    found = [table.read(spark, v).withColumn("version", F.lit(v).cast("long")) for v in (1, 2, 3)]
    return reduce(DataFrame.unionByName, found)


def latest_snapshot_since_version(spark: SparkSession, folder: str) -> DataFrame:
    """Newest rows published after a merge, after another, and after a delete of some that were newest."""
    facts = trips(spark, folder)
    table = _logged(spark, "published")
    online = online_table(spark, table.name.split(".")[0])
    table.write(_batch(facts, FIRST))
    table.publish(spark, online)
    table.write(pickup_features(facts))
    table.publish(spark, online)
    gone = table.read(spark, start="2024-01-25").where("zip % 3 = 0")
    table.delete(gone)
    table.publish(spark, online)
    return online.read(spark)


def stream_features_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Every micro-batch adds change rows; no day is rewritten until the compaction at the end."""
    facts = trips(spark, folder)
    table = _logged(spark, "stream")
    checkpoint = scratch_path(spark, "checkpoint")

    def run(landing: str) -> None:
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_features(source, pickup_features, "pickup_ts", table, checkpoint)

    run_in_slices(spark, facts, "pickup_ts", run)
    table.compact(spark)
    return table.read(spark)


QUERIES = {
    "pit_lookup_carry": pit_lookup_carry,
    "feature_merge_delta": feature_merge_delta,
    "change_feed_versions": change_feed_versions,
    "feature_overwrite_versioned": feature_overwrite_versioned,
    "latest_snapshot_since_version": latest_snapshot_since_version,
    "stream_features_delta": stream_features_delta,
}
