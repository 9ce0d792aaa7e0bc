"""Registered queries on stored feature tables: zones, late rows, promotion, drop-offs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lookup import PitOptions
from tidemark.operators.refresh import refresh
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, add_features
from tidemark.operators.windows import (
    DROPOFF_WINDOW,
    PICKUP_SLIDE,
    PICKUP_WINDOW,
    Measure,
    dropoff_features,
    pickup_features,
    windowed_features,
)
from tidemark.plans.common import DROPOFF_NAMES, DROPOFF_SCHEMA, PICKUP_NAMES, PICKUP_SCHEMA, dropoff_table, pickup_table
from tidemark.plans.streams import edges_of
from tidemark.session import scratch_database, scratch_path
from tidemark.sources.scan import read_table
from tidemark.sources.trips import trips
from tidemark.streaming import features as stream

OTHER_ZONE = "Australia/Sydney"


def _utc(day: int) -> datetime:
    return datetime(2024, 1, day, tzinfo=timezone.utc)


@contextmanager
def _zone(spark: SparkSession, name: str) -> Iterator[None]:
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", name)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _zoned_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with instants for times, stored so that no later zone can move them."""
    path = scratch_path(spark, "instants")
    facts = trips(spark, folder)
    facts.withColumns({c: F.col(c).cast("timestamp") for c in ("pickup_ts", "dropoff_ts")}).write.parquet(path)
    return spark.read.parquet(path)


def _zoned_table(spark: SparkSession, facts: DataFrame) -> FeatureTable:
    """Two overlapping batches, the second one merged under another session zone."""
    schema = PICKUP_SCHEMA.replace("timestamp_ntz", "timestamp")
    name = f"{scratch_database(spark, 'zoned')}.pickups"
    table = FeatureTable.define(name, ["zip"], schema, "ts").create(spark)
    table.merge(pickup_features(facts, "pickup_ts", None, _utc(16)))
    with _zone(spark, OTHER_ZONE):
        table.merge(pickup_features(facts, "pickup_ts", _utc(11)))
    return table


def feature_merge_zoned(spark: SparkSession, folder: str) -> DataFrame:
    rows = _zoned_table(spark, _zoned_trips(spark, folder)).read(spark)
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def pit_lookup_stored_zoned(spark: SparkSession, folder: str) -> DataFrame:
    """Looked up under the other zone, by the way that large tables go."""
    facts = _zoned_trips(spark, folder)
    table = _zoned_table(spark, facts)
    table.merge(pickup_features(facts))
    options = PitOptions(matched_ts="feature_ts", small_input_bytes=0)
    with _zone(spark, OTHER_ZONE):
        out = add_features(facts, [FeatureLookup(PICKUP_NAMES, ["pickup_zip"], "pickup_ts", table.name, options=options)])
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_ts", "dropoff_ts", "feature_ts")})


def pit_lookup_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The batch of the last days against all stored features; older rows shrink to one for each key."""
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "history"))
    table.write(pickup_features(facts), "overwrite")
    options = PitOptions(matched_ts="feature_ts", small_input_bytes=0)
    lookup = FeatureLookup(PICKUP_NAMES, ["pickup_zip"], "pickup_ts", table.name, options=options)
    return add_features(facts.where(F.col("pickup_ts") >= F.lit("2024-01-28").cast("timestamp_ntz")), [lookup])


def key_lookup_latest(spark: SparkSession, folder: str) -> DataFrame:
    """By key alone in a table with a time key: its newest row, and as many rows as the base has."""
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "newest"))
    table.write(pickup_features(facts), "overwrite")
    return add_features(facts, [FeatureLookup(PICKUP_NAMES, ["pickup_zip"], None, table.name)])


def order_features_decimal(spark: SparkSession, folder: str) -> DataFrame:
    """Exact prices in both window forms."""
    orders = read_table(spark, folder, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(12,2)"))
    measures = {
        "n_orders": Measure("count"),
        "mean_price": Measure("mean", "price"),
        "min_price": Measure("min", "price"),
        "max_price": Measure("max", "price"),
        "sum_price": Measure("sum", "price"),
    }
    forms = []
    for name, slots in (("rows", False), ("slots", True)):
        out = windowed_features(
            orders, {"o_custkey": "custkey"}, "o_orderdate", "30 days", measures, slide="10 days", pre_aggregate=slots
        )
        forms.append(out.select(F.lit(name).alias("form"), "*"))
    assert forms[0].dtypes == forms[1].dtypes
    both = forms[0].unionByName(forms[1])
    prices = ("mean_price", "min_price", "max_price", "sum_price")
    return both.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in prices})


def feature_promote(spark: SparkSession, folder: str) -> DataFrame:
    """A table of the first half month, made a feature table where it lies, then merged into."""
    facts = trips(spark, folder)
    name = f"{scratch_database(spark, 'promote')}.given"
    old = pickup_features(facts, "pickup_ts", None, "2024-01-16")
    old.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").saveAsTable(name)
    table = FeatureTable.promote(spark, name, ["zip"], "ts")
    table.merge(pickup_features(facts, "pickup_ts", "2024-01-11"))
    return table.read(spark)


def dropoff_merge(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    table = dropoff_table(spark, scratch_database(spark, "dropoff"))
    table.write(dropoff_features(facts, "dropoff_ts", None, "2024-01-16"))
    table.write(dropoff_features(facts, "dropoff_ts", "2024-01-11"))
    return table.read(spark)


def dropoff_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A cut inside a window; the refresh completes it."""
    facts = trips(spark, folder)
    cut = "2024-01-15 10:07:00"
    table = dropoff_table(spark, scratch_database(spark, "dropoff"))
    table.write(dropoff_features(facts, "dropoff_ts", None, cut))
    refresh(table, facts, dropoff_features, "dropoff_ts", DROPOFF_WINDOW, after=cut)
    return table.read(spark)


def dropoff_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Newest drop-off rows, published twice in merge mode."""
    facts = trips(spark, folder)
    database = scratch_database(spark, "dropoff")
    table = dropoff_table(spark, database)
    online = FeatureTable.define(f"{database}.latest", ["zip"], DROPOFF_SCHEMA, buckets=8).create(spark)
    table.write(dropoff_features(facts, "dropoff_ts", None, "2024-01-16"))
    table.publish(spark, online)
    table.write(dropoff_features(facts, "dropoff_ts", "2024-01-11"))
    table.publish(spark, online, since="2024-01-11")
    return online.read(spark).select("zip", "ts", *DROPOFF_NAMES)


def stream_late_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Slices of trips in wrong order, so that the watermark leaves rows out; reconcile brings them in."""
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "late"))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    edges = edges_of(facts, "pickup_ts", 3)
    for slice_ in (edges[0], edges[2], edges[1]):
        inside = (F.col("pickup_ts") >= F.lit(slice_[0])) & (F.col("pickup_ts") < F.lit(slice_[1]))
        facts.where(inside).write.mode("append").parquet(landing)
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_features(source, pickup_features, "pickup_ts", table, checkpoint)
    # windows that no trip supports go as well
    phantom = [(-1, datetime(2024, 1, 9, 1), 1.0, 1)]
    table.merge(spark.createDataFrame(phantom, PICKUP_SCHEMA))
    until = edges[2][1].replace(microsecond=0)
    stream.reconcile(
        table, facts, pickup_features, "pickup_ts", PICKUP_WINDOW, "2023-12-01", datetime(until.year, until.month + 1, 9)
    )
    return table.read(spark)


def stream_late_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Slices of trips in wrong order; the windows that lost rows were listed on the way and are repaired."""
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "late"))
    landing, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "checkpoint")
    late = stream.LateWindows(scratch_path(spark, "late"), {"pickup_zip": "zip"}, PICKUP_WINDOW, PICKUP_SLIDE)
    edges = edges_of(facts, "pickup_ts", 4)
    for low, high in (edges[0], edges[2], edges[1], edges[3]):
        facts.where((F.col("pickup_ts") >= F.lit(low)) & (F.col("pickup_ts") < F.lit(high))).write.mode("append").parquet(landing)
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_features(source, pickup_features, "pickup_ts", table, checkpoint, late=late)
    late.repair(table, facts, pickup_features, "pickup_ts")
    return table.read(spark)


QUERIES = {
    "stream_late_windows": stream_late_windows,
    "feature_merge_zoned": feature_merge_zoned,
    "pit_lookup_stored_zoned": pit_lookup_stored_zoned,
    "pit_lookup_stored": pit_lookup_stored,
    "key_lookup_latest": key_lookup_latest,
    "order_features_decimal": order_features_decimal,
    "feature_promote": feature_promote,
    "dropoff_merge": dropoff_merge,
    "dropoff_refresh": dropoff_refresh,
    "dropoff_publish": dropoff_publish,
    "stream_late_reconcile": stream_late_reconcile,
}
