"""Registered batch queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import is_weekend
from tidemark.functions.hashing import hash_sample, with_split
from tidemark.functions.timefilter import ts_range
from tidemark.operators.changes import change_feed as changes_between
from tidemark.operators.lookup import PitOptions
from tidemark.operators.lookup import key_lookup as lookup_by_key
from tidemark.operators.lookup import pit_lookup as lookup_at_time
from tidemark.operators.refresh import refresh
from tidemark.operators.outlines import outline_join
from tidemark.operators.regions import region_join as join_regions
from tidemark.operators.tables import key_violations
from tidemark.operators.tables import latest_snapshot as newest_rows
from tidemark.operators.training import fill_missing
from tidemark.operators.windows import (
    PICKUP_WINDOW,
    Measure,
    dropoff_features,
    pickup_features,
    windowed_features,
)
from tidemark.plans.common import (
    PICKUP_NAMES,
    dropoff_table,
    fare_training_set,
    frame_lookups,
    online_table,
    pickup_table,
    with_lookup_time,
)
from tidemark.session import scratch_database
from tidemark.sources import ingest, manifest
from tidemark.sources.scan import read_table
from tidemark.sources.trips import trips

# -- filters, samples, scalars ------------------------------------------------


def ts_range_filter(spark: SparkSession, folder: str) -> DataFrame:
    return ts_range(trips(spark, folder), "pickup_ts", "2024-01-05 00:00:00", "2024-01-20 12:00:00")


def ts_range_filter_open_end(spark: SparkSession, folder: str) -> DataFrame:
    return ts_range(trips(spark, folder), "pickup_ts", "2024-01-16 00:00:00")


def sample_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    """The sampling operator itself: one row in ten, by key hash, of a date range."""
    ranged = ts_range(trips(spark, folder), "pickup_ts", "2024-01-02", "2024-01-30")
    return hash_sample(ranged, ["trip_id"], 0.1)


def weekend_flag(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    flag = is_weekend(F.col("ts"), events.schema["ts"].dataType)
    return events.select("event_id", "ts", flag.alias("is_weekend"))


def ts_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.ts_bounds(trips(spark, folder), "pickup_ts")


# -- ingest -------------------------------------------------------------------


def initial_load(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.initial_load(trips(spark, folder), "pickup_ts")


def incremental_load_step(spark: SparkSession, folder: str) -> DataFrame:
    source = trips(spark, folder)
    loaded = ingest.initial_load(source, "pickup_ts")
    return ingest.incremental_load_step(source, loaded, "pickup_ts")


def incremental_load_drain(spark: SparkSession, folder: str) -> DataFrame:
    """Rounds until dry, then the loaded table by day."""
    table = f"{scratch_database(spark, 'ingest')}.raw_data"
    rounds = list(ingest.drain(spark, trips(spark, folder), "pickup_ts", table))
    return (
        spark.table(table)
        .groupBy(F.to_date("pickup_ts").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("pickup_ts").alias("min_ts"),
            F.max("pickup_ts").alias("max_ts"),
        )
        .withColumn("n_rounds", F.lit(len(rounds)).cast("bigint"))
    )


def incremental_load_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Two scheduled runs and a drain of the rest, each starting where the manifest ends."""
    table = f"{scratch_database(spark, 'manifest')}.raw_data"
    facts = trips(spark, folder)
    for _ in range(2):
        manifest.scheduled_run(spark, facts, "pickup_ts", table)
    manifest.drain(spark, facts, "pickup_ts", table)
    by_day = manifest.loads(spark, table).groupBy(F.col("dt").alias("day")).agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_ts").alias("min_ts"), F.max("last_ts").alias("max_ts")
    )
    rows = manifest.loaded(spark, table).groupBy(F.to_date("pickup_ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    n_rounds = manifest.loads(spark, table).select("load").distinct().count()
    checked = by_day.join(rows, "day").where(F.col("n") == F.col("n_rows")).drop("n")
    return checked.withColumn("n_rounds", F.lit(n_rounds).cast("bigint"))


# -- windowed features --------------------------------------------------------


def pickup(spark: SparkSession, folder: str) -> DataFrame:
    return pickup_features(trips(spark, folder))


def pickup_preaggregated(spark: SparkSession, folder: str) -> DataFrame:
    return pickup_features(trips(spark, folder), pre_aggregate=True)


def pickup_in_range(spark: SparkSession, folder: str) -> DataFrame:
    return pickup_features(trips(spark, folder), "pickup_ts", "2024-01-01", "2024-01-16")


def dropoff(spark: SparkSession, folder: str) -> DataFrame:
    return dropoff_features(trips(spark, folder))


def rides_by_weekend(spark: SparkSession, folder: str) -> DataFrame:
    features = dropoff_features(trips(spark, folder))
    return (
        features.filter(F.col("dropoff_is_weekend").isNotNull())
        .groupBy("dropoff_is_weekend")
        .agg(F.sum("count_trips_window_30m_dropoff_zip").alias("num_rides"))
    )


def rides_by_weekend_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same report as SQL on the stored feature table."""
    table = dropoff_table(spark, scratch_database(spark, "report"))
    table.write(dropoff_features(trips(spark, folder)), "overwrite")
    return spark.sql(
        f"SELECT sum(count_trips_window_30m_dropoff_zip) AS num_rides, dropoff_is_weekend "
        f"FROM {table.name} WHERE dropoff_is_weekend IS NOT NULL GROUP BY dropoff_is_weekend"
    )


def order_features_30d(spark: SparkSession, folder: str) -> DataFrame:
    return windowed_features(
        read_table(spark, folder, "orders"),
        {"o_custkey": "custkey"},
        "o_orderdate",
        "30 days",
        {
            "n_orders": Measure("count", None, "int"),
            "mean_price": Measure("mean", "o_totalprice", "float"),
            "min_price": Measure("min", "o_totalprice"),
            "max_price": Measure("max", "o_totalprice"),
            "sum_price": Measure("sum", "o_totalprice", "float"),
        },
        slide="10 days",
    )


# -- lookups ------------------------------------------------------------------


def _pickup_lookup(spark: SparkSession, folder: str, **options) -> DataFrame:
    facts = trips(spark, folder)
    return lookup_at_time(
        facts,
        pickup_features(facts),
        ["pickup_zip"],
        "pickup_ts",
        ["zip"],
        "ts",
        PICKUP_NAMES,
        PitOptions(matched_ts="feature_ts", **options),
    )


def pit_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return _pickup_lookup(spark, folder)


def pit_lookup_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    return _pickup_lookup(spark, folder, allow_exact=True)


def pit_lookup_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    return _pickup_lookup(spark, folder, strategy="bucketed", bucket="1 day")


def pit_lookup_split(spark: SparkSession, folder: str) -> DataFrame:
    """Hot keys cut at measured times; the low limit makes most keys hot here."""
    return _pickup_lookup(spark, folder, strategy="split", max_group_rows=100)


def pit_lookup_max_age(spark: SparkSession, folder: str) -> DataFrame:
    return _pickup_lookup(spark, folder, max_age="6 hours")


def _tied_lookup(spark: SparkSession, folder: str, **options) -> DataFrame:
    facts = trips(spark, folder)
    return lookup_at_time(
        with_lookup_time(facts),
        pickup_features(facts),
        ["pickup_zip"],
        "lookup_ts",
        ["zip"],
        "ts",
        PICKUP_NAMES,
        PitOptions(matched_ts="feature_ts", **options),
    )


def pit_lookup_ties_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _tied_lookup(spark, folder)


def pit_lookup_ties_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    return _tied_lookup(spark, folder, allow_exact=True)


def pit_lookup_ties_split(spark: SparkSession, folder: str) -> DataFrame:
    return _tied_lookup(spark, folder, allow_exact=True, strategy="split", max_group_rows=100)


def key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = read_table(spark, folder, "nation")
    return lookup_by_key(customers, nations, ["c_nationkey"], ["n_nationkey"], ["n_name", "n_regionkey"])


def region_join(spark: SparkSession, folder: str) -> DataFrame:
    points = read_table(spark, folder, "events").select(
        "event_id",
        (F.lit(40.0) + (F.col("event_id") % 1000).cast("double") / 1000).alias("lat"),
        (F.lit(-74.0) + (F.col("event_id") * 7 % 1000).cast("double") / 1000).alias("lon"),
    )
    zips = spark.range(100).select(
        F.col("id").cast("int").alias("zip"),
        (F.lit(40.0) + F.floor(F.col("id") / 10).cast("double") / 10).alias("lat_lo"),
        (F.lit(40.0) + (F.floor(F.col("id") / 10) + 1).cast("double") / 10).alias("lat_hi"),
        (F.lit(-74.0) + (F.col("id") % 10).cast("double") / 10).alias("lon_lo"),
        (F.lit(-74.0) + (F.col("id") % 10 + 1).cast("double") / 10).alias("lon_hi"),
    )
    return join_regions(points, zips, cell=0.1).select("event_id", "zip")


def training_set(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    return fare_training_set(facts, frame_lookups(facts)).load_df()


def training_set_split(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    options = PitOptions(strategy="split", max_group_rows=100)
    return fare_training_set(facts, frame_lookups(facts, options)).load_df()


#: Corners of a concave outline inside a square of side 0.2.
ARROW = [(0.01, 0.01), (0.19, 0.02), (0.12, 0.1), (0.18, 0.19), (0.02, 0.17), (0.07, 0.09)]


def region_join_polygons(spark: SparkSession, folder: str) -> DataFrame:
    """Events as points in one outline for each nation."""
    points = read_table(spark, folder, "events").select(
        "event_id",
        (F.lit(40.0) + (F.col("event_id") % 1000).cast("double") / 1000).alias("lat"),
        (F.lit(-74.0) + (F.col("event_id") * 7 % 997).cast("double") / 997).alias("lon"),
    )
    key = F.col("n_nationkey")
    left = F.lit(-74.0) + (key % 5).cast("double") * F.lit(0.2)
    low = F.lit(40.0) + F.floor(key / 5).cast("double") * F.lit(0.2)
    corners = [F.struct((left + F.lit(x)).alias("x"), (low + F.lit(y)).alias("y")) for x, y in ARROW]
    outlines = read_table(spark, folder, "nation").select(key.alias("nation"), F.array(*corners).alias("ring"))
    return outline_join(points, outlines, cell=0.03).select("event_id", "nation")


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return with_split(trips(spark, folder), ["trip_id"]).select("trip_id", "split")


def training_matrix(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    rows = fare_training_set(facts, frame_lookups(facts))
    columns = [c for c in rows.feature_columns if c != "trip_id"]
    split = with_split(rows.load_df(), ["trip_id"])
    return fill_missing(split, columns, keep=["trip_id", "fare_amount", "split"])


# -- feature tables -----------------------------------------------------------


def feature_table_describe(spark: SparkSession, folder: str) -> DataFrame:
    table = pickup_table(spark, scratch_database(spark, "describe"))
    table.write(pickup_features(trips(spark, folder)), "overwrite")
    return table.describe(spark)


def feature_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table of all trips but those of the last days, replaced by all but those of the first ten.

    The days that only the first one had must go."""
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "overwrite"))
    table.write(pickup_features(facts, "pickup_ts", None, "2024-01-27"), "overwrite")
    table.write(pickup_features(facts, "pickup_ts", "2024-01-11"), "overwrite")
    return table.read(spark)


def feature_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The same two batches, the second one merged."""
    facts = trips(spark, folder)
    table = pickup_table(spark, scratch_database(spark, "merge"))
    table.write(pickup_features(facts, "pickup_ts", None, "2024-01-16"))
    table.write(pickup_features(facts, "pickup_ts", "2024-01-11"))
    return table.read(spark)


def pk_violations(spark: SparkSession, folder: str) -> DataFrame:
    rows = trips(spark, folder).select(
        F.expr("nullif(pickup_zip, dropoff_zip)").alias("zip"),
        F.window("pickup_ts", "1 hour")["start"].alias("ts"),
    )
    return key_violations(rows, ["zip", "ts"])


def change_feed(spark: SparkSession, folder: str) -> DataFrame:
    facts = trips(spark, folder)
    old = pickup_features(facts, "pickup_ts", None, "2024-01-21 10:07:00")
    new = pickup_features(facts, "pickup_ts", "2024-01-11 10:07:00")
    return changes_between(old, new, ["zip", "ts"])


def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return newest_rows(pickup_features(trips(spark, folder)), ["zip"], "ts", PICKUP_NAMES)


def latest_snapshot_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Publish, add a newer batch, publish again, then replay the first batch."""
    facts = trips(spark, folder)
    database = scratch_database(spark, "publish")
    table, online = pickup_table(spark, database), online_table(spark, database)
    table.write(pickup_features(facts, "pickup_ts", None, "2024-01-16"))
    table.publish(spark, online)
    table.write(pickup_features(facts, "pickup_ts", "2024-01-16"), "overwrite")
    table.publish(spark, online)
    table.write(pickup_features(facts, "pickup_ts", None, "2024-01-16"), "overwrite")
    table.publish(spark, online)  # older rows change nothing
    return online.read(spark)


def feature_incremental_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Features up to a cut inside a window, then the rest: equal to all at once."""
    facts = trips(spark, folder)
    cut = "2024-01-15 10:07:00"
    table = pickup_table(spark, scratch_database(spark, "refresh"))
    table.write(pickup_features(facts, "pickup_ts", None, cut))
    refresh(table, facts, pickup_features, "pickup_ts", PICKUP_WINDOW, after=cut)
    return table.read(spark)


QUERIES = {
    "training_set": training_set,
    "training_set_split": training_set_split,
    "ts_range_filter": ts_range_filter,
    "ts_range_filter_open_end": ts_range_filter_open_end,
    "hash_sample": sample_by_hash,
    "weekend_flag": weekend_flag,
    "ts_bounds": ts_bounds,
    "initial_load": initial_load,
    "incremental_load_step": incremental_load_step,
    "incremental_load_drain": incremental_load_drain,
    "incremental_load_manifest": incremental_load_manifest,
    "pickup_features": pickup,
    "pickup_features_preaggregated": pickup_preaggregated,
    "pickup_features_range": pickup_in_range,
    "dropoff_features": dropoff,
    "rides_by_weekend": rides_by_weekend,
    "rides_by_weekend_sql": rides_by_weekend_sql,
    "order_features_30d": order_features_30d,
    "pit_lookup": pit_lookup,
    "pit_lookup_inclusive": pit_lookup_inclusive,
    "pit_lookup_bucketed": pit_lookup_bucketed,
    "pit_lookup_split": pit_lookup_split,
    "pit_lookup_max_age": pit_lookup_max_age,
    "pit_lookup_ties_strict": pit_lookup_ties_strict,
    "pit_lookup_ties_inclusive": pit_lookup_ties_inclusive,
    "pit_lookup_ties_split": pit_lookup_ties_split,
    "key_lookup": key_lookup,
    "region_join": region_join,
    "region_join_polygons": region_join_polygons,
    "train_test_split": train_test_split,
    "training_matrix": training_matrix,
    "feature_table_describe": feature_table_describe,
    "feature_overwrite": feature_overwrite,
    "feature_merge": feature_merge,
    "pk_violations": pk_violations,
    "change_feed": change_feed,
    "latest_snapshot": latest_snapshot,
    "latest_snapshot_merge": latest_snapshot_merge,
    "feature_incremental_refresh": feature_incremental_refresh,
}
