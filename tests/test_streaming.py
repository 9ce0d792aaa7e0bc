from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import SMALL, at, rows_of
from tidemark.functions.timefilter import ts_range
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, add_features
from tidemark.operators.windows import PICKUP_MEASURES, PICKUP_SLIDE, PICKUP_WINDOW, dropoff_features, pickup_features
from tidemark.plans.common import dropoff_table, pickup_table
from tidemark.plans.streams import run_in_slices
from tidemark.session import scratch_path
from tidemark.sources.trips import trips
from tidemark.streaming import features as stream

TRIP = "pickup_zip int, pickup_ts timestamp_ntz, fare_amount double"


def land(spark, path, *rows):
    spark.createDataFrame([(z, at(t), f) for z, t, f in rows], TRIP).coalesce(1).write.mode("append").parquet(path)


def run_pickup(spark, path, table, checkpoint, **options):
    source = stream.file_stream(spark, path, spark.createDataFrame([], TRIP).schema)
    return stream.stream_features(source, pickup_features, "pickup_ts", table, checkpoint, **options)


@pytest.mark.parametrize("kind", ["pickup", "dropoff"])
def test_stream_equals_batch_over_ordered_files(spark, database, kind):
    facts = trips(spark, SMALL)
    make, build, ts = (
        (pickup_table, pickup_features, "pickup_ts")
        if kind == "pickup"
        else (dropoff_table, dropoff_features, "dropoff_ts")
    )
    table, checkpoint = make(spark, database), scratch_path(spark, "checkpoint")

    def run(landing):
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_features(source, build, ts, table, checkpoint)

    run_in_slices(spark, facts, ts, run, slices=4)
    assert rows_of(table.read(spark)) == rows_of(build(facts))


def test_a_window_filled_over_two_batches_is_replaced(spark, database, tmp_path):
    table = pickup_table(spark, database)
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    land(spark, path, (1, "01:00", 2.0))
    run_pickup(spark, path, table, checkpoint)
    land(spark, path, (1, "01:20", 4.0))
    run_pickup(spark, path, table, checkpoint)
    got = {r["ts"]: (r[2], r[3]) for r in table.read(spark).collect()}
    assert got[at("01:15")] == (2.0, 1) and got[at("01:30")] == (3.0, 2) and got[at("02:15")] == (4.0, 1)


def test_a_replayed_micro_batch_changes_nothing(spark, database):
    facts = trips(spark, SMALL)
    table = pickup_table(spark, database)
    built = pickup_features(facts)
    table.merge(built)
    before = rows_of(table.read(spark))
    table.merge(pickup_features(facts))
    assert rows_of(table.read(spark)) == before


def test_rows_past_the_watermark_come_in_by_reconcile(spark, database, tmp_path):
    table = pickup_table(spark, database)
    path, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    land(spark, path, (1, "01:00", 2.0), (1, "2024-01-02 12:00:00", 2.0))
    run_pickup(spark, path, table, checkpoint)
    land(spark, path, (1, "2024-01-02 12:10:00", 2.0))
    on_time = run_pickup(spark, path, table, checkpoint)
    land(spark, path, (1, "01:05", 6.0))
    late = run_pickup(spark, path, table, checkpoint)
    assert stream.dropped_by_watermark(on_time) == 0
    assert stream.dropped_by_watermark(late) == 4
    facts = spark.read.parquet(path)
    whole = pickup_features(facts)
    assert table.read(spark).exceptAll(whole).count() == 4
    fixed = stream.reconcile(
        table, facts, pickup_features, "pickup_ts", PICKUP_WINDOW, "2024-01-01", "2024-01-02"
    )
    assert fixed == 4
    assert rows_of(table.read(spark)) == rows_of(whole)
    again = stream.reconcile(
        table, facts, pickup_features, "pickup_ts", PICKUP_WINDOW, "2024-01-01", "2024-01-02"
    )
    assert again == 0


def test_reconcile_removes_windows_that_no_fact_supports_and_stays_in_its_range(spark, database, tmp_path):
    table = pickup_table(spark, database)
    facts = spark.createDataFrame([(1, at("01:00"), 2.0)], TRIP)
    table.merge(pickup_features(facts))
    phantom = [(9, at("2024-01-01 05:00:00"), 1.0, 1), (9, at("2024-01-05 05:00:00"), 1.0, 1)]
    table.merge(spark.createDataFrame(phantom, table.schema))
    fixed = stream.reconcile(
        table, facts, pickup_features, "pickup_ts", PICKUP_WINDOW, "2023-12-31", "2024-01-02"
    )
    assert fixed == 1
    kept = table.read(spark).filter("zip = 9").select("ts").collect()
    assert [r[0] for r in kept] == [at("2024-01-05 05:00:00")]


def test_write_accepts_a_stream_in_merge_mode_only(spark, database, tmp_path):
    table = FeatureTable.define(f"{database}.raw", ["pickup_zip"], TRIP, "pickup_ts").create(spark)
    path = str(tmp_path / "in")
    land(spark, path, (1, "01:00", 2.0), (2, "01:00", 3.0))
    source = stream.file_stream(spark, path, table.schema)
    with pytest.raises(ValueError, match="only be merged"):
        table.write(source, "overwrite")
    table.write(source, "merge", checkpoint=str(tmp_path / "cp"))
    assert rows_of(table.read(spark)) == [(1, at("01:00"), 2.0), (2, at("01:00"), 3.0)]


def test_ingest_takes_each_row_once_and_late_files_too(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = spark.createDataFrame([], TRIP).schema
    land(spark, path, (1, "2024-01-20 01:00:00", 2.0))
    stream.stream_ingest(stream.file_stream(spark, path, schema), out, checkpoint)
    land(spark, path, (2, "01:00", 3.0))
    for _ in range(2):
        stream.stream_ingest(stream.file_stream(spark, path, schema), out, checkpoint)
    assert rows_of(spark.read.parquet(out)) == rows_of(spark.read.parquet(path))


def test_enrichment_equals_batch_lookup(spark, database, tmp_path):
    facts = trips(spark, SMALL)
    table = pickup_table(spark, database)
    table.write(pickup_features(facts))
    lookups = [FeatureLookup(table.features, ["pickup_zip"], "pickup_ts", table.name)]
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    for low, high in (("2024-01-01", "2024-01-10"), ("2024-01-10", None)):
        ts_range(facts, "pickup_ts", low, high).write.mode("append").parquet(landing)
        source = stream.file_stream(spark, landing, facts.schema)
        stream.stream_enrich(source, lookups, out, str(tmp_path / "cp"))
    enriched = spark.read.parquet(out)
    assert enriched.select("batch_id").distinct().count() == 2
    assert rows_of(enriched.drop("batch_id")) == rows_of(add_features(facts, lookups))


def test_zoneless_streams_need_a_utc_session(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
    try:
        with pytest.raises(ValueError, match="UTC"):
            stream.zoned(spark.createDataFrame([], TRIP))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert dict(stream.zoned(spark.createDataFrame([], TRIP)).dtypes)["pickup_ts"] == "timestamp"
    assert stream.zoned(spark.range(1).select(F.current_timestamp().alias("t"))).dtypes == [("t", "timestamp")]


def test_late_windows_are_listed_and_repaired_alone(spark, database, tmp_path):
    """Micro-batches in wrong order: the sums of the last one are dropped by the watermark."""
    schema = "trip_id int, pickup_zip int, pickup_ts timestamp_ntz, fare_amount double"
    early = [(i, i % 4, at(f"2024-01-02 {i % 5:02d}:10:00"), float(i)) for i in range(20)]
    recent = [(100 + i, i % 4, at(f"2024-01-05 {i % 5:02d}:10:00"), float(i)) for i in range(20)]
    last = [(200, 1, at("2024-01-05 04:40:00"), 3.0)]
    table = pickup_table(spark, database)
    late = stream.LateWindows(str(tmp_path / "late"), {"pickup_zip": "zip"}, PICKUP_WINDOW, PICKUP_SLIDE)
    landing, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    listed = []
    for rows in (recent, last, early):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        source = stream.file_stream(spark, landing, schema)
        stream.stream_features(source, pickup_features, "pickup_ts", table, checkpoint, late=late)
        listed.append(late.listed(spark, table).count())
    expected = pickup_features(spark.createDataFrame(early + recent + last, schema))
    lost = pickup_features(spark.createDataFrame(early, schema))
    assert listed == [0, 0, lost.count()]
    names = ["zip", "ts", *PICKUP_MEASURES]
    assert rows_of(table.read(spark).select(*names)) == rows_of(expected.join(lost, ["zip", "ts"], "left_anti").select(*names))
    facts = spark.createDataFrame(early + recent + last, schema)
    assert late.repair(table, facts, pickup_features, "pickup_ts") == lost.count()
    assert rows_of(table.read(spark).select(*names)) == rows_of(expected.select(*names))
    assert late.repair(table, facts, pickup_features, "pickup_ts") == 0
