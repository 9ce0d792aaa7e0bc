from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SMALL, at, plan_of, rows_of
from tidemark.operators.changes import change_feed
from tidemark.operators.refresh import refresh, refreshed_features
from tidemark.operators.regions import region_join
from tidemark.operators.tables import FeatureTable, KeyViolation, key_violations, latest_snapshot, merge_rows
from tidemark.operators.windows import PICKUP_WINDOW, pickup_features
from tidemark.plans.common import online_table, pickup_table
from tidemark.session import estimated_bytes
from tidemark.sources.trips import trips

SCHEMA = "zip int, ts timestamp_ntz, f int"
DAY2 = "2024-01-02 06:00:00"


@pytest.fixture
def table(spark, database):
    return FeatureTable.define(f"{database}.features", ["zip"], SCHEMA, "ts", "it's a test").create(spark)


def batch(spark, *rows):
    return spark.createDataFrame([(z, at(t) if t else None, f) for z, t, f in rows], SCHEMA)


def test_spec_round_trip_and_describe(spark, table):
    loaded = FeatureTable.load(spark, table.name)
    assert (loaded.keys, loaded.ts, loaded.features) == (("zip",), "ts", ["f"])
    table.write(batch(spark, (1, "01:00", None), (1, "02:00", 5)))
    assert rows_of(loaded.describe(spark)) == [
        ("f", "int", "feature", 2, 1),
        ("ts", "timestamp_ntz", "time key", 2, 0),
        ("zip", "int", "key", 2, 0),
    ]


def test_definition_errors():
    with pytest.raises(ValueError, match="missing"):
        FeatureTable.define("t", ["zip"], "a int")
    with pytest.raises(ValueError, match="timestamp"):
        FeatureTable.define("t", ["zip"], "zip int, ts string", "ts")
    with pytest.raises(ValueError, match="reserved"):
        FeatureTable.define("t", ["zip"], "zip int, ts date, dt date", "ts")


def test_merge_inserts_replaces_and_keeps(spark, table):
    table.write(batch(spark, (1, "01:00", 1), (2, "01:00", 2), (3, DAY2, 3)))
    change = batch(spark, (1, "01:00", None), (4, "01:00", 4))
    table.write(change)
    expected = sorted(
        [(1, at("01:00"), None), (2, at("01:00"), 2), (3, at(DAY2), 3), (4, at("01:00"), 4)], key=repr
    )
    assert rows_of(table.read(spark)) == expected
    table.write(change)
    assert rows_of(table.read(spark)) == expected


def test_merge_rewrites_only_touched_days(spark, table):
    table.write(batch(spark, (1, "01:00", 1), (3, DAY2, 3)))
    files = lambda: {f for f in spark.table(table.name).inputFiles() if "dt=2024-01-02" in f}
    before = files()
    table.write(batch(spark, (1, "05:00", 9)))
    assert files() == before and before


def test_overwrite_drops_stale_days_and_may_read_itself(spark, table):
    table.write(batch(spark, (1, "01:00", 1), (3, DAY2, 3)), "overwrite")
    table.write(table.read(spark).filter("zip = 3").withColumn("f", F.col("f") + 1), "overwrite")
    assert rows_of(table.read(spark)) == [(3, at(DAY2), 4)]
    table.write(table.read(spark).filter("false"), "overwrite")
    assert table.read(spark).count() == 0


@pytest.mark.parametrize("mode", ["merge", "overwrite"])
def test_broken_keys_are_named_and_nothing_is_written(spark, table, mode):
    table.write(batch(spark, (1, "01:00", 1)))
    with pytest.raises(KeyViolation, match="'zip': 7"):
        table.write(batch(spark, (7, "01:00", 1), (7, "01:00", 2)), mode)
    with pytest.raises(KeyViolation, match="null key"):
        table.write(batch(spark, (None, "01:00", 1)), mode)
    with pytest.raises(KeyViolation, match="null key"):
        table.write(batch(spark, (1, None, 1)), mode)
    assert rows_of(table.read(spark)) == [(1, at("01:00"), 1)]
    assert not [t.name for t in spark.catalog.listTables(table.name.split(".")[0]) if t.name.startswith("stage")]


def test_size_is_known_after_overwrite_and_cleared_by_merge(spark, table):
    table.write(batch(spark, (1, "01:00", 1), (3, DAY2, 3)), "overwrite")
    assert 0 < estimated_bytes(table.read(spark)) < 100_000
    table.write(batch(spark, (1, "05:00", 9)))
    assert estimated_bytes(table.read(spark)) > 1 << 60
    table.analyze(spark)
    assert 0 < estimated_bytes(table.read(spark)) < 100_000


def test_session_setting_is_restored(spark, table):
    option = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(option)
    table.write(batch(spark, (1, "01:00", 1)))
    assert spark.conf.get(option) == before


def test_read_range_prunes_days(spark, table):
    table.write(batch(spark, (1, "01:00", 1), (3, DAY2, 3)))
    part = table.read(spark, "2024-01-02", "2024-01-03")
    assert rows_of(part) == [(3, at(DAY2), 3)]
    assert "PartitionFilters: [isnotnull(dt" in plan_of(part)


def test_violations_report(spark):
    df = batch(spark, (1, "01:00", 1), (1, "01:00", 2), (None, "01:00", 3), (2, "01:00", 4))
    assert rows_of(key_violations(df, ["zip", "ts"])) == sorted(
        [(1, at("01:00"), 2, "duplicate key"), (None, at("01:00"), 1, "null key")], key=repr
    )


def test_promote_checks_the_key_and_copies(spark, database):
    good = batch(spark, (1, "01:00", 1), (2, DAY2, 2))
    good.write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError, match="not partitioned"):
        FeatureTable.promote(spark, f"{database}.plain", ["zip"], "ts")
    made = FeatureTable.promote(spark, f"{database}.plain", ["zip"], "ts", into=f"{database}.keyed")
    assert rows_of(made.read(spark)) == rows_of(good)
    good.withColumn("dt", F.to_date("ts")).write.partitionBy("dt").saveAsTable(f"{database}.by_day")
    marked = FeatureTable.promote(spark, f"{database}.by_day", ["zip"], "ts")
    marked.write(batch(spark, (5, "03:00", 5)))
    assert FeatureTable.load(spark, f"{database}.by_day").read(spark).count() == 3
    good.union(good).write.saveAsTable(f"{database}.twice")
    with pytest.raises(KeyViolation):
        FeatureTable.promote(spark, f"{database}.twice", ["zip"], "ts", into=f"{database}.other")


def test_latest_snapshot_takes_whole_rows(spark):
    df = batch(spark, (1, "01:00", 1), (1, "02:00", None), (2, "01:00", 5))
    assert rows_of(latest_snapshot(df, ["zip"], "ts", ["f"])) == sorted(
        [(1, at("02:00"), None), (2, at("01:00"), 5)], key=repr
    )
    plan = plan_of(latest_snapshot(pickup_features(trips(spark, SMALL)), ["zip"], "ts", ["count_trips_window_1h_pickup_zip"]))
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_publish_merges_and_ignores_older_rows(spark, database):
    facts = trips(spark, SMALL)
    source, online = pickup_table(spark, database), online_table(spark, database)
    source.write(pickup_features(facts))
    source.publish(spark, online)
    newest = latest_snapshot(source.read(spark), ["zip"], "ts", source.features)
    expected = rows_of(newest.select(*online.schema.names))
    assert rows_of(online.read(spark)) == expected
    source.write(pickup_features(facts, "pickup_ts", None, "2024-01-05"), "overwrite")
    source.publish(spark, online)
    assert rows_of(online.read(spark)) == expected
    source.publish(spark, online, "overwrite")
    assert online.read(spark).agg(F.max("ts")).first()[0] < at("2024-01-06")


VALUES = st.one_of(st.none(), st.integers(0, 3))
TABLES = st.dictionaries(st.integers(0, 6), VALUES, max_size=7)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(old=TABLES, new=TABLES)
def test_change_feed_and_merge_rows_against_brute_force(spark, old, new):
    frame = lambda d: spark.createDataFrame(list(d.items()), "k int, v int")
    expected = []
    for k in set(old) | set(new):
        if k not in old:
            expected.append((k, new[k], "insert"))
        elif k not in new:
            expected.append((k, old[k], "delete"))
        elif old[k] != new[k]:
            expected += [(k, old[k], "update_preimage"), (k, new[k], "update_postimage")]
    feed = change_feed(frame(old), frame(new), ["k"])
    assert rows_of(feed) == sorted(expected, key=repr)
    assert rows_of(merge_rows(frame(old), frame(new), ["k"])) == sorted((old | new).items(), key=repr)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(minute=st.integers(0, 29 * 24 * 60))
def test_refresh_equals_recompute_for_any_cut(spark, minute):
    from datetime import timedelta

    facts = trips(spark, SMALL)
    cut = at("00:00") + timedelta(minutes=minute, seconds=17)
    whole = pickup_features(facts)
    stored = pickup_features(facts, "pickup_ts", None, cut)
    fresh = refreshed_features(facts, pickup_features, "pickup_ts", PICKUP_WINDOW, cut)
    merged = merge_rows(stored, fresh, ["zip", "ts"])
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


def test_bounded_refresh_touches_only_its_range(spark, database):
    facts = trips(spark, SMALL)
    table = pickup_table(spark, database)
    whole = pickup_features(facts)
    broken = whole.withColumn(
        "count_trips_window_1h_pickup_zip",
        F.when(F.to_date("ts") == "2024-01-10", 0).otherwise(F.col("count_trips_window_1h_pickup_zip")),
    )
    table.write(broken)
    refresh(
        table, facts, pickup_features, "pickup_ts", PICKUP_WINDOW, "2024-01-09 23:00:00", "2024-01-11 00:00:00"
    )
    assert table.read(spark).exceptAll(whole).count() == 0
    assert table.read(spark).count() == whole.count()


def test_adjacent_ranges_without_care_damage_the_edge(spark):
    """What refresh is for: merging plain ranges replaces full windows by partial ones."""
    events = spark.createDataFrame(
        [(1, at("00:50"), 1.0), (1, at("01:10"), 3.0)], "pickup_zip int, pickup_ts timestamp_ntz, fare_amount double"
    )
    cut = at("01:00")
    old = pickup_features(events, "pickup_ts", None, cut)
    careless = merge_rows(old, pickup_features(events, "pickup_ts", cut), ["zip", "ts"])
    careful = merge_rows(
        old, refreshed_features(events, pickup_features, "pickup_ts", PICKUP_WINDOW, cut), ["zip", "ts"]
    )
    assert careless.exceptAll(pickup_features(events)).count() > 0
    assert careful.exceptAll(pickup_features(events)).count() == 0


def test_region_join_edges_overlaps_and_plan(spark):
    points = spark.createDataFrame(
        [(1, 0.0, 0.0), (2, 0.1, 0.05), (3, 0.25, 0.25), (4, 9.0, 9.0), (5, -0.05, -0.05)],
        "id int, lat double, lon double",
    )
    boxes = spark.createDataFrame(
        [("a", 0.0, 0.1, 0.0, 0.1), ("b", 0.1, 0.2, 0.0, 0.1), ("big", -0.3, 0.3, -0.3, 0.3)],
        "zip string, lat_lo double, lat_hi double, lon_lo double, lon_hi double",
    )
    out = region_join(points, boxes, cell=0.1).select("id", "zip")
    assert rows_of(out) == sorted(
        [(1, "a"), (1, "big"), (2, "b"), (2, "big"), (3, "big"), (4, None), (5, "big")], key=repr
    )
    assert "NestedLoop" not in plan_of(out)
