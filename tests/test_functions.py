from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from helpers import SMALL, at, plan_of, rows_of
from tidemark.functions.calendar import is_weekend
from tidemark.functions.hashing import hash_sample, train_test_split, with_split
from tidemark.functions.timefilter import ts_range
from tidemark.sources.trips import trips


def test_range_bounds_are_optional_and_half_open(spark):
    df = spark.createDataFrame([(at("00:00"),), (at("01:00"),), (at("02:00"),)], "ts timestamp_ntz")
    assert ts_range(df, "ts", at("01:00"), at("02:00")).count() == 1
    assert ts_range(df, "ts", at("01:00")).count() == 2
    assert ts_range(df, "ts", end=at("01:00")).count() == 1
    assert ts_range(df, None, at("01:00"), at("02:00")).count() == 3
    assert ts_range(df, "ts").count() == 3


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_range_bound_kinds(spark, kind):
    df = spark.sql(
        f"SELECT cast(t AS {kind}) AS ts FROM VALUES ('2024-01-01 23:30:00'), ('2024-01-02 00:30:00') v(t)"
    )
    aware = datetime(2024, 1, 2, 1, 0, tzinfo=timezone(timedelta(hours=1)))
    for bound in ("2024-01-02", date(2024, 1, 2), datetime(2024, 1, 2), aware):
        assert ts_range(df, "ts", bound).count() == 1


def test_range_on_date_column(spark):
    df = spark.sql("SELECT DATE'2024-01-01' AS d UNION ALL SELECT DATE'2024-01-02'")
    assert ts_range(df, "d", "2024-01-02").count() == 1
    assert ts_range(df, "d", datetime(2024, 1, 1, 12)).count() == 1


def test_range_reaches_the_scan(spark):
    df = ts_range(trips(spark, SMALL), "pickup_ts", datetime(2024, 1, 5), "2024-01-06").select("trip_id")
    plan = plan_of(df)
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


@pytest.mark.parametrize("zone", ["UTC", "Australia/Sydney"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_weekend_flag_over_a_year(spark, zone, kind):
    """Both clock changes, both timestamp types, any session zone."""
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    instants = [start + timedelta(minutes=30 * i) for i in range(366 * 48)]
    local = ZoneInfo("America/New_York")
    expected = {int(t.timestamp()): int(t.astimezone(local).weekday() >= 5) for t in instants}
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        secs = spark.range(len(instants)).select((F.col("id") * 1800 + int(start.timestamp())).alias("s"))
        ts = F.timestamp_seconds("s")
        if kind == "timestamp_ntz":
            ts = F.expr("timestamp_ntz'1970-01-01' + make_dt_interval(0, 0, 0, s)")
        df = secs.withColumn("ts", ts)
        flagged = df.select("s", is_weekend(F.col("ts"), df.schema["ts"].dataType).alias("w"))
        assert {r["s"]: r["w"] for r in flagged.collect()} == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_weekend_flag_edges_and_null(spark):
    texts = [
        ("2024-01-06 04:59:00", 0),
        ("2024-01-06 05:00:00", 1),
        ("2024-07-06 03:59:00", 0),
        ("2024-07-06 04:00:00", 1),
        (None, None),
    ]
    df = spark.createDataFrame(
        [(at(t) if t else None, w) for t, w in texts], "ts timestamp_ntz, w int"
    )
    flag = is_weekend(F.col("ts"), df.schema["ts"].dataType)
    assert df.filter(~flag.eqNullSafe(F.col("w"))).count() == 0
    assert "EvalPython" not in plan_of(df.select(flag))


def test_split_survives_repartitioning(spark):
    df = trips(spark, SMALL).select("trip_id", "fare_amount")
    train, test = train_test_split(df, ["trip_id"])
    moved_train, moved_test = train_test_split(df.repartition(7), ["trip_id"])
    assert rows_of(train) == rows_of(moved_train)
    assert rows_of(test) == rows_of(moved_test)
    assert train.count() + test.count() == df.count()
    assert 0.7 < train.count() / df.count() < 0.8
    labelled = with_split(df, ["trip_id"])
    assert labelled.filter("split = 'train'").count() == train.count()


def test_sample_is_repeatable_and_nested(spark):
    df = trips(spark, SMALL).select("trip_id")
    small = {r[0] for r in hash_sample(df, ["trip_id"], 0.1).collect()}
    large = {r[0] for r in hash_sample(df.repartition(5), ["trip_id"], 0.3).collect()}
    assert small < large
    assert hash_sample(df, ["trip_id"], 1.0).count() == df.count()
    with pytest.raises(ValueError):
        hash_sample(df, ["trip_id"], 1.5)
