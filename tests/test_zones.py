"""Stored tables, lookups and loads do not depend on the session zone, nor on clock changes."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from tidemark.functions.timefilter import aggregated_times, utc_day
from tidemark.operators.lookup import PitOptions
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, create_training_set
from tidemark.operators.windows import Measure, windowed_features
from tidemark.sources.ingest import drain, incremental_load_step, initial_load, loaded_until

SYDNEY = "Australia/Sydney"
#: Clock changes of that zone: an hour repeated in April, one left out in October.
CHANGES = ["2024-04-06", "2024-10-05"]
SCHEMA = "zip int, ts timestamp, v int"


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def frame(spark, rows):
    return spark.createDataFrame([(z, int(t.timestamp() * 1e6), v) for z, t, v in rows], "zip int, m long, v int").select(
        "zip", F.timestamp_micros("m").alias("ts"), "v"
    )


def stored(spark, database, name="zoned"):
    return FeatureTable.define(f"{database}.{name}", ["zip"], SCHEMA, "ts").create(spark)


@pytest.mark.parametrize("day", CHANGES)
def test_merge_and_range_read_under_two_zones(spark, database, zone, day):
    table = stored(spark, database)
    hours = [(1, utc(f"{day} {h:02d}:10"), h) for h in range(10, 22)]
    zone("UTC")
    table.merge(frame(spark, hours))
    zone(SYDNEY)
    table.merge(frame(spark, [(z, t, v + 100) for z, t, v in hours]))
    for name in (SYDNEY, "UTC", "America/Los_Angeles"):
        zone(name)
        got = table.read(spark)
        assert rows_of(got.select("v")) == [(v + 100,) for _, _, v in hours]
        some = table.read(spark, utc(f"{day} 14:00"), utc(f"{day} 17:00"))
        assert rows_of(some.select("v")) == [(114,), (115,), (116,)]


@pytest.mark.parametrize("limit", [1 << 30, 0])
@pytest.mark.parametrize("day", CHANGES)
def test_lookup_in_a_stored_table(spark, database, zone, day, limit):
    table = stored(spark, database)
    zone("UTC")
    table.merge(frame(spark, [(1, utc(f"{day} {h:02d}:10"), h) for h in range(8, 20)] + [(2, utc("2024-01-01 00:00"), 7)]))
    zone(SYDNEY)
    base = frame(spark, [(1, utc(f"{day} {h:02d}:30"), h) for h in range(14, 18)] + [(2, utc(f"{day} 14:00"), 0)])
    base = base.withColumnRenamed("v", "want").withColumnRenamed("ts", "at")
    lookup = FeatureLookup(["v"], ["zip"], "at", table.name, options=PitOptions(small_input_bytes=limit))
    got = create_training_set(base, [lookup], None).load_df()
    assert rows_of(got.select("zip", "want", "v")) == [(1, h, h) for h in range(14, 18)] + [(2, 0, 7)]


@pytest.mark.parametrize("day", CHANGES)
def test_incremental_load_takes_no_row_twice(spark, database, zone, day):
    zone(SYDNEY)
    rows = [(1, utc(f"{day} {h:02d}:{m}"), h) for h in range(24) for m in ("05", "35")]
    source = frame(spark, rows)
    rounds = list(drain(spark, source, "ts", f"{database}.raw"))
    loaded = spark.table(f"{database}.raw")
    assert rows_of(loaded) == rows_of(source) and sum(r.n_rows for r in rounds) == len(rows)
    assert loaded_until(loaded, "ts") == rows[-1][1]
    assert incremental_load_step(source, loaded, "ts").count() == 0
    first = initial_load(source, "ts", exact_midnight=True)
    assert rows_of(first.select(F.max("ts") <= F.to_timestamp(F.lit(str((datetime.fromisoformat(day)).date()) + " 23:59:59")))) != []


def test_utc_day_is_the_day_before_the_epoch_too(spark, zone):
    zone(SYDNEY)
    got = frame(spark, [(1, utc("1969-12-31 23:59"), 0), (2, utc("2024-04-06 23:59"), 0)]).select(
        utc_day(F.col("ts"), frame(spark, []).schema["ts"].dataType).cast("string")
    )
    assert rows_of(got) == [("1969-12-31",), ("2024-04-06",)]
    ends = aggregated_times(frame(spark, [(1, utc("2024-04-06 15:30"), 0)]), frame(spark, []).schema["ts"].dataType, F.max("ts"))
    assert ends == [utc("2024-04-06 15:30")]


@pytest.mark.parametrize("kind", ["int", "bigint", "float", "double", "decimal(10,2)", "decimal(38,6)"])
def test_both_window_forms_give_the_same_types_and_values(spark, kind):
    rows = [(k % 3, datetime(2024, 1, 1, 0, k % 60, 7), Decimal(k * 7 % 101) / 4) for k in range(90)] + [(1, datetime(2024, 1, 1), None)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, x decimal(20,2)").withColumn("x", F.col("x").cast(kind))
    measures = {f"{m}_x": Measure(m, "x") for m in ("count", "sum", "mean", "min", "max")} | {"n": Measure("count")}
    plain, slots = (
        windowed_features(df, ["k"], "t", "30 minutes", measures, slide="10 minutes", pre_aggregate=p) for p in (False, True)
    )
    assert plain.dtypes == slots.dtypes
    assert rows_of(plain) == rows_of(slots)


def test_lookups_meet_the_key_of_their_table(spark, database):
    table = stored(spark, database)
    table.merge(frame(spark, [(1, utc(f"2024-01-01 {h:02d}:00"), h) for h in range(5)]))
    base = spark.createDataFrame([(1,), (2,), (None,)], "zip int")
    got = create_training_set(base, [FeatureLookup(["v"], ["zip"], None, table.name)], None).load_df()
    assert rows_of(got) == [(1, 4), (2, None), (None, None)]
    plain = FeatureTable.define(f"{database}.plain", ["zip"], "zip int, v int").create(spark)
    timed = base.withColumn("at", F.lit(datetime(2024, 1, 1)))
    with pytest.raises(ValueError, match="no time key"):
        create_training_set(timed, [FeatureLookup(["v"], ["zip"], "at", plain.name)], None).load_df()


def test_promote_refuses_rows_in_wrong_partitions(spark, database):
    name = f"{database}.given"
    spark.sql(f"CREATE TABLE {name} (zip int, ts timestamp, v int, dt date) USING parquet PARTITIONED BY (dt)")
    rows = frame(spark, [(1, utc("2024-01-02 03:00"), 5)])
    rows.withColumn("dt", F.to_date(F.lit("2024-01-01"))).write.insertInto(name)
    with pytest.raises(ValueError, match="other partitions"):
        FeatureTable.promote(spark, name, ["zip"], "ts")
    table = FeatureTable.promote(spark, name, ["zip"], "ts", into=f"{database}.copied")
    table.merge(rows)
    assert table.read(spark).count() == 1


def test_delete_rewrites_only_what_is_needed(spark, database):
    table = stored(spark, database)
    table.merge(frame(spark, [(z, utc(f"2024-01-0{d} 03:00"), d) for z in (1, 2) for d in (1, 2, 3)]))
    table.delete(frame(spark, [(1, utc("2024-01-01 03:00"), 0), (1, utc("2024-01-02 03:00"), 0), (2, utc("2024-01-02 03:00"), 0)]))
    assert rows_of(table.read(spark).select("zip", "v")) == [(1, 3), (2, 1), (2, 3)]
    table.delete(frame(spark, []))
    assert table.read(spark).count() == 3
