from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SMALL, at, plan_of, rows_of
from tidemark.operators import windows
from tidemark.operators.windows import Measure, dropoff_features, pickup_features, slots_fit, windowed_features
from tidemark.sources.scan import preview
from tidemark.sources.trips import trips

TRIP = "pickup_zip int, pickup_ts timestamp_ntz, fare_amount double"


def test_edge_event_belongs_to_the_window_it_starts(spark):
    df = spark.createDataFrame([(1, at("00:30"))], "dropoff_zip int, dropoff_ts timestamp_ntz")
    assert [r["ts"] for r in dropoff_features(df).collect()] == [at("01:00")]


def test_one_event_gives_four_sliding_windows(spark):
    df = spark.createDataFrame([(1, at("01:00"), 10.0)], TRIP)
    out = pickup_features(df).orderBy("ts").collect()
    assert [r["ts"] for r in out] == [at("01:15"), at("01:30"), at("01:45"), at("02:00")]
    assert {(r[2], r[3]) for r in out} == {(10.0, 1)}


def test_null_time_gives_no_row_and_null_entity_its_own_group(spark):
    df = spark.createDataFrame([(1, None, 10.0), (None, at("01:00"), 5.0)], TRIP)
    out = pickup_features(df)
    assert {r["zip"] for r in out.collect()} == {None}
    assert out.count() == 4


def test_output_types(spark):
    out = pickup_features(trips(spark, SMALL))
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "timestamp_ntz", "float", "int"]
    out = dropoff_features(trips(spark, SMALL))
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "timestamp_ntz", "int", "int"]


def test_range_applies_before_windowing(spark):
    df = spark.createDataFrame([(1, at("00:50"), 1.0), (1, at("01:10"), 3.0)], TRIP)
    out = pickup_features(df, "pickup_ts", at("01:00"), None)
    assert {r[3] for r in out.collect()} == {1}


def test_preaggregation_changes_nothing(spark):
    facts = trips(spark, SMALL)
    direct, slotted = pickup_features(facts), pickup_features(facts, pre_aggregate=True)
    assert direct.dtypes == slotted.dtypes
    assert direct.exceptAll(slotted).count() == 0 and slotted.exceptAll(direct).count() == 0


@pytest.mark.parametrize("pre_aggregate", [False, True])
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    events=st.lists(
        st.tuples(
            st.sampled_from([1, 2, None]),
            st.one_of(st.none(), st.integers(0, 600)),
            st.one_of(st.none(), st.integers(-5, 5)),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_all_kinds_against_brute_force(spark, pre_aggregate, events):
    base = datetime(2024, 1, 1)
    data = [(k, base + timedelta(minutes=m) if m is not None else None, v) for k, m, v in events]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, v int")
    measures = {
        "n": Measure("count"),
        "nv": Measure("count", "v"),
        "s": Measure("sum", "v"),
        "a": Measure("mean", "v"),
        "lo": Measure("min", "v"),
        "hi": Measure("max", "v"),
    }
    out = windowed_features(
        df, ["k"], "t", "30 minutes", measures, slide="10 minutes", pre_aggregate=pre_aggregate
    )
    groups = defaultdict(list)
    for k, t, v in data:
        if t is None:
            continue
        slot = base + timedelta(minutes=((t - base).seconds // 600) * 10)
        for i in range(3):
            groups[(k, slot - timedelta(minutes=10 * i) + timedelta(minutes=30))].append(v)
    expected = []
    for (k, end), values in groups.items():
        known = [v for v in values if v is not None]
        expected.append(
            (
                k,
                end,
                len(values),
                len(known),
                sum(known) if known else None,
                sum(known) / len(known) if known else None,
                min(known, default=None),
                max(known, default=None),
            )
        )
    assert rows_of(out) == sorted(expected, key=repr)


def test_plan_is_one_shuffle_with_partial_sums_and_no_python(spark):
    plan = plan_of(pickup_features(trips(spark, SMALL)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan and "partial_count" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    plan = plan_of(dropoff_features(trips(spark, SMALL)))
    assert plan.count("Exchange hashpartitioning") == 1 and "EvalPython" not in plan


def test_day_windows_with_other_keys(spark):
    df = spark.createDataFrame([(1, "a", at("00:00"), 2.0)], "x int, y string, t timestamp_ntz, v double")
    out = windowed_features(df, {"x": "id", "y": "y"}, "t", "2 days", {"v": Measure("max", "v")}, "1 day")
    assert out.columns == ["id", "y", "ts", "v"]
    assert out.select(F.max("ts")).first()[0] == datetime(2024, 1, 3)


def test_slots_are_used_for_large_input_and_only_where_they_fit(spark, monkeypatch):
    assert slots_fit("1 hour", "15 minutes") and slots_fit("30 days", "10 days") and slots_fit("2 Weeks", "1 day")
    assert not slots_fit("1 hour", "25 minutes") and not slots_fit("1 hour", None) and not slots_fit("1 hour", "1 hour")
    facts = trips(spark, SMALL)
    with pytest.raises(ValueError, match="slots"):
        windowed_features(facts, ["pickup_zip"], "pickup_ts", "1 hour", {"n": Measure("count")}, "25 minutes", pre_aggregate=True)
    assert plan_of(pickup_features(facts)).count("Exchange") == 1
    monkeypatch.setattr(windows, "SLOT_INPUT_BYTES", 0)
    assert plan_of(pickup_features(facts)).count("Exchange") == 2
    uneven = windowed_features(facts, ["pickup_zip"], "pickup_ts", "1 hour", {"n": Measure("count")}, "25 minutes")
    assert plan_of(uneven).count("Exchange") == 1


def test_builders_take_other_column_names(spark):
    facts = trips(spark, SMALL)
    named = facts.withColumnsRenamed({"fare_amount": "paid", "pickup_zip": "from_zip", "dropoff_zip": "to_zip"})
    assert rows_of(pickup_features(named, fare="paid", zip_column="from_zip")) == rows_of(pickup_features(facts))
    assert rows_of(dropoff_features(named, zip_column="to_zip")) == rows_of(dropoff_features(facts))


def test_preview_prints_the_first_rows(spark, capsys):
    preview(spark.range(5).coalesce(1), 2)
    shown = capsys.readouterr().out
    assert "|0 " in shown and "|1 " in shown and "|2 " not in shown
