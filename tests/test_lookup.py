from __future__ import annotations

from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SMALL, at, plan_of, rows_of
from tidemark.operators.lookup import PitOptions, key_lookup, pit_lookup
from tidemark.operators.skew import group_sizes, hot_key_cuts, piece_of
from tidemark.operators.windows import PICKUP_MEASURES, pickup_features
from tidemark.sources.trips import trips

LEFT = "id int, k int, t timestamp_ntz"
FEATURES = "zip int, ts timestamp_ntz, f int, g string"

MODES = [
    {"strategy": "sorted"},
    {"strategy": "bucketed", "bucket": "1 hour"},
    {"strategy": "split", "max_group_rows": 2},
    {"strategy": "auto", "small_input_bytes": 0, "max_group_rows": 2},
    {"strategy": "bucketed", "bucket": "1 hour", "small_input_bytes": 0, "max_group_rows": 2},
    {"strategy": "auto"},
]


def look_up(left, features, **options):
    return pit_lookup(left, features, ["k"], "t", ["zip"], "ts", ["f", "g"], PitOptions(**options))


@pytest.fixture(scope="module")
def features(spark):
    return spark.createDataFrame(
        [
            (1, at("01:00"), 10, "a"),
            (1, at("02:00"), 20, None),
            (1, at("03:30"), 30, "c"),
            (2, at("01:00"), 40, "d"),
            (None, at("00:10"), 99, "x"),
            (1, None, 98, "y"),
        ],
        FEATURES,
    )


@pytest.mark.parametrize("mode", MODES, ids=lambda m: "-".join(map(str, m.values())))
@pytest.mark.parametrize("exact", [False, True])
def test_point_in_time_rules(spark, features, mode, exact):
    left = spark.createDataFrame(
        [
            (1, 1, at("02:00")),  # same time as a feature
            (2, 1, at("00:30")),  # before the first feature
            (3, 7, at("02:00")),  # unknown key
            (4, None, at("02:00")),  # NULL key
            (5, 1, None),  # NULL time
            (6, 1, at("03:00")),  # newest row holds a NULL
            (6, 1, at("03:00")),  # an identical copy
            (7, 2, at("23:00")),  # far behind the last feature
            (8, 1, at("09:00")),
        ],
        LEFT,
    )
    got = {}
    for r in look_up(left, features, allow_exact=exact, matched_ts="m", **mode).collect():
        got.setdefault(r["id"], []).append((r["f"], r["g"], r["m"]))
    assert got == {
        1: [(20, None, at("02:00"))] if exact else [(10, "a", at("01:00"))],
        2: [(None, None, None)],
        3: [(None, None, None)],
        4: [(None, None, None)],
        5: [(None, None, None)],
        6: [(20, None, at("02:00"))] * 2,
        7: [(40, "d", at("01:00"))],
        8: [(30, "c", at("03:30"))],
    }


@pytest.mark.parametrize("mode", MODES[:3], ids=lambda m: m["strategy"])
def test_max_age(spark, features, mode):
    left = spark.createDataFrame([(1, 1, at("05:30")), (2, 1, at("05:31"))], LEFT)
    out = look_up(left, features, max_age="2 hours", **mode)
    assert {r["id"]: r["f"] for r in out.collect()} == {1: 30, 2: None}


KEYS = st.sampled_from([1, 1, 1, 2, None])
MINUTES = st.one_of(st.none(), st.integers(0, 180))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(st.tuples(KEYS, MINUTES), min_size=1, max_size=30),
    right=st.dictionaries(
        st.tuples(KEYS, MINUTES), st.one_of(st.none(), st.integers(0, 99)), min_size=1, max_size=30
    ),
    exact=st.booleans(),
)
def test_every_strategy_against_brute_force(spark, left, right, exact):
    base = at("00:00")

    def time(m):
        return None if m is None else base + timedelta(minutes=m)

    left_rows = [(i, k, time(m)) for i, (k, m) in enumerate(left)]
    feature_rows = [(k, time(m), v, None) for (k, m), v in right.items()]
    expected = []
    for i, k, t in left_rows:
        best = None
        for fk, ft, v, _ in feature_rows:
            if None in (k, t, fk, ft) or fk != k:
                continue
            if (ft <= t if exact else ft < t) and (best is None or ft > best[0]):
                best = (ft, v)
        expected.append((i, k, t, best[1] if best else None, None, best[0] if best else None))
    expected.sort(key=repr)
    left_df = spark.createDataFrame(left_rows, LEFT)
    feature_df = spark.createDataFrame(feature_rows, FEATURES)
    for mode in MODES[:3]:
        out = look_up(left_df, feature_df, allow_exact=exact, matched_ts="m", **mode)
        assert rows_of(out) == expected, mode


def test_a_hot_key_full_of_copies_and_a_hot_null_key(spark):
    """A third of the rows one key, a third one (key, time), a third NULL keys."""
    n = 3000
    hot = spark.range(n).select(
        F.col("id").cast("int").alias("id"),
        F.lit(1).alias("k"),
        (F.lit(at("00:00")).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("t"),
    )
    copies = spark.range(n).select(F.lit(-1).alias("id"), F.lit(2).alias("k"), F.lit("2024-01-01 00:20:00").cast("timestamp_ntz").alias("t"))
    nulls = spark.range(n).select(F.lit(-2).alias("id"), F.lit(None).cast("int").alias("k"), F.lit("2024-01-01 00:20:00").cast("timestamp_ntz").alias("t"))
    left = hot.unionByName(copies).unionByName(nulls)
    feats = (
        hot.filter("id % 7 = 0").select(F.col("k").alias("zip"), F.col("t").alias("ts"), F.col("id").alias("f"), F.lit("h").alias("g"))
        .unionByName(spark.createDataFrame([(2, at("00:10"), 5, "c")], FEATURES))
    )
    plain = look_up(left, feats, strategy="sorted", allow_exact=True)
    bucketed = {"strategy": "bucketed", "bucket": "1 day", "small_input_bytes": 0, "max_group_rows": 200}
    for mode in (bucketed, {"strategy": "split", "max_group_rows": 200}, {"strategy": "auto", "small_input_bytes": 0, "max_group_rows": 200}):
        out = look_up(left, feats, allow_exact=True, **mode)
        assert out.count() == 3 * n
        assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0
    wrong = plain.filter("k = 1 AND f <> id - id % 7").count()
    assert wrong == 0


def test_rows_without_a_key_are_dealt_over_all_tasks(spark, features):
    """In a sorted lookup, too, no task gets all rows with a NULL key."""
    left = spark.range(4000).selectExpr(
        "cast(id as int) id", "cast(if(id % 4 = 0, 1, null) as int) k", "timestamp_ntz'2024-01-01 00:30:00' t"
    )
    found = look_up(left, features, strategy="sorted")
    assert found.count() == 4000 and found.where("k is null and (f is not null or g is not null)").isEmpty()
    sizes = [r["count"] for r in found.where("k is null").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2000


def test_cuts_even_out_a_hot_key(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise((F.col("id") % 500 + 10).cast("int")).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * F.col("id") / 1000)).alias("t"),
    )
    sizes = group_sizes(rows, ["k"])
    assert sizes.total == 100_000 and sizes.largest == 33_334
    cuts = hot_key_cuts(rows, ["k"], "t", sizes, max_group_rows=1000)
    assert [r["k"] for r in cuts.collect()] == [1]
    pieces = (
        rows.join(cuts, "k").withColumn("p", piece_of("t")).groupBy("p").count().orderBy("p").collect()
    )
    assert len(pieces) >= 30
    assert max(r["count"] for r in pieces) <= 1000
    # The two-level search agrees with a plain count of earlier cuts.
    mismatch = rows.join(cuts, "k").filter(piece_of("t") != F.expr("size(filter(cuts, x -> x <= t))"))
    assert mismatch.count() == 0
    assert hot_key_cuts(rows, ["k"], "t", sizes, max_group_rows=50_000) is None


def test_more_hot_keys_than_the_driver_would_hold(spark):
    """12,000 hot keys: every one is cut, no piece is above the limit, and the answers stay the same."""
    n_keys, each, limit = 12_000, 8, 4
    facts = spark.range(n_keys * each).select(
        F.col("id").cast("int").alias("id"),
        (F.col("id") % n_keys).cast("int").alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("t"),
    )
    sizes = group_sizes(facts, ["k"])
    cuts = hot_key_cuts(facts, ["k"], "t", sizes, max_group_rows=limit)
    assert cuts.count() == n_keys
    pieces = facts.join(cuts, "k").groupBy("k", piece_of("t").alias("p")).count()
    assert pieces.agg(F.max("count")).first()[0] <= limit
    feats = facts.where("id % 3 = 0").select(
        F.col("k").alias("zip"), F.col("t").alias("ts"), F.col("id").alias("f"), F.lit("g").alias("g")
    )
    plain = look_up(facts, feats, strategy="sorted")
    out = look_up(facts, feats, strategy="split", max_group_rows=limit)
    assert out.count() == n_keys * each
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()
    assert cuts.columns == ["k", "cuts"] and cuts.inputFiles()  # a table in the shared folder


def test_two_level_search_with_many_cuts(spark):
    cuts = spark.sql("SELECT transform(sequence(1, 1000), i -> timestamp_seconds(i * 10)) AS cuts")
    probes = spark.range(0, 10_100, 3).select(F.timestamp_seconds("id").alias("t")).crossJoin(cuts)
    wrong = probes.filter(piece_of("t") != F.expr("size(filter(cuts, x -> x <= t))"))
    assert wrong.count() == 0


def test_composite_keys_and_mixed_time_types(spark):
    left = spark.createDataFrame([(1, 1, "x", at("02:00"))], "id int, a int, b string, t timestamp_ntz")
    right = spark.createDataFrame(
        [(1, "x", at("01:00"), 5), (1, "y", at("01:30"), 6)], "p int, q string, ts timestamp, f int"
    )
    for mode in MODES[:3]:
        out = pit_lookup(left, right, ["a", "b"], "t", ["p", "q"], "ts", ["f"], PitOptions(**mode))
        assert [r["f"] for r in out.collect()] == [5]


def test_name_clash_is_an_error(spark, features):
    left = spark.createDataFrame([(1, 1, at("02:00"), 0)], LEFT + ", f int")
    with pytest.raises(ValueError, match="already present"):
        look_up(left, features)
    with pytest.raises(ValueError, match="strategy"):
        look_up(left.drop("f"), features, strategy="fast")


def test_key_lookup_keeps_unmatched_and_null_keys(spark):
    left = spark.createDataFrame([(1, 5), (2, None), (3, 9), (3, 9)], "id int, k int")
    right = spark.createDataFrame([(5, "five"), (None, "none")], "key int, name string")
    out = key_lookup(left, right, ["k"], ["key"], ["name"])
    assert rows_of(out) == sorted([(1, 5, "five"), (2, None, None), (3, 9, None), (3, 9, None)], key=repr)


def test_plans_have_no_nested_loop_and_one_shuffle_per_sorted_lookup(spark):
    facts = trips(spark, SMALL)
    stored = pickup_features(facts)
    for mode in MODES[:2]:
        out = pit_lookup(
            facts, stored, ["pickup_zip"], "pickup_ts", ["zip"], "ts", list(PICKUP_MEASURES), PitOptions(**mode)
        )
        plan = plan_of(out)
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "EvalPython" not in plan
        if mode["strategy"] == "sorted":
            # one for the features themselves, one for the lookup
            assert plan.count("Exchange hashpartitioning") == 2
