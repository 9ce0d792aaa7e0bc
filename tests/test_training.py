from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import SMALL, at, plan_of, rows_of
from tidemark import FeatureClient, FeatureLookup, create_training_set
from tidemark.functions.hashing import train_test_split
from tidemark.functions.timefilter import ts_range
from tidemark.models.regression import (
    append_inference_log,
    fit_regression,
    grouped_mean_predictor,
    inference_log,
    predict,
    rmse,
    rmse_of,
)
from tidemark.operators.lookup import PitOptions
from tidemark.operators.training import add_features, fill_missing, lookups_from_json, lookups_to_json
from tidemark.operators.windows import pickup_features
from tidemark.plans.common import (
    DROPOFF_NAMES,
    PICKUP_NAMES,
    fare_training_set,
    frame_lookups,
    pickup_table,
    table_lookups,
    written_tables,
)
from tidemark.plans.models import LABEL, REQUEST
from tidemark.sources.trips import trips


def test_columns_and_rows_of_the_training_set(spark):
    facts = trips(spark, SMALL)
    rows = fare_training_set(facts, frame_lookups(facts))
    df = rows.load_df()
    assert df.columns == [
        "trip_id", "pickup_zip", "dropoff_zip", "trip_distance", "fare_amount", *PICKUP_NAMES, *DROPOFF_NAMES,
    ]
    assert rows.feature_columns == [c for c in df.columns if c != "fare_amount"]
    assert df.count() == facts.count()
    plan = plan_of(df)
    assert "EvalPython" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_stored_and_inline_features_agree(spark):
    facts = trips(spark, SMALL)
    inline = fare_training_set(facts, frame_lookups(facts)).load_df()
    stored = fare_training_set(facts, table_lookups(*written_tables(spark, SMALL))).load_df()
    split = fare_training_set(
        facts, frame_lookups(facts, PitOptions(strategy="split", max_group_rows=20))
    ).load_df()
    assert rows_of(inline) == rows_of(stored) == rows_of(split)


def test_lookup_without_time_key_and_order_of_columns(spark):
    base = spark.createDataFrame([(1, 5, 7)], "id int, a int, b int")
    names = spark.createDataFrame([(5, "five")], "k int, name string")
    sizes = spark.createDataFrame([(7, 70)], "k int, size int")
    out = create_training_set(
        base,
        [
            FeatureLookup(["size"], ["b"], frame=sizes, frame_keys=["k"]),
            FeatureLookup(["name"], ["a"], frame=names, frame_keys=["k"]),
        ],
        label=None,
        exclude_columns=["a"],
    ).load_df()
    assert out.columns == ["id", "b", "size", "name"]
    assert rows_of(out) == [(1, 7, 70, "five")]


def test_clash_and_label_errors(spark):
    facts = trips(spark, SMALL)
    clashing = facts.withColumn("dropoff_is_weekend", F.lit(1))
    with pytest.raises(ValueError, match="already present"):
        fare_training_set(clashing, frame_lookups(facts)).load_df()
    with pytest.raises(ValueError, match="label"):
        create_training_set(facts, [], "missing")


def test_lookup_json_round_trip():
    lookups = [
        FeatureLookup(["a"], ["k"], "t", "db.x", options=PitOptions(allow_exact=True, max_age="1 day")),
        FeatureLookup(["b", "c"], ["k", "l"], table_name="db.y"),
    ]
    assert lookups_from_json(lookups_to_json(lookups)) == lookups


def test_fill_missing_loses_no_row(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, 3, None)], "id int, a int, b double")
    assert rows_of(fill_missing(df, ["a", "b"], -1.0, keep=["id"])) == [
        (1, -1.0, 2.0, 1, 0),
        (2, 3.0, -1.0, 0, 1),
    ]


def test_train_package_and_score(spark, tmp_path):
    client = FeatureClient(spark)
    facts = trips(spark, SMALL).withColumn("fare_amount", F.col("trip_distance") * 2 + 3)
    rows = client.create_training_set(
        facts, table_lookups(*written_tables(spark, SMALL)), LABEL, ["pickup_ts", "dropoff_ts"]
    )
    train, test = train_test_split(rows.load_df(), ["trip_id"])
    model = fit_regression(train, REQUEST, LABEL, rounds=10)
    path = str(tmp_path / "package")
    client.log_model(model, rows, path)

    scored = predict(model, test)
    assert scored.count() == test.count()
    error = rmse(scored, LABEL)
    assert error == pytest.approx(scored.agg(rmse_of(LABEL, "prediction")).first()[0])
    means = grouped_mean_predictor(train, "pickup_zip", LABEL)
    baseline = rmse(test.join(means, "pickup_zip"), LABEL)
    assert error < baseline / 2

    fresh = facts.drop(LABEL)
    batch = client.score_batch(path, fresh)
    assert batch.count() == fresh.count()
    assert batch.filter("prediction IS NULL").count() == 0

    # Values carried by the request win over the stored ones.
    given = fresh.withColumn("mean_fare_window_1h_pickup_zip", F.lit(12.5).cast("float"))
    kept = client.score_batch(path, given)
    assert kept.filter("mean_fare_window_1h_pickup_zip <> 12.5").count() == 0

    requests = batch.select("trip_id", F.struct(*REQUEST).alias("request"), F.col("prediction").alias("expected"))
    from tidemark.models.regression import PackagedModel

    structs = PackagedModel.load(spark, path).score_struct(requests, "request")
    assert structs.schema["prediction"].dataType.simpleString() == "double"
    assert structs.filter("prediction <> expected").count() == 0
    one = spark.sql(
        "SELECT named_struct('trip_distance', CAST(4.2 AS DOUBLE), 'pickup_zip', 41, 'dropoff_zip', 17, "
        "'mean_fare_window_1h_pickup_zip', CAST(12.0 AS DOUBLE), 'count_trips_window_1h_pickup_zip', 3, "
        "'count_trips_window_30m_dropoff_zip', 2, 'dropoff_is_weekend', 0) AS request"
    )
    one.createOrReplaceTempView("one_request")
    PackagedModel.load(spark, path).create_view(spark, "one_request", "request", "one_scored")
    answer = spark.sql("SELECT prediction FROM one_scored").first()["prediction"]
    assert 10 < answer < 18

    log_path = str(tmp_path / "log")
    for _ in range(2):
        append_inference_log(inference_log(batch, REQUEST, "1", F.col("pickup_ts")), log_path, "first")
    logged = spark.read.parquet(log_path)
    assert logged.count() == fresh.count()  # the second run was a retry
    assert logged.select("request.*").columns == REQUEST


def test_client_tables(spark, database):
    client = FeatureClient(spark)
    facts = trips(spark, SMALL)
    name = f"{database}.made"
    client.create_table(name, ["zip"], timestamp_key="ts", df=pickup_features(facts, "pickup_ts", None, "2024-01-16"))
    client.write_table(name, pickup_features(facts, "pickup_ts", "2024-01-16"))
    assert client.read_table(name).agg(F.max("ts")).first()[0] > at("2024-01-29")
    online = f"{database}.online"
    client.create_table(online, ["zip"], pickup_table(spark, database).schema)
    client.publish_table(name, online)
    assert client.read_table(online).count() == client.read_table(name).select("zip").distinct().count()
    client.drop_table(name)
    assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError):
        client.create_table(name, ["zip"])


def test_stored_features_out_of_reach_are_not_read(spark, database):
    table = pickup_table(spark, database)
    facts = trips(spark, SMALL)
    table.write(pickup_features(facts))
    day = ts_range(facts, "pickup_ts", "2024-01-10", "2024-01-11")
    for age in ("6 hours", None):
        options = PitOptions(max_age=age, small_input_bytes=0, matched_ts="m")
        pruned = FeatureLookup(PICKUP_NAMES, ["pickup_zip"], "pickup_ts", table.name, options=options)
        rows, _, _ = pruned.resolve(day)
        low, high = rows.agg(F.min("ts"), F.max("ts")).first()
        assert high <= at("2024-01-11") and (low >= at("2024-01-09 18:00:00")) == (age is not None)
        if age is None:  # one row per key from before the batch
            early = F.col("ts") < F.lit(day.agg(F.min("pickup_ts")).first()[0])
            assert rows.filter(early).count() == table.read(spark).filter(early).select("zip").distinct().count()
        whole = FeatureLookup(
            PICKUP_NAMES, ["pickup_zip"], "pickup_ts", table.name, options=PitOptions(max_age=age, matched_ts="m")
        )
        assert rows_of(add_features(day, [pruned])) == rows_of(add_features(day, [whole]))
    assert pruned.resolve(day.filter("false"))[0].count() == table.read(spark).count()


def test_training_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        made.add(1)
        return float(x % 7)

    rows = spark.range(400).select(F.col("id").alias("x"), F.when(F.col("id") >= 50, counted("id")).alias("y"))
    model = fit_regression(rows, ["x"], "y", rounds=3, depth=2)
    assert predict(model, rows.select("x")).count() == 400
    assert 350 <= made.value <= 2 * 400  # the filter and the column may each call it


def test_many_training_rows_are_dealt_evenly(spark, monkeypatch):
    from tidemark.models import regression

    rows = spark.range(4000).selectExpr("cast(id % 3 AS double) AS `a x`", "cast(id % 3 AS double) AS y").coalesce(1)
    few = predict(fit_regression(rows, ["a x"], "y", rounds=2, depth=2), rows.select("a x")).distinct()
    numbered = rows.select("*", F.monotonically_increasing_id().alias("__at"))
    assert [r["a x"] for r in regression._dealt(numbered, 4000).collect()] == [i % 3 for i in range(4000)]
    monkeypatch.setattr(regression, "LEAST_ROWS", 100)
    sizes = regression._dealt(numbered, 4000).rdd.glom().map(len).collect()
    assert len(sizes) == 2 * spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= 1
    many = predict(fit_regression(rows, ["a x"], "y", rounds=2, depth=2), rows.select("a x")).distinct()
    pairs = zip(many.orderBy("a x").collect(), few.orderBy("a x").collect(), strict=True)
    assert all(tuple(m) == pytest.approx(tuple(f)) for m, f in pairs)


def test_very_many_training_rows_are_one_task_a_core(spark, monkeypatch):
    from tidemark.models import regression

    numbered = spark.range(4000).withColumn("__at", F.col("id")).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(regression, "LEAST_ROWS", 100)
    monkeypatch.setattr(regression, "MANY_ROWS", 4000 // cores, raising=False)
    for most, turns in ((4000, 1), (4000 // cores, 1), (4000 // cores - 1, 2), (300, 4)):
        monkeypatch.setattr(regression, "MOST_ROWS", most)
        dealt = regression._dealt(numbered, 4000).rdd.glom().map(lambda rows: [r["id"] for r in rows]).collect()
        sizes = [len(ids) for ids in dealt]
        assert len(sizes) == turns * cores and max(sizes) - min(sizes) <= 2
        assert all(ids == sorted(ids) for ids in dealt) and sorted(sum(dealt, [])) == list(range(4000))


def test_trips_kept_for_the_test_are_not_looked_up(spark, tmp_path, monkeypatch):
    from tidemark.plans import models

    seen = {}

    def stored_rows(facts, lookups):
        seen["base"] = facts
        seen["rows"] = fare_training_set(facts, lookups)
        return seen["rows"]

    def fitted(train, inputs, label):
        seen["train"] = train
        return fit_regression(train, inputs, label, rounds=1, depth=1)

    monkeypatch.setattr(models, "fare_training_set", stored_rows)
    monkeypatch.setattr(models, "fit_regression", fitted)
    folder = str(tmp_path)
    spark.range(300).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 5 AS int)) AS ts",
        "cast(id % 11 AS double) AS value",
    ).write.parquet(f"{folder}/events.parquet")
    models._package(spark, folder)
    facts = trips(spark, folder)
    whole = fare_training_set(facts, seen["rows"].lookups).load_df()  # split after the lookups
    assert rows_of(seen["train"]) == rows_of(train_test_split(whole, ["trip_id"])[0])
    assert rows_of(seen["base"]) == rows_of(train_test_split(facts, ["trip_id"])[0])
