from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import SMALL, rows_of
from tidemark import jobs
from tidemark.operators.tables import FeatureTable
from tidemark.operators.windows import dropoff_features, pickup_features
from tidemark.session import SESSION_DEFAULTS, build_session, shared_dir
from tidemark.sources.trips import trips


def test_the_whole_pipeline(spark, database, tmp_path):
    """Setup, scheduled loads, features for a range, extension, publish, train, score."""
    columns = jobs.Columns("began", "ended")
    source = (
        trips(spark, SMALL)
        .withColumnsRenamed({"pickup_ts": "began", "dropoff_ts": "ended"})
        .filter("began < '2024-01-06'")
        .withColumn("fare_amount", F.col("trip_distance") * 3)
    )
    jobs.setup(spark, database, source, columns)
    runs = 0
    while jobs.ingest(spark, database, source, columns):
        runs += 1
    assert runs == 4
    raw = spark.table(f"{database}.raw_data")
    assert rows_of(raw) == rows_of(source)

    jobs.features(spark, database, columns, end="2024-01-04 10:07:00")
    jobs.features(spark, database, columns, after="2024-01-04 10:07:00")
    stored = spark.table(f"{database}.{jobs.PICKUPS}").drop("dt")
    assert rows_of(stored) == rows_of(pickup_features(source, event_ts="began"))
    stored = spark.table(f"{database}.{jobs.DROPOFFS}").drop("dt")
    assert rows_of(stored) == rows_of(dropoff_features(source, event_ts="ended"))

    jobs.publish(spark, database)
    jobs.publish(spark, database, since="2024-01-05")
    online = spark.table(f"{database}.{jobs.PICKUPS}_online")
    assert online.count() == source.select("pickup_zip").distinct().count()

    model = str(tmp_path / "model")
    error = jobs.train(spark, database, model, ["trip_id"], columns, rounds=10)
    spread = source.agg(F.stddev("fare_amount")).first()[0]
    assert error < spread / 2
    jobs.score(spark, model, source.drop("fare_amount"), f"{database}.scored")
    scored = spark.table(f"{database}.scored")
    assert scored.count() == source.count()
    assert scored.filter("prediction IS NULL").count() == 0

    log = str(tmp_path / "log")
    for _ in range(2):  # the second run is a retry
        jobs.score(spark, model, source.drop("fare_amount"), f"{database}.scored", log, "one")
    assert spark.read.parquet(log).count() == source.count()
    with pytest.raises(ValueError, match="batch id"):
        jobs.score(spark, model, source.drop("fare_amount"), f"{database}.scored", log)

    landing = str(tmp_path / "landing")
    source.write.parquet(landing)
    streamed = jobs.Columns("began", "ended", "fare_amount")
    assert jobs.stream(spark, database, landing, str(tmp_path / "cp"), streamed) == 0
    wrong = spark.table(f"{database}.{jobs.PICKUPS}").limit(3).withColumn("zip", F.lit(-5)).drop("dt")
    FeatureTable.load(spark, f"{database}.{jobs.PICKUPS}").merge(wrong)
    fixed = jobs.reconcile(spark, database, streamed, "2023-12-01", "2024-03-01")
    assert fixed == {jobs.PICKUPS: 3, jobs.DROPOFFS: 0}
    stored = spark.table(f"{database}.{jobs.PICKUPS}").drop("dt")
    assert rows_of(stored) == rows_of(pickup_features(source, event_ts="began"))


def test_session_defaults(spark):
    session = build_session("again")
    for key, value in SESSION_DEFAULTS.items():
        assert session.conf.get(key) == value


def test_a_cluster_session_needs_a_shared_folder(tmp_path):
    def stub(setting, master):
        conf = SimpleNamespace(get=lambda key, default=None: setting if "checkpoint" in key else "file:/warehouse/")
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="a-stub"))

    assert shared_dir(stub("hdfs:///shared/", "yarn")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(stub(None, "yarn"))
    assert shared_dir(stub(None, "local[4]")) == "file:/warehouse/scratch-a-stub"
