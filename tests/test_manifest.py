from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SMALL, at, rows_of
from tidemark.session import scratch_database
from tidemark.sources import ingest, manifest
from tidemark.sources.trips import trips

SCHEMA = "id int, ts timestamp_ntz"


def source_of(spark, times):
    return spark.createDataFrame([(i, t) for i, t in enumerate(times)], SCHEMA)


def test_scheduled_runs_equal_the_unlogged_ones(spark, database):
    source = source_of(spark, [at("01:00") + timedelta(hours=12 * i) for i in range(8)])
    name, other = f"{database}.raw", f"{database}.other"
    while True:
        more = manifest.scheduled_run(spark, source, "ts", name)
        assert ingest.scheduled_run(spark, source, "ts", other) == more
        assert rows_of(manifest.loaded(spark, name)) == rows_of(spark.table(other))
        if not more:
            break
    assert rows_of(manifest.loaded(spark, name)) == rows_of(source)
    by_day = manifest.loads(spark, name).groupBy("dt").agg(F.sum("n_rows").alias("n")).collect()
    assert sum(r["n"] for r in by_day) == 8


def test_a_run_reads_no_loaded_row(spark, database):
    source = source_of(spark, [at("01:00") + timedelta(hours=6 * i) for i in range(20)])
    name = f"{database}.raw"
    assert manifest.scheduled_run(spark, source, "ts", name)
    files = [Path(f.removeprefix("file://").removeprefix("file:")) for f in spark.table(name).inputFiles()]
    for file in files:
        file.write_bytes(b"no parquet")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert manifest.scheduled_run(spark, source, "ts", name)
    assert [r.n_rows for r in manifest.drain(spark, source, "ts", name)]
    assert manifest.loads(spark, name).agg(F.sum("n_rows")).first()[0] == 20
    with pytest.raises(Exception, match="(?i)parquet"):
        manifest.loaded(spark, name).collect()


def test_failed_load_is_not_shown_and_replaced(spark, database, monkeypatch):
    source = source_of(spark, [at("01:00") + timedelta(hours=12 * i) for i in range(6)])
    name = f"{database}.raw"
    manifest.scheduled_run(spark, source, "ts", name)
    first = rows_of(manifest.loaded(spark, name))
    write = manifest.replace_partitions

    def half(rows, table, *partitions):
        write(rows, table, *partitions)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(manifest, "replace_partitions", half)
        with pytest.raises(RuntimeError, match="lost"):
            manifest.scheduled_run(spark, source.where("id < 4"), "ts", name)
    assert rows_of(manifest.loaded(spark, name)) == first
    while manifest.scheduled_run(spark, source.where("id != 3"), "ts", name):
        pass
    assert rows_of(manifest.loaded(spark, name)) == rows_of(source.where("id != 3"))


def test_drain_of_trips_and_of_nothing(spark, database):
    source = trips(spark, SMALL)
    rounds = manifest.drain(spark, source, "pickup_ts", f"{database}.raw")
    assert rounds == list(ingest.drain(spark, source, "pickup_ts", f"{database}.other"))
    assert rows_of(manifest.loaded(spark, f"{database}.raw")) == rows_of(source)
    assert manifest.drain(spark, source, "pickup_ts", f"{database}.raw") == []
    assert manifest.drain(spark, source.where("false"), "pickup_ts", f"{database}.none") == []
    with pytest.raises(ValueError, match="reserved"):
        manifest.drain(spark, source.withColumn("load", F.lit(1)), "pickup_ts", f"{database}.no")


# times around midnight, with fractions, so that cuts split the first second of a day
TIMES = st.builds(
    lambda day, rest: datetime(2024, 1, 1) + timedelta(days=day, microseconds=rest),
    st.integers(0, 9),
    st.one_of(st.sampled_from([0, 1, 200_000, 500_000, 999_999, 1_000_000]), st.integers(0, 86_399_999_999)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TIMES, min_size=1, max_size=12), st.booleans(), st.booleans())
def test_drain_makes_the_same_loads(spark, times, exact, skip):
    source = source_of(spark, times)
    database = scratch_database(spark, "loads")
    options = {"exact_midnight": exact, "skip_gaps": skip}
    rounds = manifest.drain(spark, source, "ts", f"{database}.raw", **options)
    assert rounds == list(ingest.drain(spark, source, "ts", f"{database}.other", **options))
    assert rows_of(manifest.loaded(spark, f"{database}.raw")) == rows_of(spark.table(f"{database}.other"))


def test_zoned_times_in_another_session_zone(spark, database):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
        start = "timestamp'2024-01-01 10:00:00.5'"
        source = spark.range(40).selectExpr("id", f"{start} + make_dt_interval(0, id * 5, 0, 0) AS ts")
        rounds = manifest.drain(spark, source, "ts", f"{database}.raw")
        assert rounds == list(ingest.drain(spark, source, "ts", f"{database}.other"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
