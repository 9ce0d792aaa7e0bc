from __future__ import annotations

from datetime import datetime, timedelta

from helpers import SMALL, at, plan_of, rows_of
from tidemark.sources import ingest
from tidemark.sources.scan import append_if_any, create_or_replace, drop_table, ensure_database, read_path
from tidemark.sources.trips import trips

SCHEMA = "id int, ts timestamp_ntz"


def source_of(spark, *times):
    return spark.createDataFrame([(i, at(t)) for i, t in enumerate(times)], SCHEMA)


def test_initial_cut_keeps_the_fraction_of_a_second(spark):
    source = source_of(
        spark,
        "2024-01-01 00:00:07.179575",
        "2024-01-02 00:00:00.179575",
        "2024-01-02 00:00:00.179576",
        "2024-01-02 00:00:00",
    )
    assert {r["id"] for r in ingest.initial_load(source, "ts").collect()} == {0, 1, 3}
    assert {r["id"] for r in ingest.initial_load(source, "ts", exact_midnight=True).collect()} == {0, 3}


def test_step_takes_rows_after_the_maximum_only(spark):
    source = source_of(
        spark,
        "2024-01-01 05:00:00",
        "2024-01-01 23:00:00",
        "2024-01-01 22:00:00",
        "2024-01-01 23:00:00.000001",
        "2024-01-03 00:00:00",
        "2024-01-03 00:00:01",
    )
    loaded = source.filter("id in (0, 1)")
    step = ingest.incremental_load_step(source, loaded, "ts")
    # row 2 is late, row 1 sits at the maximum, row 5 is past the cut
    assert {r["id"] for r in step.collect()} == {3, 4}


def test_cut_reaches_the_scan(spark):
    source = trips(spark, SMALL)
    plan = plan_of(ingest.load_step(source, "pickup_ts", datetime(2024, 1, 3)))
    assert "GreaterThan(ts" in plan and "LessThanOrEqual(ts" in plan


def test_gap_stops_unless_skipped(spark, database):
    source = source_of(spark, "2024-01-01 01:00:00", "2024-01-09 01:00:00", "2024-01-09 02:00:00", "2024-01-10 03:00:00")
    stalled = list(ingest.drain(spark, source, "ts", f"{database}.stalled"))
    assert [r.n_rows for r in stalled] == [1]
    assert spark.table(f"{database}.stalled").count() == 1
    rounds = list(ingest.drain(spark, source, "ts", f"{database}.whole", skip_gaps=True))
    assert sum(r.n_rows for r in rounds) == 4
    assert rows_of(spark.table(f"{database}.whole")) == rows_of(source)


def test_drain_equals_source(spark, database):
    source = trips(spark, SMALL)
    rounds = list(ingest.drain(spark, source, "pickup_ts", f"{database}.raw"))
    loaded = spark.table(f"{database}.raw")
    assert rows_of(loaded) == rows_of(source)
    assert [r.number for r in rounds] == list(range(len(rounds)))
    assert all(a.last < b.first for a, b in zip(rounds, rounds[1:]))


def test_drain_of_an_empty_source(spark, database):
    empty = source_of(spark, "2024-01-01 01:00:00").filter("id < 0")
    assert list(ingest.drain(spark, empty, "ts", f"{database}.none")) == []


def test_scheduled_runs(spark, database):
    source = source_of(spark, *[str(at("01:00") + timedelta(hours=12 * i)) for i in range(8)])
    name = f"{database}.scheduled"
    runs = 0
    while ingest.scheduled_run(spark, source, "ts", name):
        runs += 1
    assert runs >= 3
    assert rows_of(spark.table(name)) == rows_of(source)


def test_zoned_timestamps_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Australia/Sydney")
        source = spark.sql(
            "SELECT cast(t AS timestamp) AS ts FROM VALUES ('2024-01-01 10:00:00'), "
            "('2024-01-02 00:00:00'), ('2024-01-02 00:00:01') v(t)"
        )
        assert ingest.initial_load(source, "ts").count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_guarded_append_and_names(spark, database, tmp_path):
    source = source_of(spark, "2024-01-01 01:00:00")
    name = f"{database}.appended"
    create_or_replace(source, name)
    assert append_if_any(source, name) is True
    assert append_if_any(source.filter("id < 0"), name) is False
    assert spark.table(name).count() == 2
    source.write.json(str(tmp_path / "j"))
    assert read_path(spark, str(tmp_path / "j"), "json").count() == 1
    ensure_database(spark, f"{database}_more")
    drop_table(spark, name)
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
