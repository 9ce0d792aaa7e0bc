from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import rows_of
from tidemark.operators import carry
from tidemark.operators.lookup import PitOptions
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, add_features
from tidemark.session import scratch_database

SCHEMA = "zip int, ts timestamp_ntz, f int"


def at(day, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=day, hours=hour)


def frame(spark, rows):
    return spark.createDataFrame([(z, at(d, h), f) for z, d, h, f in rows], SCHEMA)


@pytest.fixture
def table(spark, database):
    return FeatureTable.define(f"{database}.history", ["zip"], SCHEMA, "ts").create(spark)


def lookup(spark, table, probes):
    base = spark.createDataFrame([(z, at(d, h)) for z, d, h in probes], "z int, t timestamp_ntz")
    options = PitOptions(matched_ts="used", small_input_bytes=0)
    return add_features(base, [FeatureLookup(["f"], ["z"], "t", table.name, options=options)])


def plain(rows, probes):
    out = []
    for z, d, h in probes:
        earlier = [(at(rd, rh), f) for rz, rd, rh, f in rows if rz == z and at(rd, rh) < at(d, h)]
        used = max(earlier, default=(None, None), key=lambda e: e[0])
        out.append((z, at(d, h), used[1], used[0]))
    return sorted(out, key=repr)


def plain_folder(rows, day):
    newest = {}
    for z, d, h, f in rows:
        if d < day and (z not in newest or newest[z][0] < at(d, h)):
            newest[z] = (at(d, h), f)
    return sorted([(z, t, f) for z, (t, f) in newest.items()], key=repr)


def as_day(day):
    return date(2024, 1, 1) + timedelta(days=day)


def folders(spark, table):
    return [(d - date(2024, 1, 1)).days for d in carry._days(spark, carry.carry_name(table))]


ROWS = [(1, 0, 5, 10), (1, 3, 1, None), (2, 1, 0, 20), (2, 1, 7, 21), (3, 6, 2, 30)]


@pytest.mark.parametrize("every", [1, 3])
def test_folders_hold_the_newest_row_before(spark, table, every):
    table.write(frame(spark, ROWS))
    carry.enable(spark, table, every)
    assert folders(spark, table) == ([1, 2, 3, 4, 5, 6, 7] if every == 1 else [1, 4, 7])
    for day in folders(spark, table):
        assert rows_of(carry.read_folder(spark, table, as_day(day))) == plain_folder(ROWS, day)


def test_lookup_lists_one_folder_and_the_days_of_the_batch(spark, table):
    table.write(frame(spark, ROWS))
    carry.enable(spark, table)
    probes = [(1, 6, 1), (2, 6, 3), (3, 6, 3), (4, 6, 3), (None, 6, 3)]
    found = lookup(spark, table, probes)
    assert rows_of(found) == plain(ROWS, probes)
    files = found.inputFiles()
    assert {f.split("/")[-2] for f in files} == {"carry_day=2024-01-07", "dt=2024-01-07"}


def test_lookups_before_and_after_all_folders(spark, table):
    table.write(frame(spark, ROWS))
    carry.enable(spark, table, 3)
    for probes in ([(1, -1, 0)], [(1, 0, 5), (1, 0, 6), (2, 2, 0)], [(1, 90, 0), (3, 91, 0)], [(2, 5, 0), (3, 6, 3)]):
        assert rows_of(lookup(spark, table, probes)) == plain(ROWS, probes)


def test_merge_delete_and_overwrite_keep_the_folders(spark, table):
    table.write(frame(spark, ROWS))
    carry.enable(spark, table)
    late = [(2, 2, 1, 22), (1, 3, 1, 11), (4, 9, 0, 40)]
    table.write(frame(spark, late))
    now = [r for r in ROWS if r[:3] != (1, 3, 1)] + late
    for day in folders(spark, table):
        assert rows_of(carry.read_folder(spark, table, as_day(day))) == plain_folder(now, day)
    table.delete(frame(spark, [(2, 2, 1, None), (4, 9, 0, None)]))
    now = [r for r in now if r[:3] not in ((2, 2, 1), (4, 9, 0))]
    assert folders(spark, table) == [1, 2, 3, 4, 5, 6, 7]
    assert rows_of(carry.read_folder(spark, table, as_day(7))) == plain_folder(now, 7)
    table.write(frame(spark, [(9, 4, 4, 1)]), "overwrite")
    assert folders(spark, table) == [5]
    assert rows_of(lookup(spark, table, [(9, 8, 0), (1, 8, 0)])) == plain([(9, 4, 4, 1)], [(9, 8, 0), (1, 8, 0)])
    table.write(frame(spark, []), "overwrite")
    assert folders(spark, table) == []
    assert rows_of(lookup(spark, table, [(9, 8, 0)])) == plain([], [(9, 8, 0)])


def test_failed_write_leaves_folders_unused(spark, table, monkeypatch):
    """The rows are merged, the folders are not made again: lookups must not read the old ones."""
    table.write(frame(spark, ROWS))
    carry.enable(spark, table)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(carry, "refresh_from", fail)
        with pytest.raises(RuntimeError, match="lost"):
            table.write(frame(spark, [(1, 4, 0, 12)]))
    now = [*ROWS, (1, 4, 0, 12)]
    probes = [(1, 6, 1), (2, 6, 3)]
    assert carry.last_valid(spark, table, as_day(6)) == as_day(4)
    assert rows_of(lookup(spark, table, probes)) == plain(now, probes)
    table.write(frame(spark, [(1, 5, 0, 13)]))  # the next write brings them back
    assert carry.last_valid(spark, table, as_day(6)) == as_day(6)
    assert rows_of(lookup(spark, table, probes)) == plain([*now, (1, 5, 0, 13)], probes)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 6), st.integers(0, 23)), min_size=1, max_size=6), min_size=1, max_size=3),
    st.integers(1, 4),
)
def test_any_merges(spark, batches, every):
    table = FeatureTable.define(f"{scratch_database(spark, 'carry')}.h", ["zip"], SCHEMA, "ts").create(spark)
    carry.enable(spark, table, every)
    now = {}
    for number, batch in enumerate(batches):
        rows = {key: number for key in batch}
        now |= rows
        table.write(frame(spark, [(*key, f) for key, f in rows.items()]))
        stored = [(*key, f) for key, f in now.items()]
        for day in folders(spark, table):
            assert rows_of(carry.read_folder(spark, table, as_day(day))) == plain_folder(stored, day)
    probes = [(z, d, 12) for z in (1, 2, 3) for d in (3, 5, 9)]
    assert rows_of(lookup(spark, table, probes)) == plain(stored, probes)


def test_needs_a_time_key(spark, database):
    table = FeatureTable.define(f"{database}.keyed", ["zip"], "zip int, f int").create(spark)
    with pytest.raises(ValueError, match="no time key"):
        carry.enable(spark, table)
