from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import at, rows_of
from tidemark.client import FeatureClient
from tidemark.operators import versions
from tidemark.operators.lookup import PitOptions
from tidemark.operators.tables import FeatureTable, KeyViolation
from tidemark.operators.training import FeatureLookup, add_features
from tidemark.operators.versions import LoggedTable
from tidemark.session import scratch_database

SCHEMA = "zip int, ts timestamp_ntz, f int"
DAY2, DAY3 = "2024-01-02 06:00:00", "2024-01-03 06:00:00"


def frame(spark, *rows):
    return spark.createDataFrame([(z, at(t), f) for z, t, f in rows], SCHEMA)


def stored(*rows):
    return sorted([(z, at(t), f) for z, t, f in rows], key=repr)


@pytest.fixture
def table(spark, database):
    return LoggedTable.create(spark, f"{database}.features", ["zip"], SCHEMA, "ts")


def base_files(spark, table):
    return sorted(spark.table(table.current(spark).base).inputFiles())


def test_merges_are_read_from_changes_and_from_the_base(spark, table):
    assert rows_of(table.read(spark)) == []
    table.write(frame(spark, (1, "01:00", 1), (2, "01:00", 2), (3, DAY2, 3)))
    assert table.write(frame(spark, (1, "01:00", None), (4, "01:00", 4))) == 2
    expected = stored((1, "01:00", None), (2, "01:00", 2), (3, DAY2, 3), (4, "01:00", 4))
    assert rows_of(table.read(spark)) == rows_of(spark.table(table.name).drop("dt")) == expected
    table.compact(spark)
    assert spark.table(table.changes_name).count() > 0
    assert rows_of(table.read(spark)) == rows_of(spark.table(table.name).drop("dt")) == expected
    table.delete(frame(spark, (2, "01:00", None), (3, DAY2, None), (9, DAY2, None)))
    expected = [r for r in expected if r[0] not in (2, 3)]
    assert rows_of(table.read(spark)) == expected
    table.compact(spark)
    assert rows_of(table.read(spark)) == rows_of(spark.table(table.current(spark).base).drop("dt")) == expected


def test_small_merge_writes_no_other_key(spark, table):
    days = ["01:00", DAY2, DAY3]
    table.write(frame(spark, *[(z, t, z) for z in range(300) for t in days]))
    table.compact(spark)
    before = base_files(spark, table)
    changed = [(z, DAY2, -z) for z in range(5, 15)]
    version = table.write(frame(spark, *changed))
    assert base_files(spark, table) == before
    written = spark.table(table.changes_name).where(F.col("version") == version)
    assert {r["zip"] for r in written.collect()} == set(range(5, 15))
    assert written.count() == 20 and {str(r["dt"]) for r in written.collect()} == {"2024-01-02"}
    # the same batch again changes nothing and writes nothing
    version = table.write(frame(spark, *changed))
    assert spark.table(table.changes_name).where(F.col("version") == version).count() == 0
    # compaction leaves the files of days without changes
    table.compact(spark)
    assert [f for f in before if "dt=2024-01-02" not in f] == [f for f in base_files(spark, table) if "dt=2024-01-02" not in f]


def test_change_rows_by_version_range(spark, table):
    table.write(frame(spark, (1, "01:00", 1), (2, "01:00", 2)))
    table.write(frame(spark, (1, "01:00", 5), (2, "01:00", 2), (3, DAY2, 3)))
    table.write(frame(spark, (3, DAY2, 3), (2, "01:00", None)), "overwrite")
    one, three, two = at("01:00"), at(DAY2), at("01:00")
    second = [
        (1, one, 1, "update_preimage", 2),
        (1, one, 5, "update_postimage", 2),
        (3, three, 3, "insert", 2),
    ]
    third = [
        (1, one, 5, "delete", 3),
        (2, two, 2, "update_preimage", 3),
        (2, two, None, "update_postimage", 3),
    ]
    assert rows_of(table.changes(spark, 1)) == sorted(second + third, key=repr)
    assert rows_of(table.changes(spark, 1, 2)) == sorted(second, key=repr)
    assert rows_of(table.changes(spark, 3)) == []


def test_versions_stay_readable(spark, table):
    rows = {0: []}
    table.write(frame(spark, (1, "01:00", 1)))
    rows[1] = stored((1, "01:00", 1))
    table.write(frame(spark, (1, "01:00", 2), (2, DAY2, 2)))
    rows[2] = stored((1, "01:00", 2), (2, DAY2, 2))
    held = table.read(spark)
    table.write(frame(spark, (7, DAY3, 7)), "overwrite")
    rows[3] = stored((7, DAY3, 7))
    table.write(frame(spark, (8, DAY3, 8)))
    rows[4] = stored((7, DAY3, 7), (8, DAY3, 8))
    for version, expected in rows.items():
        assert rows_of(table.read(spark, version)) == expected
    assert rows_of(held) == rows[2]  # the frame keeps the version it began with
    assert rows_of(table.read(spark, 2, start=DAY2)) == stored((2, DAY2, 2))
    with pytest.raises(ValueError, match="version"):
        table.read(spark, 5)
    table.compact(spark)
    with pytest.raises(ValueError, match="version"):  # folded into the base
        table.read(spark, 3)
    assert rows_of(table.read(spark)) == rows[4]
    table.forget(spark, 6)
    assert rows_of(table.read(spark)) == rows[4]
    kept = {r[1] for r in spark.sql(f"SHOW TABLES IN {table.name.split('.')[0]}").collect()}
    assert {n for n in kept if "__base_" in n} == {"features__base_3"}
    with pytest.raises(ValueError, match="any more"):
        table.changes(spark, 0)


@pytest.mark.parametrize("step", ["_write_changes", "_commit"])
def test_failed_overwrite_leaves_the_old_version_whole(spark, table, monkeypatch, step):
    table.write(frame(spark, (1, "01:00", 1), (2, DAY2, 2)))
    expected = stored((1, "01:00", 1), (2, DAY2, 2))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(LoggedTable, step, fail)
        for write in (lambda: table.write(frame(spark, (3, DAY3, 3)), "overwrite"), lambda: table.write(frame(spark, (1, "01:00", 9)))):
            with pytest.raises(RuntimeError, match="lost"):
                write()
    assert rows_of(table.read(spark)) == rows_of(spark.table(table.name).drop("dt")) == expected
    table.write(frame(spark, (4, DAY2, 4)))  # takes the number of the failed write, and none of its rows
    assert rows_of(table.read(spark)) == stored((1, "01:00", 1), (2, DAY2, 2), (4, DAY2, 4))
    assert rows_of(table.changes(spark, 1)) == [(4, at(DAY2), 4, "insert", 2)]


def test_failed_compaction_keeps_the_rows(spark, table, monkeypatch):
    table.write(frame(spark, (1, "01:00", 1), (2, DAY2, 2)))
    table.delete(frame(spark, (1, "01:00", 0)))
    write = versions.replace_partitions

    def half(rows, name, *partitions):
        write(rows, name, *partitions)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "replace_partitions", half)
        with pytest.raises(RuntimeError, match="lost"):
            table.compact(spark)
    spark.catalog.refreshTable(table.current(spark).base)
    assert rows_of(table.read(spark)) == stored((2, DAY2, 2))
    with pytest.raises(ValueError, match="version"):
        table.read(spark, 1)
    table.compact(spark)
    assert rows_of(table.read(spark)) == stored((2, DAY2, 2))


def test_lookup_by_name(spark, table):
    table.write(frame(spark, (1, "01:00", 1), (1, DAY2, 2)))
    table.write(frame(spark, (1, DAY2, 5)))
    base = spark.createDataFrame([(1, at("02:00")), (1, at(DAY3)), (2, at(DAY3))], "z int, t timestamp_ntz")
    lookup = FeatureLookup(["f"], ["z"], "t", table.name, options=PitOptions(small_input_bytes=0))
    assert rows_of(add_features(base, [lookup])) == sorted(
        [(1, at("02:00"), 1), (1, at(DAY3), 5), (2, at(DAY3), None)], key=repr
    )
    assert LoggedTable.load(spark, table.name).spec.keys == ("zip",)


def newest(rows):
    found = {}
    for z, t, f in rows:
        if z not in found or found[z][0] < t:
            found[z] = (t, f)
    return sorted([(z, t, f) for z, (t, f) in found.items()], key=repr)


def test_publish_reads_changes_since_the_mark(spark, table, database):
    online = FeatureTable.define(f"{database}.online", ["zip"], SCHEMA, buckets=8).create(spark)
    table.write(frame(spark, *[(z, "01:00", z) for z in range(40)], (1, DAY2, 5)))
    assert table.publish(spark, online) == 1
    assert rows_of(online.read(spark)) == newest(rows_of(table.read(spark)))
    before = set(online.read(spark).inputFiles())
    table.write(frame(spark, (3, DAY2, 7), (2, "00:30", 1)))  # one newer, one older than what is published
    table.publish(spark, online)
    assert rows_of(online.read(spark)) == newest(rows_of(table.read(spark)))
    assert len(before - set(online.read(spark).inputFiles())) <= 2  # at most the buckets of both keys
    table.delete(frame(spark, (1, DAY2, 0), (4, "01:00", 0), (2, "00:30", 0)))
    table.write(frame(spark, (5, "01:00", None)))
    table.publish(spark, online)
    assert rows_of(online.read(spark)) == newest(rows_of(table.read(spark)))
    table.publish(spark, online)  # nothing new
    table.write(frame(spark, (9, DAY3, 1), (10, DAY2, 1)), "overwrite")
    table.publish(spark, online)
    assert rows_of(online.read(spark)) == newest(rows_of(table.read(spark)))
    table.write(frame(spark, (9, "02:00", 1)))
    table.compact(spark)
    table.forget(spark, 10**6)  # the changes are gone, so all rows are read
    table.publish(spark, online)
    assert rows_of(online.read(spark)) == newest(rows_of(table.read(spark)))


def test_through_the_client(spark, database):
    client = FeatureClient(spark)
    rows = frame(spark, (1, "01:00", 1), (1, DAY2, 2), (2, "01:00", 3))
    made = client.create_table(f"{database}.made", ["zip"], timestamp_key="ts", df=rows, description="it's logged", logged=True)
    assert isinstance(made, LoggedTable) and isinstance(client.get_table(made.name), LoggedTable)
    client.create_table(f"{database}.online", ["zip"], SCHEMA)
    client.publish_table(made.name, f"{database}.online")
    assert client.write_table(made.name, frame(spark, (2, DAY3, 4))) == 2
    client.publish_table(made.name, f"{database}.online")
    assert rows_of(client.read_table(f"{database}.online")) == newest(rows_of(client.read_table(made.name)))
    client.write_table(made.name, frame(spark, (5, DAY3, 5)), "overwrite")
    client.drop_table(made.name)
    client.drop_table(made.name)
    assert [r[1] for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["online"]
    made = client.create_table(made.name, ["zip"], SCHEMA, "ts", logged=True)
    assert rows_of(made.read(spark)) == []


def test_stream_and_refusals(spark, table, tmp_path):
    frame(spark, (1, "01:00", 1), (2, DAY2, 2)).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    table.write(source, checkpoint=str(tmp_path / "checkpoint"))
    assert rows_of(table.read(spark)) == stored((1, "01:00", 1), (2, DAY2, 2))
    with pytest.raises(ValueError, match="streams"):
        table.write(source, "overwrite")
    with pytest.raises(ValueError, match="mode"):
        table.write(frame(spark), "append")
    with pytest.raises(KeyViolation):
        table.write(frame(spark, (1, "01:00", 1), (1, "01:00", 2)))
    assert table.current(spark).version == 1
    with pytest.raises(ValueError, match="reserved"):
        LoggedTable.create(spark, f"{table.name}2", ["zip"], SCHEMA + ", version int", "ts")
    with pytest.raises(ValueError, match="time key"):
        LoggedTable(FeatureTable.define("t", ["zip"], "zip int"))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["merge", "merge", "overwrite", "delete", "compact"]),
            st.dictionaries(st.tuples(st.integers(1, 3), st.sampled_from(["01:00", DAY2, DAY3])), st.integers(0, 2), max_size=4),
        ),
        min_size=2,
        max_size=5,
    )
)
def test_any_writes(spark, writes):
    table = LoggedTable.create(spark, f"{scratch_database(spark, 'logged')}.t", ["zip"], SCHEMA, "ts")
    now = {}
    for kind, rows in writes:
        batch = frame(spark, *[(z, t, f) for (z, t), f in rows.items()])
        if kind == "compact":
            table.compact(spark)
        elif kind == "delete":
            table.delete(batch)
            now = {k: v for k, v in now.items() if k not in rows}
        else:
            table.write(batch, kind)
            now = (now if kind == "merge" else {}) | rows
        assert rows_of(table.read(spark)) == stored(*[(z, t, f) for (z, t), f in now.items()])
