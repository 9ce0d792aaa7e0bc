"""Feature tables that record their changes and are read at a version.

A logged table is four catalog objects. ``<name>__base_<n>`` holds rows by day.
``<name>__changes`` holds the change rows of every write, in folders by
version and day. ``<name>__log`` has a row for each version. ``<name>`` is a view:
the base rows without a newer change, and the newest change of each changed key.

- A merge or delete writes its change rows and nothing else, however few of a
  day's rows it touches. The cost moves to the reader, who joins the changes
  since the last compaction; ``compact`` folds them into the days they touch.
- An overwrite writes a base of its own. Readers of the old one are not
  disturbed, and it stays readable by version until ``forget``.
- A write takes effect when the view is replaced, which the catalog does at
  once. A job that fails before leaves files no reader sees, and the next write of
  that version replaces them.

One writer per table is assumed, as for all feature tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changes import AFTER, BEFORE, DELETE, INSERT, change_feed
from tidemark.operators.tables import (
    DAY,
    FeatureTable,
    latest_snapshot,
    properties,
    replace_partitions,
    set_properties,
)

VERSION, CHANGE = "version", "change_type"
PUBLISHED = "feature.published_version"


@dataclass(frozen=True)
class Commit:
    """A version: the base its rows come from, and up to which version the base has all changes.

    ``floor`` is the oldest version that could still be read when it was written.
    """

    version: int
    mode: str
    base: str
    base_version: int
    floor: int


class LoggedTable:
    """A table with a time key whose writes are versions."""

    def __init__(self, spec: FeatureTable):
        if not spec.ts:
            raise ValueError(f"{spec.name} has no time key")
        taken = {VERSION, CHANGE} & set(spec.schema.names)
        if taken:
            raise ValueError(f"reserved column names: {sorted(taken)}")
        self.spec, self.name = spec, spec.name
        self.changes_name, self.log_name = f"{spec.name}__changes", f"{spec.name}__log"

    @staticmethod
    def create(
        spark: SparkSession, name: str, keys: Sequence[str], schema: T.StructType | str, ts: str, comment: str = ""
    ) -> LoggedTable:
        """An empty table at version 0."""
        table = LoggedTable(FeatureTable.define(name, keys, schema, ts, comment))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.spec.schema.fields)
        spark.sql(
            f"CREATE TABLE {table.changes_name} ({columns}, {CHANGE} STRING, {VERSION} BIGINT, {DAY} DATE) "
            f"USING parquet PARTITIONED BY ({VERSION}, {DAY})"
        )
        spark.sql(
            f"CREATE TABLE {table.log_name} ({VERSION} BIGINT, mode STRING, base STRING, base_version BIGINT, "
            "floor BIGINT, committed_at TIMESTAMP) USING parquet"
        )
        if comment:
            escaped = comment.replace("'", "\\'")
            spark.sql(f"COMMENT ON TABLE {table.changes_name} IS '{escaped}'")
        base = table._base(0).create(spark)
        table._commit(spark, Commit(0, "create", base.name, 0, 0))
        return table

    @staticmethod
    def load(spark: SparkSession, name: str) -> LoggedTable:
        return LoggedTable(FeatureTable.load(spark, name))

    @staticmethod
    def is_logged(spark: SparkSession, name: str) -> bool:
        return VERSION in properties(spark, name)

    def drop(self, spark: SparkSession) -> None:
        """Remove the view first, so that no reader meets a half-removed table."""
        bases = [r[0] for r in self.history(spark).select("base").distinct().collect()]
        spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for name in [*bases, self.changes_name, self.log_name]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    @property
    def ts(self) -> str:
        return self.spec.ts

    @property
    def schema(self) -> T.StructType:
        return self.spec.schema

    def _base(self, version: int) -> FeatureTable:
        return FeatureTable.define(f"{self.name}__base_{version}", self.spec.keys, self.spec.schema, self.spec.ts)

    # -- versions -------------------------------------------------------------

    def history(self, spark: SparkSession) -> DataFrame:
        """One row per version."""
        return spark.table(self.log_name)

    def current(self, spark: SparkSession, version: int | None = None) -> Commit:
        """The commit that readers see, or the one that a version was."""
        rows = self.history(spark)
        shown = int(properties(spark, self.name)[VERSION]) if version is None else version
        # of two rows for one version, the first comes from a write that failed before its view
        fields = F.struct(VERSION, "committed_at", "mode", "base", "base_version", "floor")
        found = rows.where(F.col(VERSION) <= shown).agg(F.max(fields).alias("c")).first()["c"]
        if found is None:
            raise ValueError(f"{self.name} has no version {version}")
        commit = Commit(found[VERSION], found["mode"], found["base"], found["base_version"], found["floor"])
        if version is not None:
            newest = self.current(spark)
            if not newest.floor <= version <= newest.version:
                raise ValueError(f"{self.name} can be read from version {newest.floor} to {newest.version}")
        return commit

    def _commit(self, spark: SparkSession, commit: Commit) -> None:
        """Log the version, then show it by replacing the view."""
        spark.sql(
            f"INSERT INTO {self.log_name} VALUES ({commit.version}, '{commit.mode}', '{commit.base}', "
            f"{commit.base_version}, {commit.floor}, current_timestamp())"
        )
        spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ({self.spec._properties()}, '{VERSION}'='{commit.version}') "
            f"AS {self._sql(commit, commit.version)}"
        )

    def _sql(self, commit: Commit, version: int) -> str:
        """Rows of a version: what a view can hold, so text and not a frame."""
        on = [*self.spec.key_columns, DAY]
        rest = self.spec.features
        names = ", ".join(f"`{c}`" for c in [*self.spec.schema.names, DAY])
        if commit.base_version == version:
            return f"SELECT {names} FROM {commit.base}"
        keys = ", ".join(f"`{c}`" for c in on)
        values = ", ".join(f"`{c}`" for c in [CHANGE, *rest])
        taken = ", ".join(f"r.`{c}`" if c in rest else f"`{c}`" for c in [*self.spec.schema.names, DAY])
        same = " AND ".join(f"b.`{c}` = n.`{c}`" for c in on)
        return (
            f"WITH newest AS (SELECT {keys}, max_by(struct({values}), {VERSION}) AS r FROM {self.changes_name} "
            f"WHERE {VERSION} > {commit.base_version} AND {VERSION} <= {version} AND {CHANGE} <> '{BEFORE}' GROUP BY {keys}) "
            f"SELECT {names} FROM {commit.base} b LEFT ANTI JOIN newest n ON {same} "
            f"UNION ALL SELECT {taken} FROM newest WHERE r.{CHANGE} <> '{DELETE}'"
        )

    # -- reading ------------------------------------------------------------

    def read(self, spark: SparkSession, version: int | None = None, start=None, end=None) -> DataFrame:
        """Rows now, or at a version, with ``start <= ts < end``; the bounds prune day folders of both parts.

        The version is settled here: the frame stays at it, whatever is written meanwhile.
        """
        commit = self.current(spark, version)
        rows = spark.sql(self._sql(commit, commit.version if version is None else version))
        return self.spec.between(rows, start, end).select(*self.spec.schema.names)

    def changes(self, spark: SparkSession, after: int, until: int | None = None) -> DataFrame:
        """Change rows of the versions in ``(after, until]``: columns, ``change_type``, ``version``."""
        newest = self.current(spark)
        if after < self._kept_from(spark):
            raise ValueError(f"{self.name} has no changes of before version {self._kept_from(spark) + 1} any more")
        until = newest.version if until is None else min(until, newest.version)
        rows = spark.table(self.changes_name).where((F.col(VERSION) > after) & (F.col(VERSION) <= until))
        return rows.select(*self.spec.schema.names, CHANGE, VERSION)

    def _kept_from(self, spark: SparkSession) -> int:
        """Changes up to this version are gone."""
        return int(properties(spark, self.changes_name).get("feature.forgotten", "0"))

    # -- writing --------------------------------------------------------------

    def _write_changes(self, spark: SparkSession, rows: DataFrame, version: int) -> None:
        shown = rows.withColumn(VERSION, F.lit(version).cast("long"))
        self._drop_changes(spark, lambda v: v >= version)  # left by a failed write
        replace_partitions(shown, self.changes_name, VERSION, DAY)

    def _drop_changes(self, spark: SparkSession, gone: Callable[[int], bool]) -> None:
        folders = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {self.changes_name}").collect()]
        named = [dict(part.split("=", 1) for part in folder) for folder in folders]
        specs = [f"PARTITION ({VERSION}={n[VERSION]}, {DAY}='{n[DAY]}')" for n in named if gone(int(n[VERSION]))]
        if specs:
            spark.sql(f"ALTER TABLE {self.changes_name} DROP IF EXISTS {', '.join(specs)}")

    def merge(self, df: DataFrame, validate: bool = True) -> int:
        """Insert new keys and replace existing ones whole. Rows that change nothing are not written.

        Stored rows are read for the days and keys of the batch only. Returns the version.
        """
        spark = df.sparkSession
        now = self.current(spark)
        with self._base(0)._staged(df, validate) as (incoming, touched):
            stored = spark.sql(self._sql(now, now.version)).where(F.col(DAY).isin(touched))
            on = [*self.spec.key_columns, DAY]
            met = stored.join(incoming.select(*on), on, "left_semi")
            self._write_changes(spark, change_feed(met, incoming, on, CHANGE), now.version + 1)
        return self._next(spark, now, "merge")

    def delete(self, keys: DataFrame) -> int:
        """Remove the rows with these keys."""
        spark = keys.sparkSession
        now = self.current(spark)
        gone = self.spec.key_rows(keys)
        touched = [r[0] for r in gone.select(DAY).distinct().collect()]
        stored = spark.sql(self._sql(now, now.version)).where(F.col(DAY).isin(touched))
        met = stored.join(gone, [*self.spec.key_columns, DAY], "left_semi")
        self._write_changes(spark, met.withColumn(CHANGE, F.lit(DELETE)), now.version + 1)
        return self._next(spark, now, "delete")

    def _next(self, spark: SparkSession, now: Commit, mode: str) -> int:
        self._commit(spark, Commit(now.version + 1, mode, now.base, now.base_version, now.floor))
        return now.version + 1

    def overwrite(self, df: DataFrame, validate: bool = True) -> int:
        """Replace all rows by a base of their own; the change rows against the old ones are logged too."""
        spark = df.sparkSession
        now = self.current(spark)
        version = now.version + 1
        base = self._base(version).create(spark, replace=True)
        base.overwrite(df, validate)
        old = spark.sql(self._sql(now, now.version))
        self._write_changes(spark, change_feed(old, spark.table(base.name), [*self.spec.key_columns, DAY], CHANGE), version)
        self._commit(spark, Commit(version, "overwrite", base.name, version, now.floor))
        return version

    def write(self, df: DataFrame, mode: str = "merge", **stream_options) -> StreamingQuery | int:
        """As ``FeatureTable.write``; every micro-batch of a stream is a version."""
        if df.isStreaming:
            if mode != "merge":
                raise ValueError("streams can only be merged")
            return self.spec.merge_stream(df, **({"merge": lambda batch, _: self.merge(batch)} | stream_options))
        if mode not in ("merge", "overwrite"):
            raise ValueError("mode must be merge or overwrite")
        return self.merge(df) if mode == "merge" else self.overwrite(df)

    # -- upkeep -----------------------------------------------------------------

    def compact(self, spark: SparkSession) -> int:
        """Fold the changes into the days of the base that they touch. Rows stay the same.

        Older versions on this base cannot be read afterwards, nor while it runs, so
        that is logged first. Until the end is logged, readers still join the changes,
        which gives the same rows from days that are folded already.
        """
        now = self.current(spark)
        if now.version == now.base_version:
            return now.version
        pending = spark.table(self.changes_name).where(
            (F.col(VERSION) > now.base_version) & (F.col(VERSION) <= now.version)
        )
        touched = [r[0] for r in pending.select(DAY).distinct().collect()]  # days of the log's folders
        started = Commit(now.version + 1, "compact", now.base, now.base_version, now.version)
        self._commit(spark, started)
        rows = spark.sql(self._sql(now, now.version)).where(F.col(DAY).isin(touched))
        if touched:
            kept = {r[0] for r in rows.select(DAY).distinct().collect()}
            replace_partitions(rows, now.base, DAY)
            specs = ", ".join(f"PARTITION ({DAY}='{d}')" for d in touched if d not in kept)
            if specs:
                spark.sql(f"ALTER TABLE {now.base} DROP IF EXISTS {specs}")
        spark.catalog.refreshTable(now.base)
        done = started.version + 1
        self._commit(spark, Commit(done, "compacted", now.base, done, done))
        return done

    def forget(self, spark: SparkSession, before: int) -> None:
        """Drop bases and change rows that no version from ``before`` on needs."""
        now = self.current(spark)
        before = min(before, now.version)
        floor = max(now.floor, before)
        self._commit(spark, Commit(now.version + 1, "forget", now.base, now.base_version, floor))
        used = {now.base, self.current(spark, floor).base}
        used |= {r[0] for r in self.history(spark).where(F.col(VERSION) >= floor).select("base").distinct().collect()}
        for (base,) in self.history(spark).select("base").distinct().collect():
            if base not in used:
                spark.sql(f"DROP TABLE IF EXISTS {base}")
        needed_after = min(now.base_version, floor, self.current(spark, floor).base_version)
        set_properties(spark, self.changes_name, {"feature.forgotten": str(needed_after)})
        self._drop_changes(spark, lambda v: v <= needed_after)

    # -- publishing ---------------------------------------------------------------

    def publish(self, spark: SparkSession, online: FeatureTable) -> int:
        """Bring a table keyed without time to the newest row per key, from the changes since the last time.

        The version published last is a property of ``online``, set at the end, so a
        run that failed is simply run again. Only the buckets of changed keys are
        rewritten. History is read for one kind of key alone: one whose published
        row was deleted. The first run, or one after its changes were forgotten,
        reads all rows.
        """
        if online.ts:
            raise ValueError("publish goes from a table with a time key to one without")
        keys, ts, features = self.spec.keys, self.spec.ts, self.spec.features
        now = self.current(spark)
        mark = properties(spark, online.name).get(PUBLISHED)
        if mark is None or int(mark) < self._kept_from(spark):
            online.overwrite(latest_snapshot(self.read(spark), keys, ts, features))
        elif int(mark) < now.version:
            values = F.struct(CHANGE, *features)
            last = self.changes(spark, int(mark), now.version).where(F.col(CHANGE) != BEFORE)
            last = last.groupBy(*keys, ts).agg(F.max_by(values, VERSION).alias("r")).select(*keys, ts, "r.*")
            gained = last.where(F.col(CHANGE).isin(INSERT, AFTER)).drop(CHANGE)
            online.merge(latest_snapshot(gained, keys, ts, features), newest_by=ts)
            lost = last.where(F.col(CHANGE) == DELETE).select(*keys, ts)
            lost = online.read(spark).join(lost, [*keys, ts], "left_semi").select(*keys)
            if not lost.isEmpty():
                left = self.read(spark).join(lost, list(keys), "left_semi")
                # both are planned before either is written
                found = online.stage(latest_snapshot(left, keys, ts, features))
                gone = online.stage(lost.withColumns({c: F.lit(None) for c in online.schema.names if c not in keys}))
                online.delete(spark.table(gone))
                online.merge(spark.table(found))
                for name in (found, gone):
                    spark.sql(f"DROP TABLE IF EXISTS {name}")
        set_properties(spark, online.name, {PUBLISHED: str(now.version)})
        return now.version
