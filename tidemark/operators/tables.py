"""Keyed feature tables on plain parquet catalog tables.

A table is partitioned by day (``dt``, in UTC for zoned times) when it has a
time key, else by a hash bucket of its key. Writes replace only the partitions they touch, through
Spark's dynamic partition overwrite: new files are written aside and moved in
when the job commits, so a table may feed its own update and a failed job
leaves the old rows. The move is atomic per partition, not across partitions;
one writer per table is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timefilter import Bound, time_literal, ts_range, utc_day

DAY = "dt"
BUCKET = "key_bucket"
BUCKETS = 64
KEYS_PROPERTY = "feature.keys"
TS_PROPERTY = "feature.ts"
BUCKETS_PROPERTY = "feature.buckets"


class KeyViolation(ValueError):
    """Rows break the table key: a NULL key column or a repeated key."""


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per broken key: (keys, n_rows, reason).

    One aggregation with counts summed before the shuffle, so many copies of
    one key, or many NULL keys, cost one row per task.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        *keys,
        "n_rows",
        F.when(any_null, "null key").when(F.col("n_rows") > 1, "duplicate key").alias("reason"),
    ).filter(F.col("reason").isNotNull())


def latest_snapshot(df: DataFrame, keys: Sequence[str], ts: str, features: Sequence[str]) -> DataFrame:
    """Newest row per key. ``df`` must be unique by (keys, ts).

    One ``max_by`` per column and not one over a struct: fixed-width buffers
    keep this a hash aggregate with a partial step, whereas a struct buffer
    would sort the input. The key being unique, all of them pick the same row.
    """
    return df.groupBy(*keys).agg(
        F.max(ts).alias(ts), *[F.max_by(name, ts).alias(name) for name in features]
    )


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def set_properties(spark: SparkSession, name: str, values: dict[str, str]) -> None:
    listed = ", ".join(f"'{k}'='{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def replace_partitions(rows: DataFrame, name: str, *partitions: str) -> None:
    """Write the partitions that ``rows`` have, and leave the others of the table.

    Rebalancing gives each partition value files of even size: small days are
    joined up and a hot day is split over tasks by adaptive execution. The mode
    is a session setting, as an option of the write would not let a table feed
    its own update.
    """
    spark = rows.sparkSession
    shaped = rows.select(*spark.table(name).columns).hint("rebalance", *partitions)
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        shaped.write.mode("overwrite").insertInto(name)


@contextmanager
def _setting(spark: SparkSession, option: str, value: str) -> Iterator[None]:
    before = spark.conf.get(option)
    spark.conf.set(option, value)
    try:
        yield
    finally:
        spark.conf.set(option, before)


@dataclass(frozen=True)
class FeatureTable:
    """Name, key, optional time key and row schema of a feature table.

    ``schema`` is DDL text or a ``StructType`` of keys, time and features.
    """

    name: str
    keys: tuple[str, ...]
    schema: T.StructType
    ts: str | None = None
    comment: str = ""
    buckets: int = BUCKETS

    @staticmethod
    def define(
        name: str,
        keys: Sequence[str],
        schema: T.StructType | str,
        ts: str | None = None,
        comment: str = "",
        buckets: int = BUCKETS,
    ) -> FeatureTable:
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        table = FeatureTable(name, tuple(keys), schema, ts, comment, buckets)
        missing = [c for c in table.key_columns if c not in schema.names]
        if missing:
            raise ValueError(f"key columns missing from the schema: {missing}")
        if ts and not isinstance(schema[ts].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            raise ValueError("the time key must be a timestamp or a date")
        if table.partition in schema.names:
            raise ValueError(f"column name {table.partition} is reserved")
        return table

    @staticmethod
    def load(spark: SparkSession, name: str) -> FeatureTable:
        """The spec of a table made by ``create`` or ``promote``."""
        props = properties(spark, name)
        if KEYS_PROPERTY not in props:
            raise ValueError(f"{name} is not a feature table")
        fields = [f for f in spark.table(name).schema.fields if f.name not in (DAY, BUCKET)]
        return FeatureTable(
            name,
            tuple(props[KEYS_PROPERTY].split(",")),
            T.StructType(fields),
            props.get(TS_PROPERTY) or None,
            buckets=int(props.get(BUCKETS_PROPERTY, BUCKETS)),
        )

    @property
    def key_columns(self) -> tuple[str, ...]:
        return self.keys + ((self.ts,) if self.ts else ())

    @property
    def features(self) -> list[str]:
        return [n for n in self.schema.names if n not in self.key_columns]

    @property
    def partition(self) -> str:
        return DAY if self.ts else BUCKET

    def _partition_value(self) -> Column:
        if self.ts:
            return utc_day(F.col(self.ts), self.schema[self.ts].dataType)
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _shape(self, df: DataFrame) -> DataFrame:
        """Columns in table order and type, partition value last."""
        cast = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return cast.withColumn(self.partition, self._partition_value())

    # -- definition ---------------------------------------------------------

    def create(self, spark: SparkSession, replace: bool = False) -> FeatureTable:
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        kind = "DATE" if self.ts else "INT"
        comment = self.comment.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}, {self.partition} {kind}) "
            f"USING parquet PARTITIONED BY ({self.partition}) COMMENT '{comment}' "
            f"TBLPROPERTIES ({self._properties()})"
        )
        return self

    def _properties(self) -> str:
        props = {
            KEYS_PROPERTY: ",".join(self.keys),
            TS_PROPERTY: self.ts or "",
            BUCKETS_PROPERTY: str(self.buckets),
        }
        return ", ".join(f"'{k}'='{v}'" for k, v in props.items())

    @staticmethod
    def promote(
        spark: SparkSession,
        source: str,
        keys: Sequence[str],
        ts: str | None = None,
        into: str | None = None,
    ) -> FeatureTable:
        """Make an existing table a feature table once its key holds.

        A table already partitioned as feature tables are is marked in place,
        if every row lies in the partition that its key asks for; any other is
        copied to ``into``.
        """
        rows = spark.table(source)
        fields = [f for f in rows.schema.fields if f.name not in (DAY, BUCKET)]
        table = FeatureTable.define(into or source, keys, T.StructType(fields), ts)
        if into:
            table.create(spark).overwrite(rows)
            return table
        parts = [c.name for c in spark.catalog.listColumns(source) if c.isPartition]
        if parts != [table.partition]:
            raise ValueError(f"{source} is not partitioned by {table.partition}; give into=")
        table.check(rows)
        astray = rows.filter(~F.col(table.partition).eqNullSafe(table._partition_value()))
        if not astray.isEmpty():
            raise ValueError(f"{source} has rows in other partitions than their key asks for; give into=")
        spark.sql(f"ALTER TABLE {source} SET TBLPROPERTIES ({table._properties()})")
        return table

    def describe(self, spark: SparkSession) -> DataFrame:
        """(column_name, data_type, role, n_rows, n_null) of the stored rows."""
        rows = self.read(spark)
        counts = rows.agg(
            F.count(F.lit(1)).alias("n_rows"), *[F.count(n).alias(f"c_{n}") for n in self.schema.names]
        )
        roles = {k: "key" for k in self.keys} | ({self.ts: "time key"} if self.ts else {})
        described = F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.lit(roles.get(f.name, "feature")).alias("role"),
                    F.col("n_rows"),
                    (F.col("n_rows") - F.col(f"c_{f.name}")).alias("n_null"),
                )
                for f in self.schema.fields
            ]
        )
        return counts.select(F.inline(described))

    # -- reading ------------------------------------------------------------

    def read(self, spark: SparkSession, start: Bound = None, end: Bound = None) -> DataFrame:
        """Rows with ``start <= ts < end``; the bounds also prune day folders."""
        return self.between(spark.table(self.name), start, end).select(*self.schema.names)

    def between(self, df: DataFrame, start: Bound = None, end: Bound = None) -> DataFrame:
        """Stored rows of a range of times; needs the day column."""
        if self.ts and (start or end):
            ts_type = self.schema[self.ts].dataType
            if start:
                df = df.filter(F.col(DAY) >= utc_day(time_literal(start, ts_type), ts_type))
            if end:
                df = df.filter(F.col(DAY) <= utc_day(time_literal(end, ts_type), ts_type))
            df = ts_range(df, self.ts, start, end)
        return df

    # -- writing ------------------------------------------------------------

    def check(self, df: DataFrame) -> None:
        bad = key_violations(df, self.key_columns).take(1)
        if bad:
            raise KeyViolation(f"{self.name}: {bad[0].asDict()}")

    def write(self, df: DataFrame, mode: str = "merge", **stream_options) -> StreamingQuery | None:
        """``merge`` or ``overwrite`` a batch; merge every micro-batch of a stream."""
        if df.isStreaming:
            if mode != "merge":
                raise ValueError("streams can only be merged")
            return self.merge_stream(df, **stream_options)
        if mode == "merge":
            self.merge(df)
        elif mode == "overwrite":
            self.overwrite(df)
        else:
            raise ValueError("mode must be merge or overwrite")
        return None

    def stage(self, df: DataFrame) -> str:
        """Rows in table order, written to a table of their own beside this one; its name."""
        database = self.name.rsplit(".", 1)[0] + "." if "." in self.name else ""
        name = f"{database}stage_{uuid.uuid4().hex}"
        self._shape(df).write.format("parquet").saveAsTable(name)
        return name

    def key_rows(self, keys: DataFrame) -> DataFrame:
        """Distinct keys with the partition that each lies in."""
        typed = keys.select(*[F.col(k).cast(self.schema[k].dataType).alias(k) for k in self.key_columns])
        return typed.withColumn(self.partition, self._partition_value()).distinct()

    @contextmanager
    def _staged(self, df: DataFrame, validate: bool) -> Iterator[tuple[DataFrame, list]]:
        """The incoming rows, written once beside the table, and their partition values.

        The key check, the list of touched partitions and the write all read
        this copy, so an expensive feature plan is not run once for each.
        """
        spark = df.sparkSession
        stage = self.stage(df)
        try:
            rows = spark.table(stage)
            yield rows, self._touched(rows, validate)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {stage}")

    def _touched(self, rows: DataFrame, validate: bool) -> list:
        """Days or buckets of a batch (few by nature), checking its key on the way.

        A partition value depends on the key alone, so grouping by it as well
        leaves the key check as it is and makes both one job.
        """
        if not validate:
            return [r[0] for r in rows.select(self.partition).distinct().collect()]
        broken = F.col("n") > 1
        for k in self.key_columns:
            broken = broken | F.col(k).isNull()
        per_key = rows.groupBy(self.partition, *self.key_columns).agg(F.count(F.lit(1)).alias("n"))
        found = per_key.groupBy(self.partition).agg(F.bool_or(broken).alias("broken")).collect()
        if any(r["broken"] for r in found):
            self.check(rows)
        return [r[self.partition] for r in found]

    def _replace_partitions(self, rows: DataFrame) -> None:
        replace_partitions(rows.select(*self.schema.names, self.partition), self.name, self.partition)

    @contextmanager
    def _carried(self, spark: SparkSession, touched: Sequence) -> Iterator[None]:
        """Keeps the carry folders of a table that has them, see ``operators/carry.py``."""
        from tidemark.operators import carry

        days = [d for d in touched if d is not None]
        if not self.ts or not days or not carry.is_kept(spark, self):
            yield
            return
        carry.lower(spark, self, min(days))
        yield
        carry.refresh_from(spark, self, min(days))

    def merge(self, df: DataFrame, newest_by: str | None = None, validate: bool = True) -> None:
        """Insert new keys and replace existing ones as whole rows, NULLs included.

        Writing the same batch again changes nothing. With ``newest_by`` a
        stored row with a later value in that column stays.
        """
        with self._staged(df, validate) as (incoming, touched):
            if not touched:
                return
            stored = df.sparkSession.table(self.name).filter(F.col(self.partition).isin(touched))
            with self._carried(df.sparkSession, touched):
                self._replace_partitions(
                    merge_rows(stored, incoming, self.key_columns, newest_by, self.partition)
                )
        if not self.ts:
            self.analyze(df.sparkSession)

    def overwrite(self, df: DataFrame, validate: bool = True) -> None:
        """Replace the table. New partitions are committed before stale ones go."""
        spark = df.sparkSession
        with self._staged(df, validate) as (incoming, values):
            touched = {str(v) for v in values}
            listed = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
            changed = [date.fromisoformat(v) for v in touched.union(listed)] if self.ts else []
            with self._carried(spark, changed):
                if touched:
                    self._replace_partitions(incoming)
                stale = [v for v in listed if v not in touched]
                if stale:
                    specs = ", ".join(f"PARTITION ({self.partition}='{v}')" for v in stale)
                    spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")
            self.analyze(spark)

    def delete(self, keys: DataFrame) -> None:
        """Remove the rows whose key is in ``keys``; only the partitions they lie in are rewritten."""
        spark = keys.sparkSession
        gone = self.key_rows(keys)
        touched = [r[0] for r in gone.select(self.partition).distinct().collect()]
        if not touched:
            return
        stored = spark.table(self.name).filter(F.col(self.partition).isin(touched))
        left = stored.join(gone, [*self.key_columns, self.partition], "left_anti")
        kept = {r[0] for r in left.select(self.partition).distinct().collect()}
        with self._carried(spark, touched):
            self._replace_partitions(left)
            specs = ", ".join(f"PARTITION ({self.partition}='{v}')" for v in touched if v not in kept)
            if specs:  # nothing is left to be written there
                spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {specs}")

    def analyze(self, spark: SparkSession) -> None:
        """Record the table size (a file listing, no scan).

        It lets Spark broadcast a small table in a key lookup and a time lookup
        skip its skew measurement. Every later insert clears it again, so it is
        never stale. Done after overwrites and for tables without time key;
        listing all days after each merge would cost more than it gives.
        """
        spark.sql(f"ANALYZE TABLE {self.name} COMPUTE STATISTICS NOSCAN")

    def merge_stream(
        self,
        df: DataFrame,
        checkpoint: str,
        wait: bool = True,
        trigger: dict | None = None,
        merge: Callable[[DataFrame, int], object] | None = None,
    ) -> StreamingQuery:
        """Merge each micro-batch, here or by ``merge`` (given its number too). Replayed batches are harmless: merge is idempotent.

        Micro-batches without input are left out. In update mode they give no
        rows; old state is then cleared by the next batch that has some.
        """

        def merge_batch(batch: DataFrame, batch_id: int) -> None:
            if merge is None:
                self.merge(batch)
            else:
                merge(batch, batch_id)

        writer = (
            df.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .foreachBatch(merge_batch)
        )
        with _setting(df.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled", "false"):
            query = writer.start()
        if wait:
            query.awaitTermination()
            # micro-batches write in a session of their own; this one's file listing is old by now
            df.sparkSession.catalog.refreshTable(self.name)
        return query

    def publish(
        self, spark: SparkSession, online: FeatureTable, mode: str = "merge", since: Bound = None
    ) -> None:
        """Push the newest row per key to a table keyed without time.

        In merge mode a later row already there stays, so publishing out of
        order, or twice, is safe. ``since`` limits a regular run to the days
        written after the last one.
        """
        if not self.ts or online.ts:
            raise ValueError("publish goes from a table with a time key to one without")
        latest = latest_snapshot(self.read(spark, since), self.keys, self.ts, self.features)
        if mode == "merge":
            online.merge(latest, newest_by=self.ts)
        else:
            online.write(latest, mode)


def merge_rows(
    stored: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    newest_by: str | None = None,
    partition: str | None = None,
) -> DataFrame:
    """Stored rows without a newer version, plus the incoming ones.

    Both sides are unique by ``keys``. Plain merge is an anti join (Spark
    broadcasts a small batch by itself); with ``newest_by`` the later of the
    two versions of a key wins and the incoming one wins a tie.
    """
    on = list(keys) + ([partition] if partition else [])
    if newest_by is None:
        return stored.join(incoming.select(*on), on, "left_anti").unionByName(incoming)
    rest = [c for c in incoming.columns if c not in on]
    both = stored.select(*on, F.struct(*rest).alias("__old")).join(
        incoming.select(*on, F.struct(*rest).alias("__new")), on, "full_outer"
    )
    keep_old = F.col("__old").isNotNull() & (
        F.col("__new").isNull() | (F.col(f"__old.{newest_by}") > F.col(f"__new.{newest_by}"))
    )
    return both.select(*on, F.when(keep_old, F.col("__old")).otherwise(F.col("__new")).alias("__row")).select(
        *on, "__row.*"
    )
