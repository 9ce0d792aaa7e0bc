"""Loading a growing source by a manifest of what is loaded.

The raw table has folders by day and load. ``<table>__loads`` is its manifest: for each
load and day the number of rows and the first and last time. A scheduled run
takes its next cut from the manifest, and no loaded row is read for it. A load
counts once its manifest rows are written; files of one that failed are not
shown by ``loaded`` and are replaced by the next run, which has the same number.

Cuts are those of ``sources/ingest.py``. ``drain`` finds all of them from one
aggregate of the source by day and writes every load in one more pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefilter import session_zone, time_literal, time_number, time_value, utc_day
from tidemark.operators.tables import DAY, replace_partitions
from tidemark.session import delete_path, scratch_path
from tidemark.sources.ingest import LoadRound, _cut, initial_load, load_step

LOAD = "load"


def manifest_name(table: str) -> str:
    return f"{table}__loads"


def _create(spark: SparkSession, table: str, schema: T.StructType, ts: str) -> None:
    reserved = {LOAD, DAY} & set(schema.names)
    if reserved:
        raise ValueError(f"reserved column names: {sorted(reserved)}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {DAY} DATE, {LOAD} BIGINT) "
        f"USING parquet PARTITIONED BY ({DAY}, {LOAD})"
    )
    kind = schema[ts].dataType.simpleString()
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {manifest_name(table)} "
        f"({LOAD} BIGINT, {DAY} DATE, n_rows BIGINT, first_ts {kind}, last_ts {kind}) USING parquet"
    )


def loads(spark: SparkSession, table: str) -> DataFrame:
    """The manifest: ``load``, day ``dt``, ``n_rows``, ``first_ts``, ``last_ts``."""
    return spark.table(manifest_name(table))


def _state(spark: SparkSession, table: str, ts_type: T.DataType) -> tuple[int, datetime | None]:
    """Number of the next load, and the last loaded time; one row, of the manifest alone."""
    row = loads(spark, table).agg(F.max(LOAD), time_number(F.max("last_ts"), ts_type)).first()
    return (0 if row[0] is None else row[0] + 1), time_value(row[1])


def loaded(spark: SparkSession, table: str) -> DataFrame:
    """The raw rows of all loads that the manifest has."""
    rows = spark.table(table)
    number, _ = _state(spark, table, T.TimestampNTZType())
    return rows.where(F.col(LOAD) < number).drop(DAY, LOAD)


def _write(rows: DataFrame, ts: str, table: str, first: int) -> DataFrame:
    """Write rows with their ``load`` to their folders and then to the manifest; its new rows.

    The manifest reads back one column of what was written, not the source.
    """
    spark, ts_type = rows.sparkSession, rows.schema[ts].dataType
    left = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    stale = [p for p in left if int(p[1].split("=", 1)[1]) >= first]
    if stale:
        specs = ", ".join(f"PARTITION ({DAY}='{d.split('=', 1)[1]}', {LOAD}={n.split('=', 1)[1]})" for d, n in stale)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    replace_partitions(rows.withColumn(DAY, utc_day(F.col(ts), ts_type)), table, DAY, LOAD)
    written = spark.table(table).where(F.col(LOAD) >= first).groupBy(LOAD, DAY)
    new = written.agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    new.coalesce(1).write.insertInto(manifest_name(table))
    return loads(spark, table).where(F.col(LOAD) >= first)


def scheduled_run(spark: SparkSession, source: DataFrame, ts: str, table: str, **options) -> bool:
    """Load what is due, the first day if nothing is loaded yet; True when rows came.

    ``options`` are those of ``load_step``. The source is read once, for the due range alone.
    """
    _create(spark, table, source.schema, ts)
    number, until = _state(spark, table, source.schema[ts].dataType)
    if until is None:
        due = initial_load(source, ts, options.get("exact_midnight", False))
    else:
        due = load_step(source, ts, until, **options)
    return not _write(due.withColumn(LOAD, F.lit(number).cast("long")), ts, table, number).isEmpty()


def drain(
    spark: SparkSession,
    source: DataFrame,
    ts: str,
    table: str,
    exact_midnight: bool = False,
    skip_gaps: bool = False,
) -> list[LoadRound]:
    """All loads that scheduled runs would make from here on, until one finds nothing.

    Two passes over the source whatever their number: an aggregate by day, from
    which all cuts follow, and the write. The driver holds one row per day.
    """
    _create(spark, table, source.schema, ts)
    ts_type = source.schema[ts].dataType
    number, until = _state(spark, table, ts_type)
    days = _Days(source, ts)
    cuts = list(days.cuts(until, exact_midnight, skip_gaps))
    if cuts:
        rows = source if until is None else source.where(F.col(ts) > time_literal(until, ts_type))
        rows = rows.where(F.col(ts) <= time_literal(cuts[-1], ts_type))
        of_day = days.loads_by_day(cuts, number)
        # a row for each day, met by its number
        met = rows.withColumn("__day", _local_day(F.col(ts))).join(F.broadcast(of_day), "__day")
        met = met.withColumn(LOAD, F.col("__load") + F.coalesce(F.col(ts) > F.col("__cut"), F.lit(False)).cast("long"))
        _write(met.drop("__day", "__cut", "__load"), ts, table, number)
    days.close()
    rows = loads(spark, table).where(F.col(LOAD) >= number).groupBy(LOAD).agg(
        F.sum("n_rows").alias("n"), time_number(F.min("first_ts"), ts_type).alias("a"), time_number(F.max("last_ts"), ts_type).alias("b")
    )
    return [LoadRound(r[LOAD], r["n"], time_value(r["a"]), time_value(r["b"])) for r in rows.orderBy(LOAD).collect()]


def _local_day(ts: Column) -> Column:
    """Days of the session zone, in which cuts are midnights."""
    return F.to_date(ts)


class _Days:
    """Counts and bounds of a source by day.

    A cut lies in the first second of a day. So that it can be placed exactly,
    times in that second are kept one by one, in the staged table; the driver
    gets one row per day, and looks into the second only if a cut splits it.
    """

    def __init__(self, source: DataFrame, ts: str):
        self.source, self.ts, self.type = source, ts, source.schema[ts].dataType
        spark = source.sparkSession
        time = F.col(ts)
        early = F.when(time < F.date_trunc("day", time).cast(self.type) + F.expr("INTERVAL 1 SECOND"), time)
        by_day = source.where(time.isNotNull()).groupBy(_local_day(time).alias("day"), early.alias("early"))
        self.path = scratch_path(spark, "days")
        by_day.agg(F.min(ts).alias("first"), F.max(ts).alias("last")).write.parquet(self.path)
        self.staged = spark.read.parquet(self.path)
        found = self.staged.groupBy("day").agg(
            *[
                time_number(of, self.type).alias(name)
                for name, of in (("first", F.min("first")), ("last", F.max("last")), ("early", F.min("early")), ("late", F.max("early")))
            ]
        )
        self.rows = {
            r["day"]: tuple(time_value(r[n]) for n in ("first", "last", "early", "late")) for r in found.collect()
        }
        self.days = sorted(self.rows)

    def close(self) -> None:
        delete_path(self.source.sparkSession, self.path)

    def _day(self, time: datetime) -> date:
        return (time if time.tzinfo is None else time.astimezone(session_zone(self.source.sparkSession))).date()

    def _early_before(self, day: date, cut: datetime) -> datetime | None:
        """The last time in the first second of a day up to the cut in it."""
        early, late = self.rows[day][2:]
        if early is None or early > cut:
            return None
        if late <= cut:
            return late
        inside = self.staged.where((F.col("day") == F.lit(day)) & (F.col("early") <= time_literal(cut, self.type)))
        return time_value(inside.agg(time_number(F.max("early"), self.type)).first()[0])

    def last_up_to(self, cut: datetime) -> datetime | None:
        day = self._day(cut)
        found = self._early_before(day, cut) if day in self.rows else None
        earlier = [d for d in self.days if d < day]
        return found or (self.rows[earlier[-1]][1] if earlier else None)

    def _after(self, until: datetime) -> datetime | None:
        """The first time after ``until``."""
        later = [d for d in self.days if self.rows[d][1] > until]
        if not later:
            return None
        if self.rows[later[0]][0] > until:
            return self.rows[later[0]][0]
        newer = self.source.where(F.col(self.ts) > time_literal(until, self.type))
        return time_value(newer.agg(time_number(F.min(self.ts), self.type)).first()[0])

    def cuts(self, until: datetime | None, exact_midnight: bool, skip_gaps: bool) -> Iterator[datetime]:
        if not self.days:
            return
        while True:
            if until is None:
                cut = _cut(self.source, self.rows[self.days[0]][0], 1, exact_midnight)
            else:
                cut = _cut(self.source, until, 2, exact_midnight)
                if skip_gaps:
                    following = self._after(until)
                    if following is not None and following > cut:
                        cut = _cut(self.source, following, 1, exact_midnight)
            last = self.last_up_to(cut)
            if last is None or (until is not None and last <= until):
                return
            yield cut
            until = last
            if last >= self.rows[self.days[-1]][1]:
                return

    def loads_by_day(self, cuts: list[datetime], number: int) -> DataFrame:
        """(day, load of its first rows, cut inside the day or NULL)."""
        spark = self.source.sparkSession
        on = {self._day(cut): cut for cut in cuts}
        rows = [(d, number + sum(self._day(c) < d for c in cuts), on.get(d)) for d in self.days]
        literals = [
            F.struct(
                F.lit(d).alias("__day"),
                F.lit(n).cast("long").alias("__load"),
                (F.lit(None).cast(self.type) if c is None else time_literal(c, self.type)).alias("__cut"),
            )
            for d, n, c in rows
        ]
        return spark.range(1).select(F.inline(F.array(*literals)))
