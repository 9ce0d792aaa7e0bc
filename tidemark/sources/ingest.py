"""Bringing a growing source into a table, day by day."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta
from itertools import count

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timefilter import aggregated_times, session_zone, time_literal, time_number, time_value
from tidemark.sources.scan import append_if_any


def ts_bounds(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def _time(df: DataFrame, ts: str, aggregate) -> datetime | None:
    """One aggregated time, in UTC if the column is zoned."""
    return aggregated_times(df, df.schema[ts].dataType, aggregate)[0]


def _cut(df: DataFrame, value: datetime, days: int, exact_midnight: bool) -> datetime:
    """Midnight ``days`` later, of the session zone if the time is zoned.

    The fraction of a second stays unless asked otherwise.
    """
    local = value if value.tzinfo is None else value.astimezone(session_zone(df.sparkSession))
    cut = (local + timedelta(days=days)).replace(hour=0, minute=0, second=0, fold=0)
    return cut.replace(microsecond=0) if exact_midnight else cut


def initial_load(source: DataFrame, ts: str, exact_midnight: bool = False) -> DataFrame:
    """The first day: rows up to and including the midnight after the oldest row."""
    oldest = _time(source, ts, F.min(ts))
    if oldest is None:
        return source.filter(F.lit(False))
    cut = _cut(source, oldest, 1, exact_midnight)
    return source.filter(F.col(ts) <= time_literal(cut, source.schema[ts].dataType))


def load_step(
    source: DataFrame,
    ts: str,
    loaded_until: datetime,
    exact_midnight: bool = False,
    skip_gaps: bool = False,
) -> DataFrame:
    """Rows after ``loaded_until`` up to and including the midnight two days on.

    Without ``skip_gaps`` a gap longer than that yields nothing, now and in
    every later step. With it the step starts at the next row there is.
    Rows at or before ``loaded_until`` are never taken, however late they come.
    Times of a zoned column are instants: give and get them with a zone.
    """
    data_type = source.schema[ts].dataType
    newer = source.filter(F.col(ts) > time_literal(loaded_until, data_type))
    cut = _cut(source, loaded_until, 2, exact_midnight)
    if skip_gaps:
        following = _time(newer, ts, F.min(ts))
        if following is not None and following > cut:
            cut = _cut(source, following, 1, exact_midnight)
    return newer.filter(F.col(ts) <= time_literal(cut, data_type))


def loaded_until(loaded: DataFrame, ts: str) -> datetime | None:
    return _time(loaded, ts, F.max(ts))


def incremental_load_step(source: DataFrame, loaded: DataFrame, ts: str, **options) -> DataFrame:
    """The rows one scheduled run would append to ``loaded``."""
    until = loaded_until(loaded, ts)
    if until is None:
        return initial_load(source, ts, options.get("exact_midnight", False))
    return load_step(source, ts, until, **options)


@dataclass(frozen=True)
class LoadRound:
    number: int
    n_rows: int
    first: datetime
    last: datetime


def drain(
    spark: SparkSession,
    source: DataFrame,
    ts: str,
    table: str,
    exact_midnight: bool = False,
    skip_gaps: bool = False,
) -> Iterator[LoadRound]:
    """Run the initial load and then steps until one finds nothing.

    The table is replaced by the first round. Each round is one pass over the
    matching source rows: the write itself observes their count and time
    bounds, which give the next start, so neither the source nor the loaded
    table is read a second time.
    """
    source_end = loaded_until(source, ts)
    batch = initial_load(source, ts, exact_midnight)
    data_type = source.schema[ts].dataType
    for number in count():
        seen = Observation()
        watched = batch.observe(
            seen,
            F.count(F.lit(1)).alias("n"),
            time_number(F.min(ts), data_type).alias("first"),
            time_number(F.max(ts), data_type).alias("last"),
        )
        mode = "overwrite" if number == 0 else "append"
        watched.write.format("parquet").mode(mode).saveAsTable(table)
        stats = seen.get
        if not stats["n"]:
            return
        last = time_value(stats["last"])
        yield LoadRound(number, stats["n"], time_value(stats["first"]), last)
        if last >= source_end:
            return
        batch = load_step(source, ts, last, exact_midnight, skip_gaps)


def scheduled_run(spark: SparkSession, source: DataFrame, ts: str, table: str, **options) -> bool:
    """One run of the scheduled job: append what is due; True when rows came."""
    if not spark.catalog.tableExists(table):
        initial_load(source, ts, options.get("exact_midnight", False)).write.format("parquet").mode(
            "overwrite"
        ).saveAsTable(table)
        return True
    return append_if_any(incremental_load_step(source, spark.table(table), ts, **options), table)
