"""Carry folders: what a lookup needs of all history before a day.

``<table>__carry`` has a folder for every ``every``-th day from the day after the first
stored one to the day after the last. Folder D holds, for every key, its
newest row before D. A lookup whose first time lies on or after D then reads
that folder and the day folders from D on, and no older one.

Merges, deletes and overwrites of the feature table keep the folders: those
after the first changed day are made again, from the last folder that still
holds and the days since. The table property ``feature.carry_until`` names the
last folder that holds. It is lowered before a write and raised after it, so
a job that fails between leaves folders unused, never wrong.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.timefilter import time_literal, utc_day
from tidemark.operators.tables import DAY, FeatureTable, properties, replace_partitions, set_properties

CARRY_DAY = "carry_day"
UNTIL_PROPERTY = "feature.carry_until"
EVERY_PROPERTY = "feature.carry_every"


def carry_name(table: FeatureTable) -> str:
    return f"{table.name}__carry"


def enable(spark: SparkSession, table: FeatureTable, every: int = 1) -> None:
    """Make the carry folders of a stored table; later writes keep them.

    ``every`` trades folders (each has one row per key) for days that a lookup reads.
    """
    if not table.ts:
        raise ValueError(f"{table.name} has no time key")
    if every < 1:
        raise ValueError("every must be at least 1")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {carry_name(table)} ({columns}, {CARRY_DAY} DATE) "
        f"USING parquet PARTITIONED BY ({CARRY_DAY})"
    )
    set_properties(spark, table.name, {EVERY_PROPERTY: str(every), UNTIL_PROPERTY: ""})
    refresh_from(spark, table, None)


def is_kept(spark: SparkSession, table: FeatureTable) -> bool:
    return EVERY_PROPERTY in properties(spark, table.name)


def _days(spark: SparkSession, name: str) -> list[date]:
    """Folder days in order, from the catalog; no file is read."""
    found = (r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    return sorted(date.fromisoformat(v) for v in found if v != "__HIVE_DEFAULT_PARTITION__")


def last_valid(spark: SparkSession, table: FeatureTable, before: date) -> date | None:
    """The newest folder at or before a day that holds."""
    until = properties(spark, table.name).get(UNTIL_PROPERTY)
    if not until:
        return None
    limit = min(before, date.fromisoformat(until))
    usable = [d for d in _days(spark, carry_name(table)) if d <= limit]
    return usable[-1] if usable else None


def lower(spark: SparkSession, table: FeatureTable, first_changed: date | None) -> None:
    """Before a write: folders after its first day no longer hold. ``None``: none does."""
    until = properties(spark, table.name).get(UNTIL_PROPERTY)
    if not until:
        return
    kept = "" if first_changed is None else min(until, first_changed.isoformat())
    set_properties(spark, table.name, {UNTIL_PROPERTY: kept})


def read_folder(spark: SparkSession, table: FeatureTable, day: date) -> DataFrame:
    rows = spark.table(carry_name(table)).where(F.col(CARRY_DAY) == F.lit(day))
    return rows.select(*table.schema.names)


def refresh_from(spark: SparkSession, table: FeatureTable, first_changed: date | None) -> None:
    """After a write: make the folders after ``first_changed`` (or all) again.

    Rows shrink to the newest of each key and day before anything is sorted;
    each of those is then listed for the folders up to the key's next day.
    """
    stored = _days(spark, table.name)
    if not stored:
        _drop(spark, table, _days(spark, carry_name(table)))
        set_properties(spark, table.name, {UNTIL_PROPERTY: ""})
        return
    every = int(properties(spark, table.name)[EVERY_PROPERTY])
    grid, day = [], stored[0] + timedelta(days=1)
    while day <= stored[-1]:
        grid.append(day)
        day += timedelta(days=every)
    grid.append(stored[-1] + timedelta(days=1))  # what comes next reads this one folder
    base = last_valid(spark, table, first_changed) if first_changed else None
    stale = [d for d in grid if base is None or d > base]
    keys, rest = list(table.keys), [c for c in table.schema.names if c not in table.keys]
    rows = spark.table(table.name).select(*table.schema.names, F.col(DAY).alias("__day"))
    if base is not None:
        # the folder itself stands for the day before it, and for all earlier ones
        before = read_folder(spark, table, base).withColumn("__day", F.lit(base - timedelta(days=1)))
        rows = rows.where(F.col(DAY) >= F.lit(base)).unionByName(before)
    newest = rows.groupBy(*keys, "__day").agg(
        *[(F.max(c) if c == table.ts else F.max_by(c, table.ts)).alias(c) for c in rest]
    )
    following = F.lead("__day").over(Window.partitionBy(*keys).orderBy("__day"))
    folders = F.array(*[F.lit(d) for d in stale])
    listed = newest.withColumn("__next", following).withColumn(
        CARRY_DAY,
        F.explode(F.filter(folders, lambda d: (d > F.col("__day")) & (F.col("__next").isNull() | (d <= F.col("__next"))))),
    )
    if stale:
        replace_partitions(listed.select(*table.schema.names, CARRY_DAY), carry_name(table), CARRY_DAY)
    _drop(spark, table, [d for d in _days(spark, carry_name(table)) if d not in grid])
    set_properties(spark, table.name, {UNTIL_PROPERTY: grid[-1].isoformat()})


def _drop(spark: SparkSession, table: FeatureTable, days: list[date]) -> None:
    if days:
        specs = ", ".join(f"PARTITION ({CARRY_DAY}='{d}')" for d in days)
        spark.sql(f"ALTER TABLE {carry_name(table)} DROP IF EXISTS {specs}")


def reachable(spark: SparkSession, table: FeatureTable, first, last_exclusive) -> DataFrame | None:
    """All rows that lookups in ``[first, last_exclusive)`` can use, or ``None`` without a folder that serves.

    No folder serves when the lookups begin before the first one: nothing is
    stored before the table's first day, so reading from there is as cheap.
    """
    ts_type = table.schema[table.ts].dataType
    # a value and not a filter, as it chooses the folders that are planned at all
    day = spark.range(1).select(utc_day(time_literal(first, ts_type), ts_type)).first()[0]
    base = last_valid(spark, table, day)
    if base is None:
        return None
    recent = spark.table(table.name).where(F.col(DAY) >= F.lit(base))
    recent = recent.where(F.col(DAY) <= utc_day(time_literal(last_exclusive, ts_type), ts_type))
    recent = recent.where(F.col(table.ts) < time_literal(last_exclusive, ts_type))
    return read_folder(spark, table, base).unionByName(recent.select(*table.schema.names))
