"""Training sets: base rows plus looked-up features."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefilter import aggregated_times
from tidemark.operators import carry
from tidemark.operators.lookup import PitOptions, key_lookup, pit_lookup
from tidemark.operators.tables import FeatureTable, latest_snapshot
from tidemark.operators.windows import duration_micros
from tidemark.session import estimated_bytes


@dataclass(frozen=True)
class FeatureLookup:
    """Which features to fetch, and by which columns of the base rows.

    ``table_name`` names a feature table, whose key comes from its properties.
    A frame not stored as a table is given as ``frame`` with its key columns.
    Without ``timestamp_lookup_key`` the lookup is by key alone, in a table with
    a time key by its newest row per key.
    """

    feature_names: Sequence[str]
    lookup_key: Sequence[str]
    timestamp_lookup_key: str | None = None
    table_name: str | None = None
    frame: DataFrame | None = field(default=None, compare=False)
    frame_keys: Sequence[str] = ()
    frame_ts: str = "ts"
    options: PitOptions = PitOptions()

    def resolve(self, base: DataFrame) -> tuple[DataFrame, list[str], str | None]:
        """The feature rows this lookup can need, their key and time columns."""
        if self.frame is not None:
            ts = self.frame_ts if self.frame_ts in self.frame.columns else None
            return self.frame, list(self.frame_keys), ts
        spark = base.sparkSession
        table = FeatureTable.load(spark, self.table_name)
        rows = table.read(spark)
        if self.timestamp_lookup_key and table.ts:
            size = estimated_bytes(rows)
            if size is None or size > self.options.small_input_bytes:
                rows = self._within_reach(base, table)
        return rows, list(table.keys), table.ts

    def _within_reach(self, base: DataFrame, table: FeatureTable) -> DataFrame:
        """The stored rows that a lookup can use; the same answers as from all rows.

        Nothing after the last lookup matters. Before the first one only the
        newest row of each key does, so older rows shrink to that by partial
        aggregates and do not enter the sort; with an age limit, rows long
        before it are not read at all. A table with carry folders has that
        row in one of them, and older days are not listed. The bounds are instants (two values to
        the driver), never text of the session zone. Where one side has zoned
        times and the other has not, they cannot be compared before the
        lookup, and all rows are read.
        """
        spark = base.sparkSession
        ts_type = table.schema[table.ts].dataType
        if base.schema[self.timestamp_lookup_key].dataType != ts_type:
            return table.read(spark)
        ts = F.col(self.timestamp_lookup_key)
        first, last = aggregated_times(base, ts_type, F.min(ts), F.max(ts))
        if first is None:
            return table.read(spark)
        after_last = last + timedelta(microseconds=1)
        age = duration_micros(self.options.max_age) if self.options.max_age else None
        if age:
            return table.read(spark, first - timedelta(microseconds=age), after_last)
        names = [n for n in self.feature_names if n in table.features]
        if carry.is_kept(spark, table):
            rows = carry.reachable(spark, table, first, after_last)
            rows = table.read(spark, None, after_last) if rows is None else rows
            # the batch's keys alone; a small batch's keys are broadcast by their own size
            wanted = base.select(*[F.col(c).alias(k) for c, k in zip(self.lookup_key, table.keys)]).distinct()
            rows = rows.select(*table.key_columns, *names)
            return rows.join(wanted, list(table.keys), "left_semi").select(*table.key_columns, *names)
        inside = table.read(spark, first, after_last).select(*table.key_columns, *names)
        before = latest_snapshot(table.read(spark, None, first), table.keys, table.ts, names)
        return inside.unionByName(before.select(*inside.columns))

    def to_dict(self) -> dict:
        if self.table_name is None:
            raise ValueError("only lookups in named tables can be stored")
        return {
            "table_name": self.table_name,
            "feature_names": list(self.feature_names),
            "lookup_key": list(self.lookup_key),
            "timestamp_lookup_key": self.timestamp_lookup_key,
            "allow_exact": self.options.allow_exact,
            "max_age": self.options.max_age,
            "strategy": self.options.strategy,
            "bucket": self.options.bucket,
            "max_group_rows": self.options.max_group_rows,
        }

    @staticmethod
    def from_dict(spec: dict) -> FeatureLookup:
        names = ("allow_exact", "max_age", "strategy", "bucket", "max_group_rows")
        return FeatureLookup(
            spec["feature_names"],
            spec["lookup_key"],
            spec["timestamp_lookup_key"],
            spec["table_name"],
            options=PitOptions(**{n: spec[n] for n in names if n in spec}),
        )


def lookups_to_json(lookups: Sequence[FeatureLookup]) -> str:
    return json.dumps([lookup.to_dict() for lookup in lookups])


def lookups_from_json(text: str) -> list[FeatureLookup]:
    return [FeatureLookup.from_dict(spec) for spec in json.loads(text)]


def add_features(base: DataFrame, lookups: Sequence[FeatureLookup], keep_given: bool = False) -> DataFrame:
    """Base columns, then features in lookup order.

    A feature already among the base columns is an error, or with
    ``keep_given`` is taken from the base rows and not looked up.
    """
    out = base
    for lookup in lookups:
        wanted = [n for n in lookup.feature_names if not (keep_given and n in base.columns)]
        if not wanted:
            continue
        features, keys, ts = lookup.resolve(base)
        if lookup.timestamp_lookup_key is not None and ts is None:
            raise ValueError(f"{lookup.table_name or 'the frame'} has no time key to look up by")
        if lookup.timestamp_lookup_key is None:
            if ts is not None:  # one row per key, or base rows would multiply
                features = latest_snapshot(features, keys, ts, wanted)
            out = key_lookup(out, features, lookup.lookup_key, keys, wanted)
        else:
            out = pit_lookup(
                out,
                features,
                lookup.lookup_key,
                lookup.timestamp_lookup_key,
                keys,
                ts,
                wanted,
                lookup.options,
                probe_source=base,
            )
    return out


@dataclass(frozen=True)
class TrainingSet:
    base: DataFrame
    lookups: tuple[FeatureLookup, ...]
    label: str | None = None
    exclude_columns: tuple[str, ...] = ()

    def load_df(self) -> DataFrame:
        """The training rows. They stay distributed; lookups that measure sizes or
        times of their input run small jobs here, the rest runs when used."""
        return add_features(self.base, self.lookups).drop(*self.exclude_columns)

    @property
    def feature_columns(self) -> list[str]:
        looked_up = [n for lookup in self.lookups for n in lookup.feature_names]
        dropped = {*self.exclude_columns, self.label}
        return [c for c in [*self.base.columns, *looked_up] if c not in dropped]


def create_training_set(
    df: DataFrame,
    feature_lookups: Sequence[FeatureLookup],
    label: str | None,
    exclude_columns: Sequence[str] = (),
) -> TrainingSet:
    if label is not None and label not in df.columns:
        raise ValueError(f"label {label} is not a column of the base rows")
    return TrainingSet(df, tuple(feature_lookups), label, tuple(exclude_columns))


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0.0, keep: Sequence[str] = ()) -> DataFrame:
    """NULL-free copy: ``value`` in place of NULL plus a 0/1 ``_missing`` column.

    No row is lost, and a tree can still split on whether a value was there.
    """
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(value)).alias(c) for c in columns]
    flags = [F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in columns]
    return df.select(*keep, *filled, *flags)
