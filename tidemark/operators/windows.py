"""Time-window features per entity, stamped with the window end."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import is_weekend
from tidemark.functions.timefilter import Bound, ts_range
from tidemark.session import estimated_bytes

# Above this optimizer estimate of the input, sliding windows are built from slots.
SLOT_INPUT_BYTES = 64 * 1024 * 1024
# Means of decimals with more digits are taken from rows.
EXACT_DIGITS = 18
# Microseconds per unit of a window duration.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(text: str) -> int | None:
    """Length of ``"<n> <unit>"``, or None for other spellings."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", text.lower())
    if not match or match[2] not in UNIT_MICROS:
        return None
    return int(match[1]) * UNIT_MICROS[match[2]]


def slots_fit(window: str, slide: str | None) -> bool:
    """Whether each window is a whole number of slide-wide slots, more than one."""
    if slide is None:
        return False
    width, step = duration_micros(window), duration_micros(slide)
    return bool(width and step and width > step and width % step == 0)


@dataclass(frozen=True)
class Measure:
    """One windowed aggregate: ``kind`` of ``column``, narrowed to ``type``."""

    kind: str  # count, sum, mean, min or max
    column: str | None = None
    type: str | None = None

    def _cast(self, value: Column) -> Column:
        return value.cast(self.type) if self.type else value

    def direct(self) -> Column:
        if self.kind == "count":
            return self._cast(F.count(F.lit(1) if self.column is None else F.col(self.column)))
        builders = {"sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max}
        return self._cast(builders[self.kind](self.column))

    def needs_rows(self, df: DataFrame) -> bool:
        """Whether slots cannot give the same digits: a mean of decimals too wide to be divided exactly as Spark does."""
        kind = df.schema[self.column].dataType if self.kind == "mean" else None
        return isinstance(kind, T.DecimalType) and kind.precision > EXACT_DIGITS

    def partials(self, name: str, df: DataFrame) -> list[Column]:
        """Aggregates of one slide-wide slot, enough to finish any window of slots."""
        if self.kind == "mean":
            value = F.col(self.column)
            exact = isinstance(df.schema[self.column].dataType, T.DecimalType)
            return [
                F.sum(value if exact else value.cast("double")).alias(f"{name}__sum"),
                F.count(value).alias(f"{name}__n"),
            ]
        return [Measure(self.kind, self.column).direct().alias(f"{name}__part")]

    def finish(self, name: str, df: DataFrame) -> Column:
        """The window's value from its slots, with type and value of the direct form."""
        plain = Measure(self.kind, self.column)
        direct = df.agg(plain.direct().alias("x")).schema["x"].dataType
        if self.kind == "mean":
            total, n = F.sum(f"{name}__sum"), F.sum(f"{name}__n")
            if isinstance(direct, T.DecimalType):
                total, n = total.cast(df.agg(F.sum(self.column).alias("x")).schema["x"].dataType), n.cast("decimal(20,0)")
            return self._cast((total / F.nullif(n, F.lit(0))).cast(direct))
        combine = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind]
        return self._cast(combine(f"{name}__part").cast(direct))


def windowed_features(
    df: DataFrame,
    keys: Mapping[str, str] | Sequence[str],
    ts: str,
    window: str,
    measures: Mapping[str, Measure],
    slide: str | None = None,
    out_ts: str = "ts",
    pre_aggregate: bool | None = None,
) -> DataFrame:
    """One row per entity and non-empty window ``[end - window, end)``.

    ``keys`` maps input to output names (a list keeps names). Windows start at
    multiples of ``slide`` since the epoch; rows without event time are dropped.

    Plain form: every row is copied to the windows it falls in, summed before
    the shuffle, and shuffled once by (key, window). ``pre_aggregate`` first
    sums rows to slide-wide slots, then copies slots instead of rows: a second
    shuffle of slot rows buys ``window / slide`` times less work per input row.
    It pays on large input, where a slot holds many rows, and needs ``window``
    to be a multiple of ``slide``. Left at None it is chosen by the size of the
    input; both forms give the same types and values. Streams, and means of
    decimals of more than ``EXACT_DIGITS`` digits, always use the plain form.
    """
    if pre_aggregate and not slots_fit(window, slide):
        raise ValueError(f"{window} is not several slots of {slide}")
    if pre_aggregate is None:
        pre_aggregate = (
            not df.isStreaming
            and slots_fit(window, slide)
            and (estimated_bytes(df) or 0) > SLOT_INPUT_BYTES
        )
    pre_aggregate = pre_aggregate and not any(m.needs_rows(df) for m in measures.values())
    names = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    entity = [F.col(k).alias(v) for k, v in names.items()]
    direct = [m.direct().alias(n) for n, m in measures.items()]
    if df.isStreaming:
        # The window struct itself is the key the watermark clears state by.
        out = df.groupBy(*entity, F.window(ts, window, slide).alias("__w")).agg(*direct)
        return out.select(*names.values(), F.col("__w.end").alias(out_ts), *measures)
    # In batch the end alone is the key: a plain number, which the hash
    # aggregate handles faster than a struct and which shuffles half the bytes.
    if not pre_aggregate:
        placed = df.withColumn("__w", F.window(ts, window, slide))
        out = placed.groupBy(*entity, F.col("__w.end").alias(out_ts)).agg(*direct)
        return out.select(*names.values(), out_ts, *measures)
    partials = [p for n, m in measures.items() for p in m.partials(n, df)]
    slots = (
        df.withColumn("__w", F.window(ts, slide))
        .groupBy(*entity, F.col("__w.start").alias("__slot"))
        .agg(*partials)
    )
    placed = slots.withColumn("__w", F.window("__slot", window, slide))
    out = placed.groupBy(*names.values(), F.col("__w.end").alias(out_ts)).agg(
        *[m.finish(n, df).alias(n) for n, m in measures.items()]
    )
    return out.select(*names.values(), out_ts, *measures)


# The two feature groups, with the names their users query.
PICKUP_MEASURES = {
    "mean_fare_window_1h_pickup_zip": Measure("mean", "fare_amount", "float"),
    "count_trips_window_1h_pickup_zip": Measure("count", None, "int"),
}
PICKUP_WINDOW, PICKUP_SLIDE = "1 hour", "15 minutes"
DROPOFF_MEASURES = {"count_trips_window_30m_dropoff_zip": Measure("count", None, "int")}
DROPOFF_WINDOW = "30 minutes"


def pickup_features(
    df: DataFrame,
    ts_column: str | None = None,
    start: Bound = None,
    end: Bound = None,
    event_ts: str = "pickup_ts",
    pre_aggregate: bool | None = None,
    fare: str = "fare_amount",
    zip_column: str = "pickup_zip",
) -> DataFrame:
    """Mean fare and trip count of the last hour per pickup ZIP, every 15 minutes."""
    measures = {n: replace(m, column=fare) if m.kind == "mean" else m for n, m in PICKUP_MEASURES.items()}
    return windowed_features(
        ts_range(df, ts_column, start, end),
        {zip_column: "zip"},
        event_ts,
        PICKUP_WINDOW,
        measures,
        slide=PICKUP_SLIDE,
        pre_aggregate=pre_aggregate,
    )


def dropoff_features(
    df: DataFrame,
    ts_column: str | None = None,
    start: Bound = None,
    end: Bound = None,
    event_ts: str = "dropoff_ts",
    zip_column: str = "dropoff_zip",
) -> DataFrame:
    """Trip count per drop-off ZIP and half hour, with the weekend flag of the window end."""
    out = windowed_features(
        ts_range(df, ts_column, start, end),
        {zip_column: "zip"},
        event_ts,
        DROPOFF_WINDOW,
        DROPOFF_MEASURES,
    )
    return out.withColumn("dropoff_is_weekend", is_weekend(F.col("ts"), out.schema["ts"].dataType))
