"""Half-open time-range filters with literals typed like the column."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone, tzinfo
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Bound = datetime | date | str | None

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
DAY_MICROS = 86_400_000_000


def time_literal(value: datetime | date | str, data_type: T.DataType) -> Column:
    """A constant of the column's own type, so the comparison reaches the scan.

    A Python ``datetime`` sent as such becomes a zoned literal, read in the
    zone of the driver process. The text form is read in the session zone (zoned columns)
    or as is (zone-less columns). Aware datetimes are turned to UTC first.
    """
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
        if not isinstance(data_type, T.TimestampType):
            value = value.replace(tzinfo=None)
    if isinstance(data_type, T.DateType) and isinstance(value, datetime):
        # Comparing at timestamp precision keeps a bound inside a day exact.
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast(data_type)


def ts_range(df: DataFrame, ts_column: str | None, start: Bound = None, end: Bound = None) -> DataFrame:
    """Keep ``start <= ts < end``. A missing bound or column filters nothing."""
    if not ts_column:
        return df
    data_type = df.schema[ts_column].dataType
    if start:
        df = df.filter(F.col(ts_column) >= time_literal(start, data_type))
    if end:
        df = df.filter(F.col(ts_column) < time_literal(end, data_type))
    return df


def time_number(value: Column, data_type: T.DataType) -> Column:
    """A time as it travels to the driver: microseconds since the epoch, or text if it has no zone.

    Text of a zoned time would lose its offset in the hour that a clock change repeats.
    """
    return F.unix_micros(value) if isinstance(data_type, T.TimestampType) else value.cast("string")


def time_value(number: int | str | None) -> datetime | None:
    """The Python form of a ``time_number``: in UTC if the time is zoned, else without a zone."""
    if number is None:
        return None
    if isinstance(number, int):
        return EPOCH + timedelta(microseconds=number)
    return datetime.fromisoformat(number)


def aggregated_times(df: DataFrame, data_type: T.DataType, *aggregates: Column) -> list[datetime | None]:
    """Aggregated times of one type, in one row to the driver."""
    numbers = [time_number(a, data_type).alias(f"t{i}") for i, a in enumerate(aggregates)]
    return [time_value(v) for v in df.agg(*numbers).first()]


def utc_day(value: Column, data_type: T.DataType) -> Column:
    """The day of a time; of a zoned one in UTC, whatever the session zone is."""
    if not isinstance(data_type, T.TimestampType):
        return F.to_date(value)
    micros = F.unix_micros(value)
    day = (micros - F.pmod(micros, F.lit(DAY_MICROS))) / F.lit(DAY_MICROS)
    return F.date_from_unix_date(day.cast("int"))


def session_zone(spark: SparkSession) -> tzinfo:
    name = spark.conf.get("spark.sql.session.timeZone")
    if name in ("Z", "UTC", "GMT"):
        return timezone.utc
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError):  # an offset such as +10:00
        return datetime.strptime(name.removeprefix("UTC").removeprefix("GMT"), "%z").tzinfo
