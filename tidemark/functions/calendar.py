"""Calendar flags as built-in expressions (no Python worker involved)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the flag is defined in New York local time.
WEEKEND_ZONE = "America/New_York"


def is_weekend(ts: Column, data_type: T.DataType, zone: str = WEEKEND_ZONE) -> Column:
    """1 when ``ts`` falls on Saturday or Sunday in ``zone``, else 0; NULL stays NULL.

    Zone-less timestamps are UTC instants. Zoned ones are instants already; the
    conversion starts from the session zone they are shown in, so the result
    does not depend on that zone.
    """
    if isinstance(data_type, T.TimestampType):
        local = F.convert_timezone(None, F.lit(zone), ts)
    else:
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))
    return (F.weekday(local) >= 5).cast("int")
