"""Recomputing part of a feature table without damaging window edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefilter import Bound, time_literal
from tidemark.operators.tables import FeatureTable

Builder = Callable[[DataFrame], DataFrame]


def refreshed_features(
    source: DataFrame,
    build: Builder,
    event_ts: str,
    window: str,
    after: Bound,
    until: Bound = None,
    out_ts: str = "ts",
) -> DataFrame:
    """Features whose window end lies in ``(after, until]``, all of them complete.

    A window ending just past ``after`` reaches back by its own length, so the
    source is read from ``after - window``. Filtering the source at ``after``
    itself would compute those windows from part of their rows, and merging
    would then replace whole counts by partial ones. The time bounds are constants,
    so they reach the scan.
    """
    event_type = source.schema[event_ts].dataType
    reach = time_literal(after, event_type) - F.expr(f"INTERVAL {window}")
    rows = source.filter(F.col(event_ts) >= reach)
    if until:
        rows = rows.filter(F.col(event_ts) < time_literal(until, event_type))
    built = build(rows)
    out_type = built.schema[out_ts].dataType
    built = built.filter(F.col(out_ts) > time_literal(after, out_type))
    if until:
        built = built.filter(F.col(out_ts) <= time_literal(until, out_type))
    return built


def refresh(
    table: FeatureTable,
    source: DataFrame,
    build: Builder,
    event_ts: str,
    window: str,
    after: Bound,
    until: Bound = None,
) -> None:
    """Recompute and merge. Also the way to bring in late rows of a past day."""
    table.merge(refreshed_features(source, build, event_ts, window, after, until, table.ts))
