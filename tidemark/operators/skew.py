"""Finding hot keys and cutting their time line into even pieces."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Rows of one key that a single task may sort.
MAX_GROUP_ROWS = 2_000_000
# Cut points are searched in blocks of this many.
BLOCK = 64
# Rows looked at per piece when placing cuts.
SAMPLES_PER_PIECE = 100


@dataclass(frozen=True)
class GroupSizes:
    total: int
    largest: int


def key_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; counts are summed before the shuffle, so a hot key is cheap here."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def group_sizes(rows: DataFrame, keys: Sequence[str]) -> GroupSizes:
    """Total and largest group: one row to the driver."""
    row = key_counts(rows, keys).agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    return GroupSizes(row["total"] or 0, row["largest"] or 0)


def hot_key_cuts(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    sizes: GroupSizes,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame | None:
    """(keys, cuts): ascending times that cut each key of more than ``max_group_rows`` rows into pieces.

    The number of such keys, and of cuts, grows with the input, so the table is
    written to the shared folder and nothing is collected. It has to be fixed
    there: both sides of a lookup must be cut at the same times.

    Only the position of the cuts comes from a sample of about
    ``SAMPLES_PER_PIECE`` rows for each piece: every so many of a key's sampled
    times is a cut. Pieces aim at half of ``max_group_rows``, so that an unlucky
    sample still stays below it. Every row is then assigned to a piece, so an
    uneven cut costs balance and never a row.
    """
    if sizes.largest <= max_group_rows:
        return None
    hot = key_counts(rows, keys).filter(F.col("n") > max_group_rows)
    fraction = min(1.0, SAMPLES_PER_PIECE / max_group_rows)
    looked_at = rows if fraction == 1.0 else rows.sample(fraction, seed=0)
    step = max(1, int(max_group_rows * fraction / 2))
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(ts))
    cuts = (
        looked_at.join(hot.select(*keys), list(keys), "left_semi")
        .withColumn("__at", at)
        .filter(F.col("__at") % step == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set(ts)).alias("cuts"))
    )
    path = scratch_path(rows.sparkSession, "cuts")
    cuts.write.parquet(path)
    return rows.sparkSession.read.schema(cuts.schema).parquet(path)


def piece_of(ts: str, cuts: str = "cuts") -> Column:
    """Number of cuts at or before ``ts`` (0 for keys without cuts).

    Many cuts are searched in two short scans, over every ``BLOCK``-th cut and
    then inside one block, instead of one long one.
    """
    few = f"size(filter({cuts}, x -> x <= {ts}))"
    blocks = f"size(filter(filter({cuts}, (x, i) -> (i + 1) % {BLOCK} = 0), x -> x <= {ts}))"
    inside = f"size(filter(slice({cuts}, __block * {BLOCK} + 1, {BLOCK}), x -> x <= {ts}))"
    many = f"element_at(transform(array({blocks}), __block -> __block * {BLOCK} + {inside}), 1)"
    number = f"CASE WHEN {cuts} IS NULL THEN 0 WHEN size({cuts}) <= {BLOCK} THEN {few} ELSE {many} END"
    return F.expr(number).cast("int")
