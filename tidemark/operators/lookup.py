"""Feature lookups: latest value before a time, and by key alone."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import MAX_GROUP_ROWS, GroupSizes, group_sizes, hot_key_cuts, piece_of
from tidemark.session import estimated_bytes

# Up to this optimizer estimate (compressed file bytes) one task can hold any group.
SMALL_INPUT_BYTES = 64 * 1024 * 1024
STRATEGIES = ("auto", "sorted", "bucketed", "split")
_DEALT_BY = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class PitOptions:
    """How a point-in-time lookup treats equal times, age and skew.

    allow_exact   also accept a feature stamped at the lookup time itself
    max_age       ignore features older than this, e.g. ``"6 hours"``
    matched_ts    output column for the time of the feature row that was used
    strategy      ``sorted``: one shuffle by key and one sorted pass per key.
                  ``split``: only hot keys are cut, at measured times.
                  ``bucketed``: every key is cut at multiples of ``bucket``,
                  and a hot bucket again at measured times.
                  ``auto``: ``sorted`` for small input or when no key is hot
                  by count, else ``split``.
    """

    allow_exact: bool = False
    max_age: str | None = None
    matched_ts: str | None = None
    strategy: str = "auto"
    bucket: str = "1 day"
    max_group_rows: int = MAX_GROUP_ROWS
    small_input_bytes: int = SMALL_INPUT_BYTES


def _common_ts_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if T.TimestampType() in (a, b):
        return T.TimestampType()
    return T.TimestampNTZType()


def _all_present(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return present


def _null_features(schema: T.StructType) -> Column:
    return F.lit(None).cast(schema)


def pit_lookup(
    left: DataFrame,
    features: DataFrame,
    left_keys: Sequence[str],
    left_ts: str,
    feature_keys: Sequence[str],
    feature_ts: str,
    feature_names: Sequence[str],
    options: PitOptions = PitOptions(),
    probe_source: DataFrame | None = None,
) -> DataFrame:
    """For each left row, the features of the latest earlier row with its key.

    Every left row comes out once, copies included. The newest row is used as
    a whole, so a NULL in it is returned as NULL. An unknown key, a NULL key or
    a time before the first feature gives NULLs.

    ``features`` must be unique by (keys, time). ``probe_source`` names a
    cheaper frame with the same keys and times as ``left``; assembling a chain
    of lookups passes the base rows, so earlier lookups are not run again.
    """
    if options.strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if len(left_keys) != len(feature_keys):
        raise ValueError("lookup key and feature table key differ in length")
    added = list(feature_names) + ([options.matched_ts] if options.matched_ts else [])
    clash = sorted(set(added) & set(left.columns))
    if clash:
        raise ValueError(f"columns already present: {clash}")

    ts_type = _common_ts_type(
        left.schema[left_ts].dataType, features.schema[feature_ts].dataType
    )
    keys = [f"__k{i}" for i in range(len(left_keys))]
    feature_rows = features.filter(_all_present([*feature_keys, feature_ts])).select(
        *[F.col(c).alias(k) for c, k in zip(feature_keys, keys)],
        F.col(feature_ts).cast(ts_type).alias("__t"),
        F.struct(F.col(feature_ts).alias("__ft"), *feature_names).alias("__f"),
    )
    source = left if probe_source is None else probe_source
    probe_rows = source.select(
        *[F.col(c).alias(k) for c, k in zip(left_keys, keys)],
        F.col(left_ts).cast(ts_type).alias("__t"),
    )

    strategy, sizes = options.strategy, None
    if strategy == "auto":
        strategy, sizes = _choose(probe_rows, feature_rows, keys, options)
    if strategy == "sorted":
        matched = _sorted_pass(left, feature_rows, left_keys, left_ts, keys, ts_type, options)
    else:
        matched = _resolve_and_join(
            left, probe_rows, feature_rows, left_keys, left_ts, keys, ts_type, strategy, sizes, options
        )
    return _emit(matched, left.columns, left_ts, ts_type, feature_names, options)


def _is_small(source: DataFrame, features: DataFrame, options: PitOptions) -> bool:
    estimates = [estimated_bytes(source), estimated_bytes(features)]
    return None not in estimates and sum(estimates) <= options.small_input_bytes


def _choose(
    probes: DataFrame, feature_rows: DataFrame, keys: list[str], options: PitOptions
) -> tuple[str, GroupSizes | None]:
    if _is_small(probes, feature_rows, options):
        return "sorted", None
    # Only key columns are read here, and counts are summed before the shuffle.
    both = probes.select(*keys).unionByName(feature_rows.select(*keys))
    sizes = group_sizes(both, keys)
    return ("sorted" if sizes.largest <= options.max_group_rows else "split"), sizes


def _latest(partition: list[str]) -> Column:
    """Latest feature struct so far; the running frame needs no look-ahead."""
    w = Window.partitionBy(*partition).orderBy("__t", "__side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return F.last("__f", ignorenulls=True).over(w)


def _sides(options: PitOptions) -> tuple[int, int]:
    """Order of (feature, lookup) rows that carry the same time."""
    return (0, 1) if options.allow_exact else (1, 0)


def _sorted_pass(
    left: DataFrame,
    feature_rows: DataFrame,
    left_keys: Sequence[str],
    left_ts: str,
    keys: list[str],
    ts_type: T.DataType,
    options: PitOptions,
) -> DataFrame:
    """Union both sides, sort each key by time once, carry the last feature on.

    Left rows with a NULL key only meet each other (feature rows with NULL keys
    are gone), and a NULL time sorts before every feature, so both get NULLs.
    The former are dealt by a hash of all that they hold, so that no task has
    them all.
    """
    feature_side, left_side = _sides(options)
    plain = [f.name for f in left.schema.fields if isinstance(f.dataType, _DEALT_BY)]
    no_key = reduce(or_, [F.col(c).isNull() for c in left_keys])
    left_rows = left.select(
        *[F.col(c).alias(k) for c, k in zip(left_keys, keys)],
        F.col(left_ts).cast(ts_type).alias("__t"),
        F.lit(left_side).alias("__side"),
        F.when(no_key, F.xxhash64(*plain)).otherwise(F.lit(0)).alias("__deal"),
        F.struct(*left.columns).alias("__row"),
        _null_features(feature_rows.schema["__f"].dataType).alias("__f"),
    )
    stacked = left_rows.unionByName(
        feature_rows.withColumns(
            {
                "__side": F.lit(feature_side),
                "__deal": F.lit(0).cast("long"),
                "__row": F.lit(None).cast(left_rows.schema["__row"].dataType),
            }
        )
    )
    return (
        stacked.withColumn("__f", _latest([*keys, "__deal"]))
        .filter(F.col("__side") == left_side)
        .select("__row.*", "__f")
    )


def _resolve_and_join(
    left: DataFrame,
    probe_rows: DataFrame,
    feature_rows: DataFrame,
    left_keys: Sequence[str],
    left_ts: str,
    keys: list[str],
    ts_type: T.DataType,
    strategy: str,
    sizes: GroupSizes | None,
    options: PitOptions,
) -> DataFrame:
    """Answer each distinct (key, time) once, in pieces, then join the answers back.

    - Copies of a (key, time) shrink to one probe before the shuffle; NULL keys
      never become probes.
    - A piece is one key over one stretch of time. The last feature before a
      piece is added to it as one carry-in row, so pieces are independent.
    - The join back is an equi-join of the left rows with a side unique by
      (key, time): adaptive execution splits a hot left partition.
    """
    feature_side, left_side = _sides(options)
    probes = probe_rows.filter(_all_present([*keys, "__t"])).distinct()
    rows = probes.select(
        *keys,
        "__t",
        F.lit(left_side).alias("__side"),
        _null_features(feature_rows.schema["__f"].dataType).alias("__f"),
    ).unionByName(feature_rows.withColumn("__side", F.lit(feature_side)))

    times = probe_rows.filter(_all_present([*keys, "__t"])).unionByName(
        feature_rows.select(*keys, "__t")
    )
    group = keys
    if strategy == "bucketed":
        start = F.window("__t", options.bucket)["start"]
        rows, times = rows.withColumn("__bucket", start), times.withColumn("__bucket", start)
        group = [*keys, "__bucket"]
    cuts = None
    if strategy == "split" or not _is_small(probe_rows, feature_rows, options):
        sizes = sizes or group_sizes(times, group)
        cuts = hot_key_cuts(times, group, "__t", sizes, options.max_group_rows)
    piece = F.lit(0)
    if cuts is not None:
        # A row per hot key, without a hint: Spark broadcasts the table while its files are
        # small, else adaptive execution splits the hot keys' rows of this join.
        rows = rows.join(cuts, group, "left")
        piece = piece_of("__t")
    if strategy == "bucketed":
        rows = rows.withColumn("__piece", F.struct("__bucket", piece.alias("cut")))
        rows = rows.unionByName(_carry_in(rows, keys, feature_side), allowMissingColumns=True)
    elif cuts is not None:
        rows = rows.withColumn("__piece", piece)
        hot = rows.filter(F.col("cuts").isNotNull())
        rows = rows.unionByName(_carry_in(hot, keys, feature_side), allowMissingColumns=True)
    else:
        rows = rows.withColumn("__piece", piece)
    answers = (
        rows.withColumn("__f", _latest([*keys, "__piece"]))
        .filter(F.col("__side") == left_side)
        .select(*keys, F.col("__t").alias("__at"), "__f")
    )
    on = F.col(left_ts).cast(ts_type) == F.col("__at")
    for c, k in zip(left_keys, keys):
        on = on & (left[c] == F.col(k))
    return left.join(answers, on, "left").drop(*keys, "__at")


def _carry_in(rows: DataFrame, keys: list[str], feature_side: int) -> DataFrame:
    """For each piece, the last feature row of its key before the piece.

    Pieces are first summed up to their own last feature (before the shuffle),
    so the window below runs over one row per piece, not over the data.
    """
    fields = [f.name for f in rows.schema["__f"].dataType.fields]
    feature_time = F.when(F.col("__f").isNotNull(), F.col("__t"))
    ends = rows.groupBy(*keys, "__piece").agg(
        F.max(feature_time).alias("__t"),
        *[
            F.max_by(F.col("__f")[name], feature_time).alias(f"__v{i}")
            for i, name in enumerate(fields)
        ],
    )
    packed = F.when(
        F.col("__t").isNotNull(),
        F.struct(
            "__t",
            F.struct(*[F.col(f"__v{i}").alias(name) for i, name in enumerate(fields)]).alias("__f"),
        ),
    )
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__last", packed).withColumn(
        "__last", F.last("__last", ignorenulls=True).over(before)
    )
    return carried.filter(F.col("__last").isNotNull()).select(
        *keys, "__last.__t", F.lit(feature_side).alias("__side"), "__last.__f", "__piece"
    )


def _emit(
    matched: DataFrame,
    left_columns: list[str],
    left_ts: str,
    ts_type: T.DataType,
    feature_names: Sequence[str],
    options: PitOptions,
) -> DataFrame:
    use = F.col("__f").isNotNull()
    if options.max_age:
        oldest = F.col(left_ts).cast(ts_type) - F.expr(f"INTERVAL {options.max_age}")
        use = use & (F.col("__f.__ft").cast(ts_type) >= oldest)
    outputs = [F.when(use, F.col("__f")[n]).alias(n) for n in feature_names]
    if options.matched_ts:
        outputs.append(F.when(use, F.col("__f.__ft")).alias(options.matched_ts))
    return matched.select(*left_columns, *outputs)


def key_lookup(
    left: DataFrame,
    features: DataFrame,
    left_keys: Sequence[str],
    feature_keys: Sequence[str],
    feature_names: Sequence[str],
) -> DataFrame:
    """Features by key alone, from a table unique by that key.

    No broadcast hint: Spark broadcasts the table when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle,
    where adaptive execution splits hot left keys.
    """
    clash = sorted(set(feature_names) & set(left.columns))
    if clash:
        raise ValueError(f"columns already present: {clash}")
    keys = [f"__k{i}" for i in range(len(left_keys))]
    right = features.filter(_all_present(feature_keys)).select(
        *[F.col(c).alias(k) for c, k in zip(feature_keys, keys)], *feature_names
    )
    on = F.lit(True)
    for c, k in zip(left_keys, keys):
        on = on & (left[c] == right[k])
    return left.join(right, on, "left").select(*[left[c] for c in left.columns], *feature_names)
