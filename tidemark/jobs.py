"""The pipeline as separate jobs, for a scheduler to run.

    spark-submit --py-files tidemark.zip tidemark/jobs.py setup --database ml --source /data/trips
    ... ingest   --database ml --source /data/trips
    ... features --database ml [--start ... --end ... | --after ...]
    ... publish  --database ml [--since ...]
    ... train    --database ml --model /models/fare
    ... score    --database ml --model /models/fare --input ml.fresh --output ml.scored [--log /logs/fare --batch-id 2024-01-31]
    ... stream   --database ml --source /landing/trips --checkpoint /checkpoints/fare
    ... reconcile --database ml --after 2024-01-30 [--until 2024-01-31]

Jobs find each other's tables by name, so the session catalog must outlive one
session (a metastore), and ``spark.checkpoint.dir`` must be shared.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import train_test_split
from tidemark.functions.timefilter import Bound
from tidemark.models.regression import (
    PackagedModel,
    append_inference_log,
    fit_regression,
    inference_log,
    predict,
    rmse_of,
)
from tidemark.operators.refresh import refreshed_features
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, create_training_set
from tidemark.operators.windows import (
    DROPOFF_MEASURES,
    DROPOFF_WINDOW,
    PICKUP_MEASURES,
    PICKUP_WINDOW,
    dropoff_features,
    pickup_features,
)
from tidemark.session import build_session
from tidemark.sources import ingest as loading
from tidemark.sources.scan import create_or_replace, ensure_database, read_path
from tidemark.streaming import features as streaming

# The table names that the jobs share.
RAW = "raw_data"
PICKUPS = "trip_pickup_time_series_features"
DROPOFFS = "trip_dropoff_time_series_features"


@dataclass(frozen=True)
class Columns:
    """Names of the time and label columns in the raw trips."""

    pickup_ts: str = "pickup_ts"
    dropoff_ts: str = "dropoff_ts"
    label: str = "fare_amount"


def setup(spark: SparkSession, database: str, source: DataFrame, columns: Columns = Columns()) -> None:
    """Create the database and load the first day."""
    ensure_database(spark, database)
    create_or_replace(loading.initial_load(source, columns.pickup_ts), f"{database}.{RAW}")


def ingest(
    spark: SparkSession, database: str, source: DataFrame, columns: Columns = Columns(), skip_gaps: bool = False
) -> bool:
    """One scheduled run; True when rows were appended."""
    return loading.scheduled_run(
        spark, source, columns.pickup_ts, f"{database}.{RAW}", skip_gaps=skip_gaps
    )


def _groups(columns: Columns):
    return (
        (PICKUPS, partial(pickup_features, event_ts=columns.pickup_ts, fare=columns.label), columns.pickup_ts, PICKUP_WINDOW),
        (DROPOFFS, partial(dropoff_features, event_ts=columns.dropoff_ts), columns.dropoff_ts, DROPOFF_WINDOW),
    )


def features(
    spark: SparkSession,
    database: str,
    columns: Columns = Columns(),
    start: Bound = None,
    end: Bound = None,
    after: Bound = None,
    mode: str = "overwrite",
) -> None:
    """Build both feature tables from ``[start, end)``, or extend them past ``after``."""
    raw = spark.table(f"{database}.{RAW}")
    for name, build, event_ts, window in _groups(columns):
        if after:
            rows, how = refreshed_features(raw, build, event_ts, window, after), "merge"
        else:
            rows, how = build(raw, ts_column=event_ts, start=start, end=end), mode
        table = FeatureTable.define(f"{database}.{name}", ["zip"], rows.schema, "ts")
        table.create(spark).write(rows, how)


def publish(spark: SparkSession, database: str, since: Bound = None) -> None:
    """Newest row per ZIP of both groups, merged into ``<name>_online``."""
    for name in (PICKUPS, DROPOFFS):
        table = FeatureTable.load(spark, f"{database}.{name}")
        online = FeatureTable.define(f"{table.name}_online", table.keys, table.schema).create(spark)
        table.publish(spark, online, since=since)


def fare_lookups(database: str, columns: Columns = Columns()) -> list[FeatureLookup]:
    return [
        FeatureLookup(list(PICKUP_MEASURES), ["pickup_zip"], columns.pickup_ts, f"{database}.{PICKUPS}"),
        FeatureLookup(
            [*DROPOFF_MEASURES, "dropoff_is_weekend"], ["dropoff_zip"], columns.dropoff_ts, f"{database}.{DROPOFFS}"
        ),
    ]


def train(
    spark: SparkSession,
    database: str,
    model_path: str,
    split_keys: Sequence[str],
    columns: Columns = Columns(),
    rounds: int = 100,
) -> float:
    """Fit on the train part, store the model with its lookups, return the test rmse.

    ``split_keys`` identify a trip; they only place rows in a part and are no features.
    """
    rows = create_training_set(
        spark.table(f"{database}.{RAW}"),
        fare_lookups(database, columns),
        columns.label,
        [columns.pickup_ts, columns.dropoff_ts],
    )
    inputs = [c for c in rows.feature_columns if c not in split_keys]
    base_train, base_test = train_test_split(rows.base, list(split_keys))
    model = fit_regression(
        create_training_set(base_train, rows.lookups, rows.label).load_df(), inputs, columns.label, rounds
    )
    PackagedModel(model, tuple(inputs), rows.lookups).save(spark, model_path)
    tested = create_training_set(base_test, rows.lookups, rows.label).load_df()
    return predict(model, tested).agg(rmse_of(columns.label, "prediction")).first()[0]


def score(
    spark: SparkSession,
    model_path: str,
    rows: DataFrame,
    output: str,
    log_path: str | None = None,
    batch_id: str | None = None,
    version: str = "1",
) -> None:
    """Score into ``output``; with ``log_path`` also log requests and answers, a retried batch once."""
    package = PackagedModel.load(spark, model_path)
    create_or_replace(package.score_batch(rows), output)
    if log_path:
        if not batch_id:
            raise ValueError("a log needs a batch id, so that a retry replaces its batch")
        log = inference_log(spark.table(output), package.feature_columns, version, F.current_timestamp())
        append_inference_log(log, log_path, batch_id)


def stream(
    spark: SparkSession,
    database: str,
    source: str,
    checkpoint: str,
    columns: Columns = Columns(),
    max_files: int = 1000,
) -> int:
    """Bring what has landed into the raw table's feature tables, one run per call.

    Returns how many late (entity, window) sums the watermark left out; above
    zero, run ``reconcile`` over the days they may belong to.
    """
    counter = streaming.DropCounter()
    spark.streams.addListener(counter)
    schema = spark.table(f"{database}.{RAW}").schema
    dropped = 0
    try:
        for name, build, event_ts, _ in _groups(columns):
            landed = streaming.file_stream(spark, source, schema, maxFilesPerTrigger=str(max_files))
            rows = build(spark.table(f"{database}.{RAW}"))
            table = FeatureTable.define(f"{database}.{name}", ["zip"], rows.schema, "ts").create(spark)
            query = streaming.stream_features(landed, build, event_ts, table, f"{checkpoint}/{name}")
            dropped += streaming.dropped_by_watermark(query)
    finally:
        spark.streams.removeListener(counter)
    return max(dropped, sum(counter.dropped.values()))


def reconcile(
    spark: SparkSession, database: str, columns: Columns, after: Bound, until: Bound = None
) -> dict[str, int]:
    """Repair both feature tables for windows that end in ``(after, until]``; how many differed, by table."""
    raw = spark.table(f"{database}.{RAW}")
    return {
        name: streaming.reconcile(
            FeatureTable.load(spark, f"{database}.{name}"), raw, build, event_ts, window, after, until
        )
        for name, build, event_ts, window in _groups(columns)
    }


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark.jobs")
    parser.add_argument("job", choices=["setup", "ingest", "features", "publish", "train", "score", "stream", "reconcile"])
    parser.add_argument("--database", required=True)
    parser.add_argument("--source")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--skip-gaps", action="store_true")
    for bound in ("start", "end", "after", "until", "since"):
        parser.add_argument(f"--{bound}")
    parser.add_argument("--mode", default="overwrite", choices=["overwrite", "merge"])
    parser.add_argument("--model")
    parser.add_argument("--split-keys", default="trip_id")
    parser.add_argument("--rounds", type=int, default=100)
    parser.add_argument("--input")
    parser.add_argument("--log")
    parser.add_argument("--batch-id")
    parser.add_argument("--checkpoint")
    parser.add_argument("--output")
    for name, default in vars(Columns()).items():
        parser.add_argument(f"--{name.replace('_', '-')}", default=default)
    args = parser.parse_args(argv)
    columns = Columns(args.pickup_ts, args.dropoff_ts, args.label)
    spark = build_session(f"tidemark-{args.job}")
    if args.job == "setup":
        setup(spark, args.database, read_path(spark, args.source, args.format), columns)
    elif args.job == "ingest":
        source = read_path(spark, args.source, args.format)
        print("rows appended:", ingest(spark, args.database, source, columns, args.skip_gaps))
    elif args.job == "features":
        features(spark, args.database, columns, args.start, args.end, args.after, args.mode)
    elif args.job == "publish":
        publish(spark, args.database, args.since)
    elif args.job == "train":
        error = train(spark, args.database, args.model, args.split_keys.split(","), columns, args.rounds)
        print("test rmse:", error)
    elif args.job == "stream":
        print("late sums left out:", stream(spark, args.database, args.source, args.checkpoint, columns))
    elif args.job == "reconcile":
        print("repaired:", reconcile(spark, args.database, columns, args.after, args.until))
    else:
        score(spark, args.model, spark.table(args.input), args.output, args.log, args.batch_id)


if __name__ == "__main__":
    main()
