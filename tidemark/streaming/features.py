"""Structured Streaming upkeep of feature tables, ingest and enrichment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions.timefilter import Bound, aggregated_times, time_literal
from tidemark.operators.changes import AFTER, BEFORE, DELETE, INSERT, change_feed
from tidemark.operators.refresh import refreshed_features
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, add_features
from tidemark.session import delete_path, path_exists, require_utc, scratch_path

WATERMARK = "2 hours"
AVAILABLE_NOW = {"availableNow": True}


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as UTC instants; watermarks accept only zoned ones."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    if not columns:
        return df
    require_utc(df.sparkSession)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in columns})


def stream_features(
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    event_ts: str,
    table: FeatureTable,
    checkpoint: str,
    watermark: str = WATERMARK,
    trigger: dict | None = None,
    wait: bool = True,
    late: LateWindows | None = None,
) -> StreamingQuery:
    """Keep ``table`` equal to ``build`` over everything streamed so far.

    Update mode sends each window again when it changes and the merge replaces
    it, so no window waits for the watermark (append mode would hold the last
    ones back). The watermark only bounds the state. Rows later than it are
    left out; a ``DropCounter`` tells how many sums that were and ``reconcile``
    brings them in. With ``late`` the windows they belong to are listed, and
    ``late.repair`` computes those alone again.
    """
    if table.ts and isinstance(table.schema[table.ts].dataType, T.TimestampNTZType):
        require_utc(stream.sparkSession)  # else instants would be stored as another zone's wall clock
    built = build(zoned(stream).withWatermark(event_ts, watermark))
    options = {"checkpoint": checkpoint, "trigger": trigger, "wait": wait}
    if late is None:
        return table.write(built, **options)
    both, merge = late.beside(built, zoned(stream), event_ts, table, watermark)
    return table.write(both, merge=merge, **options)


@dataclass(frozen=True)
class LateWindows:
    """Lists the windows of rows that come later than the watermark, for ``repair``.

    path     folder of this stream in the shared file system: (keys, time) of
             late windows, and the highest event time, by micro-batch
    entity   event columns and the table keys they become
    window, slide   of the features

    The rows of a micro-batch travel beside its sums, so they meet the same
    watermark: the highest time of earlier micro-batches less the delay. A window that ended
    by then may have lost a row. Some listed windows have not; to compute
    them again does no harm. A replayed micro-batch overwrites its own folder.
    """

    path: str
    entity: Mapping[str, str]
    window: str
    slide: str

    def _ends(self, rows: DataFrame, event_ts: str, ts_type: T.DataType, ts: str) -> DataFrame:
        """Distinct keys and ends of the windows that rows lie in."""
        found = rows.select(
            *[F.col(c).alias(k) for c, k in self.entity.items()], F.window(event_ts, self.window, self.slide)["end"].alias(ts)
        )
        return found.withColumn(ts, F.col(ts).cast(ts_type)).distinct()

    def beside(
        self, built: DataFrame, stream: DataFrame, event_ts: str, table: FeatureTable, watermark: str
    ) -> tuple[DataFrame, Callable[[DataFrame, int], None]]:
        """Sums and rows as one stream, and what to do with each micro-batch of it."""
        sums = F.struct(*built.columns)
        seen = F.struct(*[F.col(c) for c in dict.fromkeys([*self.entity, event_ts])])
        rows = stream.select(seen.alias("seen"))
        none = F.lit(None)
        both = built.select(sums.alias("sums"), none.cast(rows.schema["seen"].dataType).alias("seen")).unionByName(
            rows.select(none.cast(built.select(sums.alias("s")).schema["s"].dataType).alias("sums"), "seen")
        )
        ts_type = table.schema[table.ts].dataType

        def merge(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            held = scratch_path(spark, "micro-batch")
            batch.write.parquet(held)  # evaluated once: state must not be updated twice
            batch = spark.read.schema(batch.schema).parquet(held)
            found = batch.where(F.col("seen").isNotNull()).select("seen.*")
            high = self._high(spark, batch_id)
            if high is not None:
                ended = F.timestamp_micros(F.lit(high)) - F.expr(f"INTERVAL {watermark}")
                ends = self._ends(found, event_ts, T.TimestampType(), table.ts).where(F.col(table.ts) <= ended)
                ends = ends.withColumn(table.ts, F.col(table.ts).cast(ts_type))
                ends.write.mode("overwrite").parquet(f"{self.path}/windows/batch={batch_id}")
            top = found.agg(F.max(F.unix_micros(event_ts)).alias("high"))
            top.write.mode("overwrite").parquet(f"{self.path}/highs/batch={batch_id}")
            table.write(batch.where(F.col("sums").isNotNull()).select("sums.*"))
            delete_path(spark, held)

        return both, merge

    def _high(self, spark: SparkSession, before: int) -> int | None:
        """The highest event time of earlier micro-batches."""
        if not path_exists(spark, f"{self.path}/highs"):
            return None
        rows = spark.read.schema("high bigint, batch bigint").parquet(f"{self.path}/highs")
        return rows.where(F.col("batch") < before).agg(F.max("high")).first()[0]

    def listed(self, spark: SparkSession, table: FeatureTable) -> DataFrame:
        """Distinct (keys, time) of windows not repaired yet."""
        schema = T.StructType([table.schema[c] for c in [*self.entity.values(), table.ts]])
        if not path_exists(spark, f"{self.path}/windows"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/windows").distinct()

    def repair(
        self, table: FeatureTable, source: DataFrame, build: Callable[[DataFrame], DataFrame], event_ts: str
    ) -> int:
        """Compute the listed windows again from the stored facts, and those alone; their number.

        Facts are read from the first listed window to the last and met by (entity,
        slide step), so only rows of listed windows are aggregated. Run it between
        runs of the stream.
        """
        spark = source.sparkSession
        windows = self.listed(spark, table)
        keys = list(self.entity.values())
        ts_type, event_type = table.schema[table.ts].dataType, source.schema[event_ts].dataType
        first, last = aggregated_times(windows, ts_type, F.min(table.ts), F.max(table.ts))
        if first is None:
            return 0
        near = source.where(F.col(event_ts) >= time_literal(first, event_type) - F.expr(f"INTERVAL {self.window}"))
        near = near.where(F.col(event_ts) < time_literal(last, event_type))
        step = F.window("__at", self.slide)["start"]
        lowest = F.col(table.ts) - F.expr(f"INTERVAL {self.window}")
        highest = F.col(table.ts) - F.expr(f"INTERVAL {self.slide}")
        steps = windows.withColumn("__at", F.explode(F.sequence(lowest, highest, F.expr(f"INTERVAL {self.slide}"))))
        steps = steps.withColumn("__step", step).select(*keys, "__step").distinct()
        named = {f"__k{i}": F.col(c) for i, c in enumerate(self.entity)}
        rows = near.withColumn("__at", F.col(event_ts).cast(ts_type)).withColumn("__step", step).withColumns(named)
        met = rows.join(
            steps.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__step"), [*named, "__step"], "left_semi"
        )
        built = build(met.select(*source.columns))
        built = built.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        path = scratch_path(spark, "late")
        built.join(windows, [*keys, table.ts], "left_semi").write.parquet(path)
        fixed = spark.read.schema(built.schema).parquet(path)
        table.write(fixed)
        found = fixed.count()
        for folder in (path, f"{self.path}/windows"):
            delete_path(spark, folder)
        return found


class DropCounter(StreamingQueryListener):
    """Counts late (entity, window) partial sums left out, over all batches of each query.

    Above zero means that ``reconcile`` has work to do. Register it with
    ``spark.streams.addListener`` before the query starts; progress comes
    asynchronously, a little after each batch.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        query = str(event.progress.id)
        self.dropped[query] = self.dropped.get(query, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_by_watermark(query: StreamingQuery) -> int:
    """The same count from what a query remembers: its last batches only (Spark keeps 100 by default)."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def reconcile(
    table: FeatureTable,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    event_ts: str,
    window: str,
    after: Bound,
    until: Bound,
) -> int:
    """Recompute windows ending in ``(after, until]`` from the stored facts, merge
    those that differ, and delete stored ones that no fact supports. Returns how
    many there were. The comparison runs once, into the shared folder."""
    rebuilt = refreshed_features(source, build, event_ts, window, after, until, table.ts)
    rebuilt = rebuilt.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    )
    spark = source.sparkSession
    # ends in (after, until]: the read is half-open at the other side
    ts_type = table.schema[table.ts].dataType
    stored = table.read(spark, after).filter(F.col(table.ts) > time_literal(after, ts_type))
    if until:
        stored = stored.filter(F.col(table.ts) <= time_literal(until, ts_type))
    path = scratch_path(spark, "reconcile")
    change_feed(stored, rebuilt, table.key_columns).filter(F.col("change_type") != BEFORE).write.parquet(path)
    wrong = spark.read.parquet(path)
    found = {r[0]: r[1] for r in wrong.groupBy("change_type").count().collect()}
    if found.get(INSERT) or found.get(AFTER):
        table.merge(wrong.filter(F.col("change_type").isin(INSERT, AFTER)).drop("change_type"))
    if found.get(DELETE):
        table.delete(wrong.filter(F.col("change_type") == DELETE))
    delete_path(spark, path)
    return sum(found.values())


def stream_ingest(
    stream: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None, wait: bool = True
) -> StreamingQuery:
    """Append new files' rows to ``out_path``, each exactly once.

    Progress is kept per file, not per event time, so late rows are loaded too
    and a gap in the data stops nothing.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )
    if wait:
        query.awaitTermination()
    return query


def stream_enrich(
    stream: DataFrame,
    lookups: Sequence[FeatureLookup],
    out_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Look features up for each micro-batch in the tables as they stand then.

    Each micro-batch owns one ``batch_id`` folder, so a replay overwrites its own
    output and nothing else.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        enriched = add_features(batch, lookups)
        enriched.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .foreachBatch(enrich)
        .start()
    )
    if wait:
        query.awaitTermination()
    return query
