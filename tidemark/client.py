"""One object with the calls of a feature-engineering session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.models.regression import PackagedModel
from tidemark.operators.tables import FeatureTable
from tidemark.operators.training import FeatureLookup, TrainingSet, create_training_set
from tidemark.operators.versions import LoggedTable


class FeatureClient:
    def __init__(self, spark: SparkSession):
        self.spark = spark

    def create_table(
        self,
        name: str,
        primary_keys: Sequence[str],
        schema: T.StructType | str | None = None,
        timestamp_key: str | None = None,
        df: DataFrame | None = None,
        description: str = "",
        logged: bool = False,
    ) -> FeatureTable | LoggedTable:
        """Create from a schema, or from ``df`` and fill it; ``logged`` tables record versions and changes."""
        if schema is None and df is None:
            raise ValueError("give a schema or a frame")
        if logged:
            shape = schema if schema is not None else df.schema
            table = LoggedTable.create(self.spark, name, primary_keys, shape, timestamp_key, description)
            if df is not None:
                table.write(df)
            return table
        table = FeatureTable.define(
            name, primary_keys, schema if schema is not None else df.schema, timestamp_key, description
        ).create(self.spark)
        if df is not None:
            table.write(df)
        return table

    def get_table(self, name: str) -> FeatureTable | LoggedTable:
        if LoggedTable.is_logged(self.spark, name):
            return LoggedTable.load(self.spark, name)
        return FeatureTable.load(self.spark, name)

    def read_table(self, name: str) -> DataFrame:
        return self.get_table(name).read(self.spark)

    def write_table(
        self, name: str, df: DataFrame, mode: str = "merge", **stream_options
    ) -> StreamingQuery | int | None:
        return self.get_table(name).write(df, mode, **stream_options)

    def drop_table(self, name: str) -> None:
        if self.spark.catalog.tableExists(name) and LoggedTable.is_logged(self.spark, name):
            LoggedTable.load(self.spark, name).drop(self.spark)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def publish_table(self, name: str, online_name: str, mode: str = "merge") -> None:
        """Newest rows to ``online_name``; a logged table publishes what changed since the last time, whatever the mode."""
        table, online = self.get_table(name), self.get_table(online_name)
        if isinstance(table, LoggedTable):
            table.publish(self.spark, online)
        else:
            table.publish(self.spark, online, mode)

    def create_training_set(
        self,
        df: DataFrame,
        feature_lookups: Sequence[FeatureLookup],
        label: str | None,
        exclude_columns: Sequence[str] = (),
    ) -> TrainingSet:
        return create_training_set(df, feature_lookups, label, exclude_columns)

    def log_model(self, model: PipelineModel, training_set: TrainingSet, path: str) -> PackagedModel:
        packaged = PackagedModel.of(model, training_set)
        packaged.save(self.spark, path)
        return packaged

    def score_batch(self, path: str, df: DataFrame) -> DataFrame:
        return PackagedModel.load(self.spark, path).score_batch(df)
