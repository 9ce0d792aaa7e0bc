"""Distributed regression on training sets, packaging and batch scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.training import (
    FeatureLookup,
    TrainingSet,
    add_features,
    lookups_from_json,
    lookups_to_json,
)
from tidemark.session import delete_path, ensure_checkpoint_dir, scratch_path

# 100 rounds; depth 5 allows the 32 leaves per tree asked for.
ROUNDS = 100
DEPTH = 5
SEED = 123
MISSING_VALUE = 0.0
# Training rows that are worth a task of their own, so many that a core takes them as one, and the most that
# boosting holds as one block.
LEAST_ROWS, MANY_ROWS, MOST_ROWS = 20_000, 200_000, 2_500_000
TASKS_PER_CORE = 2


def regression_pipeline(
    feature_columns: Sequence[str],
    label: str,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    seed: int = SEED,
    missing_value: float = MISSING_VALUE,
) -> Pipeline:
    """NULL handling, vector assembly and boosted trees as one storable unit.

    NULLs become a constant plus an indicator, so no row is skipped. The label
    plays no part in the first two steps; scoring needs only the features.
    """
    filled = [
        f"coalesce(cast(`{c}` AS double), {float(missing_value)}D) AS `__x_{c}`, "
        f"cast(`{c}` IS NULL AS double) AS `__m_{c}`"
        for c in feature_columns
    ]
    inputs = [f"__{kind}_{c}" for c in feature_columns for kind in ("x", "m")]
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__"),
            VectorAssembler(inputCols=inputs, outputCol="__features"),
            GBTRegressor(
                featuresCol="__features",
                labelCol=label,
                predictionCol="prediction",
                maxIter=rounds,
                maxDepth=depth,
                lossType="squared",
                seed=seed,
            ),
        ]
    )


def linear_pipeline(feature_columns: Sequence[str], label: str, missing_value: float = MISSING_VALUE) -> Pipeline:
    """Least squares by normal equations, one pass over the rows; NULLs count as ``missing_value``."""
    filled = [
        f"coalesce(cast(`{c}` AS double), {float(missing_value)}D) AS `__x_{c}`" for c in feature_columns
    ]
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__"),
            VectorAssembler(inputCols=[f"__x_{c}" for c in feature_columns], outputCol="__features"),
            LinearRegression(
                featuresCol="__features", labelCol=label, predictionCol="prediction", solver="normal", regParam=0.0
            ),
        ]
    )


def fit_regression(
    train: DataFrame, feature_columns: Sequence[str], label: str, rounds: int = ROUNDS, **options
) -> PipelineModel:
    """Train on the executors. Rows without a label are left out.

    Training reads its rows several times before the first tree and plans them
    more than once, so the narrow rows are written to the shared folder first
    and what they come from runs once. The dealt rows are kept on disk, as
    boosting needs the memory for its own copies.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)  # boosting cuts its lineage there
    features = [F.col(f"`{c}`").cast("double").alias(c) for c in feature_columns]
    rows = train.select(*features, label).filter(F.col(label).isNotNull())
    numbered = rows.select("*", F.monotonically_increasing_id().alias("__at"))
    path = scratch_path(spark, "fit")
    dealt = None
    try:
        numbered.write.parquet(path)
        staged = spark.read.schema(numbered.schema).parquet(path)
        dealt = _dealt(staged, staged.count()).persist(StorageLevel.DISK_ONLY)
        return regression_pipeline(feature_columns, label, rounds, **options).fit(dealt)
    finally:
        if dealt is not None:
            dealt.unpersist()
        delete_path(spark, path)


def _dealt(rows: DataFrame, n: int) -> DataFrame:
    """``n`` training rows in even tasks, in the order of ``__at``, which goes.

    Each round of boosting waits for its slowest task, hundreds of times, and
    pays for each task that puts its errors in memory. Few rows are one task,
    more are two for each core, many are one for each core, and what boosting
    would hold as too large blocks is dealt in whole turns of all cores, so
    that no core waits in the last turn. The order makes a task that runs again
    see its rows as the first time, which boosting relies on when it pairs them
    with their errors.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if n < MANY_ROWS * cores:
        tasks = min(-(-n // LEAST_ROWS), TASKS_PER_CORE * cores)
    else:
        tasks = cores * -(-n // (MOST_ROWS * cores))
    return rows.repartition(max(1, tasks)).sortWithinPartitions("__at").drop("__at")


def predict(model: PipelineModel, df: DataFrame, output: str = "prediction") -> DataFrame:
    """``df`` plus one double column."""
    scored = model.transform(df)
    return scored.select(*df.columns, F.col("prediction").alias(output))


def rmse(scored: DataFrame, label: str, prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(scored)


def rmse_of(label: str, prediction: str):
    """The same metric as an aggregate expression."""
    error = F.col(label) - F.col(prediction)
    return F.sqrt(F.avg(error * error))


def grouped_mean_predictor(train: DataFrame, key: str, label: str) -> DataFrame:
    """(key, prediction): mean label per key, the baseline to beat."""
    return train.groupBy(key).agg(F.avg(label).alias("prediction"))


@dataclass(frozen=True)
class PackagedModel:
    """A fitted pipeline with the lookups that feed it."""

    model: PipelineModel
    feature_columns: tuple[str, ...]
    lookups: tuple[FeatureLookup, ...]

    @staticmethod
    def of(model: PipelineModel, training_set: TrainingSet) -> PackagedModel:
        return PackagedModel(model, tuple(training_set.feature_columns), tuple(training_set.lookups))

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        spec = [(lookups_to_json(self.lookups), list(self.feature_columns))]
        spark.createDataFrame(spec, "lookups string, feature_columns array<string>").coalesce(
            1
        ).write.mode("overwrite").json(f"{path}/lookups")

    @staticmethod
    def load(spark: SparkSession, path: str) -> PackagedModel:
        schema = "lookups string, feature_columns array<string>"
        spec = spark.read.schema(schema).json(f"{path}/lookups").first()
        return PackagedModel(
            PipelineModel.load(f"{path}/model"),
            tuple(spec["feature_columns"]),
            tuple(lookups_from_json(spec["lookups"])),
        )

    def score_batch(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Look up the features ``df`` does not carry itself, then predict."""
        return predict(self.model, add_features(df, self.lookups, keep_given=True), output)

    def score_struct(self, df: DataFrame, request: str, output: str = "prediction") -> DataFrame:
        return score_struct(self.model, df, request, output)

    def create_function(self, spark: SparkSession, name: str, schema: T.StructType) -> None:
        """A persistent SQL function over a struct of the features, for any table; see ``models/expressions.py``."""
        from tidemark.models.expressions import create_function

        create_function(spark, name, self.model, self.feature_columns, schema)

    def create_view(self, spark: SparkSession, source: str, request: str, view: str) -> None:
        """For SQL users: ``view`` is ``source`` (table or view) plus ``prediction``.

        The view is a plan; a query on it scores the rows it needs.
        """
        self.score_struct(spark.table(source), request).createOrReplaceTempView(view)


def score_struct(
    model: PipelineModel, df: DataFrame, request: str, output: str = "prediction"
) -> DataFrame:
    """Score rows whose features sit in one struct column; set-based, no call per row."""
    carried = F.struct(*df.columns).alias("__row")
    scored = model.transform(df.select(carried, f"{request}.*"))
    return scored.select("__row.*", F.col("prediction").cast("double").alias(output))


def inference_log(
    scored: DataFrame, request_columns: Sequence[str], model_version: str, logged_at, output: str = "prediction"
) -> DataFrame:
    """(logged_at, day, model_version, request, response) rows for appending."""
    return scored.select(
        logged_at.alias("logged_at"),
        F.to_date(logged_at).alias("day"),
        F.lit(model_version).alias("model_version"),
        F.struct(*request_columns).alias("request"),
        F.col(output).alias("response"),
    )


def append_inference_log(log: DataFrame, path: str, batch_id: str) -> None:
    """Write one batch of the log in a folder of its own, so a retry replaces it and doubles nothing."""
    log.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch_id={batch_id}")
