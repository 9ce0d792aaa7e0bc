"""Fitted trees as one SQL expression, and as a function that SQL can call anywhere."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.models.regression import MISSING_VALUE


@dataclass(frozen=True)
class Split:
    """Rows whose input is at most ``threshold`` go to ``low``, the others to ``high``."""

    feature: int
    threshold: float
    low: Split | float
    high: Split | float


_LINE = re.compile(r"(?:If|Else) \(feature (\d+) (?:<=|>) (\S+)\)|Predict: (\S+)")


def tree_of(text: str) -> Split | float:
    """A fitted tree from its printed form, which has every threshold and value in full.

    Printing is one call for a tree, where walking its nodes would be several for each.
    """
    lines = iter([m.groups() for m in map(_LINE.search, text.splitlines()) if m])

    def read() -> Split | float:
        feature, threshold, value = next(lines)
        if value is not None:
            return float(value)
        low = read()
        next(lines)  # the line of the other branch
        return Split(int(feature), float(threshold), low, read())

    return read()


def trees_of(model: PipelineModel) -> list[tuple[float, Split | float]]:
    """Weight and tree of a boosted pipeline, in order."""
    boosted = model.stages[-1]
    return list(zip(boosted.treeWeights, (tree_of(t.toDebugString) for t in boosted.trees)))


def _number(value: float) -> str:
    return f"{value!r}D"


def tree_sql(tree: Split | float, inputs: Sequence[str]) -> str:
    if not isinstance(tree, Split):
        return _number(tree)
    low, high = tree_sql(tree.low, inputs), tree_sql(tree.high, inputs)
    return f"CASE WHEN {inputs[tree.feature]} <= {_number(tree.threshold)} THEN {low} ELSE {high} END"


def model_sql(
    model: PipelineModel, feature_columns: Sequence[str], prefix: str = "", missing_value: float = MISSING_VALUE
) -> str:
    """The prediction of a ``regression_pipeline`` over columns, or over fields of ``prefix``.

    Any engine that reads the columns can compute it; NULL features count as in the pipeline.
    """
    inputs = []
    for column in feature_columns:
        name = f"{prefix}`{column}`"
        inputs.append(f"coalesce(cast({name} AS double), {_number(float(missing_value))})")
        inputs.append(f"cast({name} IS NULL AS double)")
    return " + ".join(f"{_number(float(w))} * ({tree_sql(t, inputs)})" for w, t in trees_of(model))


def create_function(
    spark: SparkSession, name: str, model: PipelineModel, feature_columns: Sequence[str], schema: T.StructType
) -> None:
    """A persistent function ``name(request)`` from a struct of the features to a double.

    It is one expression, so Spark plans it like any other: no Python, no model
    to load, usable on every table and in every session of the catalog. Types of
    the fields come from ``schema``.
    """
    fields = ", ".join(f"`{c}`: {schema[c].dataType.simpleString()}" for c in feature_columns)
    body = model_sql(model, feature_columns, "request.")
    spark.sql(f"CREATE OR REPLACE FUNCTION {name}(request STRUCT<{fields}>) RETURNS DOUBLE RETURN {body}")
