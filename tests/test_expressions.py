from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemark.models.expressions import Split, create_function, model_sql, tree_of, trees_of
from tidemark.models.regression import fit_regression, predict

PRINTED = """DecisionTreeRegressionModel: uid=x, depth=2, numNodes=5, numFeatures=4
  If (feature 2 <= 1.5E-7)
   Predict: -0.25
  Else (feature 2 > 1.5E-7)
   If (feature 0 <= 12.0)
    Predict: 3.0
   Else (feature 0 > 12.0)
    Predict: 1.0E10
"""


def test_printed_tree():
    assert tree_of(PRINTED) == Split(2, 1.5e-7, -0.25, Split(0, 12.0, 3.0, 1e10))
    assert tree_of("DecisionTreeRegressionModel\n  Predict: 2.5\n") == 2.5


def test_expression_and_function_equal_the_model(spark, database):
    random.seed(1)
    rows = [
        (i, random.choice([None, random.random()]), random.randint(0, 9), random.gauss(0, 1) + (i % 7)) for i in range(600)
    ]
    df = spark.createDataFrame(rows, "id int, `a b` double, c int, y double")
    model = fit_regression(df, ["a b", "c"], "y", rounds=5, depth=4)
    assert len(trees_of(model)) == 5
    expected = {r["id"]: r["prediction"] for r in predict(model, df).collect()}
    by_columns = df.select("id", F.expr(model_sql(model, ["a b", "c"])).alias("p"))
    name = f"{database}.score"
    create_function(spark, name, model, ["a b", "c"], df.schema)
    # another source, in a session of its own: the function lies in the catalog
    df.drop("y").write.saveAsTable(f"{database}.rows")
    by_name = spark.newSession().sql(f"SELECT id, {name}(struct(`a b`, c)) AS p FROM {database}.rows")
    for scored in (by_columns, by_name):
        found = {r["id"]: r["p"] for r in scored.collect()}
        assert found.keys() == expected.keys()
        assert max(abs(found[i] - p) for i, p in expected.items()) < 1e-9
    assert "Python" not in by_name._jdf.queryExecution().executedPlan().toString()
