"""Every registered query with a DuckDB statement, compared on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as contract
from helpers import SMALL
from tidemark.plans import oracle, registry

duckdb = pytest.importorskip("duckdb")

QUERIES = registry.all_queries()
STATEMENTS = oracle.statements()
ROWS_ONLY = {"fare_model_metrics", "score_batch", "score_struct", "inference_log_daily"}  # boosted trees


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def normal(frame):
    def text(value):
        if pd.isna(value):
            return "null"
        if hasattr(value, "isoformat"):
            return value.isoformat()[:26].replace("T00:00:00", "")
        return repr(float(value)) if not isinstance(value, str) else value

    columns = sorted(frame.columns)
    return columns, sorted(tuple(text(v) for v in row) for row in frame[columns].astype(object).values)


def test_only_model_queries_have_no_statement():
    assert set(QUERIES) - set(STATEMENTS) == ROWS_ONLY
    assert set(STATEMENTS) <= set(QUERIES)
    assert QUERIES.keys() <= contract.queries().keys()
    assert STATEMENTS.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_statement(spark, tables, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    expected = tables.execute(STATEMENTS[name]).df()
    assert normal(got) == normal(expected)
    assert len(got) > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1000
