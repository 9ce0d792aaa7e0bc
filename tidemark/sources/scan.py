"""Reading by path or name, guarded appends, small previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Scan a path. ``fmt`` may be any format on the class path."""
    return spark.read.format(fmt).options(**options).load(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_path(spark, f"{folder}/{name}.parquet")


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_or_replace(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def append_if_any(df: DataFrame, name: str, fmt: str = "parquet") -> bool:
    """Append unless the frame is empty; one row is enough to decide."""
    if df.isEmpty():
        return False
    df.write.format(fmt).mode("append").saveAsTable(name)
    return True


def preview(df: DataFrame, rows: int = 20) -> None:
    df.limit(rows).show(truncate=False)
