"""Repeatable sampling and splitting by a hash of the row key.

The bucket of a row depends only on its key, so it survives any repartition,
retry or reordering, which ``sample`` and ``randomSplit`` do not promise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000


def hash_bucket(keys: Sequence[str], seed: int = 0, buckets: int = BUCKETS) -> Column:
    """Bucket in ``[0, buckets)`` from the first 32 bits of an md5 digest."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie in [0, 1]")
    return df.filter(hash_bucket(keys, seed) < round(fraction * BUCKETS))


def with_split(
    df: DataFrame,
    keys: Sequence[str],
    train_fraction: float = 0.75,
    seed: int = 123,
    column: str = "split",
) -> DataFrame:
    """Add ``column`` with 'train' or 'test'."""
    is_train = hash_bucket(keys, seed) < round(train_fraction * BUCKETS)
    return df.withColumn(column, F.when(is_train, "train").otherwise("test"))


def train_test_split(
    df: DataFrame, keys: Sequence[str], train_fraction: float = 0.75, seed: int = 123
) -> tuple[DataFrame, DataFrame]:
    limit = round(train_fraction * BUCKETS)
    bucket = hash_bucket(keys, seed)
    return df.filter(bucket < limit), df.filter(bucket >= limit)
