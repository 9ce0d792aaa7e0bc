"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs nothing but its running tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_crc(column: str, modulus: int) -> Column:
    """crc32 of an id written as decimal text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[list]:
    """Lists of values of one Arrow column, about ``limit`` characters each; NULL comes as ``None``.

    Words of a whole batch need many times its size as Python objects; a
    piece at a time keeps a worker's memory flat.
    """
    piece, size = [], 0
    for value in texts:
        value = value.as_py()
        piece.append(value)
        size += 1 if value is None else len(value) + 1
        if size >= limit:
            yield piece
            piece, size = [], 0
    if piece:
        yield piece


def splitmix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array, so that near numbers get unlike hashes."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
