"""Row-level changes between two versions of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The names used by change feeds of table formats.
INSERT, DELETE = "insert", "delete"
BEFORE, AFTER = "update_preimage", "update_postimage"


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str], out: str = "change_type") -> DataFrame:
    """Inserts, deletes and both images of updates; equal rows give nothing.

    NULL equals NULL here. Both versions must be unique by ``keys``, so the
    full join meets at most one row per side and key.
    """
    rest = [c for c in new.columns if c not in keys]
    values = F.struct(*rest) if rest else F.struct(F.lit(0).alias("__none"))
    joined = old.select(*keys, values.alias("__old")).join(
        new.select(*keys, values.alias("__new")), list(keys), "full_outer"
    )

    def image(kind: str, side: str):
        return F.struct(F.lit(kind).alias(out), F.col(side).alias("__row"))

    images = (
        F.when(F.col("__old").isNull(), F.array(image(INSERT, "__new")))
        .when(F.col("__new").isNull(), F.array(image(DELETE, "__old")))
        .otherwise(F.array(image(BEFORE, "__old"), image(AFTER, "__new")))
    )
    changed = joined.filter(~F.col("__old").eqNullSafe(F.col("__new")))
    exploded = changed.select(*keys, F.inline(images))
    return exploded.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest], out)
