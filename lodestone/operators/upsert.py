"""Keyed merge of a batch into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str | tuple[str, ...], *order: str) -> DataFrame:
    """One row per key, the one with the greatest ``order`` columns; full ties fall
    to the greatest row content. A key may have several columns.

    An aggregate instead of a window: copies of a key collapse before the
    shuffle, so a key that holds a third of the rows is no hot partition.
    """
    keys = (key,) if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in order and c not in keys]
    row = F.max(F.struct(*order, *rest)).alias("row")
    return df.groupBy(*keys).agg(row).select(*(c if c in keys else f"row.{c}" for c in df.columns))


def merge(target: DataFrame | None, batch: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``batch`` put in by key.

    The batch wins over the target, and inside the batch the latest timestamp
    wins. Target rows that the batch does not mention stay, and merging the same
    batch twice changes nothing.
    """
    sides = batch.withColumn("_side", F.lit(1))
    if target is not None:
        sides = sides.unionByName(target.select(*batch.columns).withColumn("_side", F.lit(0)))
    return latest_per_key(sides, key, "_side", "timestamp").drop("_side")
