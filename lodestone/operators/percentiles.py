"""Exact nearest-rank percentiles of a column of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rank error of the first pass is n / ACCURACY; twice that is left on both sides.
ACCURACY = 100_000
MARGIN = 2.0 / ACCURACY


def nearest_rank(df: DataFrame, column: str, points: dict[str, float]) -> DataFrame:
    """One row with the value at index ``round_half_even(p * (n - 1))`` per named point.

    Two passes. The first takes a quantile sketch, whose error is bounded, and
    so an interval certain to hold the wanted rank. The second counts what lies
    below each interval and builds the exact frequency table inside it, which
    is a sliver of the data: at most a few ``n / ACCURACY`` distinct values plus
    whatever equals the interval's ends, and equal values are one row. No values
    give 0.0; NULLs are no values.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    edges = [
        F.percentile_approx("v", [max(p - MARGIN, 0.0), min(p + MARGIN, 1.0)], ACCURACY).alias(name)
        for name, p in points.items()
    ]
    sketch = values.agg(F.count("*").alias("n"), *edges)
    # One small array of intervals: (name, wanted index, low, high).
    intervals = F.array(*(
        F.struct(
            F.lit(name).alias("name"),
            F.rint(F.lit(p) * (F.col("n") - 1)).cast("bigint").alias("idx"),
            F.col(name)[0].alias("low"),
            F.col(name)[1].alias("high"),
        ) for name, p in points.items()
    ))
    targets = sketch.select(intervals.alias("targets"))
    placed = values.select("v", F.explode(targets.scalar()).alias("t")).where(F.col("v") <= F.col("t.high"))
    # Everything below the interval collapses into one row per point before the shuffle.
    spot = F.when(F.col("v") >= F.col("t.low"), F.col("v"))
    counts = placed.groupBy("t.name", "t.idx", spot.alias("value")).agg(F.count("*").alias("c"))
    running = Window.partitionBy("name").orderBy(F.asc_nulls_first("value"))
    reached = counts.withColumn("upto", F.sum("c").over(running))
    passed = F.col("upto") > F.col("idx")
    missed = F.col("value").isNull() & passed  # would mean that the sketch broke its bound

    def exact(name: str):
        mine = F.col("name") == name
        broken = F.coalesce(F.max(mine & missed), F.lit(False))
        value = F.min(F.when(mine & passed, F.col("value")))
        return (
            F.when(broken, F.raise_error(F.lit("percentile interval missed its rank")).cast("double"))
            .otherwise(F.coalesce(value, F.lit(0.0))).alias(name)
        )

    return reached.agg(*(exact(name) for name in points))
