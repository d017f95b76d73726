"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def unit(vector: Column) -> Column:
    """The vector at length one; a zero vector stays as it is.

    The outer transform is over one element and is there to name the length, so
    that it is taken once and not once per component.
    """
    sized = F.array(F.struct(vector.alias("v"), F.sqrt(dot(vector, vector)).alias("length")))
    scaled = F.transform(sized, lambda s: F.when(s["length"] == 0, s["v"]).otherwise(
        F.transform(s["v"], lambda x: x / s["length"])))
    return scaled[0]
