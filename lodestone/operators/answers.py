"""Judging and shaping query results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.portable import json_safe

# Words of a rate question, the verdicts, the size and name hints of charts.
RATE_WORDS = ("rate", "percentage", "share", "fraction")
NO_ROWS = "Query returned no rows."
ONLY_NULLS = "Query returned only NULL values."
OUTSIDE_RANGE = "Question asks for a rate/share, but the result falls outside [0, 1]."
PLAUSIBLE = "Result looks plausible."
MAX_KPI_COLUMNS = 4
DATE_WORDS = ("date", "month", "quarter", "year", "week")

PLAIN_NUMBERS = (T.IntegralType, T.FloatType, T.DoubleType)


def is_rate_question(question: Column, strict: bool = False) -> Column:
    """By substring, so "generates" is a rate question too; ``strict`` wants whole words."""
    if strict:
        return F.lower(question).rlike(r"\b(" + "|".join(RATE_WORDS) + r")s?\b")
    return reduce(lambda a, b: a | b, [F.lower(question).contains(w) for w in RATE_WORDS])


def _outside_unit(column: Column, dtype: T.DataType) -> Column:
    value = column.cast("double")
    return value.isNotNull() & (F.isnan(value) | (value < 0) | (value > 1))


def plausibility(question: Column, result: DataFrame, strict: bool = False) -> DataFrame:
    """One row: question, plausible, reason. One pass over the result.

    Decimal values are not range-checked unless ``strict``.
    """
    numeric = PLAIN_NUMBERS + (T.BooleanType,) + ((T.DecimalType,) if strict else ())
    fields = result.schema.fields
    filled = reduce(lambda a, b: a | b, [F.col(f"`{f.name}`").isNotNull() for f in fields], F.lit(False))
    outside = reduce(
        lambda a, b: a | b,
        [_outside_unit(F.col(f"`{f.name}`"), f.dataType) for f in fields if isinstance(f.dataType, numeric)],
        F.lit(False),
    )
    facts = result.agg(
        F.count("*").alias("rows"), F.count_if(filled).alias("filled"), F.count_if(outside).alias("outside")
    )
    reason = (
        F.when(F.col("rows") == 0, NO_ROWS)
        .when(F.col("filled") == 0, ONLY_NULLS)
        .when(is_rate_question(question, strict) & (F.col("outside") > 0), OUTSIDE_RANGE)
        .otherwise(PLAUSIBLE)
    )
    return facts.select(
        question.alias("question"), (reason == PLAUSIBLE).alias("plausible"), reason.alias("reason")
    )


def _is_plain_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, PLAIN_NUMBERS)


def chart_kind(result: DataFrame, succeeded: bool = True) -> str:
    """``metric``, ``kpi_row``, ``line``, ``bar`` or ``table`` for a result's shape.

    A failed answer is always a table. Decided after ``json_safe``, since only
    plain numbers count as numeric.
    """
    if not succeeded:
        return "table"
    df = json_safe(result)
    fields = df.schema.fields
    rows = len(df.limit(2).collect())
    if rows == 0 or not fields:
        return "table"
    if rows == 1:
        if len(fields) == 1:
            return "metric"
        return "kpi_row" if len(fields) <= MAX_KPI_COLUMNS else "table"
    if len(fields) != 2 or not _is_plain_number(fields[1].dataType):
        return "table"
    first, second = (F.col(f"`{f.name}`") for f in fields)
    dtype = fields[0].dataType
    as_time = first.try_cast("timestamp") if isinstance(dtype, T.StringType) else F.lit(None)
    facts = df.agg(
        F.count_if(second.isNull()).alias("gaps"),
        F.count_if(first.isNotNull() & as_time.isNull()).alias("not_dates"),
    ).first()
    if facts.gaps:
        return "table"
    named_like_date = any(word in fields[0].name.lower() for word in DATE_WORDS)
    date_like = isinstance(dtype, T.StringType) and facts.not_dates == 0
    return "line" if named_like_date or _is_plain_number(dtype) or date_like else "bar"
