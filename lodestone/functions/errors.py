"""Sorting error texts by the layer that produced them, and reading wait hints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The system's own error vocabulary and category names.
GUARDRAIL_TEXTS = ("Empty query.", "Multiple statements are not allowed.")
GUARDRAIL_PREFIXES = ("Only SELECT", "Disallowed keyword in query:")
IMPLAUSIBLE_TEXTS = ("Query returned no rows.", "Query returned only NULL values.")
OUTSIDE_RANGE = "falls outside [0, 1]"
ENGINE_PREFIXES = (
    "Binder Error:", "Catalog Error:", "Parser Error:", "Conversion Error:", "Constraint Error:",
)
BACKEND_WORDS = ("HTTP", "unreachable", "Unavailable", "timed out", "Connection")
# Spark's own messages open with an error class in brackets, parse errors after a newline.
SPARK_ERROR = r"^\s*\[[A-Z_.]+\]"


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def error_category(error: Column) -> Column:
    """The layer an error came from. The order of the rules is part of their meaning."""
    starts = lambda prefixes: _any([error.startswith(p) for p in prefixes])
    return (
        F.when(error.isNull() | (error == ""), "succeeded")
        .when(error.isin(*GUARDRAIL_TEXTS) | starts(GUARDRAIL_PREFIXES), "guardrail rejection")
        .when(error.contains("exceeded") & error.contains("cancelled"), "query timeout")
        .when(error.isin(*IMPLAUSIBLE_TEXTS) | error.contains(OUTSIDE_RANGE), "implausible result")
        .when(starts(ENGINE_PREFIXES), "SQL execution error")
        .when(_any([error.contains(w) for w in BACKEND_WORDS]), "LLM backend error")
        .when(error.rlike(SPARK_ERROR), "SQL execution error")
        .otherwise("other")
    )


# The wait hint's form, the wait without one, the longest wait, the margin.
RETRY_HINT = r"try again in (?:(\d+)m)?([\d.]+)s"
DEFAULT_WAIT = 30.0
LONGEST_WAIT = 900.0
WAIT_MARGIN = 2.0


def retry_after_seconds(message: Column) -> Column:
    """Seconds from a hint such as "try again in 9m26.784s", or the default."""
    minutes = F.coalesce(F.regexp_extract(message, RETRY_HINT, 1).try_cast("double"), F.lit(0.0))
    seconds = F.regexp_extract(message, RETRY_HINT, 2).try_cast("double")
    return F.coalesce(minutes * 60 + seconds, F.lit(DEFAULT_WAIT))


def wait_seconds(message: Column) -> Column:
    return F.least(retry_after_seconds(message), F.lit(LONGEST_WAIT)) + WAIT_MARGIN
