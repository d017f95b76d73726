"""Scoring retrieval and generated SQL against golden questions."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.portable import json_safe
from lodestone.functions.statements import sql_of_reply
from lodestone.operators.guard import GuardrailViolation, QueryResult, QueryTimeout, run_guarded

TIERS = (1, 2, 3)
ALL_TIERS = "all"

# --- retrieval ---------------------------------------------------------------


def hit_and_reciprocal_rank(queries: DataFrame, ranked: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per query: whether a relevant document was found, and one over the rank of the
    first. Nothing found counts zero, since ``queries`` is the left side.
    """
    found = (
        ranked.join(relevant.select("query_id", "doc_id").distinct(), ["query_id", "doc_id"], "left_semi")
        .groupBy("query_id").agg(F.min("rank").alias("first"))
    )
    return queries.join(found, "query_id", "left").select(
        *queries.columns,
        F.col("first").isNotNull().cast("int").alias("hit"),
        F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"),
    )


def evaluate_methods(
    queries: DataFrame, methods: dict[str, DataFrame], relevant: DataFrame
) -> DataFrame:
    """(method, ordinal, tier, questions, hit_rate, mrr), per tier and over all tiers."""
    scored = reduce(DataFrame.unionByName, [
        hit_and_reciprocal_rank(queries.select("query_id", "tier"), ranked, relevant)
        .withColumns({"method": F.lit(name), "ordinal": F.lit(i)})
        for i, (name, ranked) in enumerate(methods.items())
    ])
    means = [F.count("*").alias("questions"), F.avg("hit").alias("hit_rate"),
             F.avg("reciprocal_rank").alias("mrr")]
    # One aggregation with two levels: (method, tier) and (method).
    leveled = scored.withColumn(
        "level", F.explode(F.array(F.col("tier").cast("string"), F.lit(ALL_TIERS)))
    )
    return leveled.groupBy("method", "ordinal", F.col("level").alias("tier")).agg(*means)


def winner(results: DataFrame, *measures: str, name: str = "method") -> DataFrame:
    """The best row's name by the measures in order; the earlier ordinal wins a tie."""
    order = F.struct(*(F.col(m) for m in measures), (-F.col("ordinal")).alias("earlier"))
    return results.agg(F.max_by(F.struct(name, *measures), order).alias("best")).select("best.*")


# --- results -----------------------------------------------------------------


def comparable(df: DataFrame, keys: list[str]) -> DataFrame:
    """Values by position, with numbers of any type as doubles where they are not whole."""
    safe = json_safe(df)
    values = [f for f in safe.schema.fields if f.name not in keys]
    return safe.select(*keys, *(
        (F.col(f.name).cast("double") if isinstance(f.dataType, T.NumericType) else F.col(f.name).cast("string"))
        .alias(f"c{i}") for i, f in enumerate(values)
    ))


def mismatched_rows(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose number differs between the sides, as (keys, values, surplus).

    Both sides are counted together with opposite sign. Equal rows cancel before
    the shuffle, order plays no part, and NULLs equal each other.
    """
    sides = comparable(actual, keys).withColumn("side", F.lit(1)).unionByName(
        comparable(expected, keys).withColumn("side", F.lit(-1)))
    columns = [c for c in sides.columns if c != "side"]
    return sides.groupBy(*columns).agg(F.sum("side").alias("surplus")).where(F.col("surplus") != 0)


def results_match(actual: DataFrame, expected: DataFrame, digits: int | None = None) -> bool:
    """Same rows the same number of times, in any order. Exact unless ``digits`` rounds."""
    if len(actual.columns) != len(expected.columns):
        return actual.isEmpty() and expected.isEmpty()
    a, b = (comparable(df, []) for df in (actual, expected))
    if [f.dataType for f in a.schema] != [f.dataType for f in b.schema]:
        return a.isEmpty() and b.isEmpty()
    if digits is not None:
        a, b = (_rounded(df, digits) for df in (a, b))
    return mismatched_rows(a, b, []).isEmpty()


def _rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*(
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ))


def match_per_question(questions: DataFrame, actual: DataFrame, expected: DataFrame) -> DataFrame:
    """(question_id, correct) for many results at once; values line up by position."""
    wrong = mismatched_rows(actual, expected, ["question_id"]).select("question_id").distinct()
    return questions.select("question_id").join(
        wrong.withColumn("wrong", F.lit(True)), "question_id", "left"
    ).select("question_id", F.col("wrong").isNull().alias("correct"))


def matches_recorded(result: QueryResult, recorded: list[list]) -> bool:
    """Same rows in the same order, as a golden question records them. A guarded
    result has a bounded number of rows, so this compares plain lists; one that
    was cut at the bound matches nothing."""
    return not result.truncated and [list(row) for row in result.rows] == [list(row) for row in recorded]


EXECUTION = ("question_id string, tier int, sql string, api_error string, run_error string, matched boolean, "
             "total_tokens bigint")
# Statements that run at the same time.
AT_ONCE = 8


def run_statements(spark: SparkSession, questions: list[dict], **limits) -> DataFrame:
    """Executions of generated statements against their recorded results.

    ``questions`` are (id, tier, sql, reference_result), and optionally
    ``api_error`` and ``total_tokens``. Each statement is a guarded query of its
    own, some at a time, so what reaches the driver is bounded by the row cap; rows
    match in any order, a result cut at the cap matches nothing, and whatever stops
    a statement is its ``run_error``.
    """

    def execute(q: dict) -> tuple:
        error, matched = None, None
        if q.get("api_error") is None:
            try:
                result = run_guarded(spark, q["sql"], **limits)
                matched = not result.truncated and Counter(result.rows) == Counter(tuple(row) for row in q["reference_result"])
            except (GuardrailViolation, QueryTimeout, PySparkException) as failure:
                error = str(failure)
        return q["id"], q["tier"], q["sql"], q.get("api_error"), error, matched, q.get("total_tokens")

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return spark.createDataFrame(list(pool.map(execute, questions)), EXECUTION)


API_ERROR = "API error"
MISMATCH = "result mismatch"


def outcomes(executions: DataFrame) -> DataFrame:
    """Executions (…, sql, api_error, run_error, matched) with ``correct`` and ``error``.

    A model that could not be reached leaves no statement; a statement that
    failed keeps its error text; one that ran is right or a mismatch.
    """
    failed_call = F.col("api_error").isNotNull()
    correct = ~failed_call & F.col("run_error").isNull() & F.coalesce("matched", F.lit(False))
    error = (
        F.when(failed_call, F.concat(F.lit(f"{API_ERROR}: "), F.col("api_error")))
        .when(F.col("run_error").isNotNull(), F.col("run_error"))
        .when(~correct, MISMATCH)
    )
    return executions.withColumns({
        "sql": F.when(failed_call, "").otherwise(F.col("sql")), "correct": correct, "error": error,
    }).drop("api_error", "run_error", "matched")


def share(flag: str) -> Column:
    return F.coalesce(F.avg(F.col(flag).cast("double")), F.lit(0.0))


def tier_share(flag: str, tier: int) -> Column:
    """Share of true flags in one tier; an empty tier counts 0."""
    return F.coalesce(F.avg(F.when(F.col("tier") == tier, F.col(flag).cast("double"))), F.lit(0.0))


def outcome_summary(scored: DataFrame, *by: str) -> DataFrame:
    """Accuracy overall and per tier, tokens, and calls that failed."""
    return scored.groupBy(*by).agg(
        F.count("*").alias("questions"),
        share("correct").alias("accuracy"),
        *(tier_share("correct", t).alias(f"tier_{t}_accuracy") for t in TIERS),
        F.coalesce(F.sum("total_tokens"), F.lit(0)).alias("total_tokens"),
        F.count_if(F.coalesce(F.col("error").startswith(API_ERROR), F.lit(False))).alias("api_error_count"),
    )


# --- attempts ----------------------------------------------------------------

MAX_ATTEMPTS = 2


def final_attempts(attempts: DataFrame) -> DataFrame:
    """The last attempt of each question decides; ``succeeded`` if it was valid."""
    return attempts.groupBy("question_id").agg(
        F.max_by(F.struct(*(c for c in attempts.columns if c != "question_id")), "attempt_no").alias("last"),
        F.count("*").alias("attempt_count"),
    ).select("question_id", "last.*", "attempt_count", F.col("last.valid").alias("succeeded"))


def retry_outcomes(attempts: DataFrame) -> DataFrame:
    """Per question whether the first and the last attempt were right, and what retrying did."""
    return attempts.groupBy("question_id", "tier").agg(
        F.min_by("correct", "attempt_no").alias("single_shot_correct"),
        F.max_by("correct", "attempt_no").alias("retry_correct"),
        F.count("*").alias("attempt_count"),
        F.max_by("error", "attempt_no").alias("final_error"),
    ).select(
        "question_id", "tier", "single_shot_correct", "retry_correct",
        (F.col("attempt_count") > 1).alias("retried"),
        ((F.col("attempt_count") > 1) & ~F.col("single_shot_correct") & F.col("retry_correct"))
        .alias("rescued"),
        ((F.col("attempt_count") > 1) & F.col("single_shot_correct") & ~F.col("retry_correct"))
        .alias("regressed"),
        "attempt_count", "final_error",
    )


def retry_summary(retried: DataFrame) -> DataFrame:
    single, final = "single_shot_correct", "retry_correct"
    return retried.agg(
        share(single).alias("single_shot_accuracy"),
        share(final).alias("retry_accuracy"),
        *(tier_share(single, t).alias(f"tier_{t}_single") for t in TIERS),
        *(tier_share(final, t).alias(f"tier_{t}_retry") for t in TIERS),
        *(F.count_if(flag).alias(f"{flag}_count") for flag in ("retried", "rescued", "regressed")),
    ).withColumn("lift", F.col("retry_accuracy") - F.col("single_shot_accuracy"))


def ablation(tagged: DataFrame, tier: int = 3) -> DataFrame:
    """Accuracy per model and condition on one tier."""
    return tagged.where(F.col("tier") == tier).groupBy("model", "condition").agg(
        F.count("*").alias("questions"), share("correct").alias("accuracy"))


def compare_runs(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """This run beside an earlier one; what the earlier run lacks stays NULL."""
    before = earlier.select("model", "condition", F.col("accuracy").alias("earlier_accuracy"))
    return current.join(before, ["model", "condition"], "left").withColumn(
        "change", F.col("accuracy") - F.col("earlier_accuracy"))


def tag_outcomes(scored: DataFrame, model: str, condition: str) -> DataFrame:
    return scored.withColumns({"model": F.lit(model), "condition": F.lit(condition)})


def assemble_traces(attempts: DataFrame) -> DataFrame:
    """One row per question with every recorded attempt nested in order, and the last one as ``final``.

    An attempt number that was recorded several times is kept once, with the
    greatest row. Those repeats collapse before the shuffle, so a question's row
    grows only with the attempts that were made.
    """
    rest = [c for c in attempts.columns if c not in ("question_id", "tier", "attempt_no")]
    once = attempts.groupBy("question_id", "tier", "attempt_no").agg(F.max(F.struct(*rest)).alias("row"))
    nested = once.groupBy("question_id", "tier").agg(
        F.sort_array(F.collect_list(F.struct("attempt_no", "row.*"))).alias("attempts"))
    return nested.withColumn("final", F.element_at("attempts", -1))


def answered(attempts: DataFrame) -> DataFrame:
    """Trace rows of answered questions for the log: question, last statement and its
    outcome, time, model, rows and error, with the attempts, seconds and tokens of all."""
    last = {"question": "question", "timestamp": "timestamp", "model": "model", "row_count": "row_count",
            "succeeded": "valid"}
    requests = attempts.groupBy("query_id").agg(
        *(F.max_by(column, "attempt_no").alias(name) for name, column in last.items()),
        F.max_by(sql_of_reply(F.col("reply")), "attempt_no").alias("sql"),
        F.sum("latency_seconds").alias("latency_seconds"),
        F.count("*").alias("attempt_count"),
    )
    return (
        requests.join(failure_text(attempts, requests), "query_id")
        .join(usage_totals(requests, attempts), "query_id")
        .withColumn("usage", F.struct("prompt_tokens", "completion_tokens", "total_tokens"))
    )


def select_questions(df: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of the chosen questions, such as those known to fail."""
    return df.join(chosen.select("question_id").distinct(), "question_id", "left_semi")


def kept_attempts(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Attempts up to the stop: the first valid one, a failed call to the model, or
    ``max_attempts``.

    The stop is one small row per question, found by an aggregate that combines
    before it shuffles.
    """
    stops = F.col("valid")
    if "api_error" in attempts.columns:
        stops = stops | F.col("api_error").isNotNull()
    allowed = attempts.where(F.col("attempt_no") <= max_attempts)
    last = allowed.groupBy("question_id").agg(
        F.coalesce(F.min(F.when(stops, F.col("attempt_no"))), F.lit(max_attempts)).alias("stop"))
    return allowed.join(last, "question_id").where(F.col("attempt_no") <= F.col("stop")).drop("stop")


def attempt_feedback(attempts: DataFrame) -> DataFrame:
    """Each attempt with what the model was told about the one before: its error,
    else why its result was implausible. The first attempt was told nothing."""
    told = attempts.select(
        "question_id", (F.col("attempt_no") + 1).alias("attempt_no"),
        F.coalesce("error", "reason").alias("feedback"))
    return attempts.join(told, ["question_id", "attempt_no"], "left")


def attempt_verdicts(attempts: DataFrame) -> DataFrame:
    """``valid`` and ``reason`` per attempt from ``error`` and the plausibility ``verdict``."""
    failed = F.col("error").isNotNull()
    return attempts.withColumns({
        "valid": ~failed & F.coalesce("plausible", F.lit(False)),
        "reason": F.when(failed, "execution failed").otherwise(F.col("verdict")),
    })


def failure_text(attempts: DataFrame, requests: DataFrame) -> DataFrame:
    """Per request the error of its last attempt, else that attempt's reason; a
    request that succeeded has none, one without attempts says so."""
    last = attempts.groupBy("query_id").agg(
        F.max_by(F.struct("valid", "error", "reason"), "attempt_no").alias("last"))
    return requests.select("query_id").join(last, "query_id", "left").select(
        "query_id",
        F.when(F.col("last").isNull(), "no attempts made")
        .when(~F.col("last.valid"), F.coalesce("last.error", "last.reason")).alias("error"),
    )


def usage_totals(requests: DataFrame, calls: DataFrame) -> DataFrame:
    """Token totals per request; missing counts are 0, and no calls at all is NULL."""
    names = ("prompt_tokens", "completion_tokens", "total_tokens")
    totals = calls.groupBy("query_id").agg(
        *(F.sum(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in names))
    return requests.select("query_id").join(totals, "query_id", "left")
