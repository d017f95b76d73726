import random
import re
from datetime import date
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from lodestone.functions.errors import error_category, retry_after_seconds, wait_seconds
from lodestone.operators import monitoring
from lodestone.operators.percentiles import nearest_rank
from lodestone.streaming.ingest import compact_daily_series, daily_series_stream, read_daily_series, write_daily_series

TRACES = (
    "query_id string, timestamp timestamp, question string, model string, succeeded boolean, error string, "
    "attempt_count bigint, latency_seconds double, usage__prompt_tokens bigint, usage__completion_tokens bigint"
)
FEEDBACK = "query_id string, timestamp timestamp, vote string"


def traces(spark, *rows):
    made = spark.createDataFrame(
        [(q, t, "?", m, e is None, e, 1, s, p, c) for q, t, m, e, s, p, c in rows],
        TRACES.replace("timestamp timestamp", "timestamp string"))
    return monitoring.enriched_traces(made.withColumn("timestamp", F.col("timestamp").cast("timestamp")))


def feedback(spark, *votes):
    return spark.createDataFrame([(q, None, v) for q, v in votes], FEEDBACK)


@pytest.mark.parametrize("model, tokens, cost", (
    ("llama3", 1_000_000, 0.0), ("gpt-4o-mini", 1_000_000, 0.75), ("unknown", 5, 0.0), (None, 5, 0.0)))
def test_cost(spark, model, tokens, cost):
    value = monitoring.cost_usd(F.lit(model).cast("string"), F.lit(tokens), F.lit(tokens))
    assert spark.range(1).select(value.alias("c")).first().c == cost


@pytest.mark.parametrize("values, p50, p95", (
    ([], 0.0, 0.0), ([5.0], 5.0, 5.0), ([float(i) for i in range(1, 101)], 51.0, 95.0),
    ([None, None], 0.0, 0.0), ([7.0] * 1000 + [1.0], 7.0, 7.0)))
def test_nearest_rank(spark, values, p50, p95):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert tuple(nearest_rank(df, "v", {"p50": 0.5, "p95": 0.95}).first()) == (p50, p95)


def test_nearest_rank_of_few(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 1.0, 3.0, 2.0, 4.0)], "v double")
    assert nearest_rank(df, "v", {"p50": 0.5}).first().p50 == 3.0


@pytest.mark.parametrize("seed", range(3))
def test_nearest_rank_equals_sorting(spark, seed):
    """Half of the values are one value, the rest spread over many magnitudes."""
    rng = random.Random(seed)
    values = [1.25] * 150_000 + [rng.uniform(0, 1) * 10 ** rng.randint(-3, 9) for _ in range(150_001)]
    rng.shuffle(values)
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 0.999, "f": 1.0}
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(16)
    last = len(values) - 1
    ranks = [(Decimal(p) * last).to_integral_value(ROUND_HALF_EVEN) for p in points.values()]
    want = tuple(sorted(values)[int(rank)] for rank in ranks)
    assert tuple(nearest_rank(df, "v", points).first()) == want


@pytest.mark.parametrize("error, category", (
    (None, "succeeded"), ("", "succeeded"), ("Empty query.", "guardrail rejection"),
    ("Multiple statements are not allowed.", "guardrail rejection"),
    ("Only SELECT (or WITH ... SELECT) statements are allowed.", "guardrail rejection"),
    ("Disallowed keyword in query: DROP", "guardrail rejection"),
    ("Query exceeded 10.0s and was cancelled.", "query timeout"),
    ("Query returned no rows.", "implausible result"),
    ("Query returned only NULL values.", "implausible result"),
    ("Question asks for a rate/share, but the result falls outside [0, 1].", "implausible result"),
    ('Binder Error: Table "r" does not have a column', "SQL execution error"),
    ("Catalog Error: Table does not exist", "SQL execution error"),
    ("HTTP 429: rate_limit_exceeded", "LLM backend error"), ("backend unreachable", "LLM backend error"),
    ("[TABLE_OR_VIEW_NOT_FOUND] The table", "SQL execution error"),
    ("\n[PARSE_SYNTAX_ERROR] Syntax error", "SQL execution error"), ("something else", "other"),
))
def test_error_category(spark, error, category):
    row = spark.range(1).select(error_category(F.lit(error).cast("string")).alias("c")).first()
    assert row.c == category


@pytest.mark.parametrize("message, hint, wait", (
    ("please try again in 9m26.784s", 566.784, 568.784), ("try again in 10m37.632s", 637.632, 639.632),
    ("try again in 5.2s", 5.2, 7.2), ("no hint", 30.0, 32.0), ("try again in 20m0s", 1200.0, 902.0)))
def test_retry_hint(spark, message, hint, wait):
    row = spark.range(1).select(
        retry_after_seconds(F.lit(message)).alias("h"), wait_seconds(F.lit(message)).alias("w")).first()
    assert (row.h, row.w) == (pytest.approx(hint), pytest.approx(wait))


def test_summary_of_an_empty_log_is_zero(spark):
    row = monitoring.summary(traces(spark), feedback(spark, ("q1", "up"))).first()
    assert set(row.asDict().values()) == {0}


def test_summary(spark):
    log = traces(
        spark, ("q1", "2026-08-01 10:00:00", "gpt-4o-mini", None, 2.0, 1000, 500),
        ("q2", "2026-08-01 11:00:00", "llama3", "Query returned no rows.", 4.0, None, None))
    row = monitoring.summary(log, feedback(spark, ("q1", "up"))).first()
    assert (row.total_queries, row.execution_accuracy, row.feedback_rate) == (2, 0.5, 0.5)
    assert row.total_cost_usd == pytest.approx(0.00045)
    assert (row.helpful_count, row.not_helpful_count) == (1, 0)
    assert row.latency_p50_seconds in (2.0, 4.0) and row.latency_p95_seconds == 4.0


def test_daily_series_skips_empty_days(spark):
    log = traces(
        spark, ("q1", "2026-08-01 10:00:00", "llama3", None, 1.0, 0, 0),
        ("q2", "2026-08-01 23:59:59", "llama3", "x", 1.0, 0, 0), ("q3", "2026-08-03 00:00:00", "llama3", None, 1.0, 0, 0))
    assert [tuple(r) for r in monitoring.daily_series(log).collect()] == [
        (date(2026, 8, 1), 2, 0.5, 0.0), (date(2026, 8, 3), 1, 1.0, 0.0)]


def test_failures_by_category(spark):
    log = traces(spark, *(
        (f"q{i}", "2026-08-01 10:00:00", "llama3", e, 1.0, 0, 0)
        for i, e in enumerate(("Binder Error: a", None, "Binder Error: b", "unreachable"))))
    assert [tuple(r) for r in monitoring.failure_categories(log).collect()] == [
        ("SQL execution error", 2), ("LLM backend error", 1)]


def test_trace_page(spark):
    log = traces(spark, *((f"q{i}", f"2026-08-0{i} 10:00:00", "llama3", None, 1.0, 0, 0) for i in (1, 2, 3)))
    assert [r.query_id for r in monitoring.trace_page(log, 2).collect()] == ["q3", "q2"]
    assert [r.query_id for r in monitoring.trace_page(log, 2, 2).collect()] == ["q1"]
    assert monitoring.trace_total(log).first().total == 3


def test_quota_counts_the_paid_model_per_day(spark):
    log = traces(spark, *(
        (f"q{i}", f"2026-08-0{d} 10:00:0{i}", m, None, 1.0, 0, 0)
        for i, (d, m) in enumerate([(1, "paid"), (1, "free"), (1, "paid"), (1, "paid"), (2, "paid"), (2, "free")])))
    assert [r.query_id for r in monitoring.over_quota(log, "paid", 2).collect()] == ["q3"]
    assert monitoring.over_quota(log, "paid", 0).count() == 4


def test_daily_series_as_a_stream(spark, tmp_path):
    log = traces(
        spark, ("q1", "2026-08-01 10:00:00", "llama3", None, 1.0, 0, 0),
        ("q2", "2026-08-01 11:00:00", "llama3", "x", 1.0, 0, 0), ("q3", "2026-08-05 00:00:00", "llama3", None, 1.0, 0, 0))
    log.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    query = (
        daily_series_stream(stream).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "progress")).option("path", str(tmp_path / "out"))
        .trigger(availableNow=True).start())
    query.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(date(2026, 8, 1), 2, 0.5, 0.0)]
    write_daily_series(stream, str(tmp_path / "kept")).awaitTermination()
    shown = {tuple(r) for r in read_daily_series(spark, str(tmp_path / "kept")).collect()}
    assert shown == {(date(2026, 8, 1), 2, 0.5, 0.0), (date(2026, 8, 5), 1, 1.0, 0.0)}
    log.limit(1).withColumn("timestamp", F.lit("2026-08-05 01:00:00").cast("timestamp")).write.mode("append").parquet(
        str(tmp_path / "in"))
    write_daily_series(stream, str(tmp_path / "kept")).awaitTermination()
    assert {r.date.day: r.query_count for r in read_daily_series(spark, str(tmp_path / "kept")).collect()} == {1: 2, 5: 2}


def test_rows_of_any_lateness_are_in_the_streamed_series(spark, tmp_path):
    log = traces(
        spark, ("q1", "2026-08-20 10:00:00", "gpt-4o-mini", None, 1.0, 10, 10), ("q2", "2026-08-21 11:00:00", "llama3", "x", 1.0, 0, 0))
    late = traces(
        spark, ("q3", "2026-08-10 10:00:00", "gpt-4o-mini", "x", 1.0, 7, 3), ("q4", "2026-08-20 12:00:00", "gpt-4o-mini", "x", 1.0, 5, 1))
    root, parts = str(tmp_path / "kept"), str(tmp_path / "in")
    seen = None
    for part in (log, late, late):
        part.write.mode("append").parquet(parts)
        write_daily_series(spark.readStream.schema(log.schema).parquet(parts), root).awaitTermination()
        seen = part if seen is None else seen.unionByName(part)
        assert sorted(read_daily_series(spark, root).collect()) == sorted(monitoring.daily_series(seen).collect())
        compact_daily_series(spark, root)
    log.write.parquet(f"{root}/load=9/days")
    assert sorted(read_daily_series(spark, root).collect()) == sorted(monitoring.daily_series(seen).collect())


@pytest.mark.parametrize("shallow", [0, 40])
def test_deep_pages(spark, shallow):
    random.seed(shallow)
    stamps = ["2026-08-01 10:00:00", "2026-08-01 10:00:00.5", "2026-08-01 10:07:00", "2026-08-03 23:00:00", "2026-07-01 00:00:00", None]
    rows = [(random.choice(["", "a", "ä", "ab"]) + f"q{i}", random.choice(stamps), "m", None, 1.0, 0, 0) for i in range(200)]
    rows += [("same", stamps[0], "m", None, 1.0, 0, 0)] * 30 + [(None, stamps[0], "m", None, 1.0, 0, 0)] * 2
    log = traces(spark, *rows).cache()
    want = [r.query_id for r in log.orderBy(F.desc("timestamp"), "query_id").collect()]
    for offset in (41, 133, 225, 500):
        assert [r.query_id for r in monitoring.trace_page(log, 7, offset, shallow).collect()] == want[offset : offset + 7]


def test_a_deep_page_keeps_few_rows(spark):
    log = traces(spark, *((f"q{i}", "2026-08-01 10:00:00", "m", None, 1.0, 0, 0) for i in range(300)))
    plan = monitoring.trace_page(log, 5, 250, 20)._jdf.queryExecution().executedPlan().toString()
    assert max(int(n) for n in re.findall(r"TakeOrderedAndProject\(limit=(\d+)", plan)) <= 25
