"""Query log, votes, attempts and retrieval inputs that follow from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.bm25 import Index, build_index
from lodestone.operators.search import sent
from lodestone.session import scratch_path, settled
from lodestone.sources.base import read_table

PAID, LOCAL = "gpt-4o-mini", "llama3"

ERRORS = (
    "Empty query.",
    "Disallowed keyword in query: DROP",
    "Query exceeded 10.0s and was cancelled.",
    "Query returned no rows.",
    'Binder Error: Referenced column "x" not found',
    "HTTP 429: rate_limit_exceeded",
    "Question asks for a rate/share, but the result falls outside [0, 1].",
    "no attempts made",
)

REPLIES = (
    "```sql\nSELECT COUNT(*) FROM fact_orders;\n```",
    "```\nDROP TABLE fact_orders",
    "SELECT 1; SELECT 2",
    "  WITH x AS (SELECT 1 AS a) SELECT a FROM x ;; ",
    "```SQL SELECT order_key FROM fact_orders WHERE order_status = 'SET'```",
    "EXPLAIN SELECT 1",
    "```sql\n;\n```",
    "select region_name from dim_region",
)

WAITS = (
    "HTTP 429: please try again in 9m26.784s",
    "HTTP 429: please try again in 5.2s.",
    "HTTP 500: no hint",
    "HTTP 429: try again in 20m0s",
)


def one_of(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (number % len(values) + 1).cast("int"))


def events(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "events").withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.get_json_object("props", "$.k").cast("bigint"),
    })


def log_traces(spark: SparkSession, path: str) -> DataFrame:
    """One trace per event, shaped as the log has them."""
    failed = F.col("event_type") == "error"
    return events(spark, path).select(
        F.concat(F.lit("q"), F.col("event_id").cast("string")).alias("query_id"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("What about "), F.col("event_type"), F.lit("?")).alias("question"),
        F.when(~failed, F.lit("SELECT 1")).alias("sql"),
        (~failed).alias("succeeded"),
        F.when(failed, one_of(ERRORS, F.col("event_id"))).alias("error"),
        F.when(failed, 2).otherwise(1).cast("bigint").alias("attempt_count"),
        F.when(failed, 0).otherwise(F.col("user_id")).alias("row_count"),
        F.col("value").alias("latency_seconds"),
        F.when(F.col("user_id") % 3 == 0, PAID).otherwise(LOCAL).alias("model"),
        F.struct(
            F.col("k").alias("prompt_tokens"), (2 * F.col("k")).alias("completion_tokens"),
            (3 * F.col("k")).alias("total_tokens"),
        ).alias("usage"),
    )


def log_feedback(spark: SparkSession, path: str) -> DataFrame:
    """Votes of three kinds of events; five neighbouring events vote on one query."""
    voting = events(spark, path).where(F.col("event_type").isin("click", "purchase", "signup"))
    return voting.select(
        F.concat(F.lit("q"), (F.col("event_id") - F.col("event_id") % 5).cast("string")).alias("query_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "signup", "down").otherwise("up").alias("vote"),
    )


def attempts(spark: SparkSession, path: str) -> DataFrame:
    """Two attempts per question, with reply, error, verdict and correctness."""
    n, kind = F.col("event_id"), F.col("event_type")
    question = F.floor(n / 2).cast("bigint")
    return events(spark, path).select(
        question.alias("question_id"),
        (n % 2 + 1).cast("int").alias("attempt_no"),
        (question % 3 + 1).cast("int").alias("tier"),
        one_of(REPLIES, n).alias("reply"),
        F.when(kind == "error", one_of(ERRORS, n)).alias("error"),
        F.when((kind == "error") & (n % 8 == 5), "backend unreachable").alias("api_error"),
        kind.isin("click", "purchase", "view").alias("valid"),
        F.when(kind == "signup", "Query returned no rows.").otherwise("Result looks plausible.")
        .alias("reason"),
        kind.isin("click", "purchase").alias("correct"),
        F.col("k").alias("total_tokens"),
        (F.col("k") - F.floor(F.col("k") / 4)).alias("prompt_tokens"),
        F.floor(F.col("k") / 4).alias("completion_tokens"),
        F.concat(F.lit("What about "), kind, F.lit("?")).alias("question"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("latency_seconds"),
        F.when(kind != "error", F.col("user_id")).otherwise(0).alias("row_count"),
        F.when(F.col("user_id") % 2 == 0, PAID).otherwise(LOCAL).alias("model"),
        F.when(F.col("user_id") % 4 < 2, "retrieval enabled").otherwise("retrieval disabled")
        .alias("condition"),
    )


# --- retrieval ---------------------------------------------------------------


def corpus(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "documents").select(
        "doc_id", F.col("lang").alias("doc_type"), F.col("source").alias("name"), "text")


def questions(spark: SparkSession, path: str) -> DataFrame:
    """Benchmark passages as queries, in three tiers."""
    return read_table(spark, path, "benchmark").select(
        F.col("item_id").alias("query_id"), "text", (F.col("item_id") % 3 + 1).cast("int").alias("tier"))


def vectors(spark: SparkSession, path: str, key: str) -> DataFrame:
    return read_table(spark, path, "embeddings").select(
        F.col("vec_id").alias(key), F.col("embedding").alias("vector"))


def index(spark: SparkSession, path: str) -> Index:
    """The index of the corpus, written once per application to the shared folder."""
    root = scratch_path(spark, "index/" + path.strip("/").replace("/", "-"))
    stored = Index.open(spark, root)
    if stored is not None:
        return stored
    documents = corpus(spark, path).select("doc_id", "text")
    return build_index(documents, vectors(spark, path, "doc_id"), laid_out=False).write(root)


def quoted_by(ranked: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """The ranked pairs whose document holds the whole query text.

    Whether an unranked document would be relevant changes neither hits nor
    ranks, so only ranked pairs are looked at.
    """
    pairs = sent(settled(ranked.select("query_id", "doc_id").distinct()))
    asked = questions(spark, path).select("query_id", F.col("text").alias("query_text"))
    held = corpus(spark, path).select("doc_id", F.col("text").alias("doc_text"))
    return (
        pairs.join(held, "doc_id").join(asked, "query_id")
        .where(F.col("doc_text").contains(F.col("query_text"))).select("query_id", "doc_id")
    )
