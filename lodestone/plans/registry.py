"""Every query by name, over the given tables of one folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.errors import retry_after_seconds, wait_seconds
from lodestone.functions.portable import json_safe
from lodestone.functions.statements import rejection, sql_of_reply
from lodestone.functions.text import tokenize
from lodestone.functions.vectors import as_double, dot, unit
from lodestone.operators import answers, evaluation, execution, guard, metrics, monitoring, quality, search, star
from lodestone.operators.bm25 import Index, bm25_scores
from lodestone.operators.percentiles import nearest_rank
from lodestone.operators.star import Warehouse
from lodestone.operators.upsert import merge
from lodestone.plans import derived, golden
from lodestone.plans.refresh import build_warehouse, nightly_refresh
from lodestone.plans.telemetry import load_tables, run_telemetry
from lodestone.session import scratch_path, settled, stored_bytes, tune
from lodestone.sources import eventlog
from lodestone.sources.base import RAW_TABLES, load_base
from lodestone.sources.versions import latest_version, mark_complete, next_version
from lodestone.streaming.ingest import ingest_new_files, read_daily_series, read_ingested, write_daily_series

Query = Callable[[SparkSession, str], DataFrame]

# The given data names its nations NATION_0 to NATION_24.
NATION = "NATION_7"


def on_star(query: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, path: json_safe(query(Warehouse.derive(spark, path)))


def on_raw(query: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, path: json_safe(query(load_base(spark, path)))


def base_totals(raw: dict[str, DataFrame]) -> DataFrame:
    """Row counts and exact money and date totals of the raw relations."""
    lines, orders = raw["lineitem"], raw["orders"]
    return lines.agg(
        F.count("*").alias("line_rows"), F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price"), F.sum("l_discount").alias("discount"),
        F.sum("l_tax").alias("tax"), F.min("l_shipdate").alias("first_shipped"),
    ).select(
        "*",
        *(orders.agg(agg.alias("v")).scalar().alias(name) for name, agg in (
            ("order_rows", F.count("*")), ("order_total", F.sum("o_totalprice")),
            ("last_ordered", F.max("o_orderdate")),
        )),
    )


def warehouse_queries() -> dict[str, Query]:
    def rebuilt(spark, path):
        return build_warehouse(spark, path, scratch_path(spark, f"warehouse/{uuid.uuid4()}"))

    def written(spark, path):
        """Exact totals of the written fact."""
        root = scratch_path(spark, f"warehouse/{uuid.uuid4()}")
        build_warehouse(spark, path, root)
        return Warehouse.open(spark, root).fact.agg(
            F.count("*").alias("line_rows"), F.sum("net_revenue").alias("net_revenue"),
            F.sum(F.col("order_date_key").cast("bigint")).alias("order_dates"),
            F.sum(F.col("ship_date_key").cast("bigint")).alias("ship_dates"))

    def nightly(spark, path):
        root = scratch_path(spark, f"nightly/{uuid.uuid4()}")
        documents = derived.corpus(spark, path).select("doc_id", "text")
        report = nightly_refresh(
            spark, path, documents, written_log(spark, path), root, derived.vectors(spark, path, "doc_id"))
        indexed = Index.open(spark, f"{root}/index").documents
        stages = {
            "index": indexed, "vectors": indexed.where("vector IS NOT NULL"),
            **load_tables(spark, f"{root}/telemetry"),
        }
        return reduce(DataFrame.unionByName, [report, *(
            df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name))
            for name, df in stages.items())])

    return {
        "W9_written_fact": lambda spark, path: json_safe(written(spark, path)),
        "W12_rebuild": rebuilt,
        "W1_base": on_raw(base_totals),
        "W2_dim_region": on_star(lambda w: w.region),
        "W3_dim_customer": on_star(lambda w: w.customer),
        "W4_dim_supplier": on_star(lambda w: w.supplier),
        "W5_dim_product": on_star(lambda w: w.product),
        "W6a_date_bounds": on_raw(lambda raw: star.date_bounds(raw["orders"], raw["lineitem"])),
        "W6b_date_spine": on_raw(
            lambda raw: star.date_spine(star.date_bounds(raw["orders"], raw["lineitem"]))),
        "W6c_dim_date": on_star(lambda w: w.calendar),
        "W7_fact_orders": on_star(lambda w: w.fact),
        "W11_row_counts": on_star(quality.row_counts),
        "W13_nightly_refresh": nightly,
        "W14_non_empty": on_star(quality.non_empty),
        "W15_key_uniqueness": on_star(quality.key_uniqueness),
        "W16_grain_uniqueness": on_star(quality.grain_uniqueness),
        "W17_fact_orphans": on_star(quality.fact_orphans),
        "W18_nation_orphans": on_star(quality.nation_orphans),
        "W19_date_contiguity": on_star(quality.date_contiguity),
        "W20_negative_revenue": on_star(quality.negative_revenue),
    }


def metric_queries() -> dict[str, Query]:
    named = {
        "S9": "total_revenue", "S10": "order_count", "S11": "average_order_value",
        "S12": "repeat_customer_rate", "S13": "average_discount_rate",
    }
    return {
        "S6_metric_health": on_star(metrics.metric_health),
        **{f"{key}_{name}": on_star(partial(metrics.metric, name=name)) for key, name in named.items()},
        "S14_order_value_by_region": on_star(
            lambda w: metrics.metric_by(w, "average_order_value", "region_name")),
        "S14_repeat_rate_by_segment": on_star(
            lambda w: metrics.metric_by(w, "repeat_customer_rate", "market_segment")),
        "S14_revenue_by_brand_and_year": on_star(
            lambda w: metrics.metric_by(w, "total_revenue", "brand", "year")),
    }


def golden_queries() -> dict[str, Query]:
    named = {
        **golden.GOLDEN,
        **golden.FURTHER,
        "t2_13": partial(golden.orders_from_nation, nation=NATION),
        "Q53": partial(golden.orders_from_nation_by_key, nation=NATION),
        "Q_lines_by_return_flag": partial(golden.lines_by, column="return_flag"),
    }
    return {key: on_star(query) for key, query in named.items()}


def written_log(spark: SparkSession, path: str) -> str:
    """The whole log as files, written once per application."""
    root = scratch_path(spark, "log/" + path.strip("/").replace("/", "-"))
    if latest_version(spark, root) is None:
        folder = next_version(spark, root)
        eventlog.append_events(eventlog.trace_events(derived.log_traces(spark, path)), f"{folder}/events")
        eventlog.append_feedback(
            eventlog.feedback_events(derived.log_feedback(spark, path)), f"{folder}/events")
        mark_complete(spark, folder)
    return f"{latest_version(spark, root)}/events"


def telemetry_queries() -> dict[str, Query]:
    def logged(spark, path):
        return eventlog.read_log(spark, written_log(spark, path))

    def event_counts(spark, path):
        return logged(spark, path).groupBy("event_type").agg(
            F.count("*").alias("events"), F.count_distinct("query_id").alias("queries"),
            F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))

    def votes(spark, path):
        kind = F.col("event_type")
        cast = derived.events(spark, path).select(
            F.when(kind == "click", "up").when(kind == "signup", "down").when(kind == "view", kind).alias("vote"))
        valid, rejected = eventlog.split_votes(cast)
        return valid.withColumn("accepted", F.lit(True)).unionByName(
            rejected.withColumn("accepted", F.lit(False))
        ).groupBy("accepted", F.coalesce("vote", F.lit("none")).alias("vote")).agg(
            F.count("*").alias("rows"))

    def merged_traces(spark, path):
        """The log without purchases, then a load of purchases and of corrected errors."""
        log = eventlog.flatten_usage(eventlog.trace_events(derived.log_traces(spark, path)))
        purchase = F.col("question").contains("purchase")
        loaded = log.where(~purchase)
        load = log.where(purchase | ~F.col("succeeded")).withColumn(
            "attempt_count", F.col("attempt_count") + 1)
        once = merge(loaded, load, "query_id")
        return merge(once, load, "query_id").drop("event_type")

    def latest_votes(spark, path):
        votes = eventlog.feedback_events(derived.log_feedback(spark, path))
        return merge(None, votes, "query_id").select("query_id", "timestamp", "vote")

    def both(tables):
        columns = ("query_id", "timestamp")
        return tables["traces"].select(F.lit("traces").alias("table_name"), *columns, "model").unionByName(
            tables["feedback"].select(F.lit("feedback").alias("table_name"), *columns, F.col("vote").alias("model")))

    def pipeline_twice(spark, path):
        root = scratch_path(spark, f"telemetry/{uuid.uuid4()}")
        log = written_log(spark, path)
        run_telemetry(spark, log, root)
        return both(run_telemetry(spark, log, root))

    def incremental(spark, path):
        root = scratch_path(spark, f"stream/{uuid.uuid4()}")
        log = written_log(spark, path)
        for _ in range(2):
            ingest_new_files(spark, log, root).awaitTermination()
        return both({name: read_ingested(spark, root, name) for name in ("traces", "feedback")})

    plain = {
        "T1_append_log": event_counts,
        "T2_vote_domain": votes,
        "T3_read_feedback": lambda spark, path: eventlog.feedback_of(logged(spark, path)),
        "T4_flat_traces": lambda spark, path: eventlog.traces_of(logged(spark, path)),
        "T6_merge_traces": merged_traces,
        "T7_merge_feedback": latest_votes,
        "T8_pipeline": pipeline_twice,
        "T9_incremental": incremental,
    }
    return {key: (lambda spark, path, q=q: json_safe(q(spark, path))) for key, q in plain.items()}


def monitoring_queries() -> dict[str, Query]:
    def enriched(spark, path):
        log = eventlog.trace_events(derived.log_traces(spark, path))
        return monitoring.enriched_traces(eventlog.flatten_usage(log))

    def summary(spark, path):
        votes = merge(None, eventlog.feedback_events(derived.log_feedback(spark, path)), "query_id")
        return monitoring.summary(enriched(spark, path), votes)

    def streamed(spark, path):
        """The daily series as a stream over the log, days still open included."""
        root = scratch_path(spark, f"daily/{uuid.uuid4()}")
        log = spark.readStream.schema(eventlog.EVENT).option("mode", "FAILFAST").json(written_log(spark, path))
        write_daily_series(monitoring.enriched_traces(eventlog.traces_of(log)), root).awaitTermination()
        return read_daily_series(spark, root)

    plain = {
        "M6_daily_stream": streamed,
        "M1_enriched": lambda spark, path: enriched(spark, path).select(
            "query_id", "date", "category", "usage__prompt_tokens", "usage__completion_tokens", "cost_usd"),
        "M2_cost_by_model": lambda spark, path: enriched(spark, path).groupBy("model").agg(
            monitoring.total_cost().alias("cost_usd")),
        "M3_latency": lambda spark, path: nearest_rank(
            enriched(spark, path), "latency_seconds", {"p50": 0.5, "p95": 0.95}),
        "M4_categories": lambda spark, path: enriched(spark, path).groupBy("error", "category").agg(
            F.count("*").alias("n")).select(F.coalesce("error", F.lit("")).alias("error"), "category", "n"),
        "M5_summary": summary,
        "M6_daily": lambda spark, path: monitoring.daily_series(enriched(spark, path)),
        "M7_failures": lambda spark, path: monitoring.failure_categories(enriched(spark, path)),
        "M8_trace_page": lambda spark, path: monitoring.trace_page(
            enriched(spark, path), limit=100, offset=50),
        "M8_trace_total": lambda spark, path: monitoring.trace_total(enriched(spark, path)),
        "G11_over_quota": lambda spark, path: monitoring.over_quota(
            enriched(spark, path), derived.PAID).select("query_id", "date"),
    }
    return {key: (lambda spark, path, q=q: json_safe(q(spark, path))) for key, q in plain.items()}


GUARDED_SQL = """
    SELECT r.region_name, d.year, COUNT(DISTINCT f.order_key) AS orders
    FROM fact_orders f
    JOIN dim_customer c ON f.customer_key = c.customer_key
    JOIN dim_region r ON c.nation_key = r.nation_key
    JOIN dim_date d ON f.order_date_key = d.date_key
    GROUP BY r.region_name, d.year
    ORDER BY r.region_name, d.year;
"""

METRIC_QUESTIONS = {
    "total_revenue": "What share of revenue is the total?",
    "order_count": "How many orders are there?",
    "average_order_value": "What rate does a typical order reach?",
    "repeat_customer_rate": "What is the repeat customer rate?",
    "average_discount_rate": "Which fraction is discounted?",
}


def guard_queries() -> dict[str, Query]:
    def classified(spark, path):
        replies = derived.attempts(spark, path).select("question_id", "attempt_no", F.col("reply").alias("sql"))
        as_written = guard.classify(replies).select("question_id", "attempt_no", "rejection", "allowed")
        cleaned = guard.classify(replies.withColumn("sql", sql_of_reply(F.col("sql"))))
        return as_written.join(
            cleaned.select("question_id", "attempt_no", F.col("rejection").alias("clean_rejection")),
            ["question_id", "attempt_no"]
        ).withColumns({c: F.coalesce(c, F.lit("")) for c in ("rejection", "clean_rejection")})

    def row_cap(w):
        return guard.capped(w.fact).agg(F.count("*").alias("n")).select(
            F.least("n", F.lit(guard.MAX_ROWS)).alias("row_count"),
            (F.col("n") > guard.MAX_ROWS).alias("truncated"))

    def guarded(spark, path):
        own = guard.guarded_session(spark)
        Warehouse.derive(own, path).register_views(own)
        schema = json_safe(guard.plan_guarded(own, GUARDED_SQL)).schema
        seconds = guard.allowed_seconds(sum(stored_bytes(spark, f"{path.rstrip('/')}/{name}.parquet") for name in RAW_TABLES))
        return spark.createDataFrame(guard.run_guarded(own, GUARDED_SQL, timeout_seconds=seconds).rows, schema)

    def plausible(w):
        values = settled(metrics.metric_values(w))
        checks = [
            answers.plausibility(F.lit(question), values.select(name))
            for name, question in METRIC_QUESTIONS.items()
        ]
        return reduce(DataFrame.unionByName, checks)

    def plain_orders(raw):
        return raw["orders"].select("o_orderkey", "o_totalprice", "o_orderdate")

    def nested(spark, path):
        """Times with and without a fraction, and decimals and dates inside arrays and structs."""
        amount = F.col("k").cast("decimal(15,2)")
        rows = derived.events(spark, path).select(
            "event_id", "ts", F.array(F.col("ts"), F.date_trunc("second", "ts")).alias("times"),
            F.struct(amount.alias("amount"), F.array(F.to_date("ts")).alias("days")).alias("inner"),
            F.create_map(F.lit("amount"), amount).alias("named"))
        return json_safe(rows).select(
            "event_id", "ts", F.element_at("times", 2).alias("whole_second"), "inner.amount",
            F.element_at("inner.days", 1).alias("day"), F.element_at("named", "amount").alias("named_amount"))

    def usage(spark, path):
        attempts = derived.attempts(spark, path)
        query = F.col("question_id").alias("query_id")
        calls = attempts.where(F.col("api_error").isNull()).select(
            query, F.col("total_tokens").alias("prompt_tokens"),
            F.when(F.col("valid"), F.col("total_tokens")).alias("completion_tokens"), "total_tokens")
        totals = evaluation.usage_totals(attempts.select(query).distinct(), calls)
        return totals.select("query_id", *(
            F.coalesce(c, F.lit(-1)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")))

    def failures(spark, path):
        attempts = derived.attempts(spark, path).withColumnRenamed("question_id", "query_id")
        made = attempts.where(F.col("api_error").isNull())
        texts = evaluation.failure_text(made, attempts.select("query_id").distinct())
        return texts.select("query_id", F.coalesce("error", F.lit("")).alias("error"))

    return {
        "G1_classify": lambda spark, path: json_safe(classified(spark, path)),
        "G2_row_cap": on_star(row_cap),
        "G5_guarded_query": lambda spark, path: guarded(spark, path),
        "G6_sql_of_reply": lambda spark, path: derived.attempts(spark, path).select(
            "question_id", "attempt_no", sql_of_reply(F.col("reply")).alias("sql")),
        "G7_plausibility": on_star(plausible),
        "G8_json_safe": on_raw(plain_orders),
        "G8_json_safe_nested": nested,
        "G12_usage_totals": usage,
        "G13_failure_text": failures,
    }


# What a question's statement should return, by question.
REFERENCES = (
    "SELECT COUNT(*) AS lines FROM fact_orders",
    "SELECT 1 AS one",
    "SELECT region_name FROM dim_region ORDER BY region_name",
)
REPLY_ORDERS = ("3, 1, 2", "no idea", "9, 1, 1, 2", "Best: 8 then 4 then 12345678901234567890")


def retriever(spark: SparkSession, path: str, with_vectors: bool = True) -> search.Retriever:
    vectors = derived.vectors(spark, path, "query_id") if with_vectors else None
    return search.Retriever(derived.index(spark, path), derived.questions(spark, path), vectors)


def retrieval_queries() -> dict[str, Query]:
    def tokens(spark, path):
        words = tokenize(F.col("text"))
        return derived.corpus(spark, path).select(
            "doc_id", F.size(words).alias("tokens"), F.md5(F.array_join(words, " ")).alias("digest"))

    def terms(spark, path):
        return derived.index(spark, path).rated_terms.withColumn("idf", F.round("idf", 6))

    def corpus_row(spark, path):
        return derived.index(spark, path).corpus.select(
            "n", F.round("mean_length", 6).alias("mean_length"), F.round("mean_idf", 6).alias("mean_idf"))

    def stored(spark, path):
        blocks = derived.index(spark, path).blocks
        return blocks.agg(
            F.sum(F.size("docs").cast("long")).alias("postings"),
            F.sum(F.aggregate("tfs", F.lit(0).cast("long"), lambda a, x: a + x)).alias("tokens"),
            F.count_distinct("term").alias("terms"), F.max(F.array_max("tfs")).cast("bigint").alias("most"))

    def score_totals(spark, path):
        scores = bm25_scores(derived.index(spark, path), derived.questions(spark, path))
        return scores.groupBy("query_id").agg(
            F.count("*").alias("matched"), F.round(F.sum("score"), 4).alias("total"),
            F.round(F.max("score"), 6).alias("best"))

    def units(spark, path):
        made = derived.vectors(spark, path, "doc_id").select(
            "doc_id", unit(as_double(F.col("vector"))).alias("u"))
        total = F.aggregate("u", F.lit(0.0), lambda a, x: a + x)
        return made.select("doc_id", F.round(dot(F.col("u"), F.col("u")), 6).alias("length"),
                           F.round(total, 6).alias("total"))

    def ranges(spark, path):
        found = retriever(spark, path).score_ranges()
        return found.select("query_id", *(F.round(c, 6).alias(c) for c in ("v_low", "v_high", "k_low", "k_high")))

    def declarative(spark, path):
        scores = bm25_scores(derived.index(spark, path), derived.questions(spark, path))
        return search.top_k(scores.withColumn("score", F.round("score", 6)), 5)

    def found(method, with_vectors=True):
        return lambda spark, path: retriever(spark, path, with_vectors).search(method, 5)

    def reranked(spark, path):
        r = retriever(spark, path)
        candidates = search.with_vectors(r.keyword_search(8), r.index, r.vectors)
        return search.rerank(candidates, search.cosine_of_candidates(), 4).select(
            "query_id", "doc_id", "score", "rank")

    def vector_scores(spark, path):
        """Of each question its scores with all documents."""
        scores = retriever(spark, path).vector_scores()
        return scores.groupBy("query_id").agg(
            F.count("*").alias("documents"), F.round(F.sum("score"), 4).alias("total"),
            F.round(F.min("score"), 6).alias("lowest"), F.round(F.max("score"), 6).alias("highest"))

    def reordered(spark, path):
        r = retriever(spark, path)
        replies = r.queries.select("query_id", derived.one_of(REPLY_ORDERS, F.col("query_id")).alias("reply"))
        return search.apply_reply_order(settled(r.keyword_search(8)), replies, 5)

    def schema_search(spark, path):
        return search.search_schema(retriever(spark, path), derived.corpus(spark, path))

    def contexts(spark, path):
        blocks = search.context_blocks(schema_search(spark, path))
        return blocks.select("query_id", F.length("context").alias("characters"), F.md5("context").alias("digest"))

    return {
        "R1_tokenize": tokens,
        "R2_terms": terms,
        "R2_corpus": corpus_row,
        "R3_stored_index": stored,
        "R4_bm25_scores": score_totals,
        "R5_unit_vectors": units,
        "R6_vector_scores": vector_scores,
        "R7_score_ranges": ranges,
        "R8_top_k": declarative,
        "R9_keyword_search": found("keyword"),
        "R10_vector_search": found("vector"),
        "R11_hybrid_search": found("hybrid"),
        "R12_no_vectors": found("hybrid", with_vectors=False),
        "R13_rerank": reranked,
        "R14_reply_order": reordered,
        "R15_search_schema": schema_search,
        "R16_context": contexts,
    }


def evaluation_queries() -> dict[str, Query]:
    def methods(spark, path):
        r = retriever(spark, path)
        wide = settled(r.hybrid_search(8))
        return {
            "Keyword only": settled(r.keyword_search(5)),
            "Vector only": settled(r.vector_search(5)),
            "Hybrid": wide.where(F.col("rank") <= 5),
            "Hybrid + rerank": search.rerank(
                search.with_vectors(wide, r.index, r.vectors), search.cosine_of_candidates(), 5
            ).select(*wide.columns),
        }

    def hits(spark, path):
        r = retriever(spark, path)
        ranked = settled(r.keyword_search(5))
        return evaluation.hit_and_reciprocal_rank(
            r.queries.select("query_id", "tier"), ranked, derived.quoted_by(ranked, spark, path))

    def compared(spark, path):
        ranked = methods(spark, path)
        pairs = reduce(DataFrame.unionByName, [r.select("query_id", "doc_id") for r in ranked.values()])
        return evaluation.evaluate_methods(
            derived.questions(spark, path), ranked, derived.quoted_by(pairs, spark, path))

    def shown(results):
        return results.select(
            "method", "tier", "questions", F.round("hit_rate", 9).alias("hit_rate"), F.round("mrr", 9).alias("mrr"))

    def one_method(spark, path):
        r = retriever(spark, path)
        ranked = settled(r.vector_search(5))
        return shown(evaluation.evaluate_methods(
            r.queries, {"Vector only": ranked}, derived.quoted_by(ranked, spark, path)))

    def best(spark, path):
        overall = compared(spark, path).where(F.col("tier") == evaluation.ALL_TIERS)
        return evaluation.winner(overall, "hit_rate", "mrr").withColumn("mrr", F.round("mrr", 9))

    def matches(raw):
        """Per customer: do the large orders by status tell the same as all orders?"""
        orders = raw["orders"].withColumnRenamed("o_custkey", "question_id")

        def by_status(df):
            return df.groupBy("question_id", "o_orderstatus").agg(F.count("*").alias("n"))

        return evaluation.match_per_question(
            orders.select("question_id").distinct(), by_status(orders.where("o_totalprice >= 20000")),
            by_status(orders))

    def executed(spark, path):
        return derived.attempts(spark, path).select(
            "question_id", "attempt_no", "tier", "model", "condition", "total_tokens",
            sql_of_reply(F.col("reply")).alias("sql"), "api_error", F.col("error").alias("run_error"),
            F.col("correct").alias("matched"))

    def scored(spark, path):
        return evaluation.outcomes(executed(spark, path)).select(
            "question_id", "attempt_no", "sql", "correct", F.coalesce("error", F.lit("")).alias("error"))

    def run_and_matched(spark, path):
        """The distinct statements of all replies, run over the star and compared with a reference a question."""
        own = guard.guarded_session(spark)
        Warehouse.derive(own, path).register_views(own)
        tries = derived.attempts(own, path).select(
            "question_id", "attempt_no", sql_of_reply(F.col("reply")).alias("sql"),
            derived.one_of(REFERENCES, F.col("question_id")).alias("reference_sql"))
        tries = tries.withColumn("refused", rejection(F.col("sql")))
        statements = tries.where("refused IS NULL").select("sql").unionByName(tries.select(F.col("reference_sql").alias("sql")))
        runs = execution.run_table(own, statements, scratch_path(spark, f"runs/{uuid.uuid4()}"), timeout_seconds=120)
        found = execution.matched(tries, runs)
        answers = runs.rows.where("position = 0").select("statement", F.get_json_object("answer", "$.c0").alias("first"))
        named = found.join(answers, execution.statement_key(F.col("sql")) == F.col("statement"), "left")
        return named.select(
            "question_id", "attempt_no", "correct", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
            F.when(F.col("n_rows") == 1, F.col("first").cast("double")).otherwise(-1.0).alias("answer"),
            F.coalesce("refused", "error", F.lit("")).alias("error"))

    def summary(spark, path):
        return evaluation.outcome_summary(evaluation.outcomes(executed(spark, path)), "model", "condition")

    def waits(spark, path):
        message = derived.one_of(derived.WAITS, F.col("event_id"))
        return derived.events(spark, path).select(
            "event_id", retry_after_seconds(message).alias("hint"), wait_seconds(message).alias("wait"))

    def kept(spark, path):
        return evaluation.kept_attempts(derived.attempts(spark, path))

    def finals(spark, path):
        return evaluation.final_attempts(kept(spark, path)).select(
            "question_id", "attempt_no", "attempt_count", "succeeded")

    def retried(spark, path):
        return evaluation.retry_outcomes(kept(spark, path))

    def retried_plain(spark, path):
        return retried(spark, path).withColumn("final_error", F.coalesce("final_error", F.lit("")))

    def ablated(spark, path):
        tagged = evaluation.outcomes(executed(spark, path))
        current = evaluation.ablation(tagged.where(F.col("attempt_no") == 2))
        earlier = evaluation.ablation(tagged.where(F.col("attempt_no") == 1))
        return evaluation.compare_runs(current, earlier).withColumn("change", F.round("change", 9))

    def tagged(spark, path):
        """Outcome records of both conditions, written and read back."""
        root = scratch_path(spark, f"outcomes/{uuid.uuid4()}")
        plain = evaluation.outcomes(executed(spark, path).drop("model", "condition"))
        first = evaluation.tag_outcomes(plain.where("attempt_no = 1"), derived.LOCAL, "retrieval disabled")
        second = evaluation.tag_outcomes(plain.where("attempt_no = 2"), derived.PAID, "retrieval enabled")
        records = first.unionByName(second)
        records.write.json(root)
        return spark.read.schema(records.schema).json(root).groupBy("model", "condition", "correct").agg(
            F.count("*").alias("n"), F.sum("total_tokens").alias("total_tokens"))

    def assembled(spark, path):
        traces = evaluation.assemble_traces(derived.attempts(spark, path))
        return traces.select(
            "question_id", "tier", F.size("attempts").alias("attempts"), "final.question", "final.row_count",
            F.col("final.valid").alias("succeeded"), sql_of_reply(F.col("final.reply")).alias("sql"),
            F.array_join(F.transform("attempts", lambda a: a["reply"]), "|").alias("replies"))

    def failing(spark, path):
        attempts = kept(spark, path)
        wrong = retried(spark, path).where(~F.col("retry_correct"))
        return evaluation.select_questions(attempts, wrong).select("question_id", "attempt_no", "tier")

    def verdicts(spark, path):
        attempts = derived.attempts(spark, path).withColumns({
            "sql": sql_of_reply(F.col("reply")), "verdict": F.col("reason"), "plausible": F.col("valid")})
        stopped = attempts.withColumn("error", F.coalesce(rejection(F.col("sql")), F.col("error")))
        return evaluation.attempt_verdicts(stopped).select(
            "question_id", "attempt_no", "valid", "reason", F.coalesce("error", F.lit("")).alias("error"))

    def told(spark, path):
        return evaluation.attempt_feedback(derived.attempts(spark, path)).select(
            "question_id", "attempt_no", F.coalesce("feedback", F.lit("")).alias("feedback"))

    def answer_log(spark, path):
        """Answered questions as trace rows, appended to a log and read back."""
        root = scratch_path(spark, f"answers/{uuid.uuid4()}")
        attempts = kept(spark, path).withColumn("query_id", F.col("question_id").cast("string"))
        eventlog.append_events(eventlog.trace_events(evaluation.answered(attempts)), root)
        return eventlog.traces_of(eventlog.read_log(spark, root)).select(
            "query_id", "timestamp", "question", "model", "succeeded", "attempt_count", "row_count",
            F.coalesce("error", F.lit("")).alias("error"), "sql", F.round("latency_seconds", 6).alias("latency_seconds"),
            "usage__prompt_tokens", "usage__completion_tokens", "usage__total_tokens")

    return {
        "E2_hits": hits,
        "E3_rates_by_tier": one_method,
        "E4_compare_methods": lambda spark, path: shown(compared(spark, path)),
        "E5_winner": best,
        "E6_match_per_question": on_raw(matches),
        "E8_outcomes": scored,
        "E8_executed": run_and_matched,
        "E9_summary": summary,
        "E10_waits": waits,
        "E11_final_attempts": finals,
        "E12_retry_outcomes": retried_plain,
        "E13_retry_summary": lambda spark, path: evaluation.retry_summary(retried(spark, path)).withColumn(
            "lift", F.round("lift", 9)),
        "E14_ablation": ablated,
        "E15_tagged_outcomes": tagged,
        "E16_assembled_traces": assembled,
        "E17_failing_questions": failing,
        "A1_candidate_sql": lambda spark, path: evaluation.final_attempts(kept(spark, path)).select(
            "question_id", sql_of_reply(F.col("reply")).alias("sql")),
        "A2_verdicts": verdicts,
        "A3_feedback": told,
        "A4_kept_attempts": lambda spark, path: kept(spark, path).select("question_id", "attempt_no", "valid"),
        "A5_answer_log": lambda spark, path: json_safe(answer_log(spark, path)),
    }


def all_queries() -> dict[str, Query]:
    named = {
        **warehouse_queries(), **metric_queries(), **golden_queries(), **telemetry_queries(),
        **monitoring_queries(), **guard_queries(), **retrieval_queries(), **evaluation_queries(),
    }
    return {key: (lambda spark, path, q=q: q(tune(spark), path)) for key, q in named.items()}
