"""What the query log says about cost, latency, accuracy and failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.errors import error_category
from lodestone.operators.percentiles import nearest_rank

# US dollars per million prompt and completion tokens. Models that
# are not listed run locally and cost nothing.
PRICES = {"gpt-4o-mini": (0.15, 0.60)}
PER_TOKENS = 1_000_000


def cost_usd(model: Column, prompt: Column, completion: Column, prices: dict = PRICES) -> Column:
    """The price list is a handful of constants, so it is a CASE and not a join."""
    cases = [
        (name, (prompt * F.lit(p) + completion * F.lit(c)) / PER_TOKENS) for name, (p, c) in prices.items()
    ]
    chain = reduce(lambda acc, case: acc.when(model == case[0], case[1]), cases[1:],
                   F.when(model == cases[0][0], cases[0][1])) if cases else F.lit(0.0)
    return F.coalesce(chain.otherwise(0.0) if cases else chain, F.lit(0.0))


# Costs add up as exact decimals, so a total does not depend on the order of its rows.
EXACT_COST = "decimal(28,12)"


def total_cost() -> Column:
    return F.sum(F.col("cost_usd").cast(EXACT_COST)).cast("double")


def mean_cost() -> Column:
    return total_cost() / F.count("cost_usd")


def enriched_traces(traces: DataFrame) -> DataFrame:
    """Traces with their date, error category, token counts without gaps, and cost."""
    tokens = {
        c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
        for c in ("usage__prompt_tokens", "usage__completion_tokens")
    }
    return traces.withColumns({
        "date": F.to_date("timestamp"),
        "category": error_category(F.col("error")),
        **tokens,
    }).withColumn(
        "cost_usd",
        cost_usd(F.col("model"), F.col("usage__prompt_tokens"), F.col("usage__completion_tokens")),
    )


def _accuracy() -> Column:
    return F.avg(F.col("succeeded").cast("double"))


def summary(enriched: DataFrame, feedback: DataFrame) -> DataFrame:
    """The whole log in one row; zeros when it is empty.

    Orphan votes count, so the feedback rate may exceed one. Without traces
    everything is zero, votes included.
    """
    totals = enriched.agg(
        F.count("*").alias("total_queries"),
        F.coalesce(_accuracy(), F.lit(0.0)).alias("execution_accuracy"),
        F.coalesce(total_cost(), F.lit(0.0)).alias("total_cost_usd"),
    )
    votes = feedback.agg(
        F.count("*").alias("votes"),
        F.count_if(F.col("vote") == "up").alias("up"),
        F.count_if(F.col("vote") == "down").alias("down"),
    )
    latency = nearest_rank(enriched, "latency_seconds", {"p50": 0.5, "p95": 0.95})
    some = F.col("total_queries") > 0
    vote = lambda name: F.when(some, votes.select(name).scalar()).otherwise(F.lit(0))
    return totals.select(
        "total_queries",
        "execution_accuracy",
        "total_cost_usd",
        F.when(some, vote("votes").cast("double") / F.col("total_queries")).otherwise(0.0)
        .alias("feedback_rate"),
        vote("up").alias("helpful_count"),
        vote("down").alias("not_helpful_count"),
        latency.select("p50").scalar().alias("latency_p50_seconds"),
        latency.select("p95").scalar().alias("latency_p95_seconds"),
    )


def daily_series(enriched: DataFrame) -> DataFrame:
    """Per day with traffic: query count, accuracy and mean cost."""
    return (
        enriched.groupBy("date")
        .agg(F.count("*").alias("query_count"), _accuracy().alias("execution_accuracy"),
             mean_cost().alias("avg_cost_usd"))
        .orderBy("date")
    )


def daily_partials(enriched: DataFrame) -> DataFrame:
    """What a part of the traces adds to each day; the parts of a day add up to its place in the series."""
    return enriched.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("query_count"), F.count("succeeded").alias("judged"),
        F.count_if("succeeded").alias("succeeded"), F.sum(F.col("cost_usd").cast(EXACT_COST)).alias("cost"),
        F.count("cost_usd").alias("priced"))


def add_partials(partials: DataFrame) -> DataFrame:
    sums = (F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in partials.columns if c != "date")
    return partials.groupBy("date").agg(*sums)


def series_of_partials(partials: DataFrame) -> DataFrame:
    """``daily_series`` from partials of any number of parts."""
    return add_partials(partials).select(
        "date", "query_count", (F.col("succeeded").cast("double") / F.nullif(F.col("judged"), F.lit(0))).alias("execution_accuracy"),
        (F.col("cost").cast("double") / F.nullif(F.col("priced"), F.lit(0))).alias("avg_cost_usd"))


def failure_categories(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(~F.col("succeeded")).groupBy("category").agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "category")
    )


PAGE_COLUMNS = (
    "query_id", "timestamp", "question", "model", "succeeded", "category", "attempt_count",
    "latency_seconds", "cost_usd",
)


# A page that starts within so many rows is found by keeping that many a task.
SHALLOW = 10_000
# Rows without a time come last.
NO_TIME = "0001-01-01 00:00:00"


def trace_page(enriched: DataFrame, limit: int = 100, offset: int = 0, shallow: int = SHALLOW) -> DataFrame:
    """One page of traces, newest first; the query id decides between equal times.

    For a deep page the traces are counted by day, then within the day of the page's first row by
    minute, and so on down to characters of the query id, until ``shallow`` rows at most lie between the
    start of a range and the page. The page is then read from the start of that range, so no task keeps
    more than ``shallow`` rows and the page.
    """
    stamp, name = F.coalesce("timestamp", F.lit(NO_TIME).cast("timestamp")), F.coalesce("query_id", F.lit(""))
    rest = enriched
    if offset > shallow:
        rest, offset = _from_near(enriched, stamp, name, offset, shallow)
    return rest.orderBy(stamp.desc(), name).offset(offset).limit(limit).select(*PAGE_COLUMNS)


def _from_near(df: DataFrame, stamp: Column, name: Column, offset: int, shallow: int) -> tuple[DataFrame, int]:
    """The rows from some place at or before the ``offset``-th on, and how far the latter is from there."""
    units = ("DAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND", "MICROSECOND")
    inside, later, level, longest = F.lit(True), F.lit(False), 0, 0
    while offset > shallow:
        length = level - len(units) + 1
        if length == 1:  # one time is left; its ids are told apart by ever longer starts
            longest = df.where(inside).agg(F.max(F.char_length(name))).first()[0]
        if length > longest:
            break
        newest_first = length < 1
        key = F.unix_micros(F.date_trunc(units[level], stamp)) if newest_first else F.left(name, F.lit(length))
        counts = df.where(inside).groupBy(key.alias("key")).agg(F.count("*").alias("n"))
        passed = 0
        for at, n in counts.orderBy(F.desc("key") if newest_first else "key").collect():
            if passed + n > offset:
                break
            passed += n
        else:
            return df.where(F.lit(False)), 0
        offset -= passed
        after = key < F.lit(at) if newest_first else key > F.lit(at)
        inside, later, level = inside & (key == F.lit(at)), later | (inside & after), level + 1
    return df.where(inside | later), offset


def trace_total(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count("*").alias("total"))


# Fixed value: queries per day on the paid model.
DAILY_QUOTA = 50


def over_quota(traces: DataFrame, paid_model: str, cap: int = DAILY_QUOTA) -> DataFrame:
    """Requests on the paid model after the day's first ``cap``, in log order.

    Only the first ``cap`` requests of each day are ranked; the last of them is
    the day's cutoff and everything later is over. A day with a third of all
    requests therefore never has to be sorted whole.
    """
    paid = traces.where(F.col("model") == paid_model).withColumn("date", F.to_date("timestamp"))
    if cap < 1:
        return paid
    first = smallest_per_group(paid.select("date", "timestamp", "query_id"), "date",
                               ("timestamp", "query_id"), cap)
    cutoffs = first.where(F.col("rank") == cap).select(
        "date", F.struct("timestamp", "query_id").alias("cutoff"))
    return (
        paid.join(cutoffs, "date")
        .where(F.struct("timestamp", "query_id") > F.col("cutoff")).drop("cutoff")
    )


def smallest_per_group(df: DataFrame, group: str, order: tuple[str, ...], k: int) -> DataFrame:
    """The first ``k`` rows per group with their rank. Spark prunes each task's
    share to ``k`` rows per group before the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
