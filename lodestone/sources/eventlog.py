"""The query log: one JSON object per line, in a folder of files.

A folder instead of one growing file lets many writers append at once and lets a
stream pick up only what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.sources.versions import path_exists

USAGE = T.StructType([
    T.StructField("prompt_tokens", T.LongType()),
    T.StructField("completion_tokens", T.LongType()),
    T.StructField("total_tokens", T.LongType()),
])

TRACE = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("question", T.StringType()),
    T.StructField("sql", T.StringType()),
    T.StructField("succeeded", T.BooleanType()),
    T.StructField("error", T.StringType()),
    T.StructField("attempt_count", T.LongType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("latency_seconds", T.DoubleType()),
    T.StructField("model", T.StringType()),
    T.StructField("usage", USAGE),
])

# One schema for the whole log: a line fills the fields of its own event type.
# It is declared, never inferred, so a column that is NULL in every line keeps its type.
EVENT = T.StructType(TRACE.fields + [T.StructField("vote", T.StringType())])

FEEDBACK_FIELDS = ("event_type", "query_id", "timestamp", "vote")

VOTES = ("up", "down")

CORRUPT = "_corrupt_line"


def trace_events(df: DataFrame) -> DataFrame:
    """Rows as the log stores them; a missing timestamp is now."""
    return _events(df, "trace", [f.name for f in TRACE.fields])


def feedback_events(df: DataFrame) -> DataFrame:
    return _events(df, "feedback", list(FEEDBACK_FIELDS))


def _events(df: DataFrame, event_type: str, names: list[str]) -> DataFrame:
    stamp = F.col("timestamp") if "timestamp" in df.columns else F.lit(None)
    ready = df.withColumns({
        "event_type": F.lit(event_type),
        "timestamp": F.coalesce(stamp.cast("timestamp"), F.current_timestamp()),
    })
    return ready.select(*(
        (F.col(n) if n in ready.columns else F.lit(None)).cast(EVENT[n].dataType).alias(n) for n in names
    ))


def split_votes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feedback with a vote in the domain, and the rejected rest."""
    valid = F.coalesce(F.col("vote").isin(*VOTES), F.lit(False))
    return df.where(valid), df.where(~valid)


def append_events(events: DataFrame, log_dir: str) -> None:
    """Add events to the log; the timestamp is written in UTC with its offset."""
    stamp = F.to_utc_timestamp("timestamp", F.current_timezone())
    text = F.concat(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    events.withColumn("timestamp", text).write.mode("append").json(log_dir)


def append_feedback(events: DataFrame, log_dir: str, rejected_dir: str | None = None) -> None:
    """Add votes to the log. Those outside the domain go to ``rejected_dir``; without it one of them fails the write."""
    if rejected_dir is None:
        wrong = F.raise_error(F.concat(F.lit("Not a vote: "), F.coalesce(F.col("vote"), F.lit("NULL"))))
        append_events(events.withColumn("vote", F.when(F.col("vote").isin(*VOTES), F.col("vote")).otherwise(wrong)), log_dir)
        return
    valid, rejected = split_votes(events)
    append_events(valid, log_dir)
    append_events(rejected, rejected_dir)


def read_log(spark: SparkSession, log_dir: str | list[str], quarantine: bool = False) -> DataFrame:
    """All events of a folder, or of the files named. A malformed line fails the read, or with ``quarantine``
    is kept as text in its own column; blank lines are skipped; no folder means no events."""
    if isinstance(log_dir, str) and not path_exists(spark, log_dir):
        return spark.createDataFrame([], EVENT)
    if not quarantine:
        return spark.read.schema(EVENT).option("mode", "FAILFAST").json(log_dir)
    schema = T.StructType(EVENT.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).json(log_dir)
    )


def of_type(events: DataFrame, event_type: str) -> DataFrame:
    return events.where(F.col("event_type") == event_type)


def flatten_usage(events: DataFrame) -> DataFrame:
    """Nested token counts as ``usage__*`` columns."""
    others = [c for c in events.columns if c != "usage"]
    flat = [F.col(f"usage.{f.name}").alias(f"usage__{f.name}") for f in USAGE.fields]
    return events.select(*others, *flat)


def traces_of(events: DataFrame) -> DataFrame:
    return flatten_usage(of_type(events, "trace").select(*(f.name for f in TRACE.fields)))


def feedback_of(events: DataFrame) -> DataFrame:
    return of_type(events, "feedback").select(*FEEDBACK_FIELDS)
