"""Incremental ingestion of the query log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.monitoring import add_partials, daily_partials, mean_cost, series_of_partials
from lodestone.operators.upsert import merge
from lodestone.sources.eventlog import EVENT, feedback_of, traces_of
from lodestone.sources.versions import MARKER, child_names, mark_complete, path_exists


def _complete(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Numbers of the folders of one kind that were written to the end."""
    numbers = [int(n.split("=")[1]) for n in child_names(spark, root) if n.startswith(f"{kind}=")]
    return sorted(n for n in numbers if path_exists(spark, f"{root}/{kind}={n}/{MARKER}"))


def ingest_new_files(spark: SparkSession, log_dir: str, root: str) -> StreamingQuery:
    """Load the log files that arrived since the last run, then stop.

    Each micro-batch is merged within itself and written to a folder of its own
    number, which readers open once both tables are in it. A batch that is
    retried after a failure overwrites its unfinished folder, and one that had
    been finished is left as it is, so no row is loaded twice.
    """

    def load(events: DataFrame, batch_id: int) -> None:
        folder = f"{root}/load={batch_id}"
        if path_exists(spark, f"{folder}/{MARKER}"):
            return
        for name, batch in (("traces", traces_of(events)), ("feedback", feedback_of(events))):
            merge(None, batch.drop("event_type"), "query_id").write.mode("overwrite").parquet(f"{folder}/{name}")
        mark_complete(spark, folder)

    return (
        spark.readStream.schema(EVENT).option("mode", "FAILFAST").json(log_dir)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{root}/_progress")
        .trigger(availableNow=True)
        .start()
    )


def _sources(spark: SparkSession, root: str) -> list[str]:
    """The newest compaction and the loads after it."""
    newest = max(_complete(spark, root, "base"), default=None)
    since = -1 if newest is None else newest
    loads = [f"{root}/load={n}" for n in _complete(spark, root, "load") if n > since]
    return loads if newest is None else [f"{root}/base={newest}", *loads]


def read_ingested(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table over all finished loads: per key the row with the latest timestamp."""
    folders = _sources(spark, root)
    if not folders:
        return None
    return merge(None, spark.read.parquet(*(f"{f}/{name}" for f in folders)), "query_id")


def compact(spark: SparkSession, root: str) -> None:
    """Merge the finished loads into one folder, so that later reads do not merge all history again.
    What it replaces stays for readers that are still in it."""
    loads = _complete(spark, root, "load")
    if not loads or loads[-1] in _complete(spark, root, "base"):
        return
    folder = f"{root}/base={loads[-1]}"
    for name in ("traces", "feedback"):
        read_ingested(spark, root, name).write.mode("overwrite").parquet(f"{folder}/{name}")
    mark_complete(spark, folder)


def daily_series_stream(traces: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Daily query count, accuracy and mean cost over a stream of enriched traces.

    A day is final once the watermark has passed its end, and later rows are dropped;
    ``write_daily_series`` shows every day and takes rows however late.
    """
    return (
        traces.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", "1 day").alias("day"))
        .agg(
            F.count("*").alias("query_count"),
            F.avg(F.col("succeeded").cast("double")).alias("execution_accuracy"),
            mean_cost().alias("avg_cost_usd"),
        )
        .select(F.to_date("day.start").alias("date"), "query_count", "execution_accuracy", "avg_cost_usd")
    )


def write_daily_series(traces: DataFrame, root: str) -> StreamingQuery:
    """Keep the daily series under ``root`` up to date with a stream of enriched traces.

    Every micro-batch writes what it adds to each day, in a folder of its number that
    counts once it is finished; a retry overwrites an unfinished one. The parts of a day are
    added up when read, so a row may come any time later and no state is kept.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        folder = f"{root}/load={batch_id}"
        if not path_exists(batch.sparkSession, f"{folder}/{MARKER}"):
            daily_partials(batch).write.mode("overwrite").parquet(f"{folder}/days")
            mark_complete(batch.sparkSession, folder)

    return (
        traces.writeStream.foreachBatch(add)
        .option("checkpointLocation", f"{root}/_progress").trigger(availableNow=True).start()
    )


def read_daily_series(spark: SparkSession, root: str) -> DataFrame:
    """Every day, over all finished parts."""
    return series_of_partials(spark.read.parquet(*(f"{f}/days" for f in _sources(spark, root))))


def compact_daily_series(spark: SparkSession, root: str) -> None:
    """Add the finished parts up in one folder, so that later reads need not list all of them."""
    loads = _complete(spark, root, "load")
    if loads and loads[-1] not in _complete(spark, root, "base"):
        folder = f"{root}/base={loads[-1]}"
        add_partials(spark.read.parquet(*(f"{f}/days" for f in _sources(spark, root)))).write.mode("overwrite").parquet(f"{folder}/days")
        mark_complete(spark, folder)
