"""A table of statements, run under guard and compared by the rows they return.

Each distinct statement is one guarded query; planning is the driver's work, so they start
there, some at a time. Results stay on the cluster: a statement's rows are written under its key, with their
positions, and statements are compared by digests of these rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import guard
from lodestone.operators.evaluation import AT_ONCE, comparable
from lodestone.sources.versions import child_names

# Statements whose outcomes the driver holds before it writes them.
OUTCOMES_HELD = 1000

ROWS = "statement string, position long, answer string"
OUTCOMES = "statement string, error string"


def statement_key(sql: Column) -> Column:
    return F.sha2(sql, 256)


@dataclass(frozen=True)
class Runs:
    """What the statements of a table returned."""

    outcomes: DataFrame  # statement, error (null if it ran), n_rows (up to the cap), truncated
    rows: DataFrame  # statement, position, answer (the row's values by position, as JSON)

    def digests(self) -> DataFrame:
        """(statement, error, n_rows, truncated, bag, sequence): equal bags are equal rows in any order, equal sequences in
        the order the statements gave. A statement that did not run has neither."""
        bits = F.xxhash64("answer").cast("decimal(38,0)")
        placed = F.xxhash64("position", "answer").cast("decimal(38,0)")
        found = self.rows.groupBy("statement").agg(F.sum(bits).alias("b"), F.sum(F.hash("answer").cast("long")).alias("c"), F.sum(placed).alias("s"))
        joined = self.outcomes.join(found, "statement", "left")
        ran = F.col("error").isNull()

        def made(*parts: str) -> Column:
            return F.when(ran, F.concat_ws("-", *(F.coalesce(F.col(p).cast("string"), F.lit("0")) for p in ("n_rows", *parts))))

        return joined.select("statement", "error", "n_rows", "truncated", made("b", "c").alias("bag"), made("s").alias("sequence"))


def _positioned(df: DataFrame) -> DataFrame:
    """The rows of a capped result with their positions; a limit leaves one partition, in order."""
    values = comparable(guard.positional(df), [])
    one = F.struct(*values.columns) if values.columns else F.struct(F.lit(0).alias("none"))
    return values.select(F.to_json(one, {"ignoreNullFields": "false"}).alias("answer")).coalesce(1).select(
        F.monotonically_increasing_id().alias("position"), "answer")


def run_table(spark: SparkSession, statements: DataFrame, root: str, sql_col: str = "sql", max_rows: int = guard.MAX_ROWS,
              timeout_seconds: float = guard.TIMEOUT_SECONDS, at_once: int = AT_ONCE) -> Runs:
    """Run every distinct statement in the guarded session ``spark`` and keep results under ``root``, a fresh folder.

    Null statements are left out. What stops a statement is its error: a refusal, a
    timeout, too many bytes, or the engine's message. A result over the row bound is cut and marked so.
    """

    def execute(key: str, sql: str) -> tuple[str, str | None]:
        def work(stopped: Event) -> None:
            rows = _positioned(guard.within_bytes(guard.plan_guarded(spark, sql, max_rows)))
            if stopped.is_set():
                return
            rows.select(F.lit(key).alias("statement"), "position", "answer").write.mode("overwrite").parquet(f"{root}/rows/{key}")

        try:
            guard.with_timeout(spark, work, timeout_seconds)
        except Exception as error:  # whatever stops a statement is its outcome
            return key, str(error)
        return key, None

    def finished(asked: Iterator) -> Iterator[tuple]:
        running: set[Future] = set()
        with ThreadPoolExecutor(at_once) as pool:
            for row in asked:
                running.add(pool.submit(execute, row["statement"], row["sql"]))
                if len(running) >= 2 * at_once:
                    done, running = wait(running, return_when=FIRST_COMPLETED)
                    yield from (f.result() for f in done)
            yield from (f.result() for f in running)

    def store(some: list[tuple]) -> None:
        spark.createDataFrame(some, OUTCOMES).coalesce(1).write.mode("append").parquet(f"{root}/outcomes")

    distinct = statements.select(F.col(sql_col).alias("sql")).where(F.col("sql").isNotNull()).distinct()
    held: list[tuple] = []
    for outcome in finished(distinct.select(statement_key(F.col("sql")).alias("statement"), "sql").toLocalIterator()):
        held.append(outcome)
        if len(held) >= OUTCOMES_HELD:
            store(held)
            held = []
    store(held)
    ran = child_names(spark, f"{root}/rows")
    empty = spark.createDataFrame([], ROWS)
    rows = spark.read.schema(ROWS).parquet(f"{root}/rows/*") if ran else empty
    made = spark.read.schema(OUTCOMES).parquet(f"{root}/outcomes")
    # rows of a statement that was stopped while it wrote don't count
    rows = rows.join(made.where("error IS NULL").select("statement"), "statement", "left_semi")
    counted = rows.groupBy("statement").agg(F.count("*").alias("n"))
    rows = rows.where(F.col("position") < max_rows)
    cut = F.col("n") > max_rows
    size = F.when(F.col("error").isNull(), F.least(F.coalesce("n", F.lit(0)), F.lit(max_rows)))
    outcomes = made.join(counted, "statement", "left").select(
        "statement", "error", size.cast("long").alias("n_rows"), F.when(F.col("error").isNull(), F.coalesce(cut, F.lit(False))).alias("truncated"))
    return Runs(outcomes, rows)


def matched(attempts: DataFrame, runs: Runs, sql_col: str = "sql", reference_col: str = "reference_sql", ordered: bool = False) -> DataFrame:
    """``attempts`` with ``error``, ``n_rows`` and ``correct``: whether the statement returned the rows of its reference.

    Order counts only if ``ordered``. A result that was cut, on either side, matches nothing; nor does a missing or failed statement.
    """
    side = "sequence" if ordered else "bag"
    results = runs.digests().select("statement", "error", "n_rows", F.when(~F.col("truncated"), F.col(side)).alias("digest"))
    own = results.select(F.col("statement").alias("own_key"), "error", "n_rows", F.col("digest").alias("own_digest"))
    wanted = results.select(F.col("statement").alias("wanted_key"), F.col("digest").alias("wanted_digest"))
    return attempts.join(own, statement_key(F.col(sql_col)) == F.col("own_key"), "left").join(
        wanted, statement_key(F.col(reference_col)) == F.col("wanted_key"), "left").withColumn(
        "correct", F.coalesce(F.col("own_digest") == F.col("wanted_digest"), F.lit(False))).drop(
        "own_key", "wanted_key", "own_digest", "wanted_digest")
