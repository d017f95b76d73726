"""Running one untrusted SELECT: read-only, governed tables only, capped, timed."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions.portable import json_safe
from lodestone.functions.statements import rejection
from lodestone.operators.star import STAR_TABLES
from lodestone.session import tune

MAX_ROWS = 1000
TIMEOUT_SECONDS = 10.0
# Stored bytes of the governed tables for which a statement has that time; over more it has as many times more.
TIMEOUT_BYTES = 32 * 1024 * 1024
# Bytes of a result as JSON, and the largest number that a function may make a long value from.
MAX_BYTES = 16 * 1024 * 1024
MAX_GROWTH = 10_000

# Functions a statement may read from besides tables: they make rows out of their arguments.
GENERATORS = {
    "range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack",
}
# Groups of Spark's own functions that only compute a value from their arguments. The group of
# miscellaneous ones (Java calls, file names, users, errors) is none of them, nor is any other function.
FUNCTION_GROUPS = {
    f"{kind}_funcs" for kind in (
        "agg", "array", "bitwise", "collection", "conditional", "conversion", "csv", "datetime", "generator", "hash",
        "json", "lambda", "map", "math", "predicate", "string", "struct", "url", "variant", "window",
    )
}
OTHER_FUNCTIONS = {"typeof"}
# Functions that make one long value from a number, and which argument that is.
GROWING = {"repeat": 1, "space": 0, "lpad": 1, "rpad": 1, "array_repeat": 1, "sequence": 1}
# Nodes of a parsed SELECT. Any other, such as a name made from a string or a command, is refused.
PLAN_NODES = {
    "Aggregate", "Distinct", "Except", "Filter", "Generate", "GlobalLimit", "Intersect", "Join", "LateralJoin",
    "LocalLimit", "LocalRelation", "Offset", "OneRowRelation", "PipeOperator", "Pivot", "Project", "Sample", "Sort",
    "SubqueryAlias", "Union", "UnresolvedHaving", "UnresolvedHint", "UnresolvedInlineTable", "UnresolvedRelation",
    "UnresolvedSubqueryColumnAliases", "UnresolvedTVFAliases", "UnresolvedTableValuedFunction", "UnresolvedWith",
    "Unpivot", "WithWindowDefinition",
}
# Unresolved expressions of a parsed SELECT; resolved ones come from the syntax itself.
UNRESOLVED = {
    "MultiAlias", "UnresolvedAlias", "UnresolvedAttribute", "UnresolvedExtractValue", "UnresolvedFunction",
    "UnresolvedGenerator", "UnresolvedOrdinal", "UnresolvedRegex", "UnresolvedStar", "UnresolvedStarExceptOrReplace",
    "UnresolvedWindowExpression",
}
# Leaves of an analysed plan that read nothing.
MADE_LEAVES = {"CTERelationRef", "LocalRelation", "OneRowRelation", "Range"}


class GuardrailViolation(Exception):
    """The statement may not run."""


class QueryTimeout(Exception):
    """The statement ran too long."""


@dataclass(frozen=True)
class QueryResult:
    columns: list[str]
    rows: list[tuple]
    row_count: int
    truncated: bool


def classify(statements: DataFrame, column: str = "sql") -> DataFrame:
    """A table of statements with ``allowed`` and, where refused, the ``rejection``."""
    return statements.withColumn("rejection", rejection(F.col(column))).withColumn(
        "allowed", F.col("rejection").isNull()
    )


def check_select_only(sql: str) -> None:
    """One statement typed by a user, under the same rules as the batch form."""
    spark = SparkSession.active()
    reason = spark.range(1).select(rejection(F.lit(sql)).alias("reason")).first().reason
    if reason:
        raise GuardrailViolation(reason)


def _kind(node) -> str:
    return node.getClass().getName().rsplit(".", 1)[1].rstrip("$")


def _each(*sequences) -> Iterator:
    for sequence in sequences:
        yield from (sequence.apply(i) for i in range(sequence.size()))


def _plans(plan) -> Iterator:
    """The nodes of a plan with those of its WITH parts and of the subqueries in its expressions."""
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node
        todo += _each(node.children(), node.subqueries())
        if _kind(node) == "UnresolvedWith":
            todo += _each(node.innerChildren())


def _expressions(plan) -> Iterator:
    todo = list(_each(plan.expressions()))
    while todo:
        node = todo.pop()
        yield node
        todo += _each(node.children())


def _check_growth(node, name: str) -> None:
    """A function that makes a long value from a number: the number is a literal and small, and no other such function is inside."""
    arguments = list(_each(node.children()))
    count = arguments[GROWING[name]] if len(arguments) > GROWING[name] else None
    value = str(count.value()) if count is not None and _kind(count) == "Literal" else ""
    small = value.isdigit() and int(value) <= MAX_GROWTH
    inside = [n for a in arguments for n in _below(a) if _kind(n) == "UnresolvedFunction" and ".".join(_each(n.nameParts())).lower() in GROWING]
    if not small or inside:
        raise GuardrailViolation(f"May make too large a value: {name}")


def _below(node) -> Iterator:
    todo = [node]
    while todo:
        node = todo.pop()
        yield node
        todo += _each(node.children())


def _check_expression(spark: SparkSession, node) -> None:
    """Only syntax, names of columns, and Spark's own functions of the allowed groups."""
    kind = _kind(node)
    if not node.getClass().getName().startswith("org.apache.spark.sql.catalyst.expressions.") and kind not in UNRESOLVED:
        raise GuardrailViolation(f"Not an allowed expression: {kind}")
    if kind == "UnresolvedFunction":
        name = ".".join(_each(node.nameParts())).lower()
    elif kind == "UnresolvedGenerator":
        name = node.name().unquotedString().lower()
    else:
        return
    if name in GROWING:
        _check_growth(node, name)
    catalyst = spark._jvm.org.apache.spark.sql.catalyst
    found = catalyst.analysis.FunctionRegistry.builtin().lookupFunction(catalyst.FunctionIdentifier(name))
    group = found.get().getGroup() if found.isDefined() else ""
    if group not in FUNCTION_GROUPS and name not in OTHER_FUNCTIONS:
        raise GuardrailViolation(f"Not an allowed function: {name}")


def check_governed(spark: SparkSession, sql: str, governed: tuple[str, ...] = STAR_TABLES) -> None:
    """Refuse any relation but the governed ones and any function but the allowed
    ones, wherever in the statement it stands.

    Spark's own parser makes the tree, which is walked node by node; nodes and
    functions not listed are refused. A WITH name is allowed only if no table or
    view has it, because inside its own definition it means that table.
    """
    names, local = set(), set()
    for node in _plans(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)):
        kind = _kind(node)
        if kind not in PLAN_NODES:
            raise GuardrailViolation(f"Only governed tables may be read, not {kind}.")
        if kind == "UnresolvedRelation":
            names.add(tuple(_each(node.multipartIdentifier())))
        elif kind == "UnresolvedWith":
            local |= {part._1() for part in _each(node.cteRelations())}
        elif kind == "UnresolvedTableValuedFunction":
            name = ".".join(_each(node.name())).lower()
            if name not in GENERATORS:
                raise GuardrailViolation(f"Not an allowed function: {name}")
        for expression in _expressions(node):
            _check_expression(spark, expression)
    allowed = {g.lower() for g in governed}
    for parts in sorted(names):
        name = ".".join(parts)
        if len(parts) == 1 and (name.lower() in allowed or (
                name in local and not spark.catalog.tableExists("`" + name.replace("`", "``") + "`"))):
            continue
        raise GuardrailViolation(f"Not a governed table: {name}")


def check_sources(spark: SparkSession, df: DataFrame, governed: tuple[str, ...] = STAR_TABLES) -> None:
    """A second line behind the names: what the analysed statement reads is what the governed views read."""
    def leaves(frame: DataFrame) -> list:
        plan = frame._jdf.queryExecution().analyzed()
        return [n for n in _plans(plan) if n.children().isEmpty() and _kind(n) not in MADE_LEAVES]

    asked = leaves(df)
    given = [n for name in governed if spark.catalog.tableExists(name) for n in leaves(spark.table(name))] if asked else []
    if not all(any(leaf.sameResult(known) for known in given) for leaf in asked):
        raise GuardrailViolation("Only governed tables may be read.")


def capped(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` and one more, whose presence tells that there were more."""
    return df.limit(max_rows + 1)


def positional(df: DataFrame) -> DataFrame:
    """The columns under names of their positions."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def within_bytes(df: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """A capped result that fails instead of returning more than ``max_bytes``, counted as JSON over its rows so far."""
    if not df.columns:
        return df
    named = positional(df)
    row = F.struct(*named.columns)
    sized = named.select(
        row.alias("r"), F.octet_length(F.to_json(row)).cast("long").alias("size"), F.monotonically_increasing_id().alias("at"))
    upto = F.sum("size").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))  # no more rows than the cap
    checked = F.when(upto <= max_bytes, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"Result exceeded {max_bytes} bytes.")).cast("boolean"))
    return sized.withColumn("fits", checked).where("fits").select("r.*").toDF(*df.columns)


def plan_guarded(spark: SparkSession, sql: str, max_rows: int = MAX_ROWS) -> DataFrame:
    """The checked and capped statement as a DataFrame."""
    body = re.sub(";+$", "", sql.strip())
    check_select_only(sql)
    check_governed(spark, body)
    df = spark.sql(body)
    check_sources(spark, df)
    return capped(df, max_rows)


def run_guarded(
    spark: SparkSession, sql: str, max_rows: int = MAX_ROWS, timeout_seconds: float = TIMEOUT_SECONDS,
    portable: bool = True,
) -> QueryResult:
    """Run a guarded statement. After the timeout its jobs are cancelled and the
    caller gets control back at once; the session stays usable. Engine errors
    reach the caller unchanged. Values come as JSON takes them, or with
    ``portable`` off as they are, for checks that depend on their types."""
    def work(stopped: threading.Event) -> tuple[list[str], list[tuple]]:
        planned = plan_guarded(spark, sql, max_rows)
        df = positional(within_bytes(planned))  # names may repeat
        df = json_safe(df) if portable else df
        return planned.columns, [] if stopped.is_set() else [tuple(r) for r in df.collect()]

    columns, rows = with_timeout(spark, work, timeout_seconds)
    return QueryResult(columns, rows[:max_rows], min(len(rows), max_rows), len(rows) > max_rows)


def allowed_seconds(governed_bytes: int) -> float:
    """How long a statement may run over governed tables of this size."""
    return TIMEOUT_SECONDS * max(1.0, governed_bytes / TIMEOUT_BYTES)


def with_timeout(spark: SparkSession, work: Callable[[threading.Event], Any], timeout_seconds: float) -> Any:
    """What ``work`` returns or raises. After the timeout its jobs are cancelled, also those that planning has yet to
    start, and the event it was given is set."""
    context = spark.sparkContext
    group = f"guarded-{uuid.uuid4()}"
    outcome: dict = {}
    done, stopped = threading.Event(), threading.Event()

    def run() -> None:
        try:
            context.setJobGroup(group, "guarded query", interruptOnCancel=True)
            outcome["result"] = work(stopped)
        except Exception as error:  # handed to the caller below
            outcome["error"] = error
        finally:
            done.set()

    InheritableThread(target=run, daemon=True).start()
    if not done.wait(timeout_seconds):
        stopped.set()
        context._jsc.sc().cancelJobGroupAndFutureJobs(group)
        raise QueryTimeout(f"Query exceeded {timeout_seconds}s and was cancelled.")
    if "error" in outcome:
        raise outcome["error"]
    return outcome["result"]


def guarded_session(spark: SparkSession) -> SparkSession:
    """A session of its own for guarded queries, where unbounded products do not plan."""
    own = tune(spark.newSession())
    own.conf.set("spark.sql.crossJoin.enabled", "false")
    return own
