import time
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lodestone.functions.statements import sql_of_reply
from lodestone.operators import guard
from lodestone.operators.star import Warehouse

ALLOWED = (
    "SELECT * FROM t", "select * from t", "   SELECT 1  ", "WITH x AS (SELECT 1 AS a) SELECT * FROM x",
    "SELECT 1;", "SELECT dropped, offset_x FROM t",
)
REFUSED = {
    "": "Empty query.",
    " ;; ": "Empty query.",
    "DROP TABLE t": "Only SELECT (or WITH ... SELECT) statements are allowed.",
    "EXPLAIN SELECT 1": "Only SELECT (or WITH ... SELECT) statements are allowed.",
    "SELECT 1; DROP TABLE t": "Multiple statements are not allowed.",
    "SELECT 1; SELECT 2": "Multiple statements are not allowed.",
    "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x": "Disallowed keyword in query: INSERT",
    "SELECT 'set' FROM t": "Disallowed keyword in query: set",
    "selection": "Only SELECT (or WITH ... SELECT) statements are allowed.",
}
WRITES = ("INSERT", "UPDATE", "DELETE", "DROP", "ALTER", "CREATE", "ATTACH", "PRAGMA", "CALL")


@pytest.fixture(scope="module")
def own(spark, data):
    session = guard.guarded_session(spark)
    Warehouse.derive(session, data).register_views(session)
    session.range(5).createOrReplaceTempView("raw_orders")
    return session


def test_statements_are_classified_in_bulk(spark):
    texts = [(s,) for s in (*ALLOWED, *REFUSED)]
    rows = guard.classify(spark.createDataFrame(texts, "sql string")).collect()
    assert {r.sql: r.rejection for r in rows} == {**dict.fromkeys(ALLOWED), **REFUSED}
    assert {r.sql for r in rows if r.allowed} == set(ALLOWED)


def test_null_statement_is_empty(spark):
    assert guard.classify(spark.createDataFrame([(None,)], "sql string")).first().rejection == "Empty query."


@pytest.mark.parametrize("word", WRITES)
def test_writes_are_refused(spark, word):
    for text in (f"{word} something", f"SELECT 1 AS {word.lower()}"):
        with pytest.raises(guard.GuardrailViolation):
            guard.check_select_only(text)


@pytest.mark.parametrize("reply", (
    "```sql\nSELECT 1\n```", "```sql\nSELECT 1", "```\nSELECT 1\n```", "SELECT 1", "SELECT 1;",
    "  ```SQL\n SELECT 1;\n```  ", "\u3000SELECT 1\xa0\x1c",
))
def test_sql_is_taken_out_of_a_reply(spark, reply):
    assert spark.range(1).select(sql_of_reply(F.lit(reply)).alias("s")).first().s == "SELECT 1"


def test_rows_are_capped(own):
    result = guard.run_guarded(own, "SELECT * FROM fact_orders", max_rows=5)
    assert (len(result.rows), result.row_count, result.truncated) == (5, 5, True)
    small = guard.run_guarded(own, "SELECT * FROM dim_region -- all of them")
    assert (small.row_count, small.truncated) == (25, False)
    exact = guard.run_guarded(own, "SELECT * FROM dim_region", max_rows=25)
    assert (exact.row_count, exact.truncated) == (25, False)


def test_values_are_json_safe(own):
    row = guard.run_guarded(own, "SELECT net_revenue, DATE'2020-01-02' AS d FROM fact_orders LIMIT 1").rows[0]
    assert isinstance(row[0], float) and row[1] == "2020-01-02"


@pytest.mark.parametrize("sql", (
    "SELECT * FROM raw_orders",
    "SELECT * FROM dim_region WHERE nation_key IN (SELECT id FROM raw_orders)",
    "SELECT (SELECT MAX(id) FROM raw_orders) AS m FROM dim_region",
    "WITH raw_orders AS (SELECT * FROM raw_orders) SELECT * FROM raw_orders",
    "SELECT * FROM parquet.`/root/testdata/sf0.001/orders.parquet`",
    "SELECT * FROM sql_keywords()",
    "SELECT reflect('java.lang.System', 'lineSeparator') AS r FROM dim_region",
    "SELECT nation_key FROM dim_region WHERE java_method('java.lang.Math', 'abs', 1) = 1",
    "WITH a AS (SELECT Try_Reflect('java.lang.System', 'lineSeparator') AS r) SELECT * FROM a",
    "SELECT * FROM default.dim_region",
    "SELECT COUNT(*) FROM IDENTIFIER('raw_customer')",
    "SELECT COUNT(*) FROM IDENTIFIER('raw_' || 'customer')",
    "SELECT COUNT(*) FROM identifier /* x */ ('parquet.`/root/testdata/sf0.001/orders.parquet`')",
    "SELECT IDENTIFIER('reflect')('java.lang.Math','abs',-1)",
    "SELECT * FROM dim_region LATERAL VIEW java_method('java.lang.Math', 'abs', 1) t AS z",
    "SELECT input_file_name() AS f FROM dim_region",
    "SELECT system.builtin.reflect('java.lang.Math','abs',-1) FROM dim_region",
    "SELECT nation_key, SUM(nation_key) OVER (ORDER BY version()) AS s FROM dim_region",
    "SELECT * FROM (FROM raw_orders |> SELECT id)",
    f"SELECT {', '.join(f'nation_key AS c{i}' for i in range(30))}, reflect('java.lang.Math','abs',-1) FROM dim_region",
    f"SELECT * FROM dim_region WHERE nation_key IN ({', '.join(map(str, range(40)))}, `reflect`('java.lang.Math','abs',-1))",
))
def test_only_governed_tables_are_read(own, sql):
    with pytest.raises(guard.GuardrailViolation):
        guard.run_guarded(own, sql)


@pytest.mark.parametrize("sql", (
    "SELECT 'identifier(' AS a, COUNT(DISTINCT nation_key) FILTER (WHERE nation_key > 1) AS n FROM dim_region",
    "SELECT EXTRACT(YEAR FROM DATE'2020-01-02') AS y, typeof(nation_key) AS t, upper(trim(region_name)) AS u FROM dim_region",
    "SELECT region_name || 'x' AS r, CASE WHEN nation_key BETWEEN 1 AND 3 THEN 1 END AS c FROM dim_region WHERE region_name LIKE 'A%'",
    "SELECT * FROM (SELECT region_name, nation_key FROM dim_region) PIVOT (COUNT(*) FOR region_name IN ('ASIA' AS a))",
    "SELECT /*+ BROADCAST(r) */ r.nation_key, x FROM dim_region r LATERAL VIEW explode(array(1, 2)) t AS x",
    "SELECT ROW_NUMBER() OVER w AS n FROM dim_region WINDOW w AS (ORDER BY nation_key) ORDER BY ALL LIMIT 3 OFFSET 1",
    "SELECT * FROM dim_region WHERE EXISTS (SELECT 1 FROM fact_orders f WHERE f.customer_key = nation_key) "
    "INTERSECT SELECT * FROM dim_region",
    "SELECT a.nation_key, (SELECT MAX(b.nation_key) FROM dim_region b) AS m FROM dim_region a GROUP BY ALL HAVING COUNT(*) > 0",
))
def test_ordinary_statements_run(own, sql):
    assert guard.run_guarded(own, sql).columns


def test_sources_of_the_analysed_statement_are_those_of_governed_views(own, data):
    guard.check_sources(own, own.sql("SELECT * FROM dim_region WHERE nation_key = (SELECT MAX(nation_key) FROM dim_region)"))
    own.read.parquet(f"{data}/documents.parquet").createOrReplaceTempView("texts")
    for sql in ("SELECT doc_id FROM texts", "SELECT * FROM dim_region WHERE nation_key IN (SELECT doc_id FROM texts)"):
        with pytest.raises(guard.GuardrailViolation):
            guard.check_sources(own, own.sql(sql))


def test_raw_values_can_be_had_for_checks(own):
    result = guard.run_guarded(own, "SELECT SUM(net_revenue) AS share FROM fact_orders", portable=False)
    assert isinstance(result.rows[0][0], Decimal)


def test_rows_may_be_made_from_arguments(own):
    assert guard.run_guarded(own, "SELECT SUM(id) AS s FROM range(5)").rows == [(10,)]
    assert guard.run_guarded(own, "SELECT * FROM VALUES (1), (2) AS t(a)").row_count == 2


def test_with_names_are_local(own):
    sql = "WITH a AS (SELECT * FROM dim_region), b AS (SELECT * FROM a) SELECT COUNT(*) AS n FROM b"
    assert guard.run_guarded(own, sql).rows == [(25,)]


def test_engine_errors_reach_the_caller(own):
    with pytest.raises(AnalysisException):
        guard.run_guarded(own, "SELECT no_such_column FROM dim_region")


def test_cross_product_does_not_plan(own):
    with pytest.raises(AnalysisException, match="cartesian|cross|CROSS"):
        guard.run_guarded(own, "SELECT COUNT(*) AS n FROM fact_orders a, fact_orders b")


def test_timeout_returns_control_and_keeps_the_session(own):
    slow = ("SELECT SUM(a.quantity * b.quantity) AS s FROM fact_orders a JOIN fact_orders b "
            "ON a.return_flag = b.return_flag JOIN fact_orders c ON b.return_flag = c.return_flag")
    started = time.time()
    with pytest.raises(guard.QueryTimeout, match="Query exceeded 1.0s and was cancelled."):
        guard.run_guarded(own, slow, timeout_seconds=1.0)
    assert time.time() - started < 5
    assert guard.run_guarded(own, "SELECT COUNT(*) AS n FROM dim_region").rows == [(25,)]


def test_timeout_while_planning_leaves_no_job(own):
    slow = ("SELECT SUM(a.quantity * b.quantity) AS s FROM fact_orders a JOIN fact_orders b "
            "ON a.return_flag = b.return_flag JOIN fact_orders c ON b.return_flag = c.return_flag")
    with pytest.raises(guard.QueryTimeout):
        guard.run_guarded(own, slow, timeout_seconds=0.05)
    time.sleep(4)
    assert not own.sparkContext.statusTracker().getActiveJobsIds()


@pytest.mark.parametrize("sql", (
    "SELECT repeat('x', 2000000000)", "SELECT space(20000000)", "SELECT repeat(repeat('x', 9000), 9000)", "SELECT lpad('x', 1000000000, 'y')",
    "SELECT array_repeat('x', size(sequence(1, 9)))", "SELECT explode(sequence(1, 1000000000))", "SELECT rpad('x', 10 * 1000000, 'y')",
))
def test_values_that_grow_without_bound_are_refused(own, sql):
    with pytest.raises(guard.GuardrailViolation, match="too large"):
        guard.run_guarded(own, sql)


def test_results_have_a_byte_budget(own):
    small = guard.run_guarded(own, "SELECT repeat('x', 9000) AS x FROM range(100)", timeout_seconds=120)
    assert small.row_count == 100 and len(small.rows[0][0]) == 9000
    doubled = "SELECT concat(x, x, x, x) AS x FROM (SELECT repeat('x', 10000) AS x FROM range(600))"
    with pytest.raises(Exception, match="exceeded 16777216 bytes"):
        guard.run_guarded(own, doubled, timeout_seconds=120)
    assert guard.run_guarded(own, "SELECT 1 AS a, 2 AS a", timeout_seconds=120).rows == [(1, 2)]


def test_time_limit_grows_with_the_governed_tables(spark, data, monkeypatch):
    """A statement over all lines takes longer over more of them; a limit that stays stops it."""
    from lodestone.plans.registry import all_queries

    assert guard.allowed_seconds(0) == guard.allowed_seconds(guard.TIMEOUT_BYTES) == guard.TIMEOUT_SECONDS
    assert guard.allowed_seconds(60 * guard.TIMEOUT_BYTES) == 60 * guard.TIMEOUT_SECONDS
    given, run = [], guard.run_guarded
    monkeypatch.setattr(guard, "TIMEOUT_BYTES", 1000)
    monkeypatch.setattr(guard, "run_guarded", lambda *a, **k: given.append(k) or run(*a, **k))
    assert all_queries()["G5_guarded_query"](spark, data).count() > 0
    assert given[0]["timeout_seconds"] > 10 * guard.TIMEOUT_SECONDS
