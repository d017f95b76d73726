import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import evaluation as ev
from lodestone.operators import execution, guard
from lodestone.operators.star import Warehouse
from lodestone.sources import golden


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("ranked, relevant, expected", (
    (["a", "b", "c"], ["b"], (1, 0.5)), (["a", "b"], ["a"], (1, 1.0)), (["a", "b"], ["z"], (0, 0.0)),
    ([], ["a"], (0, 0.0)), (["a", "b"], ["a", "b"], (1, 1.0))))
def test_hit_and_reciprocal_rank(spark, ranked, relevant, expected):
    queries = frame(spark, [(1,)], "query_id int")
    rows = frame(spark, [(1, d, i + 1) for i, d in enumerate(ranked)], "query_id int, doc_id string, rank int")
    truth = frame(spark, [(1, d) for d in relevant], "query_id int, doc_id string")
    row = ev.hit_and_reciprocal_rank(queries, rows, truth).first()
    assert (row.hit, row.reciprocal_rank) == expected


def test_methods_by_tier_and_winner(spark):
    queries = frame(spark, [(1, 1), (2, 1), (3, 2)], "query_id int, tier int")
    ranked = "query_id int, doc_id string, rank int"
    methods = {
        "first": frame(spark, [(1, "x", 1), (2, "a", 2), (3, "a", 1)], ranked),
        "second": frame(spark, [(1, "a", 2), (3, "a", 1)], ranked),
        "none": frame(spark, [], ranked),
    }
    truth = frame(spark, [(1, "a"), (2, "a"), (3, "a")], "query_id int, doc_id string")
    results = ev.evaluate_methods(queries, methods, truth)
    got = {(r.method, r.tier): (r.questions, r.hit_rate, r.mrr) for r in results.collect()}
    assert got[("first", "all")] == (3, pytest.approx(2 / 3), 0.5)
    assert got[("second", "1")] == (2, 0.5, 0.25) and got[("none", "2")] == (1, 0.0, 0.0)
    overall = results.where("tier = 'all'")
    assert ev.winner(overall, "hit_rate", "mrr").first().method == "first"  # a tie goes to the earlier


@pytest.mark.parametrize("actual, expected, same", (
    ([(1, "a")], [(1, "a")], True), ([(1, "a"), (2, "b")], [(2, "b"), (1, "a")], True),
    ([(1, "a")], [(2, "a")], False), ([], [], True), ([(1, "a")], [], False),
    ([(1, "a"), (1, "a")], [(1, "a")], False), ([(None, "a")], [(None, "a")], True)))
def test_results_match(spark, actual, expected, same):
    schema = "n bigint, s string"
    assert ev.results_match(frame(spark, actual, schema), frame(spark, expected, schema)) is same


def test_results_match_across_types(spark):
    one = spark.sql("SELECT 1 AS a, DATE'2020-01-02' AS d, 2.50BD AS m")
    other = spark.sql("SELECT 1.0D AS x, '2020-01-02' AS y, 2.5D AS z")
    assert ev.results_match(one, other)
    assert not ev.results_match(one, other.select("x", "y"))
    near = spark.sql("SELECT 1.0D AS x, '2020-01-02' AS y, 2.5000001D AS z")
    assert not ev.results_match(one, near) and ev.results_match(one, near, digits=3)


def test_many_questions_at_once(spark):
    schema = "question_id string, a bigint, b double"
    actual = frame(spark, [("x", 1, 1.0), ("x", 2, 2.0), ("y", 1, 1.0), ("z", 1, 1.0), ("z", 1, 1.0)], schema)
    expected = frame(spark, [("x", 2, 2.0), ("x", 1, 1.0), ("z", 1, 1.0)], schema)
    questions = frame(spark, [(q,) for q in "wxyz"], "question_id string")
    got = {r.question_id: r.correct for r in ev.match_per_question(questions, actual, expected).collect()}
    assert got == {"w": True, "x": True, "y": False, "z": False}


def test_recorded_rows_match_in_order():
    result = guard.QueryResult(["a", "b"], [("x", 1.0), ("y", 2.0)], 2, False)
    assert ev.matches_recorded(result, [["x", 1], ["y", 2]])
    assert not ev.matches_recorded(result, [["y", 2], ["x", 1]])


def test_outcomes_and_summary(spark):
    schema = ("question_id string, tier int, sql string, api_error string, run_error string, matched boolean, "
              "total_tokens bigint")
    scored = ev.outcomes(frame(spark, [
        ("a", 1, "s", None, None, True, 10), ("b", 1, "s", None, None, False, 5),
        ("c", 2, "s", None, None, True, None), ("d", 2, "s", "HTTP 500", None, None, None),
        ("e", 2, "s", None, "Binder Error", None, 1)], schema))
    errors = {r.question_id: r.error for r in scored.collect()}
    assert errors == {"a": None, "b": "result mismatch", "c": None, "d": "API error: HTTP 500", "e": "Binder Error"}
    row = ev.outcome_summary(scored).first()
    assert (row.accuracy, row.tier_1_accuracy, row.tier_3_accuracy) == (0.4, 0.5, 0.0)
    assert (row.total_tokens, row.api_error_count) == (16, 1)


ATTEMPTS = ("question_id string, tier int, attempt_no int, valid boolean, correct boolean, error string, "
            "reason string, api_error string")


def attempts(spark):
    return frame(spark, [
        ("rescued", 1, 1, False, False, "bad", "execution failed", None),
        ("rescued", 1, 2, True, True, None, "fine", None),
        ("regressed", 2, 1, False, True, None, "no rows", None),
        ("regressed", 2, 2, True, False, None, "fine", None),
        ("failed", 3, 1, False, False, "bad", "execution failed", None),
        ("failed", 3, 2, False, False, "worse", "execution failed", None),
        ("failed", 3, 3, True, True, None, "fine", None),
        ("once", 3, 1, True, True, None, "fine", None),
        ("once", 3, 2, True, False, None, "fine", None),
        ("backend", 3, 1, False, False, "down", "SQL generation failed", "down"),
        ("backend", 3, 2, True, True, None, "fine", None),
    ], ATTEMPTS)


def test_stop_rules(spark):
    kept = {}
    for r in ev.kept_attempts(attempts(spark)).collect():
        kept.setdefault(r.question_id, []).append(r.attempt_no)
    assert {q: sorted(n) for q, n in kept.items()} == {
        "rescued": [1, 2], "regressed": [1, 2], "failed": [1, 2], "once": [1], "backend": [1]}


def test_retry_outcomes_and_summary(spark):
    retried = ev.retry_outcomes(ev.kept_attempts(attempts(spark)))
    rows = {r.question_id: r for r in retried.collect()}
    assert rows["rescued"].rescued and not rows["rescued"].regressed
    assert rows["regressed"].regressed and rows["regressed"].final_error is None
    assert (rows["failed"].final_error, rows["failed"].attempt_count) == ("worse", 2)
    assert not rows["once"].retried
    row = ev.retry_summary(retried).first()
    assert (row.retried_count, row.rescued_count, row.regressed_count) == (3, 1, 1)
    assert (row.single_shot_accuracy, row.retry_accuracy, row.lift) == (0.4, 0.4, 0.0)
    assert row.tier_2_single == 1.0 and row.tier_2_retry == 0.0


def test_last_attempt_decides(spark):
    rows = {r.question_id: r for r in ev.final_attempts(ev.kept_attempts(attempts(spark))).collect()}
    assert rows["rescued"].succeeded and not rows["failed"].succeeded
    assert rows["failed"].attempt_no == rows["failed"].attempt_count == 2


def test_feedback_is_the_error_or_the_reason_before(spark):
    rows = {(r.question_id, r.attempt_no): r.feedback for r in ev.attempt_feedback(attempts(spark)).collect()}
    assert rows[("rescued", 1)] is None and rows[("rescued", 2)] == "bad" and rows[("regressed", 2)] == "no rows"


def test_traces_nest_attempts_in_order(spark):
    made = attempts(spark)
    rows = {r.question_id: r for r in ev.assemble_traces(made.unionByName(made)).collect()}
    assert [a.error for a in rows["failed"].attempts] == ["bad", "worse", None]
    assert rows["failed"].final.attempt_no == rows["failed"].attempts[-1].attempt_no == 3
    assert sum(len(r.attempts) for r in rows.values()) == made.count()  # all that was recorded


def test_failure_text_and_usage(spark):
    requests = frame(spark, [("a",), ("b",), ("c",), ("d",)], "query_id string")
    made = frame(spark, [("a", 1, False, "e1", "r1"), ("a", 2, True, None, "fine"), ("b", 1, False, None, "no rows"),
                         ("c", 1, False, "boom", "execution failed")],
                 "query_id string, attempt_no int, valid boolean, error string, reason string")
    texts = {r.query_id: r.error for r in ev.failure_text(made, requests).collect()}
    assert texts == {"a": None, "b": "no rows", "c": "boom", "d": "no attempts made"}
    calls = frame(spark, [("a", 1, None, 3), ("a", 2, 5, 7)],
                  "query_id string, prompt_tokens bigint, completion_tokens bigint, total_tokens bigint")
    totals = {r.query_id: tuple(r)[1:] for r in ev.usage_totals(requests, calls).collect()}
    assert totals["a"] == (3, 5, 10) and totals["b"] == (None, None, None)


def test_ablation_beside_an_earlier_run(spark):
    schema = "tier int, model string, condition string, correct boolean"
    now = ev.ablation(frame(spark, [(3, "m", "on", True), (3, "m", "on", False), (1, "m", "on", False),
                                    (3, "n", "on", True)], schema))
    before = frame(spark, [("m", "on", 0.25)], "model string, condition string, accuracy double")
    rows = {r.model: (r.accuracy, r.earlier_accuracy, r.change) for r in ev.compare_runs(now, before).collect()}
    assert rows == {"m": (0.5, 0.25, 0.25), "n": (1.0, None, None)}


def test_verdicts(spark):
    df = frame(spark, [("x", None, True, "fine"), ("x", "boom", None, None), ("x", None, False, "no rows")],
               "question_id string, error string, plausible boolean, verdict string")
    assert [(r.valid, r.reason) for r in ev.attempt_verdicts(df).collect()] == [
        (True, "fine"), (False, "execution failed"), (False, "no rows")]


def test_golden_file(spark, tmp_path):
    records = [
        {"id": "g1", "tier": 1, "question": "?", "sql": "SELECT 1", "relevant_doc_ids": ["table:a", "metric:b"],
         "reference_result": [["ASIA", 1.5], [None, 2]]},
        {"id": "g2", "tier": 3, "question": "?", "sql": "SELECT 2", "relevant_doc_ids": [], "reference_result": []},
    ]
    path = tmp_path / "golden.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    rows = golden.read_golden(spark, str(path))
    assert {tuple(r) for r in golden.relevant_documents(rows).collect()} == {("g1", "table:a"), ("g1", "metric:b")}
    recorded = golden.reference_rows(rows).orderBy("row_no").collect()
    assert [(r.row_no, r.row) for r in recorded] == [(1, ["ASIA", "1.5"]), (2, [None, "2"])]
    assert rows.select(F.max("tier")).first()[0] == 3


def test_statements_are_run_and_scored(spark, data):
    from lodestone.operators.star import Warehouse

    own = guard.guarded_session(spark)
    Warehouse.derive(own, data).register_views(own)
    questions = [
        {"id": "right", "tier": 1, "sql": "SELECT COUNT(*) AS n FROM dim_region", "reference_result": [[25]]},
        {"id": "wrong", "tier": 1, "sql": "SELECT COUNT(*) AS n FROM dim_region", "reference_result": [[24]]},
        {"id": "any order", "tier": 2, "reference_result": [["EUROPE", 5], ["ASIA", 5]],
         "sql": "SELECT region_name, COUNT(*) AS n FROM dim_region WHERE region_name IN ('ASIA', 'EUROPE') "
                "GROUP BY region_name"},
        {"id": "refused", "tier": 2, "sql": "DROP TABLE dim_region", "reference_result": [[1]]},
        {"id": "broken", "tier": 3, "sql": "SELECT nope FROM dim_region", "reference_result": [[1]]},
        {"id": "unreachable", "tier": 3, "sql": "", "reference_result": [[1]], "api_error": "HTTP 500"},
    ]
    rows = {r.question_id: r for r in ev.outcomes(ev.run_statements(own, questions)).collect()}
    assert [q for q in rows if rows[q].correct] == ["right", "any order"]
    assert rows["wrong"].error == "result mismatch" and rows["refused"].error.startswith("Only SELECT")
    assert "UNRESOLVED_COLUMN" in rows["broken"].error and rows["unreachable"].error == "API error: HTTP 500"


def test_report_tables_are_written(spark, tmp_path):
    from lodestone.sources.reports import write_report

    tables = {"summary": frame(spark, [("a", 0.5)], "name string, accuracy double"),
              "tiers": frame(spark, [(1, 1.0)], "tier int, accuracy double")}
    write_report(tables, str(tmp_path / "r"))
    back = spark.read.option("header", True).csv(str(tmp_path / "r" / "summary"))
    assert [tuple(r) for r in back.collect()] == [("a", "0.5")]
    write_report(tables, str(tmp_path / "p"), "parquet")
    assert spark.read.parquet(str(tmp_path / "p" / "tiers")).first().tier == 1


@pytest.fixture(scope="module")
def runs(spark, data, tmp_path_factory):
    own = guard.guarded_session(spark)
    Warehouse.derive(own, data).register_views(own)
    statements = [
        "SELECT region_name FROM dim_region ORDER BY region_name", "SELECT region_name FROM dim_region ORDER BY region_name DESC",
        "SELECT region_name FROM dim_region WHERE false", "SELECT nation_name FROM dim_region WHERE false", "SELECT 1 AS a, 1 AS a",
        "SELECT order_key FROM fact_orders", "SELECT missing FROM dim_region", "SELECT * FROM parquet.`/x`", "SELECT repeat('x', 2000000000)",
        "SELECT CAST(2 AS DECIMAL(9,2)) AS n", "SELECT 2 AS other", "SELECT NULL AS n", "DROP TABLE x", None,
    ]
    table = own.createDataFrame([(s,) for s in statements * 2], "sql string")
    made = execution.run_table(own, table, str(tmp_path_factory.mktemp("runs") / "out"), max_rows=30, timeout_seconds=300)
    return own, made, {r.statement: r for r in made.outcomes.collect()}


def key(sql):
    return hashlib.sha256(sql.encode()).hexdigest()


def test_statements_of_a_table_run_once_each(runs):
    _, made, outcomes = runs
    assert len(outcomes) == 13 == made.outcomes.count()
    assert outcomes[key("SELECT region_name FROM dim_region ORDER BY region_name")][1:] == (None, 25, False)
    assert outcomes[key("SELECT region_name FROM dim_region WHERE false")][1:] == (None, 0, False)
    assert outcomes[key("SELECT order_key FROM fact_orders")][1:] == (None, 30, True)
    for sql, said in (("SELECT missing FROM dim_region", "missing"), ("SELECT * FROM parquet.`/x`", "Not a governed table"),
                      ("SELECT repeat('x', 2000000000)", "too large"), ("DROP TABLE x", "Only SELECT")):
        assert said in outcomes[key(sql)].error and outcomes[key(sql)].n_rows is None


@pytest.mark.parametrize("sql, reference, bag, sequence", (
    ("SELECT region_name FROM dim_region ORDER BY region_name", "SELECT region_name FROM dim_region ORDER BY region_name DESC", True, False),
    ("SELECT region_name FROM dim_region ORDER BY region_name", "SELECT region_name FROM dim_region ORDER BY region_name", True, True),
    ("SELECT CAST(2 AS DECIMAL(9,2)) AS n", "SELECT 2 AS other", True, True),
    ("SELECT NULL AS n", "SELECT 2 AS other", False, False),
    ("SELECT region_name FROM dim_region WHERE false", "SELECT nation_name FROM dim_region WHERE false", True, True),
    ("SELECT order_key FROM fact_orders", "SELECT order_key FROM fact_orders", False, False),
    ("SELECT missing FROM dim_region", "SELECT missing FROM dim_region", False, False),
    ("never run", "SELECT 2 AS other", False, False),
))
def test_results_are_compared_as_rows(runs, sql, reference, bag, sequence):
    own, made, _ = runs
    attempts = own.createDataFrame([(1, sql, reference)], "question_id int, sql string, reference_sql string")
    assert execution.matched(attempts, made).first().correct is bag
    assert execution.matched(attempts, made, ordered=True).first().correct is sequence


def test_no_statements_no_outcomes(spark, runs, tmp_path):
    own = runs[0]
    made = execution.run_table(own, own.createDataFrame([(None,)], "sql string"), str(tmp_path / "none"))
    assert made.outcomes.count() == 0 and made.digests().count() == 0
