import pytest
from pyspark.sql import functions as F

from lodestone.operators.answers import chart_kind, plausibility

RATE = "what is our repeat customer rate"


def verdict(spark, question, rows, schema="value double", strict=False):
    r = plausibility(F.lit(question), spark.createDataFrame(rows, schema), strict).first()
    return r.plausible, r.reason


def test_plausibility(spark):
    assert verdict(spark, "how many", []) == (False, "Query returned no rows.")
    assert verdict(spark, "how much", [(None,)]) == (False, "Query returned only NULL values.")
    assert verdict(spark, "how many", [(42.0,)])[0]
    assert verdict(spark, RATE, [(0.34,)])[0]
    plausible, reason = verdict(spark, RATE, [(0.5,), (34.0,)])
    assert not plausible and "0, 1" in reason
    assert verdict(spark, "what percentage", [("N/A",)], "value string")[0]


def test_plausibility_quirks(spark):
    from decimal import Decimal

    revenue = [(Decimal("100.00"),)]
    assert verdict(spark, "which segment generates most", revenue, "v decimal(10,2)")[0]
    assert not verdict(spark, "which segment generates most", [(100,)], "v bigint")[0]
    assert not verdict(spark, RATE, [(float("nan"),)])[0]
    assert verdict(spark, RATE, [(True,)], "v boolean")[0]
    # strict: whole words, and decimals are checked too
    assert verdict(spark, "which segment generates most", [(100,)], "v bigint", True)[0]
    assert not verdict(spark, RATE, revenue, "v decimal(10,2)", True)[0]


@pytest.mark.parametrize("schema, rows, kind", (
    ("order_count bigint", [(150000,)], "metric"),
    ("orders bigint, revenue double", [(1, 2.0)], "kpi_row"),
    ("a int, b int, c int, d int, e int", [(1, 2, 3, 4, 5)], "table"),
    ("region string, revenue double", [("EUROPE", 1.0), ("ASIA", 2.0)], "bar"),
    ("order_month string, revenue double", [("x", 1.0), ("y", 2.0)], "line"),
    ("period string, revenue double", [("2026-01-01", 1.0), ("2026-02-01", 2.0)], "line"),
    ("period date, n bigint", None, "line"),
    ("n bigint, m bigint", [(1, 2), (3, 4)], "line"),
    ("region string, tier string", [("EUROPE", "high"), ("ASIA", "low")], "table"),
    ("region string, revenue double", [("EUROPE", 1.0), ("ASIA", None)], "table"),
    ("a string, b string, c double", [("x", "y", 1.0), ("z", "w", 2.0)], "table"),
    ("order_count bigint", [], "table"),
))
def test_chart_kind(spark, schema, rows, kind):
    if rows is None:
        from datetime import date

        rows = [(date(2026, 1, 1), 1), (date(2026, 2, 1), 2)]
    assert chart_kind(spark.createDataFrame(rows, schema)) == kind


def test_failed_answer_is_a_table(spark):
    assert chart_kind(spark.createDataFrame([(1,)], "n int"), succeeded=False) == "table"


def test_decimals_count_as_numbers_after_conversion(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1.5BD), ('b', 2.5BD) AS t(name, v)")
    assert chart_kind(df) == "bar"
