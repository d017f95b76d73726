import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestone.operators import quality, star
from lodestone.operators.star import STAR_TABLES, Warehouse
from lodestone.plans import golden
from lodestone.plans import derived
from lodestone.plans.refresh import build_warehouse, nightly_refresh
from lodestone.session import tune
from lodestone.sources.versions import drop_old_versions, latest_version, mark_complete, next_version

LINES = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity decimal(15,2), "
    "l_extendedprice decimal(15,2), l_discount decimal(15,2), l_tax decimal(15,2), l_returnflag string, "
    "l_linestatus string, l_shipdate date, l_receiptdate date, l_shipmode string"
)
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, o_orderdate date"


def lines(spark, *rows):
    return spark.createDataFrame(list(rows), LINES)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def line(order, number=1, mode="AIR", price="100.00", discount="0.05", shipped=date(1998, 1, 17),
         received=date(1998, 1, 20)):
    return (order, 1, 1, number, Decimal("1.00"), Decimal(price), Decimal(discount), Decimal("0.01"),
            "N", "O", shipped, received, mode)


def order(key, day=date(1998, 1, 15)):
    return (key, 7, "O", "1-URGENT", day)


@pytest.fixture(scope="module")
def small(spark):
    o = orders(spark, order(1), order(2, date(1997, 12, 31)), order(3, date(1998, 4, 1)))
    li = lines(
        spark, line(1), line(1, 2, "TRUCK", shipped=date(1998, 1, 18)), line(2, mode=None, price="0.01"),
        line(2, 2, "AIR", shipped=date(1998, 2, 15)),
    )
    return Warehouse.of({
        "fact_orders": star.build_fact_orders(li, o), "dim_date": star.build_dim_date(o, li),
    })


def test_ship_mode_is_matched_exactly(small):
    assert golden.air_lines(small).first().air_shipped_lines == 2
    assert [tuple(r) for r in golden.lines_by(small).collect()] == [(None, 1), ("AIR", 2), ("TRUCK", 1)]


def test_orders_without_lines_are_not_in_the_fact(small):
    assert golden.order_count(small).first().order_count == 2


def test_net_revenue_is_exact(small):
    assert [r.net_revenue for r in small.fact.orderBy("order_key", "line_number").collect()] == [
        Decimal("95.00"), Decimal("95.00"), Decimal("0.01"), Decimal("95.00")]


def test_date_dimension_spans_orders_and_receipts(small):
    days = small.calendar.agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(days) == (date(1997, 12, 31), date(1998, 4, 1), 92)
    sunday = small.calendar.where("date_key = 19980118").first()
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend, sunday.month_name, sunday.quarter) == (
        0, "Sunday", True, "January", 1)


def test_date_bounds_of_an_empty_side_are_null(spark):
    assert tuple(star.date_bounds(orders(spark, order(1)), lines(spark)).first()) == (None, None)
    assert star.build_dim_date(orders(spark), lines(spark, line(1))).count() == 0


def test_calendar_attributes_equal_the_join_with_the_date_dimension(small):
    for role in ("order", "ship"):
        joined = small.fact.join(small.calendar, F.col(f"{role}_date_key") == F.col("date_key")).drop("date_key")
        computed = small.dated(role).select(*joined.columns)
        assert computed.exceptAll(joined).isEmpty() and joined.exceptAll(computed).isEmpty()


def test_latest_quarter_comes_from_the_fact(small):
    # The newest order date has no lines, so the quarter before it counts.
    assert golden.latest_quarter_revenue(small).first().revenue == Decimal("190.00")


def test_period_is_closed(small):
    assert golden.orders_in_1997(small).first().order_count == 1
    assert golden.revenue_q1_1998(small).first().revenue == Decimal("190.00")


def test_slow_shipments_compare_both_roles(small):
    assert golden.slow_shipments(small).first().line_count == 1


def test_repeated_lines_are_reported(spark):
    o = orders(spark, order(1))
    w = Warehouse.of({"fact_orders": star.build_fact_orders(lines(spark, line(1), line(1), line(1, 2)), o)})
    assert tuple(quality.grain_uniqueness(w).first()) == (3, 2, 1)


def test_orphans_are_counted_by_row(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k bigint")
    parent = spark.createDataFrame([(1,), (3,)], "k bigint")
    assert quality.orphans(child, "k", parent, "k").first().orphan_rows == 2


def test_written_warehouse_equals_the_derived_one(spark, data, warehouse, tmp_path):
    root = str(tmp_path / "warehouse")
    report = {r.table_name: r.row_count for r in build_warehouse(spark, data, root).collect()}
    assert report["dim_region"] == 25 and set(report) == set(STAR_TABLES)
    stored = Warehouse.open(spark, root)
    for name in STAR_TABLES:
        assert stored[name].schema.simpleString() == warehouse[name].schema.simpleString()
        assert stored[name].exceptAll(warehouse[name]).isEmpty()
    for key in ("t2_03", "t2_04", "t2_05", "t2_14", "t2_19"):
        assert golden.GOLDEN[key](stored).collect() == golden.GOLDEN[key](warehouse).collect()


def test_an_unfinished_version_is_not_opened(spark, data, tmp_path):
    root = str(tmp_path / "warehouse")
    build_warehouse(spark, data, root)
    first = latest_version(spark, root)
    spark.range(3).write.parquet(f"{next_version(spark, root)}/fact_orders")
    assert latest_version(spark, root) == first
    build_warehouse(spark, data, root)
    assert latest_version(spark, root).endswith("v3")


def test_only_governed_names_are_visible(spark, warehouse):
    own = spark.newSession()
    assert quality.governed_namespace(own, ("lineitem",))["missing"] == sorted(STAR_TABLES)
    Warehouse.derive(own, "/root/testdata/sf0.001").register_views(own)
    own.range(1).createOrReplaceTempView("lineitem")
    assert quality.governed_namespace(own, ("lineitem", "orders")) == {"missing": [], "exposed": ["lineitem"]}


def test_nightly_refresh_runs_all_stages_and_again(spark, data, tmp_path):
    from lodestone.operators.bm25 import Index
    from lodestone.plans.telemetry import open_table
    from lodestone.sources import eventlog

    log, root = str(tmp_path / "log"), str(tmp_path / "out")
    eventlog.append_events(eventlog.trace_events(derived.log_traces(spark, data)), log)
    documents = derived.corpus(spark, data).select("doc_id", "text")
    for _ in range(2):
        report = nightly_refresh(spark, data, documents, log, root, derived.vectors(spark, data, "doc_id"))
    assert {r.table_name: r.row_count for r in report.collect()}["fact_orders"] == 6000
    indexed = Index.open(spark, f"{root}/index").documents
    assert indexed.count() == 200 and indexed.where("vector IS NOT NULL").count() > 0
    assert open_table(spark, f"{root}/telemetry", "traces").count() == 1000


def test_shuffles_are_sized_by_the_input(spark, data):
    from lodestone import session

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, data, "/no/such/folder") == int(before)
        session.TASK_BYTES, kept = 100_000, session.TASK_BYTES
        assert session.size_shuffles(spark, data) > int(before)
        session.TASK_BYTES = kept
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runs_at_once_get_folders_of_their_own(spark, tmp_path):
    from lodestone import session

    root = str(tmp_path / "t")
    assert next_version(spark, root) != next_version(spark, root)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session.sized_shuffles(spark, root):
        spark.conf.set("spark.sql.shuffle.partitions", "77")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_old_versions_go_and_the_newest_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    for number in range(1, 6):
        folder = next_version(spark, root)
        spark.range(number).write.parquet(f"{folder}/x")
        if number != 4:
            mark_complete(spark, folder)
    assert [f[-2:] for f in drop_old_versions(spark, root, keep=2)] == ["v1", "v2"]
    assert spark.read.parquet(f"{latest_version(spark, root)}/x").count() == 5


def test_a_hot_order_is_split_in_the_build(spark, tmp_path):
    """Most lines on one order, in a few files: the join's plan divides that order's lines."""
    lines = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id")).alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"),
        *(F.lit(1).cast("decimal(15,2)").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        *(F.xxhash64("id", F.lit(c)).alias(c) for c in ("l_partkey", "l_suppkey")),
        *(F.lit("N").alias(c) for c in ("l_returnflag", "l_linestatus")),
        *(F.lit("2024-01-01").alias(c) for c in ("l_shipdate", "l_commitdate", "l_receiptdate")))
    lines.repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(60_000).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit(1).alias("o_totalprice"), F.lit("2024-01-01").alias("o_orderdate"),
        F.lit("O").alias("o_orderstatus"), F.lit("1").alias("o_orderpriority")).write.parquet(f"{tmp_path}/orders.parquet")
    own = spark.newSession()
    tune(own)
    for key, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
                       "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
                       "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                       "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}.items():
        own.conf.set(key, value)
    fact = Warehouse.derive(own, str(tmp_path)).fact
    assert len(fact.collect()) == 60_000
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert "REPARTITION_BY_NUM" not in plan


def test_checks_pass_over_the_fact_once(warehouse):
    from lodestone.operators import metrics

    for check, scans in ((quality.fact_orphans, 2), (metrics.metric_health, 2)):  # the calendar's span is the orphans' second
        plan = check(warehouse)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"Relation \[l_orderkey", plan)) == scans
