"""The golden query set over the star: fifty questions, and five more shapes beside them.

Every query is ``Warehouse -> DataFrame``. Dimension tables carry no broadcast
hint: they grow with the data, so Spark decides from their size.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.metrics import average, metric, metric_by
from lodestone.operators.star import Warehouse

# Attributes both roles would bring; only the full date is kept of the first.
CALENDAR = ("year", "quarter", "month", "month_name", "day", "day_of_week", "day_name", "is_weekend")

Query = Callable[[Warehouse], DataFrame]

REVENUE = "revenue"


def _count(name: str) -> Column:
    return F.count("*").alias(name)


def _distinct(column: str, name: str) -> Column:
    return F.count_distinct(column).alias(name)


def _revenue_by(fact: DataFrame, *dims: str) -> DataFrame:
    return fact.groupBy(*dims).agg(F.sum("net_revenue").alias(REVENUE))


def _ranked(fact: DataFrame, dim: str) -> DataFrame:
    """Revenue per value, highest first; the value itself decides ties."""
    return _revenue_by(fact, dim).orderBy(F.desc(REVENUE), dim)


def _total(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("net_revenue").alias(REVENUE))


# --- one table ---------------------------------------------------------------

def order_count(w): return metric(w, "order_count")
def line_count(w): return w.fact.agg(_count("line_count"))
def total_revenue(w): return metric(w, "total_revenue")
def average_order_value(w): return metric(w, "average_order_value")
def average_discount_rate(w): return metric(w, "average_discount_rate")
def average_tax_rate(w): return w.fact.agg(average("tax").alias("average_tax_rate"))
def ordering_customers(w): return w.fact.agg(_distinct("customer_key", "customer_count"))
def ordered_products(w): return w.fact.agg(_distinct("product_key", "product_count"))
def used_suppliers(w): return w.fact.agg(_distinct("supplier_key", "supplier_count"))
def total_quantity(w): return w.fact.agg(F.sum("quantity").alias("total_quantity"))
def open_lines(w): return w.fact.where("order_status = 'O'").agg(_count("open_lines"))
def air_lines(w): return w.fact.where("ship_mode = 'AIR'").agg(_count("air_shipped_lines"))
def max_discount(w): return w.fact.agg(F.max("discount").alias("max_discount"))
def min_price(w): return w.fact.agg(F.min("extended_price").alias("min_extended_price"))
def customers(w): return w.customer.agg(_count("customer_count"))
def products(w): return w.product.agg(_count("product_count"))
def suppliers(w): return w.supplier.agg(_count("supplier_count"))
def nations(w): return w.region.agg(_count("nation_count"))
def segments(w): return w.customer.agg(_distinct("market_segment", "segment_count"))
def average_retail_price(w): return w.product.agg(average("retail_price").alias("average_retail_price"))


# --- fact and dimensions -----------------------------------------------------

def revenue_by_customer_region(w): return _ranked(w.by_customer(placed=True), "region_name")
def revenue_by_supplier_nation(w): return _ranked(w.by_supplier(placed=True), "nation_name")


def orders_in_1997(w):
    placed = w.in_period("order", date(1997, 1, 1), date(1997, 12, 31))
    return placed.agg(_distinct("order_key", "order_count"))


def revenue_q1_1998(w): return _total(w.in_period("order", date(1998, 1, 1), date(1998, 3, 31)))


def weekend_shipments(w):
    return w.dated("ship").where("is_weekend").agg(_count("weekend_shipped_lines"))


def order_value_by_segment(w):
    return metric_by(w, "average_order_value", "market_segment").orderBy(
        F.desc("average_order_value"), "market_segment")


def top_segment(w): return _ranked(w.by_customer(), "market_segment").limit(1)


def automobile_customers(w):
    """Ordering customers are made distinct first, so one row each meets the dimension."""
    ordering = w.fact.select("customer_key").distinct()
    return w.by_customer(ordering).where("market_segment = 'AUTOMOBILE'").agg(_count("customer_count"))


def revenue_by_brand(w): return _ranked(w.by_product(), "brand")
def revenue_by_type(w): return _ranked(w.by_product(), "product_type")


def lines_from_asia(w):
    return w.by_supplier(placed=True).where("region_name = 'ASIA'").agg(_count("line_count"))


def building_discount(w):
    return (w.by_customer().where("market_segment = 'BUILDING'")
            .agg(average("discount").alias("average_discount")))


def orders_from_nation(w, nation: str = "GERMANY"):
    return (w.by_customer(placed=True).where(F.col("nation_name") == nation)
            .agg(_distinct("order_key", "order_count")))


def latest_quarter_revenue(w):
    """Revenue of the newest quarter that has orders in the fact, whatever today is.

    The newest quarter comes from the quarter sums themselves, so the fact is
    read once and no second pass or join looks for it.
    """
    quarters = _revenue_by(w.dated("order"), "year", "quarter")
    return quarters.agg(F.max_by(REVENUE, F.struct("year", "quarter")).alias(REVENUE))


def december_shipments(w): return w.dated("ship").where("month = 12").agg(_count("line_count"))
def monday_revenue(w): return _total(w.dated("order").where("day_name = 'Monday'"))
def top_type(w): return _ranked(w.by_product(), "product_type").limit(1)


def machinery_retail_price(w):
    """Weighted by order lines: a product ordered twice counts twice."""
    machinery = w.by_customer().where("market_segment = 'MACHINERY'")
    return w.by_product(machinery).agg(average("retail_price").alias("average_retail_price"))


def slow_shipments(w):
    """The date dimension in two roles: when ordered and when shipped."""
    both = w.dated("ship", w.dated("order").withColumnRenamed("full_date", "ordered_on").drop(*CALENDAR))
    return both.where(F.datediff("full_date", "ordered_on") > 30).agg(_count("line_count"))


def revenue_by_year(w): return _revenue_by(w.dated("order"), "year").orderBy("year")
def repeat_customer_rate(w): return metric(w, "repeat_customer_rate")


# --- further shapes ----------------------------------------------------------

def open_by_either_status(w):
    return w.fact.agg(
        F.count_if(F.col("order_status") == "O").alias("open_by_order"),
        F.count_if(F.col("line_status") == "O").alias("open_by_line"),
    )


def lines_from_asia_by_membership(w):
    asia = w.region.where("region_name = 'ASIA'")
    suppliers_there = w.supplier.join(asia, "nation_key", "left_semi")
    return w.fact.join(suppliers_there, "supplier_key", "left_semi").agg(_count("line_count"))


def orders_from_nation_by_key(w, nation: str = "GERMANY"):
    """The nation's key comes from a scalar subquery, which fails if two nations match."""
    key = w.region.where(F.col("nation_name") == nation).select("nation_key").scalar()
    there = w.customer.where(F.col("nation_key") == key)
    return w.fact.join(there, "customer_key").agg(_distinct("order_key", "order_count"))


def line_and_order_value(w):
    """The grain trap: the mean line beside the mean order."""
    return w.fact.agg(
        average("net_revenue").alias("average_line_value"),
        (F.sum("net_revenue").cast("double") / F.nullif(F.count_distinct("order_key"), F.lit(0)))
        .alias("average_order_value"),
    )


def lines_from_region_any_case(w, region: str = "Asia"):
    lines = w.by_supplier(placed=True)
    return lines.where(F.upper("region_name") == region.upper()).agg(_count("line_count"))


def lines_by(w, column: str = "ship_mode"):
    return w.fact.groupBy(column).agg(_count("line_count")).orderBy(column)


GOLDEN: dict[str, Query] = {
    "t1_01": order_count, "t1_02": line_count, "t1_03": total_revenue, "t1_04": average_order_value,
    "t1_05": average_discount_rate, "t1_06": average_tax_rate, "t1_07": ordering_customers,
    "t1_08": ordered_products, "t1_09": used_suppliers, "t1_10": total_quantity,
    "t1_11": open_lines, "t1_12": air_lines, "t1_13": max_discount, "t1_14": min_price,
    "t1_15": customers, "t1_16": products, "t1_17": suppliers, "t1_18": nations,
    "t1_19": segments, "t1_20": average_retail_price,
    "t2_01": revenue_by_customer_region, "t2_02": revenue_by_supplier_nation,
    "t2_03": orders_in_1997, "t2_04": revenue_q1_1998, "t2_05": weekend_shipments,
    "t2_06": order_value_by_segment, "t2_07": top_segment, "t2_08": automobile_customers,
    "t2_09": revenue_by_brand, "t2_10": revenue_by_type, "t2_11": lines_from_asia,
    "t2_12": building_discount, "t2_13": orders_from_nation, "t2_14": latest_quarter_revenue,
    "t2_15": december_shipments, "t2_16": monday_revenue, "t2_17": top_type,
    "t2_18": machinery_retail_price, "t2_19": slow_shipments, "t2_20": revenue_by_year,
    "t3_01": repeat_customer_rate, "t3_02": repeat_customer_rate, "t3_03": repeat_customer_rate,
    "t3_04": average_order_value, "t3_05": average_order_value, "t3_06": average_order_value,
    "t3_07": average_discount_rate, "t3_08": average_discount_rate,
    "t3_09": total_revenue, "t3_10": total_revenue,
}

FURTHER: dict[str, Query] = {
    "Q51": open_by_either_status, "Q52": lines_from_asia_by_membership,
    "Q53": orders_from_nation_by_key, "Q54": line_and_order_value,
    "Q55": lines_from_region_any_case,
}
