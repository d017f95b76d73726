"""Named business metrics, each usable as one value or broken down by dimension columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.star import Warehouse


def ratio(total: Column, count: Column) -> Column:
    """Decimal averages keep few digits in Spark, so ratios are taken in double."""
    return total.cast("double") / F.nullif(count, F.lit(0))


def average(name: str) -> Column:
    return ratio(F.sum(name), F.count(name))


@dataclass(frozen=True)
class Metric:
    """An aggregate over fact columns; its SQL form is in the semantic layer."""

    name: str
    value: Column | None = None

    def aggregate(self, fact: DataFrame, dims: tuple[str, ...] = ()) -> DataFrame:
        return fact.groupBy(*dims).agg(self.value.alias(self.name))


class RepeatCustomerRate(Metric):
    """Share of ordering customers with two or more distinct orders."""

    def aggregate(self, fact: DataFrame, dims: tuple[str, ...] = ()) -> DataFrame:
        known = fact.where(F.col("customer_key").isNotNull())
        per_customer = known.groupBy(*dims, "customer_key").agg(
            F.count_distinct("order_key").alias("orders")
        )
        repeat = F.count_if(F.col("orders") >= 2)
        return per_customer.groupBy(*dims).agg(ratio(repeat, F.count("*")).alias(self.name))


def metrics() -> dict[str, Metric]:
    """The registry. Built on call because column expressions need an active session."""
    defined = [
        Metric("total_revenue", F.sum("net_revenue")),
        Metric("order_count", F.count_distinct("order_key")),
        Metric("average_order_value", ratio(F.sum("net_revenue"), F.count_distinct("order_key"))),
        RepeatCustomerRate("repeat_customer_rate"),
        Metric("average_discount_rate", average("discount")),
    ]
    return {m.name: m for m in defined}


def metric(w: Warehouse, name: str) -> DataFrame:
    return metrics()[name].aggregate(w.fact)


def metric_by(w: Warehouse, name: str, *dims: str, role: str = "order") -> DataFrame:
    """The metric per combination of dimension columns, joining only the tables they need."""
    fact = w.fact
    wanted = set(dims) - set(fact.columns)
    customer, place = set(w.customer.columns), set(w.region.columns)
    if wanted & (customer | place):
        # "Region" of a sale means where its customer is.
        placed = bool(wanted & (place - customer))
        fact = w.by_customer(fact, placed)
        wanted -= customer | (place if placed else set())
    if wanted & set(w.product.columns):
        fact = w.by_product(fact)
        wanted -= set(w.product.columns)
    if wanted & set(w.supplier.columns):
        fact = w.by_supplier(fact)
        wanted -= set(w.supplier.columns)
    if wanted:
        fact = w.dated(role, fact)
    return metrics()[name].aggregate(fact, dims)


def metric_values(w: Warehouse) -> DataFrame:
    """One row with every metric: those that are plain aggregates in one pass over the fact, and a pass for each other."""
    plain = {name: m for name, m in metrics().items() if m.value is not None}
    others = {name: m.aggregate(w.fact).scalar() for name, m in metrics().items() if name not in plain}
    row = w.fact.agg(*(m.value.alias(name) for name, m in plain.items()))
    return row.withColumns(others).select(*metrics())


def metric_health(w: Warehouse) -> DataFrame:
    """Every metric with its value; a metric without a value shows as not healthy."""
    rows = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in metrics()))
    return metric_values(w).select(F.explode(rows).alias("row")).select(
        "row.*", F.col("row.value").isNotNull().alias("healthy"))
