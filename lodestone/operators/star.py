"""The star schema: one fact and five dimensions derived from the raw relations."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.calendar import calendar_columns, date_key, date_of_key
from lodestone.sources.base import optional, read_raw
from lodestone.sources.versions import latest_version

STAR_TABLES = ("fact_orders", "dim_customer", "dim_product", "dim_date", "dim_region", "dim_supplier")

# How the written tables are ordered. An order has one date, so the fact keeps its
# lines together and lets questions about a period skip most files.
LAYOUT_KEYS = {
    "fact_orders": ["order_date_key", "order_key", "line_number"],
    "dim_customer": ["customer_key"],
    "dim_product": ["product_key"],
    "dim_date": ["date_key"],
    "dim_region": ["nation_key"],
    "dim_supplier": ["supplier_key"],
}


def build_dim_region(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("nation_key"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
    )


def build_dim_customer(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        optional(customer, "c_address").alias("address"),
        optional(customer, "c_phone").alias("phone"),
        F.col("c_acctbal").alias("account_balance"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("c_nationkey").alias("nation_key"),
    )


def build_dim_supplier(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.col("s_suppkey").alias("supplier_key"),
        F.col("s_name").alias("supplier_name"),
        optional(supplier, "s_address").alias("address"),
        optional(supplier, "s_phone").alias("phone"),
        F.col("s_acctbal").alias("account_balance"),
        F.col("s_nationkey").alias("nation_key"),
    )


def build_dim_product(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_name").alias("product_name"),
        optional(part, "p_mfgr").alias("manufacturer"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("product_type"),
        F.col("p_size").alias("size"),
        optional(part, "p_container").alias("container"),
        F.col("p_retailprice").alias("retail_price"),
    )


def date_bounds(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """First and last calendar day over order, ship and receipt dates, as one row.

    Both relations go through one aggregate over their union, so nothing is ever
    paired. An empty side leaves both bounds NULL.
    """
    received = "l_receiptdate" if "l_receiptdate" in lineitem.columns else "l_shipdate"
    missing = F.lit(None).cast("date")
    dates = orders.select(
        F.col("o_orderdate").alias("ordered"), missing.alias("shipped"), missing.alias("received")
    ).unionAll(lineitem.select(missing, F.col("l_shipdate"), F.col(received)))
    ends = dates.agg(
        F.min("ordered").alias("o_min"), F.max("ordered").alias("o_max"),
        F.min("shipped").alias("s_min"), F.max("received").alias("r_max"),
    )
    both = F.col("o_min").isNotNull() & F.col("s_min").isNotNull()
    return ends.select(
        F.when(both, F.least("o_min", "s_min")).alias("min_date"),
        F.when(both, F.greatest("o_max", "r_max")).alias("max_date"),
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per calendar day, both ends included; no rows for NULL bounds."""
    days = F.sequence("min_date", "max_date", F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(days).alias("full_date"))


def build_dim_date(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    spine = date_spine(date_bounds(orders, lineitem))
    return spine.select(*(c.alias(name) for name, c in calendar_columns(F.col("full_date")).items()))


def build_fact_orders(lineitem: DataFrame, orders: DataFrame, keep_dates: bool = False) -> DataFrame:
    """Order lines with their order header; ``keep_dates`` adds the dates behind the keys.

    The join is on the order key with one header per key, so adaptive skew
    handling can split a hot order's lines and repeat its single header.
    """
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2).cast("decimal(18,2)")
    dates = [F.col("o_orderdate").alias("order_date"), F.col("l_shipdate").alias("ship_date")]
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("l_partkey").alias("product_key"),
        date_key(F.col("o_orderdate")).alias("order_date_key"),
        date_key(F.col("l_shipdate")).alias("ship_date_key"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        optional(lineitem, "l_shipmode").alias("ship_mode"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("extended_price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        net.alias("net_revenue"),
        *(dates if keep_dates else []),
    )


class Warehouse:
    """The six governed tables, derived from raw files or read from a written warehouse."""

    def __init__(self, plans: dict[str, Callable[[], DataFrame]]):
        """``plans`` make each table on first use, so a query touches only the files it needs."""
        self._plans = plans
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def derive(cls, spark: SparkSession, raw_dir: str) -> Warehouse:
        """Star tables as plans over the raw files; nothing runs until a query does."""
        raw = partial(read_raw, spark, raw_dir)
        return cls({
            "fact_orders": lambda: build_fact_orders(raw("lineitem"), raw("orders")),
            "dated_fact": lambda: build_fact_orders(raw("lineitem"), raw("orders"), keep_dates=True),
            "dim_customer": lambda: build_dim_customer(raw("customer")),
            "dim_product": lambda: build_dim_product(raw("part")),
            "dim_date": lambda: build_dim_date(raw("orders"), raw("lineitem")),
            "dim_region": lambda: build_dim_region(raw("nation"), raw("region")),
            "dim_supplier": lambda: build_dim_supplier(raw("supplier")),
        })

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Warehouse:
        """The newest complete version that the refresh job wrote under ``root``."""
        version = latest_version(spark, root)
        if version is None:
            raise FileNotFoundError(f"no complete warehouse version under {root}")
        return cls({name: partial(spark.read.parquet, f"{version}/{name}") for name in STAR_TABLES})

    @classmethod
    def of(cls, tables: dict[str, DataFrame]) -> Warehouse:
        return cls({name: (lambda df=df: df) for name, df in tables.items()})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._plans[name]()
        return self._tables[name]

    def items(self):
        return [(name, self[name]) for name in STAR_TABLES]

    @property
    def _dated_fact(self) -> DataFrame:
        return self["dated_fact" if "dated_fact" in self._plans else "fact_orders"]

    @property
    def fact(self) -> DataFrame:
        return self["fact_orders"]

    @property
    def customer(self) -> DataFrame:
        return self["dim_customer"]

    @property
    def product(self) -> DataFrame:
        return self["dim_product"]

    @property
    def supplier(self) -> DataFrame:
        return self["dim_supplier"]

    @property
    def region(self) -> DataFrame:
        return self["dim_region"]

    @property
    def calendar(self) -> DataFrame:
        return self["dim_date"]

    def dated(self, role: str, fact: DataFrame | None = None) -> DataFrame:
        """The fact with calendar attributes of its ``order`` or ``ship`` date.

        The date dimension covers every date of the fact by construction and
        holds nothing but functions of the date, so these columns equal the
        inner join with it; rows without a date drop out as they would there.
        """
        fact = self._dated_fact if fact is None else fact
        known = f"{role}_date" in fact.columns
        day = F.col(f"{role}_date") if known else date_of_key(F.col(f"{role}_date_key"))
        return fact.where(day.isNotNull()).select(
            "*", *(c.alias(name) for name, c in calendar_columns(day).items() if name != "date_key")
        )

    def in_period(self, role: str, first: date, last: date) -> DataFrame:
        """Fact rows dated within a closed period. As a plain range over a stored
        column it reaches the scan, where file statistics skip other periods."""
        if f"{role}_date" in self._dated_fact.columns:
            return self._dated_fact.where(F.col(f"{role}_date").between(first, last))
        keys = [d.year * 10000 + d.month * 100 + d.day for d in (first, last)]
        return self._dated_fact.where(F.col(f"{role}_date_key").between(*keys))

    def by_customer(self, fact: DataFrame | None = None, placed: bool = False) -> DataFrame:
        return self._with(self.customer, "customer_key", fact, placed)

    def by_supplier(self, fact: DataFrame | None = None, placed: bool = False) -> DataFrame:
        return self._with(self.supplier, "supplier_key", fact, placed)

    def by_product(self, fact: DataFrame | None = None) -> DataFrame:
        return self._with(self.product, "product_key", fact)

    def _with(self, dim: DataFrame, key: str, fact: DataFrame | None, placed: bool = False) -> DataFrame:
        """The fact joined with a dimension; ``placed`` adds the nation and region of its rows.

        Places meet the dimension first. That is the smaller join, and a filter
        on a place cuts the dimension before the fact is touched.
        """
        if placed:
            dim = dim.join(self.region, "nation_key")
        return (self.fact if fact is None else fact).join(dim, key)

    def register_views(self, spark: SparkSession) -> None:
        """Expose the governed tables, and only those, under their names."""
        for name, df in self.items():
            df.createOrReplaceTempView(name)
