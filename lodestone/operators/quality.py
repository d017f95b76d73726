"""Warehouse integrity checks. Each returns counts as rows; the caller decides what fails."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.star import STAR_TABLES, Warehouse

PRIMARY_KEYS = {
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_supplier": "supplier_key",
    "dim_region": "nation_key",
    "dim_date": "date_key",
}

FACT_REFERENCES = (
    ("customer_key", "dim_customer", "customer_key"),
    ("supplier_key", "dim_supplier", "supplier_key"),
    ("product_key", "dim_product", "product_key"),
    ("order_date_key", "dim_date", "date_key"),
    ("ship_date_key", "dim_date", "date_key"),
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(w: Warehouse) -> DataFrame:
    return _union([
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in w.items()
    ])


def non_empty(w: Warehouse) -> DataFrame:
    return row_counts(w).select("table_name", (F.col("row_count") > 0).alias("non_empty"))


def key_uniqueness(w: Warehouse) -> DataFrame:
    return _union([
        w[table].agg(F.count("*").alias("row_count"), F.count_distinct(key).alias("distinct_keys"))
        .select(F.lit(table).alias("table_name"), "row_count", "distinct_keys",
                (F.col("row_count") == F.col("distinct_keys")).alias("is_unique"))
        for table, key in PRIMARY_KEYS.items()
    ])


def grain_uniqueness(w: Warehouse) -> DataFrame:
    """How many fact rows share their (order, line) pair; reported, not asserted."""
    per_line = w.fact.groupBy("order_key", "line_number").agg(F.count("*").alias("copies"))
    return per_line.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_lines"),
        F.count_if(F.col("copies") > 1).alias("repeated_lines"),
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key has no parent.

    Keys are counted first, so a key that fills a third of the child reaches the
    join as one row, and the parent is matched once per key.
    """
    keys = child.groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_key).alias("key"))
    return keys.join(parents, "key", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows")
    )


def fact_orphans(w: Warehouse) -> DataFrame:
    """Fact rows without a parent, for each reference, in one pass over the fact.

    Its keys and those of the parents meet in one aggregate by (reference, key), which combines
    before it shuffles. A NULL key has no parent.
    """
    at = [F.struct(F.lit(i).alias("at"), F.col(column).cast("bigint").alias("key"))
          for i, (column, _, _) in enumerate(FACT_REFERENCES)]
    children = w.fact.select(F.explode(F.array(*at)).alias("child")).select("child.*", F.lit(1).alias("n"), F.lit(False).alias("known"))
    uses = {}
    for i, (_, table, key) in enumerate(FACT_REFERENCES):
        uses.setdefault((table, key), []).append(F.lit(i))
    parents = _union([
        w[table].where(F.col(key).isNotNull()).select(
            F.explode(F.array(*by)).alias("at"), F.col(key).cast("bigint").alias("key"), F.lit(0).alias("n"), F.lit(True).alias("known"))
        for (table, key), by in uses.items()
    ])
    met = children.unionByName(parents).groupBy("at", "key").agg(F.sum("n").alias("n"), F.bool_or("known").alias("known"))
    found = met.agg(*(
        F.coalesce(F.sum(F.when((F.col("at") == i) & ~F.col("known"), F.col("n"))), F.lit(0)).alias(column)
        for i, (column, _, _) in enumerate(FACT_REFERENCES)
    ))
    return found.select(F.explode(F.array(*(
        F.struct(F.lit("fact_orders").alias("table_name"), F.lit(column).alias("column_name"), F.col(column).alias("orphan_rows"))
        for column, _, _ in FACT_REFERENCES
    ))).alias("row")).select("row.*")


def nation_orphans(w: Warehouse) -> DataFrame:
    return _union([
        orphans(w[table], "nation_key", w.region, "nation_key").select(
            F.lit(table).alias("table_name"), F.lit("nation_key").alias("column_name"), "orphan_rows")
        for table in ("dim_customer", "dim_supplier")
    ])


def date_contiguity(w: Warehouse) -> DataFrame:
    return w.calendar.agg(
        (F.datediff(F.max("full_date"), F.min("full_date")) + 1).cast("bigint").alias("days_spanned"),
        F.count("*").alias("row_count"),
    ).withColumn("contiguous", F.col("days_spanned") == F.col("row_count"))


def negative_revenue(w: Warehouse) -> DataFrame:
    return w.fact.where("net_revenue < 0").agg(F.count("*").alias("negative_rows"))


def governed_namespace(spark: SparkSession, raw_names: tuple[str, ...]) -> dict[str, list[str]]:
    """Governed names that are missing and raw names that are still visible."""
    visible = {t.name for t in spark.catalog.listTables()}
    return {
        "missing": sorted(set(STAR_TABLES) - visible),
        "exposed": sorted(set(raw_names) & visible),
    }
