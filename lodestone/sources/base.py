"""Raw relations: the only place where file types become warehouse types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

CASTS = {
    "region": {"r_regionkey": "bigint"},
    "nation": {"n_nationkey": "bigint", "n_regionkey": "bigint"},
    "customer": {"c_custkey": "bigint", "c_nationkey": "bigint", "c_acctbal": MONEY},
    "supplier": {"s_suppkey": "bigint", "s_nationkey": "bigint", "s_acctbal": MONEY},
    "part": {"p_partkey": "bigint", "p_size": "int", "p_retailprice": MONEY},
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": MONEY, "o_orderdate": "date",
    },
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": MONEY, "l_extendedprice": MONEY, "l_discount": MONEY, "l_tax": MONEY,
        "l_shipdate": "date", "l_commitdate": "date", "l_receiptdate": "date",
    },
}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{name}.parquet")


def read_raw(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One raw relation with money as decimal and timestamps as dates, in one projection.

    Money in binary floating point rounds differently from engine to engine, so
    it becomes an exact decimal before anything is computed from it.
    """
    df = read_table(spark, path, name)
    casts = CASTS[name]
    return df.select(
        *(F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns)
    )


def load_base(spark: SparkSession, path: str, tables: tuple[str, ...] = RAW_TABLES) -> dict[str, DataFrame]:
    return {name: read_raw(spark, path, name) for name in tables}


def optional(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """A column that some extracts leave out; absent means a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)
