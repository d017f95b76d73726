"""Result tables of an evaluation, as files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(tables: dict[str, DataFrame], folder: str, file_format: str = "csv") -> None:
    """Each table in a folder of its own name, as CSV with a header, JSON lines or Parquet."""
    for name, df in tables.items():
        df.write.format(file_format).option("header", True).mode("overwrite").save(f"{folder}/{name}")
