"""Batch jobs: build the warehouse, and the nightly run of all three stages."""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from lodestone.operators.bm25 import build_index
from lodestone.operators.quality import row_counts
from lodestone.operators.star import LAYOUT_KEYS, STAR_TABLES, Warehouse
from lodestone.plans.telemetry import drop_old_loads, run_telemetry
from lodestone.session import build_session, sized_shuffles, tune
from lodestone.sources.base import RAW_TABLES, read_table
from lodestone.sources.versions import drop_old_versions, mark_complete, next_version


def write_clustered(df: DataFrame, path: str, keys: list[str]) -> None:
    """Files ordered by key, so that row-group statistics can skip most of them.

    Range partitioning takes the whole key list: one order with very many lines
    spreads over several files instead of filling one.
    """
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def build_warehouse(spark: SparkSession, raw_dir: str, root: str) -> DataFrame:
    """Write a new complete version of the star and report its row counts.

    A rerun writes another version; a failed run leaves one without its marker,
    which no reader opens.
    """
    folder = next_version(spark, root)
    star = Warehouse.derive(spark, raw_dir)
    with ThreadPoolExecutor(len(STAR_TABLES)) as pool:  # the dimensions fill cores the fact leaves idle
        list(pool.map(
            lambda item: write_clustered(item[1], f"{folder}/{item[0]}", LAYOUT_KEYS[item[0]]), star.items()))
    mark_complete(spark, folder)
    return row_counts(Warehouse.open(spark, root))


def nightly_refresh(
    spark: SparkSession, raw_dir: str, documents: DataFrame, log_dir: str, root: str, vectors: DataFrame | None = None
) -> DataFrame:
    """Warehouse, then retrieval index, then telemetry tables; returns the warehouse report.

    ``vectors`` (doc_id, vector) go into the index beside the words; without them
    hybrid search ranks by words alone.
    """
    with sized_shuffles(tune(spark), *(f"{raw_dir.rstrip('/')}/{name}.parquet" for name in RAW_TABLES)):
        report = build_warehouse(spark, raw_dir, f"{root}/warehouse")
    with sized_shuffles(spark, f"{raw_dir.rstrip('/')}/documents.parquet"):
        build_index(documents, vectors, laid_out=False).write(f"{root}/index")
    with sized_shuffles(spark, log_dir):
        run_telemetry(spark, log_dir, f"{root}/telemetry")
    for stage in ("warehouse", "index"):
        drop_old_versions(spark, f"{root}/{stage}")
    drop_old_loads(spark, f"{root}/telemetry")
    return report


def main() -> None:
    """``spark-submit`` entry: all stages in order, reporting the row counts."""
    parser = argparse.ArgumentParser(description=main.__doc__)
    parser.add_argument("--raw", required=True, help="folder of the raw tables, documents included")
    parser.add_argument("--vectors", help="Parquet of (vec_id, embedding), one vector a document id")
    parser.add_argument("--log", required=True, help="folder of the query log")
    parser.add_argument("--out", required=True, help="folder for warehouse, index and telemetry")
    given = parser.parse_args()
    spark = build_session("nightly-refresh")
    documents = read_table(spark, given.raw, "documents").select("doc_id", "text")
    vectors = given.vectors and spark.read.parquet(given.vectors).selectExpr("vec_id AS doc_id", "embedding AS vector")
    nightly_refresh(spark, given.raw, documents, given.log, given.out, vectors or None).show()
    spark.stop()


if __name__ == "__main__":
    main()
