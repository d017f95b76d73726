"""Golden questions: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GOLDEN = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("tier", T.IntegerType()),
    T.StructField("question", T.StringType()),
    T.StructField("sql", T.StringType()),
    T.StructField("relevant_doc_ids", T.ArrayType(T.StringType())),
    # Values of any scalar type; each is read as its text.
    T.StructField("reference_result", T.ArrayType(T.ArrayType(T.StringType()))),
])


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(GOLDEN).option("mode", "FAILFAST").json(path)


def relevant_documents(golden: DataFrame) -> DataFrame:
    """(query_id, doc_id), one row per relevant document of a question."""
    return golden.select(F.col("id").alias("query_id"), F.explode("relevant_doc_ids").alias("doc_id"))


def reference_rows(golden: DataFrame) -> DataFrame:
    """(question_id, row_no, row): the recorded result rows in order."""
    return golden.select(
        F.col("id").alias("question_id"), F.posexplode("reference_result").alias("pos", "row")
    ).select("question_id", (F.col("pos") + 1).alias("row_no"), "row")
