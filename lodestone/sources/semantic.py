"""The semantic layer: documents about tables and metrics, as rows.

A folder has ``tables/`` with one file per table and one ``metrics`` file, in
JSON or YAML. YAML needs PyYAML where the tasks run; JSON needs nothing.
"""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions.statements import trimmed

SHIPPED = str(Path(__file__).resolve().parent.parent / "semantic")

TABLE_DOC = (
    "table string, description string, grain string, "
    "columns map<string, struct<type: string, description: string>>, "
    "joins array<map<string, string>>, caveats array<string>"
)
METRIC_DOCS = "map<string, struct<description: string, answers_questions_like: array<string>, sql: string>>"


def _as_json(files: DataFrame) -> Column:
    """File contents as JSON text; YAML files are converted in the tasks."""

    def convert(texts: pd.Series) -> pd.Series:
        import yaml

        return texts.map(lambda text: json.dumps(yaml.safe_load(text), default=str))

    def plain(texts: pd.Series) -> pd.Series:
        return texts

    is_yaml = any(name.endswith((".yml", ".yaml")) for name in files.inputFiles())
    return F.pandas_udf(convert, T.StringType())("value") if is_yaml else F.col("value")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def read_table_docs(spark: SparkSession, folder: str = SHIPPED) -> DataFrame:
    files = _files(spark, f"{folder}/tables")
    parsed = F.from_json(_as_json(files), TABLE_DOC, {"mode": "FAILFAST"})
    return files.select(parsed.alias("doc")).select(
        "doc.table", "doc.description", "doc.grain",
        F.map_entries("doc.columns").alias("columns"), "doc.caveats",
    )


def read_metric_docs(spark: SparkSession, folder: str = SHIPPED) -> DataFrame:
    files = _files(spark, f"{folder}/metrics.*")
    parsed = F.from_json(_as_json(files), METRIC_DOCS, {"mode": "FAILFAST"})
    return files.select(F.explode(parsed).alias("name", "doc")).select("name", "doc.*")


def _bullets(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda line: F.concat(F.lit("  - "), line)), "\n")


def render_table_docs(docs: DataFrame) -> DataFrame:
    columns = F.transform("columns", lambda c: F.concat(c["key"], F.lit(": "), c["value"]["description"]))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Table: "), "table"),
        F.concat(F.lit("Description: "), trimmed(F.col("description"))),
        F.concat(F.lit("Grain: "), trimmed(F.col("grain"))),
        F.lit("Columns:"), _bullets(columns),
        F.lit("Caveats:"), F.coalesce(_bullets(F.col("caveats")), F.lit("")),
    )
    return docs.select(
        F.concat(F.lit("table:"), "table").alias("doc_id"), F.lit("table").alias("doc_type"),
        F.col("table").alias("name"), text.alias("text"),
    )


def render_metric_docs(docs: DataFrame) -> DataFrame:
    asked = F.coalesce(F.array_join("answers_questions_like", ", "), F.lit(""))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Metric: "), "name"),
        F.concat(F.lit("Answers questions like: "), asked),
        F.concat(F.lit("Description: "), trimmed(F.col("description"))),
        F.lit("SQL:"), trimmed(F.col("sql")),
    )
    return docs.select(
        F.concat(F.lit("metric:"), "name").alias("doc_id"), F.lit("metric").alias("doc_type"), "name",
        text.alias("text"),
    )


def load_documents(spark: SparkSession, folder: str = SHIPPED) -> DataFrame:
    """The retrieval corpus (doc_id, doc_type, name, text) of a semantic layer."""
    return render_table_docs(read_table_docs(spark, folder)).unionByName(
        render_metric_docs(read_metric_docs(spark, folder)))


def _blank(column: str) -> Column:
    return F.coalesce(trimmed(F.col(column)) == "", F.lit(True))


def missing_fields(spark: SparkSession, folder: str = SHIPPED) -> DataFrame:
    """(doc, field) for every required text that is absent or blank; none if all is well."""
    tables, metrics = read_table_docs(spark, folder), read_metric_docs(spark, folder)
    columns = tables.select("table", F.explode("columns").alias("c")).select(
        F.concat_ws(".", "table", "c.key").alias("doc"), "c.value.type", "c.value.description")

    def gaps(df: DataFrame, doc: str, fields: tuple[str, ...]) -> DataFrame:
        named = F.array(*(F.when(_blank(f), F.lit(f)) for f in fields))
        return df.select(F.col(doc).alias("doc"), F.explode(F.array_compact(named)).alias("field"))

    no_columns = tables.where(F.coalesce(F.size("columns"), F.lit(0)) < 1).select(
        F.col("table").alias("doc"), F.lit("columns").alias("field"))
    return (
        gaps(tables, "table", ("table", "description", "grain"))
        .unionByName(no_columns)
        .unionByName(gaps(columns, "doc", ("type", "description")))
        .unionByName(gaps(metrics, "name", ("description", "sql")))
        .unionByName(
            metrics.where(F.coalesce(F.size("answers_questions_like"), F.lit(0)) < 1)
            .select(F.col("name").alias("doc"), F.lit("answers_questions_like").alias("field")))
    )


# Documented type names and the Spark types they stand for.
DOCUMENTED = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
    "DOUBLE": "double",
}


def _actual_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    rows = [
        (name, i, field.name, field.dataType.simpleString())
        for name, df in tables.items() for i, field in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(rows, "table string, position int, column string, actual string")


def schema_drift(spark: SparkSession, tables: dict[str, DataFrame], folder: str = SHIPPED) -> DataFrame:
    """(table, column, documented, actual) where one side lacks the column or the types differ."""
    documented = read_table_docs(spark, folder).select(
        "table", F.explode("columns").alias("c")
    ).select("table", F.col("c.key").alias("column"), F.upper("c.value.type").alias("documented"))
    names = F.create_map(*(F.lit(x) for pair in DOCUMENTED.items() for x in pair))
    same = (F.col("documented").startswith("DECIMAL") & F.col("actual").startswith("decimal")) | (
        F.coalesce(names[F.col("documented")], F.lit("")) == F.col("actual"))
    both = documented.join(_actual_columns(spark, tables).drop("position"), ["table", "column"], "full_outer")
    return both.where(F.col("documented").isNull() | F.col("actual").isNull() | ~same)


def schema_dump(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(table, line) with lines such as ``dim_region(nation_key BIGINT, …)``."""
    entry = F.concat_ws(" ", "column", F.upper("actual"))
    listed = F.sort_array(F.collect_list(F.struct("position", entry.alias("entry"))))
    return _actual_columns(spark, tables).groupBy("table").agg(listed.alias("l")).select(
        "table",
        F.concat(F.col("table"), F.lit("("), F.array_join(F.transform("l", lambda e: e["entry"]), ", "),
                 F.lit(")")).alias("line"),
    )
