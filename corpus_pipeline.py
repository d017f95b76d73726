"""From raw documents to token files, stage by stage; each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, langid, mixing, simhash, tokens
from lodestone.llm.blocks import crc_mod, written
from lodestone.llm.queries import END_ID, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document less like its nearest profile than this is in none of the languages.
LEAST_LIKE = 0.1


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; those without letters or unlike all of them go."""
    profiles = langid.fitted(docs, crc_mod("doc_id", 3) != 1)
    found = langid.identify(docs.withColumn("body", F.col("text")), profiles, text_col="body", keep=COLUMNS[1:])
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LIKE))
    return kept.select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id."""
    return simhash.first_of_groups(docs).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a span of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontaminate.decontaminate(docs.withColumn("body", F.col("text")), benchmark, text_col="body", keep=COLUMNS[1:])
    return found.where(F.col("n_hit") == 0).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes as often as it is taken, or not at all."""
    found = mixing.mix(docs, keep=COLUMNS[1:])
    copies = F.explode(F.sequence(F.lit(1), F.col("repeats")))
    return found.where("repeats > 0").select(*COLUMNS, copies.alias("copy")).drop("copy")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of the mix in files, and what they hold, read back."""
    path = tokens.write_tokens(docs, tokenizer_path(), end_id=END_ID)
    return tokens.read_tokens(spark, path, with_ids=False).drop("ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_output", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from ``documents`` on, each written before the next reads it."""
    docs = _documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Fingerprints, seeded hashes and the tokenizer have no counterpart in DuckDB; tests hold the stages against brute force.
ORACLE_SQL = None
