"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import (
    align, ann, decontaminate, htmltext, katz, langid, merkle, mixing, passages, simhash, tokens, topk, toxicity,
)
from lodestone.llm.blocks import crc_mod
from lodestone.llm.oracle import ORACLES

TOKENIZER = "word_bpe_49k.json"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")
END_ID = 1
TOXIC_FROM = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    found = langid.identify(docs, langid.fitted(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_mod("doc_id", 4) == 2
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels"), ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=END_ID)
    return tokens.read_tokens(spark, path, with_ids=False).drop("ids")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 5) == 1
    scored = katz.score(docs, katz.fit(docs, ~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.verified(merkle.document_leaves(docs, tampered))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(_table(spark, sf_dir, "documents"), *map(tokenizer_path, ALIGNED))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_toxicity": op2_toxicity,
        "op3_nearest_neighbours": op3_nearest_neighbours,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_html_extraction": op5_html_extraction,
        "op6_token_output": op6_token_output,
        "op7_mixing": op7_mixing,
        "op8_simhash_dedup": op8_simhash_dedup,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_decontamination": op10_decontamination,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_exact_topk": op12_exact_topk,
        "op13_token_alignment": op13_token_alignment,
        "pipeline": pipeline,
    }


def llm_oracles() -> dict[str, str]:
    return dict(ORACLES)
