"""The retrieval index and BM25 weights.

The index holds one row per document with its distinct terms, their counts and
its unit vector; a row per term with its document frequency and the highest weights a
document gives it; one row of corpus totals; and postings: documents are dealt into
ranges, and a block has a term's documents of a range, sorted, with the highest weight
among them. Blocks are stored by buckets of terms, those of a bucket and range in one value, so a search reads the buckets of its
terms alone, and a range that cannot hold one of a question's best documents is skipped.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.text import tokenize
from lodestone.functions.vectors import as_double, unit
from lodestone.operators import scoring
from lodestone.session import settled
from lodestone.sources.versions import latest_version, mark_complete, next_version

# The usual BM25 parameters, and the share of the mean idf that a
# term gets when it occurs in more than half of the documents.
K1 = 1.5
B = 0.75
EPSILON = 0.25

# Documents of a range, whose postings one task holds; postings of a bucket of terms; the
# highest weights kept for a term, so that searches for up to as many documents can skip ranges.
RANGE_DOCUMENTS = 4096
BUCKET_POSTINGS = 1 << 22
HIGHS = 32
# Questions that meet a range in one task, about.
GROUP_QUERIES = 4096
# Rows of question terms that are broadcast; more of them are shuffled.
SENT_ROWS = 200_000
# What rounding and the order of sums may move a score by.
SLACK = 1e-5


def bags(documents: DataFrame) -> DataFrame:
    """Per document its length and distinct terms with counts, beside any further columns.

    A document's terms are all in its own row, so they are split, sorted and counted
    there; the corpus is not shuffled to count them.
    """
    others = [c for c in documents.columns if c not in ("doc_id", "text")]
    words = documents.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("w"), *others)
    kept = "".join(f", {c} {documents.schema[c].dataType.simpleString()}" for c in others)
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, length int, terms array<string>, counts array<int>{kept}"
    return words.mapInArrow(scoring.counted_words, schema)


@dataclass(frozen=True)
class Index:
    documents: DataFrame  # doc_id, length, terms, counts, vector
    terms: DataFrame  # term, df, highs
    corpus: DataFrame  # n, mean_length, mean_idf
    chunks: DataFrame  # bucket, range, chunk
    ranges: int
    buckets: int

    @property
    def blocks(self) -> DataFrame:
        """(bucket, term, range, docs, tfs, lengths, peak), a row per term and range of documents."""
        return self.blocks_of(self.chunks)

    def blocks_of(self, chunks: DataFrame, terms: pa.Array | None = None) -> DataFrame:
        """The blocks of some of the chunks; only of ``terms`` if they are given."""
        kind = self.documents.schema["doc_id"].dataType.simpleString()
        schema = f"bucket int, term string, range int, docs array<{kind}>, tfs array<int>, lengths array<int>, peak double"
        return chunks.mapInArrow(lambda batches: scoring.chunked_blocks(batches, terms), schema)

    @property
    def postings(self) -> DataFrame:
        """(doc_id, length, term, tf), one row per document and term."""
        pairs = F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf")))
        return self.documents.select("doc_id", "length", pairs.alias("p")).select(
            "doc_id", "length", F.col("p.term"), F.col("p.tf")
        )

    @property
    def rated_terms(self) -> DataFrame:
        """(term, df, idf); a term in most documents gets a share of the mean instead."""
        return rate(self.terms.select("term", "df"), self.corpus.select("n").scalar(), self.corpus.select("mean_idf").scalar())

    def write(self, root: str) -> Index:
        """Store a new version and return the index read back from it. Each table
        is computed once, from the tables written before it."""
        spark = self.documents.sparkSession
        folder = next_version(spark, root)

        def store(name: str, table: DataFrame, *parts: str) -> DataFrame:
            table.write.mode("overwrite").partitionBy(*parts).parquet(f"{folder}/{name}")
            return spark.read.parquet(f"{folder}/{name}")

        documents = store("documents", self.documents)
        sizes = documents.agg(
            F.count("*").alias("n"), F.avg("length").alias("mean_length"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("postings")).first()
        ranges, buckets = layout(spark, sizes["n"], sizes["postings"])
        blocks = postings_blocks(documents, sizes["mean_length"] or 1.0, ranges, buckets)
        # buckets of much size are split, small ones written together
        blocks = store("postings", blocks.hint("rebalance", "bucket").sortWithinPartitions("bucket"), "bucket")
        terms = store("terms", term_rows(blocks, sizes["mean_length"] or 1.0))
        corpus = store("corpus", corpus_totals(documents, terms).withColumns({"ranges": F.lit(ranges), "buckets": F.lit(buckets)}))
        mark_complete(spark, folder)
        return Index(documents, terms, corpus, blocks.select(*CHUNK_COLUMNS), ranges, buckets)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Index | None:
        folder = latest_version(spark, root)
        if folder is None:
            return None
        documents, terms, corpus, blocks = (
            spark.read.parquet(f"{folder}/{name}") for name in ("documents", "terms", "corpus", "postings"))
        made = corpus.first()
        return cls(documents, terms, corpus, blocks.select(*CHUNK_COLUMNS), made["ranges"], made["buckets"])


CHUNK_COLUMNS = ("bucket", "range", "chunk")


def layout(spark: SparkSession, documents: int, postings: int) -> tuple[int, int]:
    """Ranges of documents and buckets of terms for a corpus of this size."""
    ranges = max(-(-documents // RANGE_DOCUMENTS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return ranges, max(16, -(-postings // BUCKET_POSTINGS))


def range_of(ranges: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(ranges)).cast("int")


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(buckets)).cast("int")


def postings_blocks(documents: DataFrame, mean_length: float, ranges: int, buckets: int) -> DataFrame:
    """A row per bucket of terms and range of documents, with the blocks of these; ``peak`` of a block is the highest weight in it.
    Documents are shuffled once, by range, each as one row; their terms are brought together within the range's task."""
    dealt = documents.select("doc_id", "length", "terms", "counts", range_of(ranges).alias("range"))

    def gather(own):
        return scoring.range_blocks(own, K1, B, mean_length, buckets)

    return dealt.groupBy("range").applyInArrow(gather, "bucket int, range int, chunk binary")


def term_rows(chunks: DataFrame, mean_length: float) -> DataFrame:
    """(term, df, highs): the term's documents, and its highest weights before idf, highest first.

    Stored chunks of a bucket lie side by side, so most of a term is brought together before the shuffle, which is
    by bucket.
    """
    def gather(batches):
        return scoring.chunk_highs(batches, K1, B, mean_length, HIGHS)

    def whole(own):
        return scoring.whole_terms(own, HIGHS)

    some = chunks.select("bucket", "chunk").mapInArrow(gather, "bucket int, term string, n long, best array<double>")
    return some.groupBy("bucket").applyInArrow(whole, "term string, df long, highs array<double>")


def plain_idf(n: Column, df: Column) -> Column:
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def rate(terms: DataFrame, n: Column, mean_idf: Column) -> DataFrame:
    raw = plain_idf(n, F.col("df"))
    highs = ["highs"] if "highs" in terms.columns else []
    return terms.select("term", "df", F.when(raw < 0, mean_idf * EPSILON).otherwise(raw).alias("idf"), *highs)


def corpus_totals(documents: DataFrame, terms: DataFrame) -> DataFrame:
    totals = documents.agg(F.count("*").alias("n"), F.avg("length").alias("mean_length"))
    mean = terms.agg(F.avg(plain_idf(totals.select("n").scalar(), F.col("df"))).alias("m"))
    return totals.select("n", "mean_length", mean.scalar().alias("mean_idf"))


def build_index(documents: DataFrame, vectors: DataFrame | None = None, laid_out: bool = True) -> Index:
    """Index (doc_id, text) with an optional (doc_id, vector) per document; not ``laid_out`` if it is only to be written, which lays it out by size.

    Vectors are put at unit length and stored beside the terms, so that later
    searches read one table and join nothing.
    """
    texts = documents.select("doc_id", "text")
    if vectors is None:  # an input of few files is counted by as many tasks as there are
        rows = bags(texts.hint("rebalance")).withColumn("vector", F.lit(None).cast("array<double>"))
    else:  # texts meet their vectors before they are counted, being smaller than their terms
        units = vectors.select("doc_id", as_double(F.col("vector")).alias("v")).select(
            "doc_id", unit(F.col("v")).alias("vector"))
        rows = bags(texts.repartition("doc_id").join(units, "doc_id", "left"))
    spark = documents.sparkSession
    ranges, buckets = int(spark.conf.get("spark.sql.shuffle.partitions")), 16  # laid out by size when it is written
    mean = rows.agg(F.avg("length")).first()[0] if laid_out else None
    blocks = postings_blocks(rows, mean or 1.0, ranges, buckets)
    terms = term_rows(blocks, mean or 1.0)
    return Index(rows, terms, corpus_totals(rows, terms), blocks.select(*CHUNK_COLUMNS), ranges, buckets)


def query_weights(queries: DataFrame, rated_terms: DataFrame) -> DataFrame:
    """(query_id, term, weight): how often the query has the term, times its idf."""
    counted = (
        queries.select("query_id", F.explode(tokenize(F.col("text"))).alias("term"))
        .groupBy("query_id", "term").agg(F.count("*").alias("qf"))
    )
    highs = ["highs"] if "highs" in rated_terms.columns else []
    return counted.join(rated_terms, "term").select(
        "query_id", "term", (F.col("qf") * F.col("idf")).alias("weight"), *highs
    )


def scored_cells(index: Index, queries: DataFrame, k: int | None) -> DataFrame:
    """(query_id, doc_id, score) from the postings of the queries' terms.

    Questions and blocks meet by range of documents, where all terms of a document are; so
    scores never leave a task in part, and with ``k`` only the ``k`` best of a range leave it. The lists of
    buckets to read is bounded by their number; nothing else reaches the driver but totals.
    With ``k``, ranges are skipped whose highest possible score is under one that ``k`` documents are known to reach.
    """
    spark = queries.sparkSession
    totals = index.corpus.first()  # one row
    kinds = (queries.schema["query_id"].dataType.simpleString(), index.documents.schema["doc_id"].dataType.simpleString())
    schema = f"query_id {kinds[0]}, doc_id {kinds[1]}, score double"
    rated = rate(index.terms, F.lit(totals.n), F.lit(totals.mean_idf).cast("double"))
    weights = settled(query_weights(queries, rated).withColumn("bucket", bucket_of(index.buckets)))
    buckets = [r["bucket"] for r in weights.select("bucket").distinct().collect()]
    if not buckets:
        return spark.createDataFrame([], schema)
    n = weights.agg(F.count_distinct("query_id").alias("n"), F.count("*").alias("rows"), F.min("weight").alias("least")).first()

    def sent(rows: DataFrame) -> DataFrame:
        """The question side of a join goes to all tasks while it is small, so that the postings need no shuffle for it."""
        return F.broadcast(rows) if n["rows"] <= SENT_ROWS else rows

    groups = max(1, -(-n["n"] // GROUP_QUERIES))
    chunks = index.chunks.where(F.col("bucket").isin(buckets))
    asked_terms = weights.select("term").distinct().toArrow()["term"].combine_chunks() if n["rows"] <= SENT_ROWS else None
    stored = index.blocks_of(chunks, asked_terms)
    met = stored.select("bucket", "term", "range", "peak").join(sent(weights.drop("highs")), ["bucket", "term"])
    pairs = met.groupBy("query_id", "range").agg(F.sum(F.col("weight") * F.col("peak")).alias("most"))
    if k is not None and k <= HIGHS and n["least"] >= 0:  # otherwise no score is known to be reached
        reached = F.when(F.size("highs") >= k, F.col("weight") * F.get("highs", F.lit(k - 1))).otherwise(0.0)
        floors = weights.groupBy("query_id").agg(F.max(reached).alias("floor"))
        pairs = pairs.join(sent(floors), "query_id").where(F.col("most") >= F.col("floor") - SLACK)
    asked = pairs.select("query_id", "range").join(sent(weights.select("query_id", "term", "weight")), "query_id")
    group = F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")
    asked = asked.select(F.col("range").alias("q_range"), group.alias("q_group"), "query_id", "term", "weight")
    wanted = stored.join(sent(weights.select("bucket", "term").distinct()), ["bucket", "term"], "left_semi")
    held = wanted.select("range", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "term", "docs", "tfs", "lengths")
    mean = totals.mean_length or 1.0

    def score(blocks, questions):
        return scoring.score_cell(blocks, questions, k, K1, B, mean)

    return held.groupBy("range", "group").cogroup(asked.groupBy("q_range", "q_group")).applyInArrow(score, schema)


def bm25_scores(index: Index, queries: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) for every document that shares a term with the query, for query sets of any size."""
    return scored_cells(index, queries, None)
