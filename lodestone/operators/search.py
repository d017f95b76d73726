"""Keyword, vector and hybrid search of a batch of queries over an index.

Keyword search reads the postings of its terms. Vector and hybrid search score every
document: a small batch of questions goes to the tasks that scan the index, a larger one is a
table that meets the documents by ranges of documents and groups of questions.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.vectors import as_double, dot, unit
from lodestone.operators import scoring
from lodestone.operators.bm25 import B, K1, SENT_ROWS, Index, query_weights, range_of, rate, scored_cells
from lodestone.session import settled

# Questions that go to the tasks whole have at most this many rows and terms; more of them are
# dealt into groups of about this size.
QUERIES_PER_PASS = 256
TERMS_PER_PASS = 500_000

SCORED_COLUMNS = {
    "keyword": ("length", "terms", "counts"),
    "vector": ("vector",),
    "hybrid": ("length", "terms", "counts", "vector"),
}

SCORES = "query_id {query}, doc_id {doc}, score double"
RANGES = "query_id {query}, v_low double, v_high double, k_low double, k_high double"


class Retriever:
    """A batch of queries over an index. Question weights and score ranges are made
    once and serve every search. A query id that comes in several rows is one
    query, with the greatest of its texts and vectors."""

    def __init__(self, index: Index, queries: DataFrame, vectors: DataFrame | None = None):
        self.index, self.queries, self.vectors = index, queries, vectors

    @cached_property
    def _totals(self):
        return self.index.corpus.first()  # one row

    @cached_property
    def _once(self) -> DataFrame:
        return self.queries.groupBy("query_id").agg(F.max("text").alias("text"))

    @cached_property
    def asked(self) -> DataFrame:
        """(query_id, terms, weights, unit), a row a question."""
        totals = self._totals
        rated = rate(self.index.terms.select("term", "df"), F.lit(totals.n), F.lit(totals.mean_idf).cast("double"))
        weights = query_weights(self._once, rated).groupBy("query_id").agg(
            F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("own"))
        found = self._once.select("query_id").join(weights, "query_id", "left")
        if self.vectors is None:
            found = found.withColumn("v", F.lit(None).cast("array<double>"))
        else:
            given = self.vectors.groupBy("query_id").agg(F.max(as_double(F.col("vector"))).alias("v"))
            found = found.join(given, "query_id", "left")
        none = F.array().cast("array<struct<term:string,weight:double>>")
        own = F.coalesce("own", none)
        return settled(found.select(
            "query_id", F.transform(own, lambda t: t["term"]).alias("terms"),
            F.transform(own, lambda t: t["weight"]).alias("weights"), unit(F.col("v")).alias("unit")))

    @cached_property
    def _size(self) -> tuple[int, int]:
        """Questions, and the groups they are dealt into; one group goes to the tasks whole."""
        size = self.asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
        if size.n <= QUERIES_PER_PASS and size.terms <= TERMS_PER_PASS:
            return size.n, 1
        return size.n, max(2, -(-2 * size.n // QUERIES_PER_PASS), -(-2 * size.terms // TERMS_PER_PASS))

    @property
    def _model(self) -> tuple[float, float, float]:
        return K1, B, self._totals.mean_length or 1.0

    @cached_property
    def _block(self) -> scoring.QueryBlock:
        """The questions as arrays, where they are one group."""
        return scoring.block_of(self.asked.toArrow(), *self._model)

    def _typed(self, schema: str) -> str:
        return schema.format(
            query=self.queries.schema["query_id"].dataType.simpleString(),
            doc=self.index.documents.schema["doc_id"].dataType.simpleString(),
        )

    def _cells(self, score, questions: DataFrame, schema: str, method: str) -> DataFrame:
        """``score`` of each range of documents and group of questions, both as tables."""
        ranges, groups = self.index.ranges, self._size[1]
        group = F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")
        documents = self.index.documents.select("doc_id", *SCORED_COLUMNS[method], range_of(ranges).alias("range"))
        documents = documents.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        asked = questions.withColumns({"q_group": group, "q_range": F.explode(F.sequence(F.lit(0), F.lit(ranges - 1)))})
        return documents.groupBy("range", "group").cogroup(asked.groupBy("q_range", "q_group")).applyInArrow(score, self._typed(schema))

    def score_ranges(self) -> DataFrame:
        """Per query the smallest and largest vector and keyword score over all documents."""
        n, groups = self._size
        if groups == 1:
            documents = self.index.documents.select("doc_id", *SCORED_COLUMNS["hybrid"])
            if not n:
                return documents.sparkSession.createDataFrame([], self._typed(RANGES))
            rows = documents.mapInArrow(scoring.ranges_in_batches(self._block), self._typed(RANGES))
        else:
            model = self._model
            rows = self._cells(lambda d, q: scoring.ranges_of_cell(d, q, *model), self.asked, RANGES, "hybrid")
        return rows.groupBy("query_id").agg(
            F.min("v_low").alias("v_low"), F.max("v_high").alias("v_high"),
            F.min("k_low").alias("k_low"), F.max("k_high").alias("k_high"),
        )

    def vector_scores(self) -> DataFrame:
        """(query_id, doc_id, score): the dot product of unit vectors for every question and document, 0 where one has none."""
        n, groups = self._size
        documents = self.index.documents.select("doc_id", *SCORED_COLUMNS["vector"])
        if not n:
            return documents.sparkSession.createDataFrame([], self._typed(SCORES))
        if groups == 1:
            return documents.mapInArrow(scoring.cosines_in_batches(self._block), self._typed(SCORES))
        model = self._model
        return self._cells(lambda d, q: scoring.cosines_of_cell(d, q, *model), self.asked, SCORES, "vector")

    @cached_property
    def _ranges(self) -> DataFrame:
        return settled(self.score_ranges())

    def _dense(self, method: str, k: int, alpha: float) -> DataFrame:
        """The best ``k`` of each task, every document scored."""
        n, groups = self._size
        documents = self.index.documents.select("doc_id", *SCORED_COLUMNS[method])
        if not n:
            return documents.sparkSession.createDataFrame([], self._typed(SCORES))
        if groups == 1:
            spans = None
            if method == "hybrid":
                rows = self._ranges.toArrow()
                place = pa.compute.index_in(self._block.query_ids, value_set=rows["query_id"].combine_chunks())
                mine = rows.take(place) if rows.num_rows else rows
                spans = [mine[c].to_numpy() for c in ("v_low", "v_high", "k_low", "k_high")]
            return documents.mapInArrow(scoring.top_in_batches(self._block, method, k, alpha, spans), self._typed(SCORES))
        asked = self.asked.join(self._ranges, "query_id") if method == "hybrid" else self.asked
        model = self._model
        return self._cells(lambda d, q: scoring.best_of_cell(d, q, method, k, alpha, *model), asked, SCORES, method)

    def _sparse(self, k: int) -> DataFrame:
        """The best ``k`` of each range from the postings, filled up with documents that score 0."""
        found = settled(top_k(scored_cells(self.index, self._once, k), k).drop("rank"))
        good = found.where("score > 0").groupBy("query_id").agg(F.count("*").alias("n"))
        short = self._once.select("query_id").join(good, "query_id", "left").where(F.coalesce("n", F.lit(0)) < k)
        # fewer than k match, so k of the 2k smallest ids don't
        smallest = self.index.documents.select("doc_id").orderBy("doc_id").limit(2 * k)
        listed = smallest.agg(F.sort_array(F.collect_list("doc_id")).alias("ids"))
        filling = short.select("query_id", F.explode(listed.scalar()).alias("doc_id")).join(found, ["query_id", "doc_id"], "left_anti")
        return found.unionByName(filling.withColumn("score", F.lit(0.0)))

    def search(self, method: str, k: int = 5, alpha: float = 0.5) -> DataFrame:
        """(query_id, doc_id, score, rank): the ``k`` best of all documents per query.

        ``method`` is ``keyword``, ``vector`` or ``hybrid``, the last being
        ``alpha`` times the vector score plus the rest times the keyword score,
        both stretched to [0, 1] over all documents. Documents without a match
        or without a vector score 0 and still fill up to ``k``; with no vectors
        at all, hybrid ranks by keyword alone. Scores are rounded, and equal
        scores rank by document id.
        """
        # a corpus most of whose terms are in most documents gives matches less than nothing: all documents are scored
        if method == "keyword" and (self._totals.mean_idf or 0) >= 0:
            return top_k(self._sparse(k), k)
        return top_k(self._dense(method, k, alpha), k)

    def keyword_search(self, k: int = 5) -> DataFrame:
        return self.search("keyword", k)

    def vector_search(self, k: int = 5) -> DataFrame:
        return self.search("vector", k)

    def hybrid_search(self, k: int = 5, alpha: float = 0.5) -> DataFrame:
        return self.search("hybrid", k, alpha)


def top_k(scores: DataFrame, k: int, *ties: Column | str) -> DataFrame:
    """The best ``k`` per query. Each task prunes to ``k`` before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), *(ties or ("doc_id",)))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rerank(candidates: DataFrame, scorer: Column, k: int = 5) -> DataFrame:
    """The ``k`` best candidates by a joint score; equal scores keep their order.

    ``candidates`` has (query_id, doc_id, rank) and whatever ``scorer`` reads: a
    built-in expression, or a pandas UDF around a model.
    """
    scored = candidates.withColumns({
        "score": F.round(scorer, scoring.DIGITS), "was": F.col("rank"),
    })
    return top_k(scored, k, "was").drop("was")


def sent(found: DataFrame) -> DataFrame:
    """Found documents as the side of a join that goes to all tasks while it is small, so that the corpus is not shuffled for it."""
    return F.broadcast(found) if found.count() <= SENT_ROWS else found


def with_vectors(candidates: DataFrame, index: Index, vectors: DataFrame) -> DataFrame:
    """Candidates with the unit vectors of their document and query."""
    documents = index.documents.select("doc_id", F.col("vector").alias("doc_unit"))
    given = vectors.select("query_id", as_double(F.col("vector")).alias("query_vector"))
    joined = candidates.join(documents, "doc_id").join(given, "query_id", "left")
    return joined.withColumn("query_unit", unit(F.col("query_vector"))).drop("query_vector")


def cosine_of_candidates() -> Column:
    return F.coalesce(dot(F.col("doc_unit"), F.col("query_unit")), F.lit(0.0))


def apply_reply_order(candidates: DataFrame, replies: DataFrame, k: int = 5) -> DataFrame:
    """Candidates in the order that a reply such as "3, 1, 2" gives by candidate number.

    Numbers out of range and repeats are passed over; scores fall from 1 in
    steps of 0.01. A query whose reply names no candidate, or that has no
    reply, keeps its first ``k`` candidates and their scores.
    """
    named = replies.select(
        "query_id", F.posexplode(F.regexp_extract_all("reply", F.lit(r"(\d+)"), 1)).alias("pos", "number")
    ).select("query_id", "pos", F.col("number").try_cast("int").alias("rank"))
    firsts = named.groupBy("query_id", "rank").agg(F.min("pos").alias("pos"))
    chosen = candidates.join(firsts, ["query_id", "rank"])
    order = Window.partitionBy("query_id").orderBy("pos")
    ordered = chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select(
        "query_id", "doc_id", F.round(1.0 - (F.col("place") - 1) * 0.01, 3).alias("score"),
        F.col("place").alias("rank"),
    )
    kept = candidates.join(chosen.select("query_id").distinct(), "query_id", "left_anti").where(
        F.col("rank") <= k)
    return ordered.unionByName(kept.select("query_id", "doc_id", "score", "rank"))


def context_blocks(ranked: DataFrame) -> DataFrame:
    """Per query its ranked texts in one block, best first. Groups hold ``k`` rows."""
    texts = F.sort_array(F.collect_list(F.struct("rank", "text")))
    return ranked.groupBy("query_id").agg(
        F.array_join(F.transform(texts, lambda t: t["text"]), "\n\n").alias("context")
    )


def search_schema(
    retriever: Retriever, corpus: DataFrame, k_retrieve: int = 8, k_final: int = 4
) -> DataFrame:
    """Hybrid candidates, reranked by cosine, with the columns of ``corpus``."""
    candidates = settled(retriever.hybrid_search(k_retrieve))
    joined = with_vectors(sent(candidates), retriever.index, retriever.vectors)
    best = rerank(joined, cosine_of_candidates(), k_final)
    return sent(settled(best.select("query_id", "doc_id", "rank", "score"))).join(corpus, "doc_id")
