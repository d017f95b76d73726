"""Exact top-k by inner product: term-at-a-time accumulation of sparse integer vectors.

The terms are the dimensions. A block of candidates is turned into postings: for each
dimension the candidates that are not zero there, with their weights. A query's nonzero
terms are taken one after another, and each scatters its weighted postings into a dense
array of scores, one for every candidate of the block; a batch of queries is scored at
once. The best of a block come by partition selection, and the blocks' best are merged.

Candidates are dealt into blocks of a bounded number of components, and each block is
sent once to every block of queries, queries once to every block of candidates.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.blocks import release, written

#: Components of candidates and of queries that a task holds at most, but for a single longer vector.
CANDIDATE_COMPONENTS = 1 << 21
QUERY_COMPONENTS = 1 << 18
#: Scores that are accumulated at a time.
SCORES = 1 << 21
#: Vectors of more components than this have a smaller range of components.
DIMENSIONS = 1 << 16


def quantised(column: str, scale: float) -> Column:
    """floor(scale * x) of every component as longs, or null where the vector takes no part.

    That is where it or a component is null or not finite, or where a component is so large
    (beyond 2^23 in magnitude, scaled, for up to 2^16 components) that a sum of products might leave a long.
    """
    scaled = F.transform(column, lambda x: x.cast("double") * scale)
    limit = F.sqrt(F.lit(float(1 << 62)) / F.greatest(F.size(column), F.lit(DIMENSIONS)))
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(scaled, lambda x: F.floor(x).cast("long")))


class Postings:
    """Of each dimension the rows that are not zero there, and their weights."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray):
        term = np.arange(len(values)) - np.repeat(offsets[:-1], np.diff(offsets))
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        some = values != 0
        term, row, values = term[some], row[some], values[some]
        order = np.argsort(term, kind="stable")
        self.row, self.weight, term = row[order], values[order], term[order]
        self.terms = int(term[-1]) + 1 if len(term) else 0
        self.first = np.searchsorted(term, np.arange(self.terms + 1))
        self.rows = len(offsets) - 1
        self.largest = int(np.abs(values).max()) if len(values) else 0

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.first[term], self.first[term + 1])
        return self.row[own], self.weight[own]


def accumulate(asked: Postings, held: Postings) -> np.ndarray:
    """Scores of every held row (down) for every asked row (across)."""
    terms = min(asked.terms, held.terms)
    narrow = terms * asked.largest * held.largest < 1 << 31
    kind = np.int32 if narrow else np.int64
    scores = np.zeros((held.rows, asked.rows), kind)
    for term in range(terms):
        who, asks = asked.of(term)
        rows, weight = held.of(term)
        if not len(who) or not len(rows):
            continue
        part = np.zeros(asked.rows, kind)
        part[who] = asks
        added = weight.astype(kind)[:, None] * part
        if len(rows) == held.rows:
            scores += added
        else:
            scores[rows] += added
    return scores


def select(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the ``k`` highest down ``scores``; of equal ones the upper come first."""
    n = len(scores)
    if n <= k:
        return np.arange(n), np.arange(n)
    last = np.partition(scores, n - k)[n - k]
    above = np.flatnonzero(scores > last)
    level = np.flatnonzero(scores == last)[: k - len(above)]
    return np.concatenate([above, level]), np.arange(k)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], pa.list_(pa.int64()))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(), offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


FOUND = "query_id long, vec_id long, score long"


def best_of_cell(asked: pa.Table, held: pa.Table, k: int) -> pa.Table:
    """The best ``k`` held rows of each asked row, but for those with the same id."""
    release()
    names = ["query_id", "vec_id", "score"]
    empty = pa.table([pa.array([], pa.int64())] * 3, names=names)
    if not asked.num_rows or not held.num_rows:
        return empty
    held = held.sort_by("id")
    asked = asked.sort_by("id")
    ids, who = held["id"].to_numpy(), asked["id"].to_numpy()
    kept = Postings(*_flat(held["v"]))
    values, offsets = _flat(asked["v"])
    step = max(1, SCORES // held.num_rows)
    parts = []
    for first in range(0, len(who), step):
        last = min(first + step, len(who))
        own = Postings(values[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        scores = np.ascontiguousarray(accumulate(own, kept).T)
        for q in range(last - first):
            rows, _ = select(scores[q], k + 1)  # one of them may be the query's own
            rows = rows[ids[rows] != who[first + q]]
            rows = rows[np.lexsort((rows, -scores[q][rows].astype(np.int64)))][:k]
            parts.append((np.full(len(rows), who[first + q]), ids[rows], scores[q][rows].astype(np.int64)))
    return pa.table([pa.array(np.concatenate(p)) for p in zip(*parts, strict=True)], names=names) if parts else empty


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding",
          candidate_components: int = CANDIDATE_COMPONENTS, query_components: int = QUERY_COMPONENTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products for the rows that ``queries`` admits.

    Components are floor(scale * x). Ties go to the smaller id; a query is no candidate of its
    own, but other rows with the same vector are. A component that one of two vectors lacks
    counts as zero, so vectors may differ in length, and an empty one scores 0. Rows without an id or with a vector that
    ``quantised`` refuses take no part. Of rows with the same id the one with the greatest vector
    counts. With fewer candidates all are returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(vector_col, scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    once = written(rows.groupBy("id").agg(F.max(F.struct("v", "asked")).alias("r")).select("id", "r.v", "r.asked"), "topk-vectors")
    size = F.size("v").cast("long")
    held = once.agg(F.coalesce(F.sum(size), F.lit(0)).alias("all"), F.coalesce(F.sum(F.when(F.col("asked"), size)), F.lit(0)).alias("asked")).first()
    wide = max(math.ceil(held["all"] / candidate_components), int(spark.conf.get("spark.sql.shuffle.partitions")))
    tall = max(1, math.ceil(held["asked"] / query_components))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    asked = once.where("asked").select("id", "v", dealt(tall).alias("across"), every(wide).alias("down"))
    candidates = once.select("id", "v", dealt(wide).alias("down"), every(tall).alias("across"))
    # an explicit number, since a cell is small in bytes and large in work: cells should not be merged into few tasks
    tasks = min(wide * tall, 4 * max(wide, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    asked, candidates = (side.repartition(tasks, "across", "down") for side in (asked, candidates))
    met = asked.groupBy("across", "down").cogroup(candidates.groupBy("across", "down")).applyInArrow(
        lambda a, b: best_of_cell(a.select(["id", "v"]), b.select(["id", "v"]), k), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
