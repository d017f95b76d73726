"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample of the vectors; every vector then goes to the leaf
it descends to. A search goes best bin first: a priority queue holds the branches not
taken by the distance of their centre, and the nearest is opened next, until as many
leaves are visited as the calibration found to be needed for its recall.

Vectors that are equal are one candidate with the smallest of their ids, so a vector
with very many copies costs no more than any other.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.blocks import bucket_count, written

#: Vectors the tree is fitted on, by smallest hash.
SAMPLE = 20_000
#: Vectors of the sample that are searched to calibrate, and the mean recall asked for.
CALIBRATION, RECALL = 200, 0.96
BRANCHES = 8
#: Distinct vectors a leaf should hold; leaves grow only where the sample is too small for more of them.
LEAF = 200
#: Vectors of the sample a leaf holds at least.
LEAF_SAMPLE = 8
SEED = 7


@dataclass
class Tree:
    """Centres of the nodes, their children, and the number of a node that is a leaf."""

    centres: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    leaves: int = 0

    def add(self, centre: np.ndarray) -> int:
        self.centres.append(centre)
        self.children.append(np.zeros(0, np.int64))
        self.leaf.append(-1)
        return len(self.centres) - 1

    @classmethod
    def fit(cls, x: np.ndarray, leaf_size: int, seed: int = SEED) -> Tree:
        tree, rng = cls(), np.random.default_rng(seed)
        todo = [(tree.add(x.mean(axis=0)), x)] if len(x) else [(tree.add(np.zeros(x.shape[1])), x)]
        while todo:
            node, own = todo.pop()
            parts = _means(own, min(BRANCHES, -(-len(own) // leaf_size)), rng) if len(own) > leaf_size else []
            if len(parts) < 2:
                tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
                continue
            made = [(tree.add(part.mean(axis=0)), part) for part in parts]
            tree.children[node] = np.array([m[0] for m in made])
            todo += made
        tree.centres = np.array(tree.centres)
        return tree

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            if self.leaf[node] >= 0:
                out[own] = self.leaf[node]
            elif len(own):
                near = _squares(x[own], self.centres[self.children[node]]).argmin(axis=1)
                todo += [(child, own[near == i]) for i, child in enumerate(self.children[node])]
        return out

    def visits(self, q: np.ndarray, enough) -> list[int]:
        """Leaves by best bin first; stops when ``enough(leaves)``, or when there are no more."""
        queue, out = [(0.0, 0)], []
        while queue and not enough(out):
            _, node = heapq.heappop(queue)
            while self.leaf[node] < 0:
                own = self.children[node]
                far = ((self.centres[own] - q) ** 2).sum(axis=1)
                best = int(far.argmin())
                for i, child in enumerate(own.tolist()):
                    if i != best:
                        heapq.heappush(queue, (float(far[i]), child))
                node = int(own[best])
            out.append(self.leaf[node])
        return out


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ y.T + (y * y).sum(axis=1)


def _means(x: np.ndarray, k: int, rng) -> list[np.ndarray]:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(8):
        own = _squares(x, centres).argmin(axis=1)
        centres = np.array([x[own == i].mean(axis=0) if (own == i).any() else centres[i] for i in range(k)])
    own = _squares(x, centres).argmin(axis=1)
    return [x[own == i] for i in range(k) if (own == i).any()]


def calibrate(tree: Tree, x: np.ndarray, k: int, recall: float = RECALL, n: int = CALIBRATION) -> int:
    """Leaves to visit so that the mean recall of the sample's own vectors, searched in the sample, is reached."""
    if len(x) <= 1:
        return tree.leaves
    leaf, chosen = tree.place(x), np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)
    visits, near = [], []
    for i in chosen:
        far = ((x - x[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        near.append(leaf[np.argsort(far, kind="stable")[: min(k, len(x) - 1)]])
        visits.append({v: j for j, v in enumerate(tree.visits(x[i], lambda out: False))})
    needed = [np.array([v[int(b)] for b in own]) for v, own in zip(visits, near, strict=True)]
    widen = 1
    while widen < tree.leaves and np.mean([(own < widen).mean() for own in needed]) < recall:
        widen += max(1, widen // 8)
    return min(widen, tree.leaves)


def usable(column: str) -> Column:
    """Not null or empty, without null or non-finite components, and not all zero."""
    bad = F.exists(column, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(column) > 0) & ~bad & F.exists(column, lambda v: v != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            sample: int = SAMPLE, leaf: int = LEAF, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for the rows that ``queries`` admits.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id; a
    query is no candidate of its own, but other rows with the same vector are. Rows
    without an id, with a vector that is null, empty, zero or has null or non-finite
    components, or of another length than most, take no part. Repeated rows count once.
    With fewer candidates all are returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_col).isNotNull() & usable(vector_col)).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asked"))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    found = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], found)
    rows = rows.where(F.size("v") == common["d"]).withColumn("key", F.xxhash64("v"))
    order = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    firsts = rows.select("v", "key", "vec_id").distinct().withColumn("r", order).where(F.col("r") <= k + 1)
    classes = firsts.groupBy("v", "key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = rows.where("asked").select("v").distinct().withColumn("asked", F.lit(True))
    classes = written(classes.join(asked, "v", "left"), "vector-classes")
    n = classes.count()
    x = np.array([r["v"] for r in classes.orderBy("key").limit(sample).select("v").collect()])
    tree = Tree.fit(x, max(LEAF_SAMPLE, len(x) * leaf // max(n, 1)))
    widen = calibrate(tree, x, k, recall)
    sent = spark.sparkContext.broadcast(tree)

    def place(batches):
        for batch in batches:
            v = batch.column(0).flatten().to_numpy().reshape(len(batch), -1)
            yield pa.RecordBatch.from_arrays([pa.array(sent.value.place(v)), *batch.columns], names=["leaf", "v", "key", "ids"])

    index = written(classes.select("v", "key", "ids").mapInArrow(place, "leaf long, v array<double>, key long, ids array<long>"), "vector-index")
    held = {r["leaf"]: r["n"] for r in index.groupBy("leaf").agg(F.sum(F.size("ids")).alias("n")).collect()}
    parts = bucket_count(spark, least=32)  # leaves are searched some at a time

    def visit(batches):
        for batch in batches:
            v = batch.column(0).flatten().to_numpy().reshape(len(batch), -1)
            at, part, leaves = [], [], []
            for i, q in enumerate(v):
                own = np.array(sent.value.visits(q, lambda own: len(own) >= widen and sum(held.get(b, 0) for b in own) > k))
                for p in np.unique(own % parts).tolist():
                    at.append(i)
                    part.append(p)
                    leaves.append(own[own % parts == p].tolist())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(leaves, pa.list_(pa.int64())), *(c.take(pa.array(at, pa.int64())) for c in batch.columns)], names=["part", "leaves", "v", "key", "first_id"])

    visits = classes.where("asked").select("v", "key", F.col("ids")[0].alias("first_id")).mapInArrow(visit, "part long, leaves array<long>, v array<double>, key long, first_id long")

    def compare(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(own):
            return pd.DataFrame({"key": [], "first_id": [], "score": [], "ids": pd.Series([], dtype=object)})
        q, y = np.stack(asked["v"].to_numpy()), np.stack(own["v"].to_numpy())
        first, leaf = np.array([i[0] for i in own["ids"]]), own["leaf"].to_numpy()
        asks: dict[int, list[int]] = {}
        for i, leaves in enumerate(asked["leaves"]):
            for b in leaves:
                asks.setdefault(int(b), []).append(i)
        rows, columns = [], []
        for b, who in asks.items():
            here, step = np.flatnonzero(leaf == b), max(1, (1 << 21) // max(1, int((leaf == b).sum())))
            for s in range(0, len(who) if len(here) else 0, step):
                some = np.array(who[s : s + step])
                far = _squares(q[some], y[here])
                if len(here) > k + 1:  # with what rounding may have put behind the last of the nearest
                    last = np.partition(far, k, axis=1)[:, k]
                    r, c = np.nonzero(far <= (last + 1e-9 * (1 + np.abs(last)))[:, None])
                else:
                    r, c = np.nonzero(np.ones(far.shape, bool))
                rows.append(some[r])
                columns.append(here[c])
        r, c = np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *columns])
        far = np.empty(len(r))
        for s in range(0, len(r), 1 << 16):
            far[s : s + (1 << 16)] = np.sqrt(((q[r[s : s + (1 << 16)]] - y[c[s : s + (1 << 16)]]) ** 2).sum(axis=1))
        order = np.lexsort((first[c], far, r))
        r, c, far = r[order], c[order], far[order]
        begin = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else np.zeros(0, np.int64)
        kept = np.arange(len(r)) - np.repeat(begin, np.diff(np.append(begin, len(r)))) <= k
        r, c, far = r[kept], c[kept], far[kept]
        return pd.DataFrame({"key": asked["key"].to_numpy()[r], "first_id": asked["first_id"].to_numpy()[r], "score": far, "ids": own["ids"].reset_index(drop=True)[c].reset_index(drop=True)})

    placed = index.select((F.col("leaf") % parts).alias("part"), "leaf", "v", "ids")
    met = visits.groupBy("part").cogroup(placed.groupBy("part")).applyInPandas(compare, "key long, first_id long, score double, ids array<long>")
    near = F.row_number().over(Window.partitionBy("key", "first_id").orderBy("score", F.col("ids")[0]))
    met = met.withColumn("r", near).where(F.col("r") <= k + 1)
    best = met.groupBy("key", "first_id").agg(F.collect_list(F.struct("score", "ids")).alias("near"))
    ids = rows.where("asked").select("v", F.col("vec_id").alias("query_id")).distinct()
    named = classes.where("asked").select("v", "key", F.col("ids")[0].alias("first_id"))
    each = ids.join(named, "v").select("query_id", "key", "first_id").join(best, ["key", "first_id"])
    each = each.select("query_id", F.explode("near").alias("c")).select("query_id", "c.score", F.explode("c.ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
