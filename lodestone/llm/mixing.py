"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length within each source. Most of a source's target is
taken in proportion from every length, whole passes over the source included; the
remaining budget is filled by bounded-knapsack dynamic programming over the lengths.
Which documents of a length are taken once more follows from a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.blocks import written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 20
#: The dynamic programme fills at least this many words, so that an exact sum is likely to exist.
FILL_WORDS = 4096


def fill(lengths: np.ndarray, spare: np.ndarray, budget: int, over: int = 0) -> np.ndarray:
    """How many of each length to take, at most ``spare``, so that the sum is nearest to ``budget`` among
    those that go over it by ``over`` at most; the smaller of equally near ones.

    Bounded knapsack: counts are split into powers of two, and each sum remembers the
    piece that first reached it, so a piece is used once when the sum is traced back.
    """
    took = np.zeros(len(lengths), np.int64)
    most = budget + over
    reached = np.zeros(most + 1, bool)
    reached[0] = True
    by = np.zeros(most + 1, np.int32)
    pieces: list[tuple[int, int]] = []
    for i in np.argsort(lengths, kind="stable").tolist():
        length, left, step = int(lengths[i]), int(spare[i]), 1
        while left > 0 and length > 0 and length <= most and not reached[budget]:
            n = min(step, left, most // length)
            size = n * length
            new = reached[: most + 1 - size] & ~reached[size:]
            by[size:][new] = len(pieces)
            reached[size:] |= new
            pieces.append((i, n))
            if n < min(step, left):
                break
            left, step = left - n, step * 2
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, n = pieces[by[at]]
        took[i] += n
        at -= n * int(lengths[i])
    return took


def fit(lengths: np.ndarray, counts: np.ndarray, target: int, cap: int = MAX_REPEATS, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take, repeats counted, at most ``cap`` times each.

    All lengths are taken in proportion as far as that goes without going over; single
    documents of seeded lengths bring the gap down to what the dynamic programme fills. If
    no sum fills it, some of the short ones are given back and the larger gap is filled. If that fails too, a sum over
    the target is taken where it is nearer.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if not total or target <= 0:
        return np.zeros(len(lengths), np.int64)
    passes, budget = divmod(min(int(target), cap * total), total)
    took = np.array([c * passes + c * budget // total for c in counts.tolist()], np.int64)
    took[lengths <= 0] = 0
    spare = np.where(lengths > 0, cap * counts - took, 0)
    gap = min(int(target), cap * total) - int((took * lengths).sum())
    for i in np.argsort((lengths * 2654435761 + seed) % (1 << 32), kind="stable").tolist():
        if spare[i] and gap - lengths[i] >= FILL_WORDS:
            took[i], spare[i], gap = took[i] + 1, spare[i] - 1, gap - int(lengths[i])
    filled = fill(lengths, spare, gap)
    if (lengths * filled).sum() < gap:
        for i in np.argsort(lengths, kind="stable").tolist():
            back = min(int(took[i]), 8)
            if lengths[i] > 0 and gap < 2 * FILL_WORDS:
                took[i], spare[i], gap = took[i] - back, spare[i] + back, gap + back * int(lengths[i])
        filled = fill(lengths, spare, gap)
        short = gap - int((lengths * filled).sum())
        if short > 1:
            filled = fill(lengths, spare, gap, short - 1)
    return took + filled


def source_key(column: str | Column) -> Column:
    """A text that sorts sources by code point with null last, and is never null."""
    return F.coalesce(F.concat(F.lit("s"), F.col(column) if isinstance(column, str) else column), F.lit("z"))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS) -> DataFrame:
    """(src, source_size, target) from (src, source_size), a row a source.

    All sizes are shared by weight; a source whose share is above ``cap`` times its size
    stays at that, and the excess is shared again. Sources in the order of cap by weight
    are capped up to some place, so running sums give where it ends.
    """
    rank = F.row_number().over(Window.orderBy("src")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * cap).cast("double")
    by = Window.orderBy("ratio", "src")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    d = totals.withColumn("weight", weight.cast("double")).withColumn("limit", limit).withColumn("ratio", F.col("limit") / F.col("weight"))
    d = d.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    d = d.withColumn("capped", F.col("left") >= F.col("ratio") * F.sum("weight").over(after))
    free = (F.sum("source_size").over(every) - F.coalesce(F.sum(F.when(F.col("capped"), F.col("limit"))).over(every), F.lit(0.0)))
    share = free / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("limit")).otherwise(F.least("limit", share * F.col("weight")))
    return d.select("src", "source_size", target.alias("target"))


def word_count(column: Column) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        keep: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_REPEATS,
        seed: int = SEED) -> DataFrame:
    """(doc_id, kept columns, size, source_size, target, repeats) for every row of ``docs``.

    ``repeats`` is how often the mix takes the row, 0 to ``cap``; the words taken from a
    source come as near to its target as its lengths allow. A null source is a source
    of its own, the last; null and empty texts have size 0 and cost nothing. Of rows of
    one length those with the smallest hash of id and text are taken; rows equal in both
    are equal in all that counts. Reruns agree. An empty table gives no rows.

    A task sees a source's counts by length, never its rows; rows of one source and
    length are ranked in 256 parts by hash, so that no group of copies meets in one task.
    """
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *[F.col(c).alias(f"_keep_{c}") for c in keep],
        source_key(source_col).alias("src"), word_count(F.col(text_col)).alias("size"), key.alias("key"),
        F.shiftright(key, 56).cast("int").alias("part"),
    )
    counts = written(rows.groupBy("src", "size", "part").agg(F.count("*").alias("n")), "mix-counts")
    by_length = counts.groupBy("src", "size").agg(F.sum("n").alias("n"))
    goal = targets(by_length.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, cap)

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        took = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), round(pdf["target"].iloc[0]), cap, seed)
        return pdf[["src", "size", "source_size", "target"]].assign(passes=took // pdf["n"], took=took % pdf["n"])

    planned = by_length.join(goal, "src").groupBy("src").applyInPandas(
        plan, "src string, size long, source_size long, target double, passes long, took long"
    )
    ahead = Window.partitionBy("src", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    quota = counts.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).join(planned, ["src", "size"]).select(
        "src", "size", "part", "source_size", "target", "passes",
        F.least(F.greatest(F.col("took") - F.col("ahead"), F.lit(0)), F.col("n")).alias("quota"),
    )
    place = F.row_number().over(Window.partitionBy("src", "size", "part").orderBy("key"))
    out = rows.withColumn("place", place).join(written(quota, "mix-quota"), ["src", "size", "part"])
    repeats = F.col("passes") + (F.col("place") <= F.col("quota")).cast("long")
    return out.select("doc_id", *[F.col(f"_keep_{c}").alias(c) for c in keep], "size", "source_size", "target",
                      repeats.alias("repeats"))
