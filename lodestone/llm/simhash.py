"""SimHash near-duplicates by meeting in the middle.

Two fingerprints at most ``d`` bits apart share a word that is at most ``d / 2`` bits
from each. Every fingerprint therefore emits all words within that radius (its ball),
the shuffle is by word, and fingerprints that meet on a word are compared.

Words are dealt to buckets by a linear code of their bits, so a word's bucket follows
from its fingerprint's code and its mask's. A fingerprint goes once to each bucket that
one of its words falls in, and the bucket writes the words out itself: the shuffle
carries eight bytes a bucket and fingerprint instead of the words. A bucket works
through its words in slices of bounded size.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import U64, local_components, mixed, release, utf8, written
from lodestone.llm.graph import connected_components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
#: Buckets that words are dealt to, a power of two. Memory of a task: the fingerprints that have a word in its bucket.
BUCKETS = 64
#: Words that a bucket holds at a time.
SLICE_WORDS = 1_000_000
#: Texts that go to Python at a time.
BATCH_TEXTS = 1024
CODE_BITS = 24


def fingerprint(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """64 bits; each is set if most shingles' hashes have it. No words: zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.zeros(len(words), np.int64)
    starts[1:] = ends[:-1] + 1
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)), U64, n
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(U64)[0])


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The same for rows that agree in id and text."""
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, key, fp) for every row; a null text has no words."""
    kind = docs.schema[id_col].dataType.simpleString()
    tables = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), row_key(id_col, text_col).alias("key"))

    def run(batches):
        release()
        for batch in batches:
            raw, at, _ = utf8(batch.column(1))
            data = raw.tobytes()
            fps = np.fromiter((fingerprint(data[s:e], width) for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)), U64, len(at) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], names=["doc_id", "key", "fp"])
            del raw, at, data, fps
        release()

    return tables.mapInArrow(run, f"doc_id {kind}, key long, fp long")


def ball_masks(radius: int) -> np.ndarray:
    """What turns a fingerprint into each word within ``radius`` bits, itself first."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)], U64)


_COLUMNS = mixed(np.arange(101, 165, dtype=U64)) >> U64(64 - CODE_BITS)


def code(words: np.ndarray) -> np.ndarray:
    """A linear code: the code of a XOR b is the XOR of their codes."""
    out = np.zeros(len(words), U64)
    for bit in range(64):
        out ^= ((words >> U64(bit)) & U64(1)) * _COLUMNS[bit]
    return out.astype(np.int64)


def meet(fps: np.ndarray, bucket: int, buckets: int, distance: int, slice_words: int = SLICE_WORDS):
    """Links between distinct fingerprints that share a word of this bucket, as a forest (fp, root).

    All that meet on one word are at most ``distance`` bits apart, so linking each to the
    first of them loses no connection; each link's distance is still verified.
    """
    masks = ball_masks(distance // 2)
    own, sent = code(fps), code(masks)
    parts = 1
    while len(fps) * len(masks) / (buckets * parts) > slice_words and buckets * parts < 1 << CODE_BITS:
        parts *= 2
    low = buckets * parts - 1
    order = np.argsort(sent & low, kind="stable")
    masks, sent = masks[order], (sent & low)[order]
    heads, tails = [], []
    for part in range(parts):
        want = (own & low) ^ (bucket + buckets * part)
        first, last = np.searchsorted(sent, want, "left"), np.searchsorted(sent, want, "right")
        count = last - first
        total = int(count.sum())
        if not total:
            continue
        who = np.repeat(np.arange(len(fps)), count)
        which = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
        words = fps[who] ^ masks[which]
        order = np.argsort(words)
        words, who = words[order], who[order]
        new = np.ones(total, bool)
        new[1:] = words[1:] != words[:-1]
        head = who[np.maximum.accumulate(np.where(new, np.arange(total), 0))]
        met = ~new & (head != who)
        pair = np.unique(np.stack([head[met], who[met]]), axis=1)
        near = np.bitwise_count(fps[pair[0]] ^ fps[pair[1]]) <= distance
        heads.append(pair[0][near])
        tails.append(pair[1][near])
    if not heads:
        return fps[:0], fps[:0]
    root = local_components(np.concatenate(heads), np.concatenate(tails), len(fps))
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked], fps[root[linked]]


def near_links(distinct: DataFrame, distance: int = MAX_DISTANCE, buckets: int = BUCKETS) -> DataFrame:
    """(a, b): links whose components are those of all pairs at most ``distance`` bits apart.

    ``distinct`` has one row a fingerprint, in ``fp``. ``distance`` must be even, for
    then all that meet on a word are within it of each other.
    """
    if distance % 2 or buckets & (buckets - 1) or buckets > 1 << CODE_BITS:
        raise ValueError("an even distance and a power of two of buckets")
    reach = np.zeros(buckets, bool)
    reach[code(ball_masks(distance // 2)) & (buckets - 1)] = True

    def deal(batches):
        release()
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(U64)
            own = code(fps) & (buckets - 1)
            for bucket in range(buckets):
                mine = fps[reach[own ^ bucket]]
                if len(mine):
                    yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([mine.tobytes()], pa.binary())], names=["bucket", "fps"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        release()
        fps = np.unique(np.frombuffer(b"".join(pdf["fps"]), U64))
        a, b = meet(fps, int(pdf["bucket"].iloc[0]), buckets, distance)
        del fps
        release()  # the worker waits beside the stages that follow
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "bucket int, fps binary")
    return dealt.groupBy("bucket").applyInPandas(join, "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, distance: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, fp) of all rows; (fp, component, least) of all fingerprints, the first id and key of each."""
    fps = written(fingerprints(docs, id_col, text_col, width), "simhash", BATCH_TEXTS)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key").alias("key")))
    distinct = written(fps.groupBy("fp").agg(first.alias("least")), "simhash-distinct")
    parts = connected_components(near_links(distinct, distance, buckets))
    known = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    return fps, known.select("fp", "least", F.coalesce("component", "fp").alias("component"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
                       buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, fp, component_id) for every row.

    ``component_id`` is the smallest id reachable over links of at most ``distance``
    bits, the row's own included; ids that are null count for none, and a component
    without another has null. Texts without words (null, empty, white space) have
    fingerprint zero and link like any other. Repeated rows stay, in one component; an
    empty table gives no rows; other columns are not looked at.
    """
    fps, known = _grouped(docs, id_col, text_col, width, distance, buckets)
    smallest = known.groupBy("component").agg(F.min("least").getField("id").alias("component_id"))
    members = known.join(smallest, "component").select("fp", "component_id")
    return fps.join(members, "fp").select("doc_id", "fp", "component_id")


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE,
                    buckets: int = BUCKETS) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, or without ids any one.

    Of rows that agree in id and text one stays.
    """
    _, known = _grouped(docs, id_col, text_col, width, distance, buckets)
    firsts = known.groupBy("component").agg(F.min("least").getField("key").alias("_first_key")).select("_first_key").distinct()
    keyed = docs.withColumn("_first_key", row_key(id_col, text_col))
    return keyed.join(firsts, "_first_key", "left_semi").dropDuplicates(["_first_key"]).drop("_first_key")


def hex_fingerprint(column: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
