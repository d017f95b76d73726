"""A bigram language model with Katz backoff.

Counts are discounted by Good-Turing. A bigram seen at least twice keeps its discounted
share of its history; what is left over goes to the other words by their unigram
probability, times a weight that makes each history's probabilities sum to one exactly.
Unigrams are discounted the same way, and their left-over is the probability of any
unknown word. A token's probability is that of its bigram if the table has it, and else
the history's weight times the token's unigram, itself backing off to the unknown word.

Words are 64-bit hashes. Counts and scores are gathered by hash: a task combines what it
has read into one sorted block a bucket, with the documents of each entry when scoring,
so the shuffle carries a few bytes a token. Because
log P(w | h) = [log P(w) + log weight(h)] + [log P(w | h) - log P(w) - log weight(h)],
the first part is summed word by word and only the second needs the bigram table.
"""

from __future__ import annotations

import math
import struct
import zlib
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import SPACE, U64, Words, bucket_count, discard, mixed, slices, utf8, written

#: Counts up to this are discounted.
DISCOUNTED = 5
#: Tokens a task combines before it sends.
FLUSH_TOKENS = 1_200_000
#: Blocks that go to Python at a time when scoring: they have some hundred kilobytes each.
BATCH_BLOCKS = 32
#: Buckets of bigrams and of words when scoring; a bucket's part of the model is held by a task.
PAIR_BUCKETS, WORD_BUCKETS = 64, 16
#: Parts that the bigrams are joined and looked up in, one after the other, so that the disk holds one part's shuffle.
PARTS = 2

BEGIN, END = (int(x) for x in mixed(np.array([11, 12], U64)))


def joined(*arrays: np.ndarray) -> bytes:
    return b"".join(struct.pack("<2sI", a.dtype.str[1:].encode(), len(a)) + a.tobytes() for a in arrays)


def parted(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        kind, n = struct.unpack_from("<2sI", data, at)
        out.append(np.frombuffer(data, f"<{kind.decode()}", n, at + 6))
        at += 6 + out[-1].nbytes
    return out


def spaced(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as the bytes of their distances, the high bytes of all first: those are mostly zero and compress."""
    return np.diff(keys, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.ravel()


def placed(data: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(data.reshape(8, -1).T).view("<u8").ravel(), dtype=U64)


def _small(n: np.ndarray) -> np.ndarray:
    top = int(n.max()) if len(n) else 0
    return n.astype("<u1" if top < 256 else "<u2" if top < 65536 else "<u4")


def sequences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each row's words between a begin and an end, and the row of each."""
    rows = w.rows()
    n = len(w.counts)
    seq = np.empty(len(rows) + 2 * n, U64)
    seq[np.arange(len(rows)) + 2 * rows + 1] = w.hashes
    seq[w.starts[:-1] + 2 * np.arange(n)] = BEGIN
    seq[w.starts[1:] + 2 * np.arange(n) + 1] = END
    return seq, np.repeat(np.arange(n, dtype=np.int32), w.counts + 2)


def pair_hash(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(h * U64(0x9FB21C651E98DF25) + w)


def pair_part(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (h ^ w).view(np.int64) % PARTS


def _of_part(pairs: DataFrame, part: int) -> DataFrame:
    """The rows (h, w, ...) whose ``pair_part`` is this."""
    return pairs.where(F.pmod(F.col("h").bitwiseXOR(F.col("w")), F.lit(PARTS)) == part)


def _flushes(batches):
    """(begin/end sequence, row of each, batches) of some FLUSH_TOKENS tokens each; rows count through."""
    seqs, rows, held, n, parts = [], [], 0, 0, []
    for batch in batches:
        raw, at, _ = utf8(batch.column(0))
        rest = batch.select(batch.schema.names[1:])  # without the texts, which come first
        for first, last in slices(at, 1 << 19):
            seq, row = sequences(Words(raw[at[first] : at[last]], at[first : last + 1] - at[first], SPACE))
            seqs.append(seq)
            rows.append(row + np.int32(n))
            parts.append(rest.slice(first, last - first))
            n, held = n + last - first, held + len(seq)
            if held >= FLUSH_TOKENS:
                yield np.concatenate(seqs), np.concatenate(rows), parts
                seqs, rows, held, n, parts = [], [], 0, 0, []
    if held:
        yield np.concatenate(seqs), np.concatenate(rows), parts


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_keys[1:] != sorted_keys[:-1])) if len(sorted_keys) else np.zeros(0, np.int64)


def _cuts(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys start; buckets are equal ranges of the hash."""
    bounds = [-(-(b << 64) // buckets) for b in range(1, buckets)]
    return np.append(np.append(0, np.searchsorted(sorted_keys, np.array(bounds, U64))), len(sorted_keys))


def count_ngrams(texts: DataFrame, buckets: int) -> DataFrame:
    """(kind, h, w, n) from a column ``text``: kind 1 words, kind 2 bigrams,
    kind 3 in w how many bigrams there are of each small count n."""

    def deal(batches):
        for seq, row, _ in _flushes(batches):
            words = np.sort(seq)
            first = _runs(words)
            n = np.diff(np.append(first, len(words)))
            words = words[first].copy()
            cut = _cuts(words, buckets)
            follows = row[1:] == row[:-1]
            h, w = seq[:-1][follows], seq[1:][follows]
            key = pair_hash(h, w)
            order = np.argsort(key)
            key = key[order]
            first = _runs(key)
            pairs = np.diff(np.append(first, len(key)))
            at = order[first]
            key, h, w = key[first], h[at], w[at]
            pair_cut = _cuts(key, buckets)
            out: dict[str, list] = {"bucket": [], "kind": [], "data": []}
            for b in range(buckets):
                s, e = cut[b], cut[b + 1]
                out["bucket"] += [b, b]
                out["kind"] += [1, 2]
                out["data"].append(joined(words[s:e], _small(n[s:e])))
                s, e = pair_cut[b], pair_cut[b + 1]
                out["data"].append(joined(h[s:e], w[s:e], _small(pairs[s:e])))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())]))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = int(pdf["kind"].iloc[0])
        parts = [parted(d) for d in pdf["data"]]
        *keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        n = n.astype(np.int64)
        key = keys[0] if kind == 1 else pair_hash(*keys)
        order = np.argsort(key)
        first = _runs(key[order])
        total = np.add.reduceat(n[order], first) if len(first) else n
        keys = [k[order[first]].view(np.int64) for k in keys]
        if kind == 1:
            return pd.DataFrame({"kind": 1, "h": np.zeros(len(total), np.int64), "w": keys[0], "n": total})
        rows = pd.DataFrame({"kind": 2, "h": keys[0], "w": keys[1], "n": total})
        small = np.bincount(total[total <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)
        return pd.concat([rows, pd.DataFrame({"kind": 3, "h": 0, "w": small, "n": np.arange(len(small))})])

    dealt = texts.select("text").mapInArrow(deal, "bucket int, kind int, data binary")
    return dealt.groupBy("bucket", "kind").applyInPandas(add, "kind int, h long, w long, n long")


def good_turing(of_count: dict[int, int]) -> list[float]:
    """Discounts of counts 0 to DISCOUNTED; larger counts keep all.

    Katz's formula where it gives shares between 0 and 1, and else three quarters less a count.
    """
    n = [of_count.get(r, 0) for r in range(DISCOUNTED + 2)]
    plain = [0.0] + [(r - 0.75) / r for r in range(1, DISCOUNTED + 1)]
    if all(n[1:]):
        tail = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1]
        found = [0.0] + [((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) if tail < 1 else 0.0 for r in range(1, DISCOUNTED + 1)]
        if all(0 < d < 1 for d in found[1:]):
            plain = found
    return plain


def _discounted(n: Column, shares: list[float]) -> Column:
    return F.when(n <= DISCOUNTED, F.element_at(F.array(*map(F.lit, shares)), (F.least(n, F.lit(DISCOUNTED)) + 1).cast("int")) * n).otherwise(n.cast("double"))


@dataclass
class Katz:
    """The written tables: of words (w, n, log_p, log_weight) and, a table a part, of bigrams (h, w, n, gain): what the bigram's log P has above that of backing off."""

    words: DataFrame
    parts: list[DataFrame]
    tokens: int
    types: int
    unknown: float

    @property
    def bigrams(self) -> DataFrame:
        return reduce(DataFrame.unionAll, self.parts)


def fit(docs: DataFrame, train: Column | None = None, text_col: str = "text") -> Katz:
    """Learn from all rows that ``train`` admits; a null text has no words, only an end."""
    spark = docs.sparkSession
    texts = docs.where(train if train is not None else F.lit(True)).select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    counts = written(count_ngrams(texts, bucket_count(spark)), "katz-counts")
    begin = int(np.uint64(BEGIN).astype(np.int64))
    unigrams = counts.where("kind = 1").select("w", "n")
    events = unigrams.where(F.col("w") != begin)
    tokens, types = events.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    of_one = {r["n"]: r["types"] for r in events.where(F.col("n") <= DISCOUNTED + 1).groupBy("n").agg(F.count("*").alias("types")).collect()}
    of_two = {r["n"]: r["types"] for r in counts.where("kind = 3").groupBy("n").agg(F.sum("w").alias("types")).collect()}
    one, two = good_turing(of_one), good_turing(of_two)
    lost = sum((1 - one[r]) * r * of_one.get(r, 0) for r in range(1, DISCOUNTED + 1))
    if not lost:  # no small counts: the unknown word is one more event
        lost, scale = 1.0, tokens + 1.0
    else:
        scale = float(tokens)
    unknown = lost / scale
    p = F.when(F.col("w") == begin, F.lit(0.0)).otherwise(_discounted(F.col("n"), one) / scale)
    priors = written(unigrams.select("w", "n", p.alias("p")), "katz-unigrams")
    kept = _discounted(F.col("pair_n"), two)
    counted = counts.where("kind = 2").select("h", "w", F.col("n").alias("pair_n"))
    pairs = [written(_of_part(counted, part).join(priors.select("w", "p"), "w").select("h", "w", "pair_n", "p"), "katz-pairs") for part in range(PARTS)]
    discard(counts)
    history = reduce(DataFrame.unionAll, pairs).groupBy("h").agg(F.sum(kept).alias("kept_sum"), F.sum("p").alias("p_sum"))
    history = history.join(priors.select(F.col("w").alias("h"), F.col("n").alias("h_n")), "h")
    whole = F.when(F.col("kept_sum") < F.col("h_n"), F.col("h_n").cast("double")).otherwise(F.col("h_n") + 1.0)
    history = history.withColumn("whole", whole)
    weight = F.log10((1 - F.col("kept_sum") / F.col("whole")) / (1 - F.col("p_sum")))
    history = written(history.select("h", "whole", weight.alias("log_weight")), "katz-histories")
    words = priors.join(history.select(F.col("h").alias("w"), "log_weight"), "w", "left").select(
        "w", "n", F.when(F.col("p") > 0, F.log10("p")).otherwise(0.0).alias("log_p"), F.coalesce("log_weight", F.lit(0.0)).alias("log_weight"))
    words = written(words, "katz-words")
    discard(priors)
    gain = F.log10(kept / F.col("whole")) - F.log10("p") - F.col("log_weight")
    bigrams = []
    for own in pairs:
        bigrams.append(written(own.join(history, "h").select("h", "w", F.col("pair_n").alias("n"), gain.alias("gain")), "katz-bigrams"))
        discard(own)
    discard(history)
    return Katz(words, bigrams, tokens, types, math.log10(unknown))


def _model_blocks(table: DataFrame, kind: int, buckets: int) -> DataFrame:
    """A table's rows as (bucket, kind, flush, data), the keys of each block sorted."""

    def run(batches):
        held, n = [], 0

        def send():
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            key = columns[0].view(U64) if kind == 1 else pair_hash(columns[0].view(U64), columns[1].view(U64))
            order = np.argsort(key)
            key, values = key[order], [c[order] for c in columns[kind:]]
            cut = _cuts(key, buckets)
            for b in range(buckets):
                s, e = cut[b], cut[b + 1]
                if e > s:
                    yield [b, 0, 0, joined(spaced(key[s:e]), *(v[s:e] for v in values))]

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += len(batch)
            if n >= FLUSH_TOKENS // 2:
                yield from map(_block, send())
                held, n = [], 0
        if held:
            yield from map(_block, send())

    return table.mapInArrow(run, BLOCK)


BLOCK = "bucket int, part int, flush long, data binary"
_BLOCK = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("flush", pa.int64()), ("data", pa.binary())])


def _block(row: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)


def _entries(key: np.ndarray, row: np.ndarray, rows: int, buckets: int, flush: int):
    """Blocks of one flush: its distinct keys in order, how often each comes, and in which rows."""
    order = np.argsort(key)
    key, row = key[order], row[order]
    first = _runs(key)
    n = np.diff(np.append(first, len(key)))
    names = key[first]
    cut = _cuts(names, buckets)
    end = np.append(first, len(key))
    row = row.astype("<u2" if rows < 65536 else "<u4")
    for b in range(buckets):
        s, e = cut[b], cut[b + 1]
        if e > s:
            yield _block([b, 1, flush, joined(spaced(names[s:e]), _small(n[s:e]), row[end[s] : end[e]])])


def score(docs: DataFrame, model: Katz, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, kept columns, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Scores are log10 probabilities of the text's tokens and its end. A null or empty text
    has the end alone. Repeated rows get a row each. A model of no text knows no token:
    its base gives each one the same share, and the model all of it to the unknown word.
    ``base_score`` adds a half to each count of a word and of one unknown word.

    The documents are read once for the words and once for each part of the bigrams, and must come in the same order
    each time, as they do from files: sums are kept by place. If their texts come in another order, that is an error.
    """
    table = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), F.col(id_col).alias("doc_id"), *keep)
    rest = table.drop("_text").schema
    space = model.tokens + 0.5 * (model.types + 1)
    unknown, train_tokens = (math.log10(0.5 / space), model.unknown), model.tokens

    def deal(batches, part):
        """Of the words, with the other columns, or of a part of the bigrams; each flush with a digest of its texts."""
        from pyspark import TaskContext

        flush = TaskContext.get().partitionId() << 32
        for seq, row, parts in _flushes(batches):
            n = int(row[-1]) + 1
            digest = struct.pack("<I", zlib.crc32(seq))
            if part is None:
                info = pa.Table.from_batches(parts).combine_chunks()
                info = info.append_column("n_tokens", pa.array(np.bincount(row, minlength=n) - 1))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, info.schema) as out:
                    out.write_table(info)
                yield _block([-1, 1, flush, digest + sink.getvalue().to_pybytes()])
                del info, sink, parts
                yield from _entries(seq, row, n, WORD_BUCKETS, flush)
            else:
                yield _block([-1, 1, flush, digest])
                del parts
                at = np.flatnonzero(row[1:] == row[:-1])
                at = at[pair_part(seq[at], seq[at + 1]) == part]
                key, row = pair_hash(seq[at], seq[at + 1]), row[at]
                del seq, at
                yield from _entries(key, row, n, PAIR_BUCKETS // PARTS, flush)
            flush += 1

    def look_up(batches, of_words):
        bucket, held, keys, values = None, [], None, []
        for batch in batches:
            for i in range(len(batch)):
                own, part, flush, data = (c[i].as_py() for c in batch.columns)
                if own != bucket:
                    bucket, held, keys = own, [], None
                if own < 0:
                    yield _block([0, -1, flush, data])
                    continue
                if part == 0:
                    key, *rest_of = parted(data)
                    held.append([placed(key), *rest_of])
                    continue
                if keys is None:
                    columns = [np.concatenate(x) for x in zip(*held, strict=True)] if held else [np.zeros(0, U64), np.zeros(0), np.zeros(0)]
                    order = np.argsort(columns[0])
                    keys, values, held = columns[0][order], [c[order] for c in columns[1:]], []
                names, n, row = parted(data)
                names = placed(names)
                at = np.searchsorted(keys, names)
                at[at == len(keys)] = 0
                known = keys[at] == names if len(keys) else np.zeros(len(names), bool)
                if of_words:
                    event = names != U64(BEGIN)
                    base = np.where(event, unknown[0], 0.0)
                    full = np.where(event, unknown[1], 0.0)
                    base[known & event] = np.log10((values[0][at[known & event]] + 0.5) / space)
                    full[known] = values[1][at[known]]
                    sums = [full, base, (known & event).astype(float)]
                else:
                    sums = [np.where(known, values[0][at] if len(keys) else 0.0, 0.0)]
                    if not known.any():
                        continue
                out = [np.bincount(row, np.repeat(s, n)) for s in sums]
                yield _block([0, len(out), flush, joined(*out)])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        marks = [d for d, p in zip(pdf["data"], pdf["part"], strict=True) if p < 0]
        if len(marks) != 1 + PARTS or len({m[:4] for m in marks}) > 1:
            raise ValueError("the documents came in another order when they were read again")
        info = pa.ipc.open_stream(max(marks, key=len)[4:]).read_pandas()
        total = np.zeros((3, len(info)))
        for data, part in zip(pdf["data"], pdf["part"], strict=True):
            if part > 0:
                for k, s in enumerate(parted(data)):
                    total[k, : len(s)] += s
        return info.assign(n_known=total[2].round().astype(np.int64), train_tokens=train_tokens, base_score=total[1], score=total[0])

    words = model.words.select("w", F.col("n").cast("double"), F.col("log_p") + F.col("log_weight"))

    def looked_up(part: int | None, known: DataFrame, buckets: int) -> DataFrame:
        blocks = table.mapInArrow(lambda batches: deal(batches, part), BLOCK).unionAll(known)
        dealt = blocks.repartition(buckets, "bucket").sortWithinPartitions("bucket", "part", "flush")
        return written(dealt.mapInArrow(lambda batches: look_up(batches, part is None), BLOCK), "katz-sums", BATCH_BLOCKS)

    looked = [looked_up(None, _model_blocks(words, 1, WORD_BUCKETS), WORD_BUCKETS)]
    for part, bigrams in enumerate(model.parts):
        looked.append(looked_up(part, _model_blocks(bigrams.select("h", "w", "gain"), 2, PAIR_BUCKETS // PARTS), PAIR_BUCKETS // PARTS))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "n_tokens long, n_known long, train_tokens long, base_score double, score double"])
    return reduce(DataFrame.unionAll, looked).groupBy("flush").applyInPandas(add, schema)
