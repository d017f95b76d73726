"""Benchmark decontamination by winnowing.

A text's fingerprints are the hashes of its word k-grams that are the smallest of
some sliding window of consecutive k-grams. Texts that share ``window`` words share a
window of ``window - k + 1`` k-grams, hence its smallest: no such span is missed.
Fingerprints of documents meet those of the benchmark, and each hit is extended word
by word; a hit that does not grow to a whole window is dropped.

The benchmark is a stated query set. It goes to the tasks in blocks of bounded size,
so documents are read once a block and never shuffled, however common a passage is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import NOT_WORD, U64, Words, mixed, release, shingle_hashes, slices, utf8, written

WINDOW = 10
GRAM = 5
#: Bytes of benchmark text in a block, unless one item alone has more.
BLOCK_BYTES = 16 << 20
#: Matches of fingerprints that are extended at a time, but for those of one place in a document.
MATCHES = 1 << 20


def winnow(hashes: np.ndarray, rows: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the k-grams kept: the last smallest of each whole window of words."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    grams = shingle_hashes(hashes, gram)
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, window - gram + 1):
        lower = grams[j : j + n] <= least
        np.copyto(least, grams[j : j + n], where=lower)
        np.copyto(at, np.arange(j, j + n), where=lower)
    kept = np.zeros(len(grams), bool)
    kept[at[rows[:n] == rows[window - 1 :]]] = True
    at = np.flatnonzero(kept)
    return at, grams[at]


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges [first, last): the range each element comes from, and the element."""
    count = last - first
    which = np.repeat(np.arange(len(first)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)


@dataclass
class Block:
    """Some benchmark items, indexed by their fingerprints; short items by their whole hash."""

    ids: list
    words: np.ndarray
    starts: np.ndarray
    prints: np.ndarray
    print_at: np.ndarray
    print_item: np.ndarray
    short: dict

    @classmethod
    def of(cls, ids: list, texts: list, gram: int, window: int) -> Block:
        raw, at, _ = utf8(pa.array(texts, pa.string()))
        w = Words(raw, at, NOT_WORD)
        rows = w.rows()
        position, prints = winnow(w.hashes, rows, gram, window)
        # places of one item with the same words as far as a hit is extended find the same: one of them is kept
        around = _context(w, rows, position, gram, window - gram)
        order = np.lexsort((around, rows[position], prints))
        alike = [x[order] for x in (prints, rows[position], around)]
        first = np.ones(len(order), bool)
        first[1:] = np.any([x[1:] != x[:-1] for x in alike], axis=0)
        order = order[first]
        short = {}
        for n in np.unique(w.counts[(w.counts > 0) & (w.counts < window)]).tolist():
            items = np.flatnonzero(w.counts == n)
            whole = shingle_hashes(w.hashes, n)[w.starts[items]]
            by = np.argsort(whole, kind="stable")
            short[n] = (whole[by], items[by])
        return cls(ids, w.hashes, w.starts, prints[order], position[order], rows[position][order], short)

    def hits(self, w: Words, gram: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spans [from, to) of words of ``w``, and the item that each comes from, some matches at a time."""
        rows = w.rows()
        position, prints = winnow(w.hashes, rows, gram, window)
        low, high = np.searchsorted(self.prints, prints, "left"), np.searchsorted(self.prints, prints, "right")
        upto = np.cumsum(high - low)
        spans, first = [np.zeros((3, 0), np.int64)], 0
        while first < len(position):
            done = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, done + MATCHES, "right")))
            some = self._extended(w, rows, position[first:last], low[first:last], high[first:last], gram, window)
            spans.append(np.unique(some, axis=1) if some.shape[1] else some)
            first = last
        return tuple(np.concatenate([np.concatenate(spans, axis=1), *self._whole_short(w, rows)], axis=1))

    def _extended(self, w: Words, rows, position, low, high, gram: int, window: int) -> np.ndarray:
        """(from, to, item) of the matches of fingerprints that extend to a window."""
        which, entry = _spread(low, high)
        d, b, item = position[which], self.print_at[entry], self.print_item[entry]
        row = rows[d]
        reach = window - gram
        left, right = np.zeros(len(d), np.int64), np.zeros(len(d), np.int64)
        same = np.ones(len(d), bool)
        for j in range(gram):
            same &= w.hashes[d + j] == self.words[b + j]
        for side, step, grown in ((-1, 0, left), (1, gram - 1, right)):
            going = same.copy()
            for j in range(1, reach + 1):
                x, y = d + step + side * j, b + step + side * j
                going &= (x >= w.starts[row]) & (x < w.starts[row + 1]) & (y >= self.starts[item]) & (y < self.starts[item + 1])
                ok = np.flatnonzero(going)
                going[ok] = w.hashes[x[ok]] == self.words[y[ok]]
                grown += going
        found = same & (left + gram + right >= window)
        return np.stack([(d - left)[found], (d + gram + right)[found], item[found]])

    def _whole_short(self, w: Words, rows) -> list[np.ndarray]:
        """(from, to, item) of whole items shorter than a window."""
        out = []
        for n, (whole, items) in self.short.items():
            last = len(w.hashes) - n + 1
            if last <= 0:
                continue
            grams = shingle_hashes(w.hashes, n)
            inside = np.flatnonzero(rows[:last] == rows[n - 1 :])
            which, entry = _spread(np.searchsorted(whole, grams[inside], "left"), np.searchsorted(whole, grams[inside], "right"))
            at = inside[which]
            out.append(np.stack([at, at + n, items[entry]]))
        return out


def _context(w: Words, rows: np.ndarray, position: np.ndarray, gram: int, reach: int) -> np.ndarray:
    """A hash of the words from ``reach`` before a gram to ``reach`` after it, within its text."""
    out = np.zeros(len(position), U64)
    row = rows[position]
    for j in range(-reach, gram + reach):
        at = position + j
        inside = (at >= w.starts[row]) & (at < w.starts[row + 1])
        word = np.zeros(len(position), U64)
        word[inside] = w.hashes[at[inside]]
        out = mixed(out * U64(0xD6E8FEB86659FD93) + word)
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Item ids as text and texts, block by block, each read by its own job."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where(F.length("text") > 0)
    weight = F.octet_length("text") + 64
    total = items.agg(F.sum(weight)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    while n > 1:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
        size = dealt.groupBy("block").agg(F.sum(weight).alias("size"), F.countDistinct("id", "text").alias("n"))
        if size.where((F.col("size") > block_bytes) & (F.col("n") > 1)).isEmpty():
            break
        n *= 2
    for block in range(n):
        chosen = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block).distinct().collect()
        yield n, [r["id"] for r in chosen], [r["text"] for r in chosen]


RESULT = "n_words long, spans array<array<long>>, items array<string>"


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = (),
                  gram: int = GRAM, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, kept columns, n_words, spans, items, n_hit) for every row of ``docs``.

    A-Z count as a-z; words are runs of letters, digits and non-ASCII characters. A span
    [from, to) of words is hit if it is ``window`` consecutive words of an item, or a
    whole item of fewer. ``spans`` are joined and in order; ``items`` are the ids found,
    as text, sorted by code point, each once; an item without id hits but isn't listed.
    Null and empty texts have no words and no hits; items without words find nothing;
    repeated rows get a row each. Other columns are not looked at. However often a word or
    passage repeats within a text, work grows with the text: equal places of an item are one.
    """
    kept = [F.col(c) for c in keep]
    table = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"), *kept,
                        F.lit(None).cast("long").alias("n_words"), F.array().cast("array<array<long>>").alias("spans"),
                        F.array().cast("array<string>").alias("items"))
    schema = table.schema
    context = docs.sparkSession.sparkContext
    for count, ids, texts in _blocks(benchmark, item_col, item_text_col, block_bytes):
        sent = context.broadcast(Block.of(ids, texts, gram, window))
        table = table.mapInArrow(_scan(sent, gram, window), schema)
        if count > 1:
            table = written(table, "decontaminate")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return table.select("doc_id", *keep, "n_words", "spans", "items", hit.alias("n_hit"))


def _scan(sent, gram: int, window: int):
    def run(batches):
        release()
        block: Block = sent.value
        for batch in batches:
            names = batch.schema.names
            raw, at, _ = utf8(batch.column(names.index("_text")))
            n_words = np.zeros(len(batch), np.int64)
            spans = batch.column(names.index("spans")).to_pylist()
            items = batch.column(names.index("items")).to_pylist()
            for first, last in slices(at):
                w = Words(raw[at[first] : at[last]], at[first : last + 1] - at[first], NOT_WORD)
                n_words[first:last] = w.counts
                lo, hi, item = block.hits(w, gram, window)
                if not len(lo):
                    continue
                depth = np.zeros(len(w.hashes) + 1, np.int64)
                np.add.at(depth, lo, 1)
                np.add.at(depth, hi, -1)
                inside = np.cumsum(depth)[:-1] > 0
                row = w.rows()
                edge = np.ones(len(inside), bool)
                edge[1:] = (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])
                begin = np.flatnonzero(edge)
                for s, e in zip(begin, np.append(begin[1:], len(inside)), strict=True):
                    if inside[s]:
                        r = first + row[s]
                        spans[r] = spans[r] + [[int(s - w.starts[row[s]]), int(e - w.starts[row[s]])]]
                pairs = np.unique(row[lo] * len(block.ids) + item)
                for r, i in zip((first + pairs // len(block.ids)).tolist(), (pairs % len(block.ids)).tolist(), strict=True):
                    if block.ids[i] is not None:
                        items[r] = items[r] + [block.ids[i]]
            columns = dict(zip(names, batch.columns, strict=True))
            columns["n_words"] = pa.array(n_words)
            columns["spans"] = pa.array([_joined(s) for s in spans], pa.list_(pa.list_(pa.int64())))
            columns["items"] = pa.array([sorted(set(i)) for i in items], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return run


def _joined(spans: list) -> list:
    out: list = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out
