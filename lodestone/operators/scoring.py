"""Scores of a block of queries against batches of indexed documents.

Runs inside Spark tasks on Arrow batches. Only what ranks, or the range of the
scores, leaves a batch; single (query, document) scores never do.
"""

from __future__ import annotations

import sys
from zlib import crc32
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

DIGITS = 6
# Rows of a batch that are worked on at once; what is made of them is many times their size.
SLICE_ROWS = 1024
# Rows that a task brings together at a time: of documents that meet questions, and of terms.
CELL_ROWS = 2048
HELD_ROWS = 1 << 20


@dataclass(frozen=True)
class QueryBlock:
    """A bounded block of queries as arrays: who asks, term weights, unit vectors."""

    query_ids: pa.Array
    vocabulary: pa.Array  # distinct query terms
    first: np.ndarray  # where each vocabulary term's weights start; one more entry ends the last
    asker: np.ndarray  # query position of each weight
    weight: np.ndarray
    vectors: np.ndarray  # queries x dimensions; zeros where a query has no vector
    k1: float
    b: float
    mean_length: float

    def keyword(self, batch: pa.RecordBatch) -> np.ndarray:
        """BM25, documents x queries."""
        n, q = batch.num_rows, len(self.query_ids)
        lists = batch.column("terms")
        spans = np.diff(lists.offsets.to_numpy())
        doc = np.repeat(np.arange(n), spans)
        slot = pc.index_in(lists.flatten(), value_set=self.vocabulary)
        known = pc.is_valid(slot).to_numpy(zero_copy_only=False)
        slot = slot.drop_null().to_numpy()
        doc = doc[known]
        tf = batch.column("counts").flatten().to_numpy()[known].astype(float)
        length = batch.column("length").to_numpy()[doc]
        part = weights_of(tf, length, self.k1, self.b, self.mean_length)
        # Each matched term counts for every query that has it.
        askers = self.first[slot + 1] - self.first[slot]
        row = np.repeat(np.arange(len(slot)), askers)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(askers) - askers, askers)
        at = self.first[slot][row] + inner
        cell = doc[row] * q + self.asker[at]
        # Without any match bincount gives whole numbers, hence the cast.
        return np.bincount(cell, part[row] * self.weight[at], minlength=n * q).astype(float).reshape(n, q)

    def cosine(self, batch: pa.RecordBatch) -> np.ndarray:
        """Dot products of unit vectors, documents x queries; 0 where one side has none."""
        n, dims = batch.num_rows, self.vectors.shape[1]
        lists = batch.column("vector")
        scores = np.zeros((n, len(self.query_ids)))
        given = pc.is_valid(lists).to_numpy(zero_copy_only=False)
        if dims and given.any():
            matrix = lists.drop_null().flatten().to_numpy().reshape(-1, dims)
            scores[given] = matrix @ self.vectors.T
        return scores


def slices(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    return [batch.slice(first, SLICE_ROWS) for first in range(0, batch.num_rows, SLICE_ROWS)]


def stretch(scores: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Scores of each query moved to [0, 1] by that query's range; all zero if it has none."""
    span = high - low
    return np.where(span > 0, (scores - low) / np.where(span > 0, span, 1.0), 0.0)


def top_rows(block: QueryBlock, doc_ids: pa.Array, scores: np.ndarray, k: int) -> pa.RecordBatch:
    """The best ``k`` documents per query: highest rounded score, then smallest id."""
    by_id = pc.array_sort_indices(doc_ids).to_numpy()
    ranked = np.round(scores[by_id], DIGITS) + 0.0  # no negative zero
    best = np.argsort(-ranked, axis=0, kind="stable")[:k]
    position = np.tile(np.arange(scores.shape[1]), best.shape[0])
    return pa.RecordBatch.from_arrays([
        block.query_ids.take(pa.array(position)),
        doc_ids.take(pa.array(by_id[best].ravel())),
        pa.array(np.take_along_axis(ranked, best, axis=0).ravel()),
    ], names=["query_id", "doc_id", "score"])


def combined(block: QueryBlock, method: str, alpha: float, ranges):
    """The scoring function of a search method."""
    if method == "keyword":
        return block.keyword
    if method == "vector":
        return block.cosine
    v_low, v_high, k_low, k_high = ranges

    def hybrid(batch):
        near = stretch(block.cosine(batch), v_low, v_high)
        worded = stretch(block.keyword(batch), k_low, k_high)
        return alpha * near + (1 - alpha) * worded

    return hybrid


def best_of(found: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """The best ``k`` per query of several batches of scores."""
    rows = pa.Table.from_batches(found).sort_by([("query_id", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
    queries = rows["query_id"].combine_chunks()
    who = pc.index_in(queries, value_set=queries.unique()).to_numpy()
    place = np.arange(len(who)) - np.searchsorted(who, who)
    return rows.take(pa.array(np.flatnonzero(place < k))).combine_chunks().to_batches()[0]


def top_in_batches(block: QueryBlock, method: str, k: int, alpha: float, ranges):
    score = combined(block, method, alpha, ranges)

    def run(batches):
        for batch in batches:
            best = None
            for piece in slices(batch):
                found = top_rows(block, piece.column("doc_id"), score(piece), k)
                best = found if best is None else best_of([best, found], k)
            if best is not None:
                yield best

    return run


def cosines_in_batches(block: QueryBlock):
    """Every document's vector score for every query."""
    q = len(block.query_ids)

    def run(batches):
        for piece in (p for batch in batches for p in slices(batch)):
            n = piece.num_rows
            yield pa.RecordBatch.from_arrays([
                block.query_ids.take(pa.array(np.tile(np.arange(q), n))),
                piece.column("doc_id").take(pa.array(np.repeat(np.arange(n), q))),
                pa.array(block.cosine(piece).ravel()),
            ], names=["query_id", "doc_id", "score"])

    return run


def cosines_of_cell(documents: pa.Table, questions: pa.Table, *model: float) -> pa.Table:
    """Vector scores of a group's questions with all documents of a range."""
    run = cosines_in_batches(block_of(questions, *model))
    found = list(run(documents.combine_chunks().to_batches(max_chunksize=CELL_ROWS)))
    return pa.Table.from_batches(found) if found else pa.table(
        [questions["query_id"].slice(0, 0), documents["doc_id"].slice(0, 0), pa.array([], pa.float64())], names=["query_id", "doc_id", "score"])


def ranges_in_batches(block: QueryBlock):
    """Per batch and query: how many documents, and the smallest and largest scores."""

    def run(batches):
        for batch in batches:
            columns = None
            for piece in slices(batch):
                near, worded = block.cosine(piece), block.keyword(piece)
                own = [near.min(0), near.max(0), worded.min(0), worded.max(0)]
                columns = own if columns is None else [
                    least(a, b) for least, a, b in zip((np.minimum, np.maximum) * 2, columns, own, strict=True)]
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [block.query_ids, *(pa.array(c) for c in columns)],
                    names=["query_id", "v_low", "v_high", "k_low", "k_high"],
                )

    return run


def _lists(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """All values of a list column, and how many each row has."""
    whole = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return whole.flatten(), np.diff(whole.offsets.to_numpy())


def _chunk(blocks: pa.Table) -> bytes:
    """The blocks of a range and a bucket as one value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, blocks.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(blocks)
    return sink.getvalue().to_pybytes()


def chunked_blocks(batches, terms: pa.Array | None = None):
    """(bucket, term, range, docs, tfs, lengths, peak) of chunks (bucket, range, chunk), a row a block; only of ``terms`` if they are given."""
    for batch in batches:
        for bucket, span, chunk in zip(batch.column("bucket").to_pylist(), batch.column("range").to_pylist(), batch.column("chunk"), strict=True):
            for own in pa.ipc.open_stream(chunk.as_buffer()):
                if terms is not None:
                    own = own.filter(pc.is_in(own.column("term"), value_set=terms))
                numbers = [pa.array(np.full(own.num_rows, n, np.int32)) for n in (bucket, span)]
                yield pa.RecordBatch.from_arrays(
                    [numbers[0], own.column("term"), numbers[1], *own.columns[1:]], names=["bucket", "term", "range", "docs", "tfs", "lengths", "peak"])


def _rows_of(lists: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(lists)), lists)


def weights_of(tf: np.ndarray, length: np.ndarray, k1: float, b: float, mean_length: float) -> np.ndarray:
    """What a term gives a document's score, before idf."""
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean_length))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of texts in lower case, split as ``tokenize`` does, and how many each has."""
    lists = pc.utf8_split_whitespace(pc.replace_substring(texts, "_", " "))
    words = lists.flatten()
    some = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    edges = lists.offsets.to_numpy()
    so_far = np.append(0, np.cumsum(some))
    return words.filter(pa.array(some)), np.diff(so_far[edges - edges[0]])


def counted_words(batches):
    """(doc_id, length, terms, counts, ...) of (doc_id, w, ...): each text's distinct terms in order, and how often it has them."""
    for batch in batches:
        counted = []
        for piece in slices(batch):
            words, sizes = split_words(piece.column("w"))
            coded = words.dictionary_encode()
            n = max(1, len(coded.dictionary))
            sort = pc.array_sort_indices(coded.dictionary).to_numpy()
            place = np.empty(len(sort), np.int64)
            place[sort] = np.arange(len(sort))
            own, counts = np.unique(_rows_of(sizes) * n + place[coded.indices.to_numpy()], return_counts=True)
            edges = pa.array(np.searchsorted(own, np.arange(len(sizes) + 1) * n).astype(np.int32))
            terms = coded.dictionary.take(pa.array(sort[own % n]))
            counted.append(pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(edges, terms),
                pa.ListArray.from_arrays(edges, pa.array(counts.astype(np.int32))), *piece.columns[2:],
            ], names=["doc_id", "length", "terms", "counts", *piece.schema.names[2:]]))
        yield from counted


def buckets_of(terms: pa.Array, buckets: int) -> np.ndarray:
    """The bucket of each term, as ``bm25.bucket_of`` has it."""
    return np.fromiter(map(crc32, terms.cast(pa.binary()).to_pylist()), np.int64, len(terms)) % buckets


def range_blocks(documents: pa.Table, k1: float, b: float, mean_length: float, buckets: int) -> pa.Table:
    """The postings of a range of documents: (bucket, range, chunk), a row a bucket of terms.

    A chunk has a block (term, docs, tfs, lengths, peak) for each term, documents in order. To Spark it is one
    value, so that the work of shuffling and storing postings doesn't grow with the terms of each range.
    """
    documents = documents.sort_by("doc_id")
    terms, sizes = _lists(documents["terms"])
    coded = terms.dictionary_encode()
    doc = _rows_of(sizes)
    tf = _lists(documents["counts"])[0].to_numpy()
    length = documents["length"].to_numpy()[doc]
    n = len(coded.dictionary)
    bucket = buckets_of(coded.dictionary, buckets)
    by_bucket = np.argsort(bucket, kind="stable")
    place = np.empty(n, np.int64)
    place[by_bucket] = np.arange(n)
    keyed = np.sort(place[coded.indices.to_numpy()] << 32 | np.arange(len(doc)))  # faster than a stable argsort
    code, order = keyed >> 32, keyed & 0xFFFFFFFF
    doc, tf, length = doc[order], tf[order], length[order]
    first = np.searchsorted(code, np.arange(n + 1))
    peak = np.maximum.reduceat(weights_of(tf, length, k1, b, mean_length), first[:-1]) if n else np.zeros(0)
    edges = pa.array(first.astype(np.int32))
    named = documents["doc_id"].combine_chunks().take(pa.array(doc))
    blocks = pa.table([
        coded.dictionary.take(pa.array(by_bucket)), pa.ListArray.from_arrays(edges, named), pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32))),
        pa.ListArray.from_arrays(edges, pa.array(length.astype(np.int32))), pa.array(peak),
    ], names=["term", "docs", "tfs", "lengths", "peak"])
    own, start = np.unique(bucket[by_bucket], return_index=True)
    ends = np.append(start, n)[1:]
    chunks = [_chunk(blocks.slice(int(s), int(e - s))) for s, e in zip(start, ends, strict=True)]
    span = documents["range"][0].as_py() if documents.num_rows else 0
    return pa.table([pa.array(own.astype(np.int32)), pa.array(np.full(len(own), span, np.int32)), pa.array(chunks, pa.binary())], names=["bucket", "range", "chunk"])


def _highest(code: np.ndarray, weight: np.ndarray, terms: int, highs: int) -> pa.ListArray:
    """The highest weights of each term, highest first."""
    order = np.lexsort((-weight, code))
    n = np.bincount(code, minlength=terms)
    top = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n) < highs
    edges = pa.array(np.append(0, np.cumsum(np.minimum(n, highs))).astype(np.int32))
    return pa.ListArray.from_arrays(edges, pa.array(weight[order][top]))


def term_highs(batches, k1: float, b: float, mean_length: float, highs: int):
    """(term, n, best) of blocks (term, tfs, lengths): how many documents a batch has of a term, and the highest weights among them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column("term").dictionary_encode()
        tf, sizes = _lists(pa.chunked_array([batch.column("tfs")]))
        length = _lists(pa.chunked_array([batch.column("lengths")]))[0].to_numpy()
        code = np.repeat(coded.indices.to_numpy(), sizes)
        weight = weights_of(tf.to_numpy(), length, k1, b, mean_length)
        n = np.bincount(code, minlength=len(coded.dictionary))
        yield pa.RecordBatch.from_arrays(
            [coded.dictionary, pa.array(n.astype(np.int64)), _highest(code, weight, len(coded.dictionary), highs)],
            names=["term", "n", "best"])


def _block_highs(blocks: pa.RecordBatch, k1: float, b: float, mean_length: float, highs: int) -> pa.RecordBatch:
    """(term, n, best) of the blocks of a chunk, the highest weights of each in any order."""
    tf, sizes = _lists(pa.chunked_array([blocks.column("tfs")]))
    weight = weights_of(tf.to_numpy(), _lists(pa.chunked_array([blocks.column("lengths")]))[0].to_numpy(), k1, b, mean_length)
    ends, kept = np.cumsum(sizes), np.ones(len(weight), bool)
    for end, n in zip(ends[sizes > highs].tolist(), sizes[sizes > highs].tolist(), strict=True):
        kept[end - n + np.argpartition(weight[end - n : end], n - highs)[: n - highs]] = False
    edges = pa.array(np.append(0, np.cumsum(np.minimum(sizes, highs))).astype(np.int32))
    best = pa.ListArray.from_arrays(edges, pa.array(weight[kept]))
    return pa.RecordBatch.from_arrays([blocks.column("term"), pa.array(sizes.astype(np.int64)), best], names=["term", "n", "best"])


def chunk_highs(batches, k1: float, b: float, mean_length: float, highs: int):
    """(bucket, term, n, best) of chunks (bucket, chunk): how many documents have a term, and the highest weights among them, chunks of one bucket brought together."""
    bucket, held, rows = None, [], 0

    def whole():
        return whole_terms(pa.Table.from_batches(held), highs).rename_columns(["term", "n", "best"])

    for batch in batches:
        for own, chunk in zip(batch.column("bucket").to_pylist(), batch.column("chunk"), strict=True):
            if held and (own != bucket or rows >= HELD_ROWS):
                some = whole()
                if own != bucket or 2 * some.num_rows > rows:
                    yield from some.add_column(0, "bucket", pa.array(np.full(some.num_rows, bucket, np.int32))).to_batches(max_chunksize=CELL_ROWS * 4)
                    held, rows = [], 0
                else:
                    held, rows = some.to_batches(), some.num_rows
            bucket = own
            for blocks in pa.ipc.open_stream(chunk.as_buffer()):
                held.append(_block_highs(blocks, k1, b, mean_length, highs))
                rows += blocks.num_rows
    if held:
        some = whole()
        yield from some.add_column(0, "bucket", pa.array(np.full(some.num_rows, bucket, np.int32))).to_batches(max_chunksize=CELL_ROWS * 4)


def whole_terms(found: pa.Table, highs: int) -> pa.Table:
    """(term, df, highs) of what ``term_highs`` found of all blocks of a bucket."""
    coded = found["term"].combine_chunks().dictionary_encode()
    best, sizes = _lists(found["best"])
    own, n = coded.indices.to_numpy(), len(coded.dictionary)
    df = np.zeros(n, np.int64)
    np.add.at(df, own, found["n"].to_numpy())
    return pa.table([coded.dictionary, pa.array(df), _highest(np.repeat(own, sizes), best.to_numpy(), n, highs)], names=["term", "df", "highs"])


def best_places(scores: np.ndarray, k: int | None) -> np.ndarray:
    """Places of the ``k`` highest scores; of equal ones the first."""
    if k is None or len(scores) <= k:
        return np.arange(len(scores))
    last = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > last)
    return np.append(above, np.flatnonzero(scores == last)[: k - len(above)])


def score_cell(blocks: pa.Table, asked: pa.Table, k: int | None, k1: float, b: float, mean_length: float) -> pa.Table:
    """BM25 of a group's questions against the documents of a range, from the postings blocks of the asked terms.

    ``blocks``: term, docs, tfs, lengths, one row a term; ``asked``: query_id, term, weight.
    Rounded scores of the ``k`` best documents of each question, equal ones by id; all
    matching documents, not rounded, if ``k`` is None.
    """
    terms = blocks["term"].combine_chunks()
    docs, sizes = _lists(blocks["docs"])
    tf, length = (_lists(blocks[c])[0].to_numpy().astype(float) for c in ("tfs", "lengths"))
    part = weights_of(tf, length, k1, b, mean_length)
    ids = docs.unique()
    ids = ids.take(pc.array_sort_indices(ids))
    place = pc.index_in(docs, value_set=ids).to_numpy()
    ends = np.cumsum(sizes)
    asked = asked.append_column("slot", pc.index_in(asked["term"], value_set=terms)).filter(pc.is_valid(pc.field("slot")))
    order = pc.sort_indices(asked, sort_keys=[("query_id", "ascending"), ("term", "ascending")])
    asked = asked.take(order)
    queries = asked["query_id"].combine_chunks()
    names = queries.unique()
    who = pc.index_in(queries, value_set=names).to_numpy()
    slot, weight = asked["slot"].to_numpy(), asked["weight"].to_numpy()
    first = np.searchsorted(who, np.arange(len(names) + 1))
    asker, found, scores = [], [], []
    total = np.zeros(len(ids))
    for q in range(len(names)):
        spans = [slice(ends[s] - sizes[s], ends[s]) for s in slot[first[q] : first[q + 1]]]
        for span, w in zip(spans, weight[first[q] : first[q + 1]]):
            total[place[span]] += part[span] * w  # a document comes once in a block
        own = np.unique(np.concatenate([place[span] for span in spans]))
        score = total[own]
        total[own] = 0.0
        if k is not None:
            score = np.round(score, DIGITS) + 0.0
            best = best_places(score, k)
            own, score = own[best], score[best]
        asker.append(np.full(len(own), q))
        found.append(own)
        scores.append(score)
    empty = [np.zeros(0, np.int64)]
    return pa.table([
        names.take(pa.array(np.concatenate(asker or empty))), ids.take(pa.array(np.concatenate(found or empty))),
        pa.array(np.concatenate(scores or [np.zeros(0)])),
    ], names=["query_id", "doc_id", "score"])


def block_of(rows: pa.Table, k1: float, b: float, mean_length: float) -> QueryBlock:
    """A block of queries from rows of (query_id, terms, weights, unit, ...)."""
    rows = rows.sort_by("query_id")
    query_ids = rows["query_id"].combine_chunks()
    units = rows["unit"].to_pylist()
    dims = max((len(u) for u in units if u is not None), default=0)
    matrix = np.array([u if u is not None else [0.0] * dims for u in units]).reshape(len(units), dims)
    terms, sizes = _lists(rows["terms"])
    weight = _lists(rows["weights"])[0].to_numpy()
    asker = np.repeat(np.arange(len(query_ids)), sizes)
    vocabulary = terms.unique()
    slots = pc.index_in(terms, value_set=vocabulary).to_numpy()
    order = np.argsort(slots, kind="stable")
    return QueryBlock(
        query_ids=query_ids, vocabulary=vocabulary, first=np.searchsorted(slots[order], np.arange(len(vocabulary) + 1)),
        asker=asker[order], weight=weight[order], vectors=matrix, k1=k1, b=b, mean_length=mean_length,
    )




def ranges_of_cell(documents: pa.Table, questions: pa.Table, *model: float) -> pa.Table:
    """Score ranges of a group's questions over the documents of a range."""
    run = ranges_in_batches(block_of(questions, *model))
    found = list(run(documents.combine_chunks().to_batches(max_chunksize=CELL_ROWS)))
    none = pa.array([], pa.float64())
    return pa.Table.from_batches(found) if found else pa.table(
        [questions["query_id"].slice(0, 0), none, none, none, none], names=["query_id", "v_low", "v_high", "k_low", "k_high"])


def best_of_cell(documents: pa.Table, questions: pa.Table, method: str, k: int, alpha: float, *model: float) -> pa.Table:
    """The best ``k`` documents of a range for each of a group's questions; for hybrid these have their score ranges."""
    spans = None
    if method == "hybrid":
        ordered = questions.sort_by("query_id")
        spans = [ordered[c].to_numpy() for c in ("v_low", "v_high", "k_low", "k_high")]
    run = top_in_batches(block_of(questions, *model), method, k, alpha, spans)
    found = list(run(documents.combine_chunks().to_batches(max_chunksize=CELL_ROWS))) if questions.num_rows else []
    return pa.Table.from_batches(found) if found else pa.table(
        [questions["query_id"].slice(0, 0), documents["doc_id"].slice(0, 0), pa.array([], pa.float64())], names=["query_id", "doc_id", "score"])


# Tasks get these functions by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
