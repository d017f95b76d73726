"""Alignment of two tokenizers' ids by byte offsets.

Both tokenizers' tokens cover the same bytes. Each side's cumulative ends go into a
dictionary from end to index; the keys both have, sorted, are where both end a token, and
slice both id lists into groups. The tokens of a group that share bytes are linked. How
often a pair of ids is linked in the whole corpus says how good a link is.

Ids and links are made once, by blocks of whole documents, and written: a block's
dictionary of linked pairs with their counts, and each document's links as numbers of that
dictionary. The dictionaries are added up over all blocks, a block gets back the totals of
its own pairs, and its documents' links are looked up there. So what is shuffled for counting is
a row a distinct pair of a block, and no task holds more than a block and its pairs.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import KEPT, release, slices, utf8, written
from lodestone.llm.pieces import (
    JOINED, MAYBE_SPACE, Cuts, PieceIndex, Ragged, before_first_space, before_last_space, grown, ids_of, no_cuts, tokenizers_file,
)

#: Bytes of text in a block, but for a single longer document.
BLOCK_BYTES = 1 << 24
#: Bytes of text that are aligned at a time, but for a single longer document.
SLICE = 1 << 21
SPACE_MARK = "▁"
#: Fixed by byte-level vocabularies: these bytes stand for themselves, the others for the characters from 256 on, in order.
PLAIN_BYTES = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))


def byte_level_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """A tokenizer with the bytes of each of its tokens; ``encode`` gives the ids of texts that begin with a space."""

    def __init__(self, token_bytes: list[bytes], encode, cuts: Cuts):
        self.token_bytes, self.encode, self.cuts = token_bytes, encode, cuts
        self.length = np.array([len(t) for t in token_bytes], np.int64)

    def _whole(self, ids: list[int], text: bytes) -> bool:
        return b"".join([self.token_bytes[i] for i in ids]) == text

    def of_pieces(self, pieces: list[bytes], joinable: list[bool]) -> tuple[list, list[bool]]:
        """The ids of each piece, and whether their bytes are the piece's.

        Joinable pieces go to the library many at a time as one text, whose ids are parted
        by their bytes; where these are not the text's, its pieces are encoded one by one.
        """
        out: list = [None] * len(pieces)
        own = [i for i, fits in enumerate(joinable) if fits]
        chunks = [own[i : i + JOINED] for i in range(0, len(own), JOINED)]
        texts = [b"".join([pieces[i] for i in chunk]) for chunk in chunks]
        for chunk, text, ids in zip(chunks, texts, self.encode([t.decode() for t in texts]), strict=True):
            if not self._whole(ids, text):
                continue
            ends = np.cumsum(self.length[ids])
            stops = np.cumsum([len(pieces[i]) for i in chunk])
            upto = np.searchsorted(ends, stops)
            if len(ends) and np.array_equal(ends[upto], stops):
                first = 0
                for i, last in zip(chunk, (upto + 1).tolist(), strict=True):
                    out[i], first = ids[first:last], last
        fine = [ids is not None for ids in out]
        alone = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(alone, self.encode([pieces[i].decode() for i in alone]), strict=True):
            out[i], fine[i] = ids, self._whole(ids, pieces[i])
        return out, fine


def byte_level_side(path: str) -> Side:
    """A byte-level BPE file of the tokenizers library; special tokens' strings are plain text.

    Where its pre-tokenizer is the plain byte-level one without normalizer, texts may be cut at spaces.
    """
    tokenizer = tokenizers_file(path, special_as_text=True)
    to_byte = byte_level_bytes()
    entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
    token_bytes = [bytes(map(to_byte.__getitem__, e)) if all(c in to_byte for c in e) else e.encode() for e in entries]
    spec = json.loads(tokenizer.to_str())
    before = spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    return Side(token_bytes, lambda texts: ids_of(tokenizer, texts), before_last_space if plain else no_cuts)


def sentence_side(path: str) -> Side:
    """A SentencePiece model that puts a space before a text; the space that a text here begins with is taken off.

    Where no token has a space mark after another character, texts may be cut at spaces.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    entries = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    token_bytes = [bytes([int(e[3:5], 16)]) if model.is_byte(i) else e.replace(SPACE_MARK, " ").encode() for i, e in enumerate(entries)]
    inner = any(SPACE_MARK in e.lstrip(SPACE_MARK) for e in entries)
    return Side(token_bytes, lambda texts: model.encode([t[1:] for t in texts], num_threads=1), no_cuts if inner else before_first_space)


def common_ends(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], list[int]]:
    """The indices, on both sides, of the tokens that end where a token of the other side ends, in order."""
    a_at = dict(zip(a_ends, range(len(a_ends))))
    b_at = dict(zip(b_ends, range(len(b_ends))))
    both = sorted(a_at.keys() & b_at.keys())
    return list(map(a_at.__getitem__, both)), list(map(b_at.__getitem__, both))


def linked(a_size: np.ndarray, b_size: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index pairs of tokens that share bytes, slice by slice; a slice has ``a_size`` and ``b_size`` tokens.

    Where one side of a slice has one token, all of the other's are linked with it. In other
    slices no end but the last is common, so each end of either side begins one more link.
    """
    n = a_size + b_size - 1
    group = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    a_first, b_first = np.cumsum(a_size) - a_size, np.cumsum(b_size) - b_size
    a = a_first[group] + np.where(a_size[group] > 1, step, 0)
    b = b_first[group] + np.where(b_size[group] > 1, step, 0)
    many = np.flatnonzero((a_size > 1) & (b_size > 1))
    if len(many):
        place = np.flatnonzero(((a_size > 1) & (b_size > 1))[group])
        a_own = np.repeat(a_first[many], a_size[many]) + _within(a_size[many])
        b_own = np.repeat(b_first[many], b_size[many]) + _within(b_size[many])
        ends = np.unique(np.concatenate([a_ends[a_own], b_ends[b_own]]))
        a[place] = a_own[np.searchsorted(a_ends[a_own], ends)]
        b[place] = b_own[np.searchsorted(b_ends[b_own], ends)]
    return a, b


def _within(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class _Numbers:
    """Decimal text of ids with a separator after it, gathered into group texts."""

    SEPARATORS = b",|;"

    def __init__(self, size: int):
        digits = [b"%d" % i for i in range(size)]
        self.width = np.array([len(d) for d in digits], np.int64)
        self.first = np.cumsum(self.width) - self.width
        self.data = np.frombuffer(b"".join(digits), np.uint8)

    def text(self, ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids as text, each with its separator after it, and where each id's text ends."""
        width = self.width[ids] + 1
        ends = np.cumsum(width)
        at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - width, width)
        digit = np.repeat(self.first[ids], width) + at
        out = self.data[np.minimum(digit, len(self.data) - 1)]
        out[ends - 1] = np.frombuffer(self.SEPARATORS, np.uint8)[separators]
        return out, ends


def group_texts(a_ids, b_ids, a_size, b_size, numbers: _Numbers) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;`` for every group, one after another, and where each group's text ends."""
    n = a_size + b_size
    first = np.cumsum(n) - n
    a_place = np.repeat(first, a_size) + _within(a_size)
    b_place = np.repeat(first + a_size, b_size) + _within(b_size)
    ids, marks = np.zeros(int(n.sum()), np.int64), np.zeros(int(n.sum()), np.int8)
    ids[a_place], ids[b_place] = a_ids, b_ids
    marks[first + a_size - 1], marks[first + n - 1] = 1, 2
    text, ends = numbers.text(ids, marks)
    return text, ends[first + n - 1]


class AlignedPieces(PieceIndex):
    """The alignment of distinct pieces: where both tokenizers cut, both end a token, so a text's groups and links are its pieces'."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.decimal = _Numbers(max(len(a.length), len(b.length)))
        super().__init__(lambda raw: a.cuts(raw) & b.cuts(raw))

    def clear(self) -> None:
        super().clear()
        self.links, self.texts = Ragged(np.int64), Ragged(np.uint8)
        self.counts = np.zeros((1 << 12, 3), np.int64)  # tokens of A, of B, groups
        self.fine = np.zeros(1 << 12, bool)

    def learn(self, new: list[bytes]) -> None:
        # pieces that begin at a cut of both sides when they are joined, and leave the next one at such a cut
        starts = INNER_START
        joinable = [len(p) > 1 and p[0] == 0x20 and p[1] in starts and p[-1] != 0x20 for p in new]
        a_own, a_fine = self.a.of_pieces(new, joinable)
        b_own, b_fine = self.b.of_pieces(new, joinable)
        fine = np.array(a_fine) & np.array(b_fine)
        a_own, b_own = ([ids if ok else [] for ids, ok in zip(own, fine.tolist(), strict=True)] for own in (a_own, b_own))
        n_a, n_b = (np.fromiter(map(len, own), np.int64, len(own)) for own in (a_own, b_own))
        a_ids, b_ids = (np.fromiter(chain.from_iterable(own), np.int64) for own in (a_own, b_own))
        a_ends, b_ends = np.cumsum(self.a.length[a_ids]), np.cumsum(self.b.length[b_ids])
        # the pieces one after another: a piece's end is an end of both sides
        a_cuts, b_cuts = common_ends(a_ends.tolist(), b_ends.tolist())
        a_size, b_size = np.diff(a_cuts, prepend=-1), np.diff(b_cuts, prepend=-1)
        n_groups = np.diff(np.searchsorted(a_cuts, np.append(0, np.cumsum(n_a))))
        left, right = linked(a_size, b_size, a_ends, b_ends)
        text, upto = group_texts(a_ids, b_ids, a_size, b_size, self.decimal)
        known = len(self.index)
        self.counts, self.fine = grown(self.counts, known + len(new)), grown(self.fine, known + len(new))
        self.counts[known : known + len(new)] = np.stack([n_a, n_b, n_groups], axis=1)
        self.fine[known : known + len(new)] = fine
        self.links.add((a_ids[left] << 32) | b_ids[right], n_a + n_b - n_groups)
        self.texts.add(text, np.diff(np.append(0, upto)[np.append(0, np.cumsum(n_groups))]))

    def align(self, texts: pa.Array) -> Aligned:
        raw, offsets, _ = utf8(pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), ""))
        piece, upto = self.numbers(raw, offsets)
        row = np.repeat(np.arange(len(texts)), np.diff(upto))
        fine = (np.bincount(row, ~self.fine[piece], len(texts)) == 0) & (np.diff(offsets) > 1)
        piece, row = piece[fine[row]], row[fine[row]]
        counts = self.counts[piece]
        n_a, n_b, n_groups = (np.bincount(row, counts[:, i], len(texts)).astype(np.int64) for i in range(3))
        links, _ = self.links.gather(piece)
        data, size = self.texts.gather(piece)
        edge = np.append(0, np.cumsum(np.bincount(row, size, len(texts)))).astype(np.int64).tolist()
        sha = [hashlib.sha256(data[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(edge, edge[1:], strict=False)]
        return Aligned(n_a, n_b, n_groups, n_a + n_b - n_groups, links, sha)


@dataclass
class Aligned:
    """The alignment of some consecutive texts: numbers of each, all links as pairs of ids in order, and hashes of the groups."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    sha: list[str]


def aligner(a_path: str, b_path: str) -> AlignedPieces:
    """The worker's, which lasts until a task of another kind comes."""
    name = f"{a_path}|{b_path}"
    release(but=name)
    if name not in KEPT:
        KEPT[name] = AlignedPieces(byte_level_side(a_path), sentence_side(b_path))
    return KEPT[name]


def packed(values: np.ndarray) -> bytes:
    """Small whole numbers in as few bytes each as the largest needs; the first byte is that width."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


#: Bytes after a space at which both kinds of tokenizers cut.
INNER_START = frozenset(np.flatnonzero(~MAYBE_SPACE).tolist())
KEYS = ["n_a", "n_b", "n_groups", "n_links"]


def _block_rows(block: int, ids: pa.Array, parts: list[Aligned]) -> list[pa.RecordBatch]:
    """Rows of the documents of a block with their links packed, and rows of its dictionary of pairs."""
    own = [np.unique(p.links, return_inverse=True) for p in parts]
    pairs = np.unique(np.concatenate([u for u, _ in own]))
    total = np.zeros(len(pairs), np.int64)
    codes, times = [], []
    for part, (few, code) in zip(parts, own, strict=True):
        code = np.searchsorted(pairs, few)[code]
        total += np.bincount(code, minlength=len(pairs))
        first = np.append(0, np.cumsum(part.n_links))
        for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            kinds, often = np.unique(code[s:e], return_counts=True)
            codes.append(packed(np.diff(kinds, prepend=0)))
            times.append(packed(often))
    n, m = len(ids), len(pairs)
    numbers = {k: pa.array(np.concatenate([getattr(p, k) for p in parts])) for k in KEYS}
    docs = pa.RecordBatch.from_arrays([
        pa.array(np.full(n, block)), pa.array(np.zeros(n, bool)), ids, *numbers.values(), pa.array([s for p in parts for s in p.sha], pa.string()),
        pa.array(codes, pa.binary()), pa.array(times, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
    ], names=COLUMNS)
    dictionary = pa.RecordBatch.from_arrays([
        pa.array(np.full(m, block)), pa.array(np.ones(m, bool)), pa.nulls(m, ids.type), *[pa.nulls(m, pa.int64())] * len(KEYS), pa.nulls(m, pa.string()),
        pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.array(pairs), pa.array(np.arange(m)), pa.array(total),
    ], names=COLUMNS)
    return [docs, dictionary]


COLUMNS = ["block", "is_pair", "doc_id", *KEYS, "groups_sha256", "codes", "times", "pair", "code", "n"]
SCHEMA = ("block long, is_pair boolean, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "codes binary, times binary, pair long, code long, n long")


def link_blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of documents and of their blocks' pair dictionaries, both with the block's number."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        own = aligner(a_path, b_path)
        block = TaskContext.get().partitionId() << 32
        ids, parts, held = [], [], 0
        for batch in batches:
            texts = batch.column(1)
            _, offsets, _ = utf8(texts)
            for s, e in slices(offsets, SLICE):
                parts.append(own.align(texts.slice(s, e - s)))
                ids.append(batch.column(0).slice(s, e - s))
                held += int(offsets[e] - offsets[s])
                if held >= block_bytes:
                    yield from _block_rows(block, pa.concat_arrays(ids), parts)
                    block, ids, parts, held = block + 1, [], [], 0
        if parts:
            yield from _block_rows(block, pa.concat_arrays(ids), parts)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA.format(id=kind))


def rated_pairs(totals: DataFrame) -> DataFrame:
    """(pair, total, best): ``best`` where no pair with the same right id has a higher total."""
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    high = totals.groupBy(b.alias("b")).agg(F.max("total").alias("high"))
    return totals.withColumn("b", b).join(high, "b").select("pair", "total", (F.col("total") == F.col("high")).alias("best"))


def _scored(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links."""
    release()
    pairs = pairs.sort_by("code")
    total = pairs["total"].to_numpy()
    best = pairs["best"].to_numpy().astype(np.int64)
    n_best, count_sum = [], []
    for codes, times in zip(docs["codes"].to_pylist(), docs["times"].to_pylist(), strict=True):
        code, often = np.cumsum(unpacked(codes)), unpacked(times)
        n_best.append(int((often * best[code]).sum()))
        count_sum.append(int((often * total[code]).sum()))
    out = docs.select(["doc_id", *KEYS])
    out = out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return out.append_column("groups_sha256", docs["groups_sha256"])


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row.

    A is a byte-level BPE file of the tokenizers library and encodes a space and the text, B
    a SentencePiece model that adds the space itself. A row whose text is null or empty, or whose tokens'
    bytes on either side are not those of space and text, has zeros and an empty hash. ``count_sum`` adds up, over a row's links, how often the
    link's pair of ids is linked in all rows; ``n_best`` counts the links whose pair has the
    highest such number of its B id, ties included. Repeated rows count each time and come each time.
    ``groups_sha256`` hashes the groups as ``a1,a2|b1;a3|b2,b3``. An empty table gives no rows.
    """
    made = written(link_blocks(docs, a_path, b_path, id_col, text_col, block_bytes).withColumnRenamed(id_col, "doc_id"), "token-links")
    pairs = made.where("is_pair").select("block", "pair", "code", "n")
    rated = written(rated_pairs(pairs.groupBy("pair").agg(F.sum("n").alias("total"))), "token-pairs")
    known = pairs.drop("n").join(rated, "pair").select(F.col("block").alias("of_block"), "code", "total", "best")
    rows = made.where("not is_pair").select("block", "doc_id", *KEYS, "groups_sha256", "codes", "times")
    kind = made.schema["doc_id"].dataType.simpleString()
    return rows.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(
        _scored, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
