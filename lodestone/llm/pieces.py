"""Texts as pieces between which a tokenizer never joins.

A tokenizer that never joins tokens across certain places gives the same ids for a text as
for the pieces between those places, one after another. Pieces are cut from the bytes of
many texts with NumPy and brought to their distinct ones by Arrow's dictionary encoding, so that
only distinct pieces reach Python and the tokenizer; what a worker has learnt of a piece stays with
it from task to task, within a bound.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from lodestone.llm.blocks import SPACE

#: Distinct pieces that are remembered, and their bytes; beyond either all are forgotten and learnt anew.
CACHE_PIECES, CACHE_BYTES = 700_000, 1 << 25
#: Pieces that are learnt at a time, and those that go to a library joined in one text.
LEARNT, JOINED = 1 << 14, 1 << 9

Ids = list[list[int]]
Cuts = Callable[[np.ndarray], np.ndarray]


def no_cuts(raw: np.ndarray) -> np.ndarray:
    return np.zeros(len(raw), bool)


def at_spaces(raw: np.ndarray) -> np.ndarray:
    """Pieces begin at ASCII white space that follows something else: for tokenizers that drop white space and never join across it."""
    space = SPACE[raw]
    out = space.copy()
    out[1:] &= ~space[:-1]
    return out


#: Bytes that a white-space character may start with, in its widest sense.
MAYBE_SPACE = SPACE.copy()
MAYBE_SPACE[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def before_last_space(raw: np.ndarray) -> np.ndarray:
    """Pieces begin at a space that surely something else than white space follows: where tokenizers that keep one space with the word after it always cut."""
    out = raw == 0x20
    out[:-1] &= ~MAYBE_SPACE[raw[1:]]
    out[-1:] = False
    return out


def before_first_space(raw: np.ndarray) -> np.ndarray:
    """Pieces begin at the first of a run of spaces: for tokenizers none of whose tokens has a space after anything but spaces."""
    space = raw == 0x20
    out = space.copy()
    out[1:] &= ~space[:-1]
    return out


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for ``size`` entries, doubled as often as needed."""
    while len(array) < size:
        array = np.concatenate([array, np.zeros_like(array)])
    return array


class Ragged:
    """Rows of different lengths in one array, gathered by row number."""

    def __init__(self, kind):
        self.flat = np.zeros(1 << 16, kind)
        self.first, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.rows = self.used = 0

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        n, total = len(sizes), len(values)
        self.flat = grown(self.flat, self.used + total)
        self.first, self.size = grown(self.first, self.rows + n), grown(self.size, self.rows + n)
        self.flat[self.used : self.used + total] = values
        self.size[self.rows : self.rows + n] = sizes
        self.first[self.rows : self.rows + n] = self.used + np.cumsum(sizes) - sizes
        self.rows, self.used = self.rows + n, self.used + total

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the rows one after another, and how many each has."""
        size = self.size[rows]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.first[rows] - (ends - size), size) + np.arange(total)], size


class PieceIndex:
    """Numbers of distinct pieces; ``learn`` is called with new ones, in the order of their numbers."""

    def __init__(self, cuts: Cuts):
        self.cuts = cuts
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.bytes = 0

    def learn(self, new: list[bytes]) -> None:
        raise NotImplementedError

    def numbers(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts' pieces in order, and how many pieces come before each text and at the end.

        Text ``i`` is the bytes ``raw[offsets[i]:offsets[i + 1]]``; pieces begin at texts' starts and at cuts.
        """
        if len(self.index) > CACHE_PIECES or self.bytes > CACHE_BYTES:
            self.clear()
        begins = self.cuts(raw)
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        begin = np.flatnonzero(begins)
        upto = np.searchsorted(begin, offsets)
        if not len(begin):
            return begin, upto
        edges = np.append(begin, len(raw)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        for i in range(0, len(new), LEARNT):
            some = [distinct[j] for j in new[i : i + LEARNT].tolist()]
            known = len(self.index)
            self.learn(some)
            self.bytes += sum(map(len, some))
            self.index.update(zip(some, range(known, known + len(some)), strict=True))
            at[new[i : i + LEARNT]] = np.arange(known, known + len(some))
        return at[coded.indices.to_numpy()], upto


class PieceEncoder(PieceIndex):
    """Ids of texts by a library that gives the ids of some pieces, one after another, and how many each has."""

    def __init__(self, library: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], cuts: Cuts):
        self.library = library
        super().__init__(cuts)

    def clear(self) -> None:
        super().clear()
        self.ids = Ragged(np.int32)

    def learn(self, new: list[bytes]) -> None:
        self.ids.add(*self.library(new))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        piece, upto = self.numbers(raw, offsets)
        ids, size = self.ids.gather(piece)
        return ids, np.diff(np.append(0, np.cumsum(size))[upto])


def tokenizers_file(path: str, special_as_text: bool = False):
    """The tokenizers library's tokenizer of a JSON file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = special_as_text
    return tokenizer


def flat_ids(ids: Ids) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ids one after another, and how many each has."""
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum())), size


def ids_of(tokenizer, texts: list[str]) -> Ids:
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
