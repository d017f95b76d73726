"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Two words are alike by the three-letter subsequences they share, gaps allowed: an
occurrence weighs DECAY for each letter it skips, and a word's weights are divided by
the norm that its length gives. Letters put in between or left out thus lower the
likeness a little instead of ending it. Characters that are no letters are skipped and letters
that stand alone in a row make one word.

The machine works on Nyström features, the kernel with landmark words turned by the
inverse root of the landmarks' own kernel matrix. It is trained on labelled sentences
as bags: every word of a clean document's sentences is negative, and each toxic
document must hold a positive word in some sentence, found anew each round. As the
kernel is a product of sparse features, the trained function is one weight a
subsequence, and a text is scored with a table look-up for each subsequence in it. A
text's margin is its sentences' highest; a sigmoid fitted on other labelled documents
makes it a probability.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.blocks import slices, utf8

#: Labelled documents the machine is fitted on, by smallest hash of the id: at most so many of each label.
TOXIC_DOCS, CLEAN_DOCS = 1500, 2500
LANDMARKS = 192
SPAN = 5
DECAY = 0.6
ROUNDS = 4
#: Negative words kept for training: those most alike to positives, and others by hash.
NEGATIVES = 6000
EDGE = 63
STEPS = [(j, k, DECAY ** (k - 2)) for j, k in combinations(range(1, SPAN), 2)]
#: The norm of a word by its letters with both edges.
NORM = np.sqrt(np.array([1e-9 + sum(max(0, n - k) * w * w for _, k, w in STEPS) for n in range(4096)]))

_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Code points to letters 1 to 62 regardless of case, white space to -1, all else to 0."""
    if not _CLASSES:
        table = np.zeros(0x110000, np.int8)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()[0]
                table[c] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % 36
            elif chr(c).isspace():
                table[c] = -1
        _CLASSES.append(table)
    return _CLASSES[0]


@dataclass
class Letters:
    """Words of some texts as letters between edges, the word each is in, and the row of each word."""

    codes: np.ndarray
    word: np.ndarray
    row: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, offsets: np.ndarray) -> Letters:
        points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.append(0, np.cumsum((raw & 0xC0) != 0x80))[offsets]
        kind = _classes()[points]
        breaks = (kind == -1).astype(np.int64)
        token = np.cumsum(breaks)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        token += row  # a new row starts a new token
        kept = kind > 0
        token, row, codes = token[kept], row[kept], kind[kept].astype(np.int32)
        if not len(codes):
            none = np.zeros(0, np.int64)
            return cls(none, none, none, none)
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        size = np.diff(np.append(first, len(token)))
        row = row[first]
        alone = size == 1
        join = np.append(False, alone[1:] & alone[:-1] & (row[1:] == row[:-1]))
        number = np.cumsum(~join) - 1
        word = np.repeat(number, size)
        row, size = row[~join], np.bincount(number, size).astype(np.int64)
        out = np.full(len(codes) + 2 * len(size), EDGE, np.int32)
        out[np.arange(len(codes)) + 2 * word + 1] = codes
        return cls(out, np.repeat(np.arange(len(size)), size + 2), row, size + 2)

    def subsequences(self):
        """(word, subsequence, weight) step by step."""
        for j, k, weight in STEPS:
            n = len(self.codes) - k
            if n <= 0:
                continue
            same = self.word[:n] == self.word[k:]
            yield self.word[:n][same], (self.codes[:n] << 12 | self.codes[j : j + n] << 6 | self.codes[k:])[same], weight


def margins(letters: Letters, weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value of each word."""
    total = np.zeros(len(letters.size))
    for word, code, weight in letters.subsequences():
        total += weight * np.bincount(word, weights[code], minlength=len(total))
    return total / NORM[np.minimum(letters.size, len(NORM) - 1)] + bias


def words_of(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words as strings of letter codes; which word and which text each occurrence is."""
    raw, at, _ = utf8(pa.array(texts, pa.string()))
    index: dict[bytes, int] = {}
    which, rows = [], []
    for first, last in slices(at):
        letters = Letters.of(raw[at[first] : at[last]], at[first : last + 1] - at[first])
        data = letters.codes.astype(np.uint8).tobytes()
        ends = np.cumsum(letters.size)
        own = [index.setdefault(data[s + 1 : e - 1], len(index)) for s, e in zip((ends - letters.size).tolist(), ends.tolist(), strict=True)]
        which.append(np.array(own, np.int64))
        rows.append(letters.row + first)
    return list(index), np.concatenate(which or [np.zeros(0, np.int64)]), np.concatenate(rows or [np.zeros(0, np.int64)])


def letters_of(words: list[bytes]) -> Letters:
    size = np.array([len(w) + 2 for w in words], np.int64)
    codes = np.frombuffer(b"".join(b"\x3f" + w + b"\x3f" for w in words), np.uint8).astype(np.int32)
    return Letters(codes, np.repeat(np.arange(len(words)), size), np.zeros(len(words), np.int64), size)


def kernel(words: list[bytes], table: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The kernel of words with landmarks: ``table`` has a row for each subsequence in ``columns``."""
    out = np.zeros((len(words), table.shape[1]))
    for i in range(0, len(words), 512):
        letters = letters_of(words[i : i + 512])
        part = out[i : i + 512]
        for word, code, weight in letters.subsequences():
            at = columns[code]
            known = at >= 0
            np.add.at(part, word[known], weight * table[at[known]])
        part /= NORM[np.minimum(letters.size, len(NORM) - 1)][:, None]
    return out


def support_vectors(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights, the bias last, of the machine with squared hinge loss, by Newton steps on its support vectors."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag(np.append(np.ones(x.shape[1] - 1), 1e-3))
    w, inside = np.zeros(x.shape[1]), np.ones(len(x), bool)
    for _ in range(30):
        xi, c = x[inside], cost[inside]
        w = np.linalg.solve(ridge + (xi * c[:, None]).T @ xi, xi.T @ (c * y[inside]))
        now = y * (x @ w) < 1
        if np.array_equal(now, inside):
            break
        inside = now
    return w


@dataclass
class Machine:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _sigmoid(margin: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the probability; the labels' shares are those of all labelled documents."""
    n1, n0 = max(y.sum(), 1), max((1 - y).sum(), 1)
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, share / n1, (1 - share) / n0) * len(y)
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(h, x.T @ (weight * (p - goal)) + 1e-3 * at)
    return float(max(at[0], 0.0)), float(at[1])


def fit(texts: list[str], labels: np.ndarray, fold: np.ndarray, share: float) -> Machine:
    """Train on labelled texts; those with ``fold`` true only calibrate the probability."""
    words, which, row = words_of(texts)
    none = Machine(np.zeros(1 << 18), -1.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    if not words or labels.min() == labels.max():
        return none
    used = ~fold[row]
    pairs = np.unique(which[used] * len(texts) + row[used])
    word, doc = pairs // len(texts), pairs % len(texts)
    toxic = labels[doc] == 1
    n1, n0 = max(1, int((labels[~fold] == 1).sum())), max(1, int((labels[~fold] == 0).sum()))
    df1, df0 = (np.bincount(word[m], minlength=len(words)) for m in (toxic, ~toxic))
    odds = np.log((df1 + 0.5) / n1) - np.log((df0 + 0.5) / n0)
    worth = np.sqrt(df1) * np.maximum(odds, 0)
    order = np.argsort(-worth, kind="stable")
    marked = order[: LANDMARKS * 2 // 3]
    marked = marked[worth[marked] > 0]
    rng = np.random.default_rng(5)
    rest = np.setdiff1d(np.flatnonzero(df0 > 0), marked)
    landmarks = np.concatenate([marked, rng.choice(rest, min(len(rest), LANDMARKS - len(marked)), replace=False)])
    chosen = [words[i] for i in landmarks]
    letters = letters_of(chosen)
    parts = list(letters.subsequences())
    codes = np.unique(np.concatenate([c for _, c, _ in parts]))
    columns = np.full(1 << 18, -1, np.int64)
    columns[codes] = np.arange(len(codes))
    table = np.zeros((len(codes), len(chosen)))
    for own, code, weight in parts:
        np.add.at(table, (columns[code], own), weight)
    table /= NORM[np.minimum(letters.size, len(NORM) - 1)]
    values, vectors = np.linalg.eigh(table.T @ table + 1e-6 * np.eye(len(chosen)))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    clean = np.flatnonzero(df0 > 0)
    only = np.flatnonzero((df0 == 0) & (df1 > 0))  # words that can be a toxic document's positive
    value = np.where(df0 == 0, worth, -1.0)
    all_letters = letters_of(words)
    negative = rng.choice(clean, min(len(clean), NEGATIVES // 2), replace=False)
    weights, bias = none.weights, -1.0
    for turn in range(ROUNDS):
        # each toxic document's best word, if any stands out
        ranked = np.lexsort((-value[word[toxic]], doc[toxic]))
        own_doc, own_word = doc[toxic][ranked], word[toxic][ranked]
        best = own_word[np.flatnonzero(np.append(True, own_doc[1:] != own_doc[:-1]))]
        best = best[np.isin(best, only)]
        positive, times = np.unique(best[value[best] > (1.5 if turn == 0 else 0.0)], return_counts=True)
        if not len(positive):
            return none
        x = kernel([words[i] for i in np.concatenate([positive, negative])], table, columns) @ root
        y = np.append(np.ones(len(positive)), -np.ones(len(negative)))
        cost = np.append(10.0 * np.sqrt(times), np.full(len(negative), 3.0))
        w = support_vectors(x, y, cost)
        weights = np.zeros(1 << 18)
        weights[codes] = table @ (root @ w[:-1])
        bias = float(w[-1])
        value = margins(all_letters, weights, bias)
        hard = clean[np.argsort(-value[clean], kind="stable")[: NEGATIVES // 2]]
        negative = np.union1d(hard, negative[: NEGATIVES // 2])
    top = np.full(len(texts), bias)
    np.maximum.at(top, row, value[which])
    held = fold if fold.any() and len(set(labels[fold])) == 2 else ~fold
    slope, offset = _sigmoid(top[held], labels[held], share)
    return Machine(weights.astype(np.float32).astype(float), bias, slope, offset)


def train(docs: DataFrame, labels: DataFrame, admit: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> Machine:
    """Fit on a bounded sample of the labelled documents that ``admit`` (over the id column) lets in."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (admit if admit is not None else F.lit(True)))
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    share = known.agg(F.avg("y")).first()[0] or 0.0
    key = F.xxhash64("doc_id")
    sample = known.where("y = 1").orderBy(key).limit(toxic_docs).unionAll(known.where("y = 0").orderBy(key).limit(clean_docs))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("text", "y", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(10)).alias("f")).orderBy("f", "text").collect()
    if not rows:
        return Machine(np.zeros(1 << 18), -1.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    return fit([r["text"] or "" for r in rows], np.array([r["y"] for r in rows]), np.array([r["f"] < 3 for r in rows]), share)


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, margin) for every row.

    Texts that are null, empty or without letters have the margin of no word, the bias.
    Without labels of both kinds every text has the score of the labels' share. Repeated
    rows get a row each.
    """
    table = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    kind = table.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own: Machine = sent.value
        for batch in batches:
            raw, at, _ = utf8(batch.column(1))
            top = np.full(len(batch), own.bias)
            for first, last in slices(at):
                letters = Letters.of(raw[at[first] : at[last]], at[first : last + 1] - at[first])
                if len(letters.size):
                    np.maximum.at(top, letters.row + first, margins(letters, own.weights, own.bias))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.probability(top)), pa.array(top)], names=["doc_id", "score", "margin"])

    return table.mapInArrow(run, f"doc_id {kind}, score double, margin double")
