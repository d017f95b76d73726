"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent letter n-grams, in order. A
document's own most frequent n-grams are compared with each profile: every n-gram
counts the places it is out of place, and one that the profile lacks the whole length
of the profile. The language with the smallest distance wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.blocks import release, slices, utf8, written

#: N-grams in a profile.
PROFILE = 400
#: What is sent to tasks is a row a language and n-gram; more languages than this are an error.
MAX_LANGUAGES = 5000
UNKNOWN = "und"
#: A word's end as a code; letters have larger ones.
EDGE = 1

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point the lower-case letter's, or the edge for what is no letter."""
    if not _LETTERS:
        table = np.full(0x110000, EDGE, np.int64)
        for c in range(0x110000):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTERS.append(table)
    return _LETTERS[0]


def gram_counts(raw: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, gram, count) of the 1- to 3-grams within words, by group of rows.

    A gram is its code points in 21 bits each; words have an edge on both sides. Sorted
    by group and gram. Only 3-grams are counted in the text: with its edges each shorter
    gram is the start or the middle of a known set of them.
    """
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.append(0, np.cumsum((raw & 0xC0) != 0x80))[offsets]
    codes = np.insert(_letters()[points], at[:-1], EDGE)
    codes = np.append(codes, EDGE)
    row = np.repeat(np.arange(len(group)), np.diff(at) + 1)
    row = np.append(row, len(group) - 1 if len(group) else 0)
    letter = codes != EDGE
    kept = letter.copy()  # and the edges next to a letter
    kept[1:] |= letter[:-1]
    kept[:-1] |= letter[1:]
    codes, row, letter = codes[kept], row[kept], letter[kept]
    middle = np.flatnonzero(letter)
    if not len(middle):
        none = np.zeros(0, np.int64)
        return none, none, none
    alphabet, compact = np.unique(codes, return_inverse=True)
    compact = compact + 1
    base = len(alphabet) + 1
    key = ((group[row[middle]] * base + compact[middle - 1]) * base + compact[middle]) * base + compact[middle + 1]
    key.sort()
    new = np.append(True, key[1:] != key[:-1])
    first = np.flatnonzero(new)
    key, n = key[first], np.diff(np.append(first, len(key)))
    rest, c = np.divmod(key, base)
    rest, b = np.divmod(rest, base)
    g, a = np.divmod(rest, base)
    edge = int(np.searchsorted(alphabet, EDGE)) + 1
    starts = a == edge
    pair = np.concatenate([(g * base + b) * base + c, ((g * base + a) * base + b)[starts]])
    pair, pair_n = _summed(pair, np.concatenate([n, n[starts]]))
    single, single_n = _summed(g * base + b, n)
    code = np.append(0, alphabet)
    groups = np.concatenate([single // base, pair // base**2, g])
    grams = np.concatenate([
        code[single % base], code[pair // base % base] << 21 | code[pair % base], code[a] << 42 | code[b] << 21 | code[c],
    ])
    counts = np.concatenate([single_n, pair_n, n])
    order = np.lexsort((grams, groups))
    return groups[order], grams[order], counts[order]


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(n, first)


def ranked(group: np.ndarray, gram: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, gram, rank) of the most frequent grams of each group; ties by gram."""
    order = np.argsort((group << 32) | ((1 << 32) - 1 - count), kind="stable")
    group, gram = group[order], gram[order]
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
    kept = rank < most
    return group[kept], gram[kept], rank[kept]


def language_profiles(docs: DataFrame, train: Column | None = None, text_col: str = "text",
                      lang_col: str = "lang", length: int = PROFILE) -> DataFrame:
    """(lang, gram, rank) learned from all rows with a language that ``train`` admits."""
    rows = docs.where(F.col(lang_col).isNotNull() & (train if train is not None else F.lit(True)))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        release()
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            lang = lang if isinstance(lang, pa.DictionaryArray) else lang.combine_chunks()
            which = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            raw, at, _ = utf8(batch.column(1))
            for first, last in slices(at):
                g, gram, n = gram_counts(raw[at[first] : at[last]], at[first : last + 1] - at[first], which[first:last])
                yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(g)), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])

    counts = rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return counts.withColumn("rank", rank).where(F.col("rank") < length).select("lang", "gram", "rank")


class Profiles:
    """The ranks of all profiles' grams, a column a language."""

    def __init__(self, rows: list, length: int = PROFILE):
        self.length = length
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.unique(np.array([r["gram"] for r in rows], np.int64))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int32)
        at = {lang: i for i, lang in enumerate(self.langs)}
        for r in rows:
            self.ranks[at[r["lang"]], np.searchsorted(self.grams, r["gram"])] = r["rank"]

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the language's index, or -1, and how near its profile is, 0 to 1."""
        n = len(offsets) - 1
        best, score = np.full(n, -1), np.zeros(n)
        row, gram, rank = ranked(*gram_counts(raw, offsets, np.arange(n)), self.length)
        if not len(row) or not self.langs:
            return best, score
        at = np.searchsorted(self.grams, gram)
        at[(at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] != gram)] = len(self.grams)
        first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        rows, size = row[first], np.diff(np.append(first, len(row)))
        least = np.full(len(rows), np.iinfo(np.int64).max)
        for i in range(len(self.langs)):
            own = self.ranks[i][at]
            out = np.add.reduceat(np.where(own < 0, self.length, np.abs(own - rank)), first)
            nearer = out < least
            least[nearer] = out[nearer]
            best[rows[nearer]] = i
        score[rows] = 1 - least / (size * self.length)
        return best, score


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             keep: tuple[str, ...] = (), length: int = PROFILE) -> DataFrame:
    """(doc_id, kept columns, lang_pred, score) for every row of ``docs``.

    ``score`` is 1 for a document whose n-grams are placed as in the profile and 0 where
    the profile has none of them. Texts that are null, empty or without letters, and all
    texts if there are no profiles, have ``und`` and score 0. Equal distances go to the
    language first by code point. Repeated rows get a row each. The profiles, of a fixed
    length a language, are sent to the tasks.
    """
    if profiles.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    model = docs.sparkSession.sparkContext.broadcast(Profiles(profiles.collect(), length))
    table = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).cast("string").alias("_text"),
                        F.lit(None).cast("string").alias("lang_pred"), F.lit(None).cast("double").alias("score"))

    def run(batches):
        release()
        for batch in batches:
            names = batch.schema.names
            raw, at, _ = utf8(batch.column(names.index("_text")))
            best, score = np.full(len(batch), -1), np.zeros(len(batch))
            for first, last in slices(at):
                best[first:last], score[first:last] = model.value.predict(raw[at[first] : at[last]], at[first : last + 1] - at[first])
            langs = np.array([*model.value.langs, UNKNOWN], object)
            columns = dict(zip(names, batch.columns, strict=True))
            columns["lang_pred"], columns["score"] = pa.array(langs[best], pa.string()), pa.array(score)
            kept = [c for c in names if c != "_text"]
            yield pa.RecordBatch.from_arrays([columns[c] for c in kept], names=kept)

    return table.mapInArrow(run, table.drop("_text").schema)


def fitted(docs: DataFrame, train: Column | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The profiles as a written table, so that they are counted once."""
    return written(language_profiles(docs, train, text_col, lang_col), "language-profiles")
