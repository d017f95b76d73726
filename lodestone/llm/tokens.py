"""Token ids in Simple-8b words.

A 64-bit word holds a 4-bit selector and 60 bits of ids: the selector says how many ids
of how many bits follow. One selector stands for an escape: its 60 bits point at a
64-bit value kept aside, for ids that need more than 60 bits. A frame holds
the ids of some whole documents in blocks of 1024 ids; a block starts on a new word, and
the frame lists each block's first word, so that all blocks decode at once with NumPy.

Frames are rows of Parquet files, a file a range of ids, in ascending order of document.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.blocks import KEPT, LOWER, SPACE, U64, freed_shuffles, release, slices, utf8
from lodestone.llm.pieces import JOINED, PieceEncoder, at_spaces, flat_ids, ids_of, no_cuts, tokenizers_file
from lodestone.session import scratch_path

#: Ids a word holds and bits of each, by selector. Fixed by the format; selector 1 is the escape.
COUNTS = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 1
BLOCK = 1024
FRAME_IDS = 1 << 18
MAGIC = b"S8B1"


def pack(values: np.ndarray) -> bytes:
    """A frame: magic, ids, words, escapes, then block offsets, words and escaped values, little-endian."""
    values = np.asarray(values, U64)
    n = len(values)
    blocks = -(-n // BLOCK)
    stop = np.minimum((np.arange(n) // BLOCK + 1) * BLOCK, n)  # where each id's block ends
    width = np.zeros((blocks, BLOCK), np.int8)  # whatever is past the end fits
    width.ravel()[:n] = _widths(values)
    low, high = int(width.ravel()[:n].min(initial=64)), int(width.max(initial=0))
    choice = np.full(width.shape, ESCAPE, np.int8)
    for selector in [*range(min(15, int(np.searchsorted(BITS[2:], high)) + 2), 1, -1), 0]:  # the last that fits holds the most ids
        if low <= BITS[selector]:
            choice[_fitting(width, selector)] = selector
    choice = choice.ravel()[:n]
    step = np.minimum(COUNTS[choice], stop - np.arange(n))
    at = np.arange(blocks) * BLOCK
    block = np.arange(blocks)
    heads, owners = [], []
    while len(at):
        heads.append(at)
        owners.append(block)
        at = at + step[at]
        going = at < np.minimum((block + 1) * BLOCK, n)
        at, block = at[going], block[going]
    head = np.sort(np.concatenate(heads)) if heads else np.zeros(0, np.int64)
    offsets = np.searchsorted(head, np.arange(blocks) * BLOCK).astype("<u4")
    words = choice[head].astype(U64) << U64(60)
    escaped = head[choice[head] == ESCAPE]
    words[choice[head] == ESCAPE] |= np.arange(len(escaped), dtype=U64)
    for selector in range(2, 16):
        own = np.flatnonzero(choice[head] == selector)
        if not len(own):
            continue
        for j in range(int(COUNTS[selector])):
            here = own[j < step[head[own]]]
            words[here] |= values[head[here] + j] << U64(j * int(BITS[selector]))
    return MAGIC + struct.pack("<III", n, len(words), len(escaped)) + offsets.tobytes() + words.astype("<u8").tobytes() + values[escaped].astype("<u8").tobytes()


def _fitting(width: np.ndarray, selector: int) -> np.ndarray:
    """Where in blocks a word of this selector can start: its ids fit, or all to the block's end do."""
    fits = width <= BITS[selector]
    ahead = 1  # ids that are known to fit from a place on
    while ahead < COUNTS[selector]:
        step = min(ahead, int(COUNTS[selector]) - ahead)
        more = fits.copy()
        more[:, :-step] &= fits[:, step:]
        fits, ahead = more, ahead + step
    return fits


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits each value needs, 0 to 64."""
    if not len(values) or values.max() < 1 << 53:  # exact as doubles
        return np.frexp(values.astype(np.float64))[1].astype(np.int64)
    width = np.zeros(len(values), np.int64)
    left = values.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = left >= U64(1 << step)
        width[big] += step
        left[big] >>= U64(step)
    return width + (left > 0)


def unpack(frame: bytes) -> np.ndarray:
    """The ids of a frame."""
    if frame[:4] != MAGIC:
        raise ValueError("not a frame")
    n, n_words, n_escapes = struct.unpack_from("<III", frame, 4)
    blocks = -(-n // BLOCK)
    offsets = np.frombuffer(frame, "<u4", blocks, 16).astype(np.int64)
    words = np.frombuffer(frame, "<u8", n_words, 16 + 4 * blocks)
    escapes = np.frombuffer(frame, "<u8", n_escapes, 16 + 4 * blocks + 8 * n_words)
    selector = (words >> U64(60)).astype(np.int64)
    count = COUNTS[selector]
    before = np.cumsum(count) - count
    lengths = np.diff(np.append(offsets, n_words))
    start = before - np.repeat(before[offsets], lengths) + np.repeat(np.arange(blocks) * BLOCK, lengths)
    stop = np.repeat(np.minimum(np.arange(1, blocks + 1) * BLOCK, n), lengths)
    out = np.zeros(n, U64)
    for s in range(2, 16):
        own = np.flatnonzero(selector == s)
        for j in range(int(COUNTS[s]) if len(own) else 0):
            at = start[own] + j
            ok = at < stop[own]
            out[at[ok]] = (words[own[ok]] >> U64(j * int(BITS[s]))) & U64((1 << int(BITS[s])) - 1)
    own = np.flatnonzero(selector == ESCAPE)
    out[start[own]] = escapes[(words[own] & U64((1 << 60) - 1)).astype(np.int64)]
    return out


#: The normalizers that work on a character and what combines with it, and the pattern of words that leaves out white space.
LOCAL_NORMALIZERS = ({"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"})
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Put between words that are encoded together: it is a word of its own, and text that has it is encoded by itself.
MARK = "\x01"


def drops_spaces(spec: dict) -> bool:
    """Whether a tokenizer, by its own description, drops white space and never joins tokens across it."""
    normalizer = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    steps = normalizer.get("normalizers", [normalizer])
    before = spec.get("pre_tokenizer") or {}
    first = before.get("pretokenizers", [before])[0]
    split = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True
    plain = all(t["content"].split() == [t["content"]] and not t["lstrip"] and not t["rstrip"] for t in spec.get("added_tokens", []))
    return all(step in LOCAL_NORMALIZERS for step in steps) and split and first.get("pattern") == {"Regex": WORD_PATTERN} and plain


class WordLibrary:
    """The ids of pieces by the tokenizers library, many a call.

    Pieces of letters alone are words: where the tokenizer ends a word's last token with a suffix, that tells where
    each one's ids end. Between others a mark tells it.
    """

    def __init__(self, tokenizer, suffix: str | None = None):
        self.tokenizer = tokenizer
        alone = ids_of(tokenizer, [MARK])[0]
        self.mark = alone[0] if len(alone) == 1 else None
        vocab = tokenizer.get_vocab() if suffix else {}
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode() for p in pieces]
        other = np.fromiter((not t.strip(" \t\n\v\f\r").isalpha() for t in texts), bool, len(texts)) if self.ends.any() else np.ones(len(texts), bool)
        order = np.argsort(other, kind="stable")
        texts, words = [texts[i] for i in order.tolist()], len(texts) - int(other.sum())
        flat, sizes = [], []
        for first, last, between in ((0, words, ""), (words, len(texts), f" {MARK}")):
            chunks = [texts[i : min(i + JOINED, last)] for i in range(first, last, JOINED)]
            spaced = [between.join(t if t[:1].isspace() else f" {t}" for t in c) for c in chunks] if not between or self.mark is not None else []
            for chunk, ids in zip(chunks, ids_of(self.tokenizer, spaced) if spaced else [[]] * len(chunks), strict=True):
                own, size = self._parted(chunk, np.array(ids, np.int32), between)
                flat.append(own)
                sizes.append(size)
        size, back = np.concatenate(sizes), np.argsort(order)
        start, size = (np.cumsum(size) - size)[back], size[back]
        return np.concatenate(flat)[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())], size

    def _parted(self, chunk: list[str], ids: np.ndarray, between: str) -> tuple[np.ndarray, np.ndarray]:
        if not between:
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(chunk) and last[-1] == len(ids) - 1:  # a piece of letters is one word at least, so each is one
                return ids, np.diff(np.append(-1, last))
        elif self.mark is not None:
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(chunk) - 1:
                return np.delete(ids, marks), np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
        return flat_ids(ids_of(self.tokenizer, chunk))  # a piece has the mark itself, or letters that become more than one word


#: Letters lowered, and all white space, which such a tokenizer drops, as a space: fewer distinct pieces.
LOWER_SPACED = np.where(SPACE, 0x20, LOWER).astype(np.uint8)
LETTER, PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class WordEncoder(PieceEncoder):
    """The encoder of a tokenizer that ``drops_spaces``.

    Texts are cut at white space and between a letter and punctuation, both ASCII, where words end too. If the tokenizer
    lower-cases, so are ASCII letters before, but for those that something may combine with.
    Special tokens are neither cut nor made by that.
    """

    def __init__(self, tokenizer, spec: dict):
        special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.special = [s.lower() for s in special]
        self.lowers = {"type": "Lowercase"} in (spec.get("normalizer") or {}).get("normalizers", [])
        ends = PUNCTUATION.copy()
        ends[[b for s in special for a, b in zip(s, s[1:], strict=False) if LETTER[a]]] = False

        def cuts(raw):
            out = at_spaces(raw)
            out[1:] |= LETTER[raw[:-1]] & ends[raw[1:]]
            return out

        whole = any(t["content"].isalpha() for t in spec.get("added_tokens", []))  # such a token has no suffix
        super().__init__(WordLibrary(tokenizer, None if whole else spec["model"].get("end_of_word_suffix")), cuts)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.lowers and len(raw):
            lowered = LOWER_SPACED[raw]
            if not any(s in lowered.tobytes() for s in self.special):
                raw = np.where(np.append(raw[1:], 0) < 0x80, lowered, raw)
        return super().encode(raw, offsets)


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder, which lasts until a task of another kind comes.

    Texts are cut where the tokenizer itself always cuts, by its own description; those of any other tokenizer are encoded whole.
    """
    release(but=path)
    if path not in KEPT:
        tokenizer = tokenizers_file(path)
        spec = json.loads(tokenizer.to_str())
        KEPT[path] = WordEncoder(tokenizer, spec) if drops_spaces(spec) else PieceEncoder(
            lambda pieces: flat_ids(ids_of(tokenizer, [p.decode() for p in pieces])), no_cuts)
    return KEPT[path]


#: Bytes of text encoded at a time, but for a single longer one.
TEXT_SLICE = 1 << 22


def write_tokens(docs: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 1, partitions: int | None = None) -> str:
    """Encode every text, append ``end_id``, and write the ids; returns the folder.

    Rows are in ascending order of id, null ids first, ties by a hash of the text;
    repeated rows are written as often as they come. Null and empty texts have the end id
    alone. Ranges are by id and text hash, so that rows of one id need not meet in a task.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"llm/tokens-{uuid.uuid4().hex}")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        shard, frame, before = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def row():
            values = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([frame], pa.int64()), pa.array([before], pa.int64()),
                pa.array([len(values)], pa.int64()), pa.array([ids], pa.list_(kind_of)),
                pa.array([pack(np.concatenate(sizes))], pa.binary()), pa.array([pack(values)], pa.binary()),
            ], names=FRAME_COLUMNS)

        own = encoder(tokenizer)
        for batch in batches:
            kind_of = batch.column(0).type
            keys = batch.column(0).to_pylist()
            raw, offsets, _ = utf8(batch.column(1))
            for first, last in slices(offsets, TEXT_SLICE):
                values, size = own.encode(raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                values = np.insert(values, np.cumsum(size), end_id)
                ids += keys[first:last]
                parts.append(values)
                sizes.append(size + 1)
                held += len(values)
                if held >= FRAME_IDS:
                    yield row()
                    frame, before = frame + 1, before + held
                    ids, parts, sizes, held = [], [], [], 0
        if ids:
            yield row()

    frames = ordered.mapInArrow(run, f"shard int, frame long, before long, n_ids long, doc_ids array<{kind}>, sizes binary, words binary")
    with freed_shuffles(spark):
        frames.write.option("compression", "none").parquet(path)
    return path


FRAME_COLUMNS = ["shard", "frame", "before", "n_ids", "doc_ids", "sizes", "words"]


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document, decoded from the files.

    ``ids`` is null unless they are asked for. ``start`` counts the ids of all documents before it: of earlier files, then of earlier frames.
    """
    frames = spark.read.parquet(path)
    kind = frames.schema["doc_ids"].dataType.elementType.simpleString()
    shards = frames.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))

    def run(batches):
        release()
        for batch in batches:
            for i in range(len(batch)):
                shard, before, keys, sizes, words = (batch.column(k)[i] for k in range(5))
                size = unpack(sizes.as_py()).astype(np.int64)
                values = unpack(words.as_py()).astype("<u4")
                ends = np.cumsum(size)
                starts = ends - size
                crc = [zlib.crc32(values[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(size)
                listed = pa.nulls(n, pa.list_(pa.int64()))
                if with_ids:
                    listed = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1:]).astype(np.int32)), pa.array(values.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, shard.as_py(), np.int32)), keys.values, pa.array(starts + before.as_py()),
                    pa.array(size), pa.array(crc, pa.int64()), listed,
                ], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32", "ids"])

    docs = frames.select("shard", "before", "doc_ids", "sizes", "words").mapInArrow(
        run, f"shard int, doc_id {kind}, at long, n_tokens long, ids_crc32 long, ids array<long>"
    )
    return docs.join(shards, "shard").select(
        "doc_id", (F.col("at") + F.col("ahead")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )
