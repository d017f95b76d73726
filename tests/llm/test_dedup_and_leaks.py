import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, graph, simhash
from lodestone.llm.blocks import NOT_WORD, Words, utf8, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, distance=4):
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                label[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return [least.get(root(i)) for i in range(len(ids))]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, bucket string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "x", "y") for i, t in rows], DOCS)


def near_texts(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(400)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        else:
            words = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 40, 300]))]
        rows.append((i * 7 % 1000, " ".join(words)))
    return rows


def test_fingerprint_by_definition(spark):
    texts = [t for _, t in near_texts(1, 60)] + ["", "  \n", "A b", "a B c D e\x1cF", "Ünï Ö " * 9000]
    for t in texts:
        assert simhash.fingerprint(t.encode()) == slow_fingerprint(t)
    got = simhash.fingerprints(docs_of(spark, list(enumerate([*texts, None])))).collect()
    assert {r["doc_id"]: r["fp"] & (2**64 - 1) for r in got} == {i: slow_fingerprint(t) for i, t in enumerate([*texts, None])}


def test_hash_is_sparks(spark):
    got = spark.sql("select xxhash64('a bé c d') as h").first()["h"]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest("a bé c d".encode(), 42)


def test_components_against_all_pairs(spark):
    rows = [*near_texts(2, 150), (5000, None), (5001, ""), (None, " "), (14, "lone text here now"), (14, "lone text here now"), (None, "zzz yyy")]
    got = simhash.simhash_components(docs_of(spark, rows), buckets=16).collect()
    fps = [slow_fingerprint(t) for _, t in rows]
    want = slow_components([i for i, _ in rows], fps)
    expected = sorted(((i, f, c) for (i, _), f, c in zip(rows, fps, want)), key=str)
    assert sorted(((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in got), key=str) == expected


@pytest.mark.parametrize("spread", [2, 4, 6])
def test_every_near_pair_of_random_words(spread):
    rng = np.random.default_rng(spread)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for f in base.tolist():
        for _ in range(4):
            for bit in rng.choice(64, spread // 2 if rng.random() < 0.5 else min(4, spread), replace=False):
                f ^= 1 << int(bit)
            fps.add(f)
    fps = np.array(sorted(fps), np.uint64)
    found = [], []
    for bucket in range(8):
        for side, part in zip(found, simhash.meet(fps, bucket, 8, 4, slice_words=5000), strict=True):
            side.extend(part.tolist())
    at = {f: i for i, f in enumerate(fps.tolist())}
    from lodestone.llm.blocks import local_components

    got = local_components(np.array([at[f] for f in found[0]], int), np.array([at[f] for f in found[1]], int), len(fps))
    want = slow_components(list(range(len(fps))), fps.tolist())
    assert got.tolist() == want


def test_first_of_groups_keeps_one_each(spark):
    rows = [(3, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (9, "other words stand here alone"), (None, "q r s t u"), (None, "q r s t u"), (1, None), (8, "")]
    got = simhash.first_of_groups(docs_of(spark, rows))
    assert got.columns == docs_of(spark, rows).columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([(2, "a b c d e f g"), (9, "other words stand here alone"), (None, "q r s t u"), (1, None)], key=str)


def test_texts_go_to_python_some_at_a_time(spark, monkeypatch):
    rows = {}
    monkeypatch.setattr(simhash, "written", lambda df, name, batch_rows=None: rows.update({name: batch_rows}) or written(df, name, batch_rows))
    assert simhash.first_of_groups(docs_of(spark, [(1, "a b"), (2, "a b"), (3, "c")])).count() == 2
    assert rows["simhash"] <= 1024


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert simhash.simhash_components(none).count() == 0
    assert simhash.first_of_groups(none).count() == 0
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(none, bench).count() == 0
    one = decontaminate.decontaminate(docs_of(spark, [(1, "a b")]), bench).first()
    assert (one["n_words"], one["n_hit"], one["items"]) == (2, 0, [])


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}}


def slow_decontaminate(text, items):
    words = BENCH_WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, item_text in items:
        own = BENCH_WORD.findall((item_text or "").translate(LOWER))
        if not own:
            continue
        n = min(10, len(own))
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(None if item is None else str(item))
    return len(words), len(hit), sorted(found - {None})


def leak_case(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "Straße", "x1", "ñu", "a", "b", "c"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(14)]
    items = [(i, t if len(t.split()) not in (1,) else "unique") for i, t in items] + [(3, "same id another text that is long enough to have one window"), (None, "no id but ten words that hit in any document here"), (77, None), (78, "!!!")]
    docs = []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 5, 9, 10, 60, 200]))]
        if rng.random() < 0.7:
            own = (rng.choice(items)[1] or "").split()
            s = rng.randrange(len(own) + 1)
            at = rng.randrange(len(words) + 1)
            words[at:at] = own[s : s + rng.randrange(1, 25)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    return items, [*docs, (None, None), (5, ""), (5, "unique. UNIQUE"), (5, "unique. UNIQUE")]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_bytes", [1 << 24, 700])
def test_decontamination_against_every_window(spark, seed, block_bytes):
    items, docs = leak_case(seed)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs_of(spark, docs), bench, keep=("text",), block_bytes=block_bytes).collect()
    got = sorted(((r["doc_id"], r["text"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got), key=str)
    want = []
    for i, t in docs:
        n, hit, found = slow_decontaminate(t, items)
        want.append((i, t, n, hit, tuple(found)))
    assert got == sorted(want, key=str)


def test_spans_say_where(spark):
    item = " ".join(f"i{k}" for k in range(30))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    text = f"one two {' '.join(f'i{k}' for k in range(5, 17))} three i0 i1 i2"
    row = decontaminate.decontaminate(docs_of(spark, [(1, text)]), bench).first()
    assert row["spans"] == [[2, 14]] and row["n_hit"] == 12


def test_registered_rows(spark, data):
    from lodestone.llm.queries import llm_queries

    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in llm_queries()["op10_decontamination"](spark, data).collect():
        n, hit, found = slow_decontaminate(docs[r["doc_id"]], bench)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), hit > 0)
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
    rows = llm_queries()["op8_simhash_dedup"](spark, data).collect()
    fps = [slow_fingerprint(docs[r["doc_id"]]) for r in rows]
    assert [r["fingerprint"] for r in rows] == [f"{f:016x}" for f in fps]
    assert [r["component_id"] for r in rows] == slow_components([r["doc_id"] for r in rows], fps)
    assert F is not None


@pytest.mark.parametrize("matches", (1 << 20, 3))
def test_repeated_words_in_documents_and_items(monkeypatch, matches):
    monkeypatch.setattr(decontaminate, "MATCHES", matches)
    rng = random.Random(matches)
    unit = ["a b", "a", "x y z", "a a b"]
    items = [(i, " ".join([rng.choice(unit)] * rng.randrange(1, 30) + [rng.choice("cab")] * rng.randrange(4))) for i in range(12)]
    docs = [" ".join([rng.choice(unit)] * rng.randrange(0, 30) + ["c"] * rng.randrange(3) + [rng.choice(unit)] * rng.randrange(12)) for _ in range(60)]
    block = decontaminate.Block.of([str(i) for i, _ in items], [t for _, t in items], decontaminate.GRAM, decontaminate.WINDOW)
    raw, at, _ = utf8(pa.array(docs))
    w = Words(raw, at, NOT_WORD)
    row = w.rows()
    low, high, item = block.hits(w, decontaminate.GRAM, decontaminate.WINDOW)
    for i, text in enumerate(docs):
        own = [(s, e, x) for s, e, x in zip(low.tolist(), high.tolist(), item.tolist(), strict=True) if row[s] == i]
        hit = {p for s, e, _ in own for p in range(s, e)}
        assert (len(hit), sorted({str(x) for _, _, x in own})) == slow_decontaminate(text, items)[1:]


def test_matches_of_one_word_repeated_stay_few():
    text = "word " * 20_000
    block = decontaminate.Block.of(["1"], [text], decontaminate.GRAM, decontaminate.WINDOW)
    assert len(block.prints) <= 2 * decontaminate.WINDOW
    raw, at, _ = utf8(pa.array([text]))
    low, high, item = block.hits(Words(raw, at, NOT_WORD), decontaminate.GRAM, decontaminate.WINDOW)
    assert low.min() == 0 and high.max() == 20_000 and set(item.tolist()) == {0} and len(low) <= 40 * 20_000
