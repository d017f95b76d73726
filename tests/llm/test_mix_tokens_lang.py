import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lodestone.llm import langid, mixing, pieces, tokens
from lodestone.llm.blocks import utf8
from lodestone.llm.queries import llm_queries, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, src string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, None, "x", "y") for r in rows], DOCS)


def slow_targets(sizes):
    """sizes: source -> words; shares by weight, again and again, until none is above three times its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        goal = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if goal[s] > 3 * sizes[s]}
        if not above:
            return {**{s: 3.0 * sizes[s] for s in capped}, **goal}
        capped |= above


@pytest.mark.parametrize("seed", range(4))
def test_targets_and_taken(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        source = rng.choice([None, "a", "b", "Z", "é", "ab", "a" if seed else "empty"])
        n = 0 if source == "empty" else rng.choice([0, 1, 5, 5, 40, 300])
        rows.append((i, " ".join(["w"] * n) or rng.choice([None, " "]), "en", source if i % 3 else "a"))
    rows += [rows[0]] * 5 + [(None, "x y z", None, None)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    again = mixing.mix(docs_of(spark, rows).repartition(7)).collect()
    key = lambda r: str((r["doc_id"], r["size"], r["repeats"]))
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes, source_of = defaultdict(int), {}
    for i, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
        source_of[i] = s
    goal, taken = slow_targets(sizes), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goal[s], abs=1e-6)
        assert 0 <= r["repeats"] <= 3
        taken[s] += r["size"] * r["repeats"]
    for s, t in taken.items():
        assert abs(t - goal[s]) <= max(3, 0.01 * goal[s])


@pytest.mark.parametrize("seed", range(20))
def test_fill_finds_the_best_sum(seed):
    rng = random.Random(seed)
    lengths = np.array(rng.sample(range(1, 60), rng.randrange(1, 6)))
    spare = np.array([rng.randrange(0, 7) for _ in lengths])
    budget = rng.randrange(0, 200)
    sums = {0}
    for length, n in zip(lengths.tolist(), spare.tolist(), strict=True):
        sums = {s + k * length for s in sums for k in range(n + 1)}
    took = mixing.fill(lengths, spare, budget)
    assert (took <= spare).all() and (took * lengths).sum() == max(s for s in sums if s <= budget)


def test_mix_of_nothing(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0
    only = mixing.mix(docs_of(spark, [(1, None, None, None), (1, "", None, "s")])).collect()
    assert [(r["target"], r["size"] * r["repeats"]) for r in only] == [(0.0, 0), (0.0, 0)]


@pytest.mark.parametrize("seed", range(8))
def test_pack_round_trip(seed):
    rng = np.random.default_rng(seed)
    top = [1, 2, 10, 1 << 16, 1 << 31, 1 << 59, 1 << 63, 3][seed]
    values = rng.integers(0, top, int(rng.integers(0, 5000)), dtype=np.uint64)
    values[rng.random(len(values)) < 0.1] = np.uint64(2**64 - 1) if seed > 4 else np.uint64(0)
    frame = tokens.pack(values)
    assert np.array_equal(tokens.unpack(frame), values)
    if 0 < seed < 3 and len(values) > 1000:
        assert len(frame) < len(values)
    for n in (0, 1, 240, 241, 1024, 1025):
        assert np.array_equal(tokens.unpack(tokens.pack(np.zeros(n, np.uint64))), np.zeros(n))


@pytest.mark.parametrize("selector", [0, 2, 9, 12, 15])
def test_words_start_where_all_their_ids_fit(selector):
    rng = np.random.default_rng(selector)
    bits, count = int(tokens.BITS[selector]), int(tokens.COUNTS[selector])
    width = np.where(rng.random((3, tokens.BLOCK)) < 1 / count, bits + 1, bits).astype(np.int8)
    want = [[bool((row[i : i + count] <= bits).all()) for i in range(len(row))] for row in width]
    assert tokens._fitting(width, selector).tolist() == want


def test_joined_pieces_have_no_more_space_than_they_need():
    library = tokens.encoder(tokenizer_path()).library
    seen = []

    class Heard:
        def encode_batch_fast(self, texts, add_special_tokens):
            seen.extend(texts)
            return library.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    own = tokens.WordLibrary(Heard())
    seen.clear()
    some = [b" the", b"Don't", b"\nend", b".'s", b"\x0b", b" x \x01", b" last"]
    flat, sizes = own([p for p in some if b"\x01" not in p])
    assert seen == [" the \x01 Don't \x01\nend \x01 .'s \x01\x0b \x01 last"]
    alone = [library.tokenizer.encode(p.decode(), add_special_tokens=False).ids for p in some]
    assert sizes.tolist() == [len(a) for p, a in zip(some, alone, strict=True) if b"\x01" not in p]
    assert own(some)[0].tolist() == sum(alone, []) and len(flat) < len(own(some)[0])


def test_words_of_letters_are_joined_without_marks():
    library = tokens.encoder(tokenizer_path()).library
    seen = []

    class Heard:
        def get_vocab(self):
            return library.tokenizer.get_vocab()

        def encode_batch_fast(self, texts, add_special_tokens):
            seen.extend(texts)
            return library.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    own = tokens.WordLibrary(Heard(), "</w>")
    for some in ([b" the", b"\nend", b"Word", " \u00e9cole".encode()], [b" the", b"don't", b"x", b"  ", b" 12"], [" \u0130i".encode(), b"x"], ["\u0958".encode()], [b"!"]):
        seen.clear()
        flat, sizes = own(some)
        alone = [library.tokenizer.encode(p.decode(), add_special_tokens=False).ids for p in some]
        assert sizes.tolist() == list(map(len, alone)) and flat.tolist() == sum(alone, [])
        if some[0] == b" the":
            assert seen == ([" the\nend Word \u00e9cole"] if len(some) == 4 else [" the x", " don't \x01   \x01 12"])


def encoded(own, texts):
    raw, offsets, _ = utf8(pa.array(texts))
    return own.encode(raw, offsets)


def test_pieces_equal_the_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(3)
    parts = ["the", "Don't", "l'été", "école", "!!", "...", "'s", "end.'s", "<|endoftext|>", "<|endoftext|>.", "a<|startoftext|>b", "x\x1cy", " ", " z", "12,5", "(Wow)", "\n", "\t", "ΣΑΣ.", "İi!", "日本語。", "😀😀", "́", "≠", "≠", "KK", "__init__", "a|b|", "ﬁn.", "", "İ.", "Wordİ", "i̇,", "\x01", "a\x01b", "\x85", "\u3000", "\u200b", "ı.", "ẞ!", "Å-", "\r\n", "\x0b", "H\u0331", "h\u0331,", "<|ENDOFTEXT|>", "I\u0307.", "WORD.", "K\u0301", "o'", "O'Re", "=\u0338"]
    texts = [rng.choice(["", " "]).join(rng.choice(parts) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randrange(40))) for _ in range(20_000)]
    own = tokens.encoder(tokenizer_path())
    assert isinstance(own, tokens.WordEncoder)
    for i in range(0, len(texts), 4000):
        ids, size = encoded(own, texts[i : i + 4000])
        want = [library.encode(t, add_special_tokens=False).ids for t in texts[i : i + 4000]]
        assert size.tolist() == list(map(len, want))
        assert ids.tolist() == [x for w in want for x in w]


def test_other_tokenizers_encode_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    own, library = tokens.encoder(path), Tokenizer.from_file(path)
    texts = ["Some words  and\n\n more", "", " x ", "İ. <|endoftext|>"]
    assert own.cuts is tokens.no_cuts
    assert encoded(own, texts)[0].tolist() == [x for t in texts for x in library.encode(t, add_special_tokens=False).ids]


def test_forgotten_pieces_are_learnt_anew(monkeypatch):
    own, texts = tokens.encoder(tokenizer_path()), [" ".join(f"w{i}x{j}" for i in range(50)) for j in range(6)]
    whole = [encoded(own, [t])[0].tolist() for t in texts]
    monkeypatch.setattr(pieces, "CACHE_PIECES", 60)
    assert [encoded(own, [t])[0].tolist() for t in texts] == whole


def test_token_files_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rows = [(i * 37 % 101, f"Text {i}, again and again. " * (i % 9), None, None) for i in range(101)]
    rows += [(None, None, None, None), (200, "", None, None), (5, "same id", None, None), (5, "same id", None, None), (201, "word " * 300_000, None, None)]
    path = tokens.write_tokens(docs_of(spark, rows), tokenizer_path(), str(tmp_path / "out"), partitions=5)
    got = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    want = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t, _, _ in rows)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    assert tokens.read_tokens(spark, tokens.write_tokens(docs_of(spark, []), tokenizer_path())).count() == 0


def slow_grams(text):
    counts = Counter()
    word = ""
    for c in [*(text or ""), " "]:
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            w = f"\x01{word}\x01"
            counts.update(word)
            counts.update(w[i : i + 2] for i in range(len(w) - 1))
            counts.update(w[i : i + 3] for i in range(len(w) - 2))
            word = ""
    return counts


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def test_grams_by_definition():
    rng = random.Random(1)
    texts = ["", "a", " ", "Ab, cD!e", "", "Ünï 日本 Ωx", "ab"] + ["".join(rng.choice("aB é.,\n日") for _ in range(rng.randrange(80))) for _ in range(200)]
    raw, at, _ = utf8(pa.array(texts))
    group, gram, n = langid.gram_counts(raw, at, np.arange(len(texts)))
    got = defaultdict(dict)
    for g, x, c in zip(group.tolist(), gram.tolist(), n.tolist(), strict=True):
        got[g][x] = c
    for i, t in enumerate(texts):
        assert got.get(i, {}) == {code(g): c for g, c in slow_grams(t).items()}


def slow_language(text, profiles, length=langid.PROFILE):
    own = [code(g) for g, _ in sorted(slow_grams(text).items(), key=lambda x: (-x[1], code(x[0])))[:length]]
    if not own or not profiles:
        return "und", 0.0
    far = {lang: sum(abs(p[g] - i) if g in p else length for i, g in enumerate(own)) for lang, p in profiles.items()}
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (len(own) * length)


def test_predictions_against_slow_profiles(spark):
    rows = [(i, t, lang, None) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr"), ("un dos tres", None), ("", "en"), (None, "de"), ("12 34", "fr"), ("THE DOG", None), ("und und", "en")] * 3)]
    docs = docs_of(spark, rows)
    counts = defaultdict(Counter)
    for _, t, lang, _ in rows:
        if lang:
            counts[lang] += slow_grams(t)
    profiles = {lang: {code(g): i for i, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[: langid.PROFILE])} for lang, c in counts.items()}
    got = langid.identify(docs, langid.fitted(docs), keep=("text",)).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = slow_language(r["text"], profiles)
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score)
    none = langid.identify(docs, langid.fitted(docs_of(spark, []))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert langid.identify(docs_of(spark, []), langid.fitted(docs)).count() == 0


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    got = llm_queries()["op1_language_id"](spark, path).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    own = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"] and lang[r["doc_id"]]]
    assert len(own) > 200 and sum(own) / len(own) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("seed", range(20))
def test_sums_over_the_budget_against_all_sums(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 40), 4, replace=False))
    spare = rng.integers(0, 4, 4)
    budget, over = int(rng.integers(0, 120)), int(rng.integers(0, 40))
    sums = {int(np.dot(lengths, t)) for t in np.ndindex(*(spare + 1))}
    took = mixing.fill(lengths, spare, budget, over)
    assert (took <= spare).all()
    assert int((took * lengths).sum()) == min((s for s in sums if s <= budget + over), key=lambda s: (abs(s - budget), s))


def test_one_long_text_is_taken_where_that_is_nearer():
    lengths, counts = np.array([2, 25, 400_000]), np.array([1, 1, 1])
    assert (mixing.fit(lengths, counts, 278_403) * lengths).sum() == 400_027  # short ones are taken first
    assert (mixing.fit(lengths, counts, 150_000) * lengths).sum() == 81
