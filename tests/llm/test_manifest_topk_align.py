import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import align, merkle, topk
from lodestone.llm.queries import ALIGNED, llm_queries, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars int, tree long, rid string, level int, place string, root string, digest binary"


def docs_of(spark, rows):
    return spark.createDataFrame([(*row, 7, "x", 1, "y", "z", b"d") for row in rows], DOCS)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def up(level):
    return [h("".join(level[i : i + 8])) for i in range(0, len(level), 8)]


def climb(levels, place, shown):
    """Siblings and the folded digest of a leaf in one tree."""
    around = []
    for level in levels[:-1]:
        first = place // 8 * 8
        run = level[first : first + 8]
        around += run[: place - first] + run[place - first + 1 :]
        shown = h("".join([*run[: place - first], shown, *run[place - first + 1 :]]))
        place //= 8
    return around, shown


def tower(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(up(levels[-1]))
    return levels


def slow_manifest(rows):
    def tampered(row):
        if row[0] is None or row[1] is None or zlib.crc32(str(row[0]).encode()) % 3:
            return row
        return (row[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]), *row[2:])

    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf_of(*row), leaf_of(*tampered(row)), row[0]))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = [tower([r[2] for r in sorted(groups[n])]) for n in names]
    top = tower([t[-1][0] for t in trees])
    out = []
    for rank, name in enumerate(names):
        for place, (_, _, leaf, shown, doc_id) in enumerate(sorted(groups[name])):
            low, folded = climb(trees[rank], place, shown)
            high, folded = climb(top, rank, folded)
            root = top[-1][0]
            out.append((doc_id, leaf, trees[rank][-1][0], root, h("".join(low + high)), folded, folded == root))
    return out


def sort_key(row):
    return tuple((v is not None, v) if not isinstance(v, bool) else (True, v) for v in row)


def manifest_of(spark, rows):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.verified(merkle.document_leaves(docs_of(spark, rows), tampered))
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in found.select(*columns).collect()), key=sort_key)


@pytest.mark.parametrize("langs, most", [(1, 1), (1, 9), (9, 3), (70, 20)])
def test_manifest_like_brute_force(spark, langs, most):
    rng = random.Random(langs)
    rows = []
    for lang in range(langs):
        name = None if lang == 1 else f"{'é' if lang % 3 else 'z'}{lang}"
        for _ in range(rng.randrange(1, most + 1) if most > 1 else 1):
            i = rng.choice([None, *range(50)]) if most > 1 else 6
            rows.append((i, rng.choice([None, "", "Some TEXT", "no capitals", "É Ü", "long " * 3000]), name, rng.choice([None, "s"]), rng.choice([None, 3])))
    rows += rows[:2] if most > 1 else []
    assert manifest_of(spark, rows) == sorted(slow_manifest(rows), key=sort_key)


def test_manifest_above_a_block(spark):
    rows = [(i, f"Text {i}", "en" if i % 7 else "de", "s", i) for i in range(2 * merkle.BLOCK + 700)]
    found = manifest_of(spark, rows)
    assert found == sorted(slow_manifest(rows), key=sort_key)
    assert {r[-1] for r in found} == {True, False}


def test_manifest_join_keys_hold_a_block_at_most(spark):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(3 * merkle.BLOCK)]
    made = merkle.build(merkle.document_leaves(docs_of(spark, rows), F.lit(False)))
    assert made.leaves.groupBy("tree", "block").count().agg(F.max("count")).first()[0] == merkle.BLOCK
    key = ("home", "block", "tree", "level", "idx")
    assert made.paths.count() == made.paths.select(*key).distinct().count()


def test_siblings_fold_into_the_root(spark):
    rows = [(i, f"Text {i}", "en" if i % 3 else None, "s", i) for i in range(20)]
    found = merkle.verified(merkle.document_leaves(docs_of(spark, rows), F.lit(False)), with_siblings=True).collect()
    for r in found:
        assert h(bytes(r["siblings"]).hex()) == r["proof_sha256"] and len(r["siblings"]) % 32 == 0 and r["verified"]


def test_manifest_of_nothing(spark):
    assert manifest_of(spark, []) == []


def test_manifest_settings_come_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    manifest_of(spark, [(1, "A", "en", "s", 1)])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


VECTORS = "vec_id long, embedding array<double>, id string, v string, asked int, rank string, score string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", 1, "c", "d") for i, v in rows], VECTORS)


def slow_topk(rows, k):
    held = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        held[i] = max(held.get(i, []), [int(np.floor(64 * x)) for x in v])
    out = set()
    for q, a in held.items():
        if q % 20 == 0:
            near = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in held.items() if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(near)}
    return out


def odd_vectors(seed, n=300):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([0.0, 0.001, -0.5, 0.25, 1.0, rng.uniform(-2, 2)]) for _ in range(rng.choice([6, 6, 6, 0, 9]))]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(40)] + rows[:30]
    return rows + [(None, [1.0] * 6), (1000, None), (1020, [None, 1.0]), (1040, [float("nan")] * 6), (1060, [float("inf")] * 6), (20, [9.0] * 6)]


@pytest.mark.parametrize("components", [1 << 21, 90])
def test_topk_like_brute_force(spark, components):
    rows = odd_vectors(components)
    found = topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 20 == 0, 7, candidate_components=components, query_components=components)
    assert {tuple(r) for r in found.collect()} == slow_topk(rows, 7)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]


def test_topk_fewer_candidates_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [2.0])]
    assert {tuple(r) for r in topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 20 == 0).collect()} == {(0, 1, 1, 8192), (0, 2, 2, 8192)}
    assert topk.top_k(vectors_of(spark, []), F.col("vec_id") % 20 == 0).collect() == []
    assert topk.top_k(vectors_of(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).collect() == []


def test_topk_wide_sums_and_too_large_components(spark):
    big = 100_000.0
    rows = [(0, [big] * 50), (1, [big] * 50), (2, [-big] * 50), (3, [1e300] * 50)]
    found = {(r["vec_id"], r["score"]) for r in topk.top_k(vectors_of(spark, rows), F.col("vec_id") == 0).collect()}
    assert found == {(1, 50 * 6_400_000**2), (2, -50 * 6_400_000**2)}


def test_selection_keeps_the_first_of_ties():
    rows, _ = topk.select(np.array([1, 5, 3, 3, 3, 0]), 3)
    assert sorted(rows.tolist()) == [1, 2, 3]


def slow_align(texts):
    import sentencepiece

    a = align.tokenizers_file(tokenizer_path(ALIGNED[0]), special_as_text=True)
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(ALIGNED[1]))
    to_byte, rows, links = align.byte_level_bytes(), [], []
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append((0, 0, 0, "", []))
            continue
        spans = []
        for ids, own in ((ids_a, bytes_a), (ids_b, bytes_b)):
            ends = np.cumsum([len(x) for x in own]).tolist()
            spans.append([(e - len(x), e, i) for i, e, x in zip(ids, ends, own, strict=True)])
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, first = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for s, e, i in side if first <= s and e <= end) for side in spans))
            first = end
        pairs = [(i, j) for s, e, i in spans[0] for t, f, j in spans[1] if s < f and t < e]
        rows.append((len(ids_a), len(ids_b), len(groups), h(";".join(groups)), pairs))
        links += pairs
    count = Counter(links)
    high = defaultdict(int)
    for (_, j), n in count.items():
        high[j] = max(high[j], n)
    return [(na, nb, ng, len(p), sum(count[x] == high[x[1]] for x in p), sum(count[x] for x in p), sha) for na, nb, ng, sha, p in rows]


def odd_texts(seed, n=300):
    rng = random.Random(seed)
    bits = [" ", "  ", "\n", "\t", "\r\n", "　", " ", "▁", "<s>", "</s>", "<unk>", "<|endoftext|>", "<0x41>", "a", " word", "'s", "'ll", "é", "é", "日本", "🙂",
            "​", "123", "!?", "\x00", "\x1c", "\x85", "ﬁ", "Å", "İ.", " the", " of", "naïve", " unbelievably", "ß"]
    return [None, "", " ", "  ", "\n", "x", *("".join(rng.choice(bits) for _ in range(rng.randrange(0, 14))) for _ in range(n))]


@pytest.mark.parametrize("block", [200, 1 << 24])
def test_alignment_like_brute_force(spark, block):
    texts = odd_texts(block) + ["the same text again"] * 3
    ids = [None, *range(len(texts) - 2), 5]
    found = align.align(docs_of(spark, [(i, t, "en", "s", 1) for i, t in zip(ids, texts, strict=True)]), *map(tokenizer_path, ALIGNED), block_bytes=block).collect()
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = sorted(((r["doc_id"], *(r[c] for c in columns)) for r in found), key=sort_key)
    assert got == sorted(((i, *row) for i, row in zip(ids, slow_align(texts), strict=True)), key=sort_key)


def test_alignment_of_long_and_no_texts(spark):
    texts = ["longword" * 20_000, "many words in one text\n" * 4_000]
    found = align.align(docs_of(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)]), *map(tokenizer_path, ALIGNED)).orderBy("doc_id").collect()
    slow = slow_ends(texts)
    assert [(r["n_a"], r["n_b"], r["n_groups"]) for r in found] == slow
    assert align.align(docs_of(spark, []), *map(tokenizer_path, ALIGNED)).collect() == []


def slow_ends(texts):
    a, b = align.byte_level_side(tokenizer_path(ALIGNED[0])), align.sentence_side(tokenizer_path(ALIGNED[1]))
    out = []
    for text in texts:
        ids = a.encode([" " + text])[0], b.encode([" " + text])[0]
        ends = [set(np.cumsum([side.length[i] for i in own]).tolist()) for side, own in zip((a, b), ids, strict=True)]
        out.append((len(ids[0]), len(ids[1]), len(ends[0] & ends[1])))
    return out


def test_links_of_slices_are_the_overlaps():
    rng = random.Random(5)
    for _ in range(200):
        stops = sorted(rng.sample(range(1, 60), rng.randrange(1, 12)))
        a = np.array(sorted({*stops[::2], stops[-1]}))
        b = np.array(sorted({*stops[1::2], stops[-1]}))
        a_cuts, b_cuts = align.common_ends(a.tolist(), b.tolist())
        left, right = align.linked(np.diff(a_cuts, prepend=-1), np.diff(b_cuts, prepend=-1), a, b)
        spans = [list(zip([0, *x.tolist()], x.tolist(), strict=False)) for x in (a, b)]
        assert set(zip(left.tolist(), right.tolist(), strict=True)) == {
            (i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e}


def test_packed_links_come_back():
    for values in ([], [0, 255], [256, 1], [1 << 16, 3]):
        assert align.unpacked(align.packed(np.array(values, np.int64))).tolist() == values


def test_registered_queries_on_given_data(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    found = llm_queries()["op13_token_alignment"](spark, data).collect()
    rows = docs.select("doc_id", "text").collect()
    slow = slow_align([r["text"] for r in rows])
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((r["doc_id"], *(r[c] for c in columns)) for r in found) == sorted((r["doc_id"], *s) for r, s in zip(rows, slow, strict=True))
    assert llm_queries()["op11_merkle_manifest"](spark, data).count() == docs.count()
    assert pa.types.is_int64(llm_queries()["op12_exact_topk"](spark, data).toArrow().schema.field("score").type)
