import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import ann, katz, toxicity
from lodestone.llm.blocks import utf8, written
from lodestone.llm.queries import llm_queries

DOCS = "doc_id long, text string, h string, w string, kind string, flush string, n_tokens string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, "z", "q", None) for i, t in rows], DOCS)


class SlowKatz:
    def __init__(self, texts):
        seqs = [["<s>", *t.split(), "</s>"] for t in texts]
        self.uni = Counter(w for s in seqs for w in s[1:])
        self.hist = Counter(w for s in seqs for w in s[:-1])
        self.two = Counter(p for s in seqs for p in zip(s, s[1:], strict=False))
        self.n = sum(self.uni.values())
        self.d1 = katz.good_turing(Counter(self.uni.values()))
        self.d2 = katz.good_turing(Counter(self.two.values()))
        lost = sum((1 - self.d1[c]) * c for c in self.uni.values() if c <= katz.DISCOUNTED)
        self.scale = self.n if lost else self.n + 1
        self.unknown = (lost or 1) / self.scale

    def prior(self, w):
        c = self.uni.get(w, 0)
        return self.unknown if not c else (self.d1[c] if c <= katz.DISCOUNTED else 1) * c / self.scale

    def p(self, h, w):
        kept = {b: (self.d2[c] if c <= katz.DISCOUNTED else 1) * c for (a, b), c in self.two.items() if a == h}
        if not kept:
            return self.prior(w)
        whole = self.hist[h] if sum(kept.values()) < self.hist[h] else self.hist[h] + 1
        if w in kept:
            return kept[w] / whole
        return (1 - sum(kept.values()) / whole) / (1 - sum(map(self.prior, kept))) * self.prior(w)


def lm_texts(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "日本"]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.4:
            out.append(rng.choice(out))
        else:
            out.append(" ".join(vocab[min(int(rng.expovariate(0.15)), 41)] for _ in range(rng.randrange(0, 30))))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_katz_against_slow_model(spark, seed):
    texts = lm_texts(seed)
    slow = SlowKatz(texts[:45])
    rows = [(i, t.upper() if i == 3 else t) for i, t in enumerate(texts)] + [(500, None), (None, ""), (501, "never seen w1 words"), (1, texts[1])]
    docs = docs_of(spark, rows)
    model = katz.fit(docs, F.coalesce(F.col("doc_id") < 45, F.lit(False)) & (F.monotonically_increasing_id() >= 0))
    train = [t or "" for i, t in rows if i is not None and i < 45]
    slow = SlowKatz([t.lower() for t in train])
    space = slow.n + 0.5 * (len(slow.uni) + 1)
    got = katz.score(docs, model, keep=("text",)).collect()
    assert len(got) == len(rows)
    for r in got:
        seq = ["<s>", *(r["text"] or "").lower().split(), "</s>"]
        assert r["train_tokens"] == slow.n and r["n_tokens"] == len(seq) - 1
        assert r["n_known"] == sum(w in slow.uni for w in seq[1:])
        assert r["base_score"] == pytest.approx(sum(math.log10((slow.uni.get(w, 0) + 0.5) / space) for w in seq[1:]))
        assert r["score"] == pytest.approx(sum(math.log10(slow.p(h, w)) for h, w in zip(seq, seq[1:], strict=False)))
    for h in ["<s>", "w0", "w1", "w3", "w20", "never"]:
        assert sum(slow.p(h, w) for w in slow.uni) + slow.p(h, "unknown") == pytest.approx(1)


def test_katz_goes_by_parts_of_the_bigrams(spark, monkeypatch):
    docs = docs_of(spark, list(enumerate(lm_texts(5))))
    names = []
    monkeypatch.setattr(katz, "written", lambda df, name, *rest: names.append(name) or written(df, name, *rest))
    model = katz.fit(docs)
    pairs = {(a, b) for t in lm_texts(5) for s in [["<s>", *t.split(), "</s>"]] for a, b in zip(s, s[1:], strict=False)}
    own = [p.select("h", "w").toPandas().to_numpy(np.int64).view(np.uint64) for p in model.parts]
    assert len(own) == katz.PARTS > 1 and model.bigrams.count() == sum(map(len, own)) == len(pairs)
    assert all(len(p) and (katz.pair_part(p[:, 0].copy(), p[:, 1].copy()) == i).all() for i, p in enumerate(own))
    assert katz.score(docs, model).count() == 60
    assert names.count("katz-pairs") == names.count("katz-bigrams") == katz.PARTS and names.count("katz-sums") == 1 + katz.PARTS


def test_katz_notices_documents_in_another_order(spark):
    docs = docs_of(spark, list(enumerate(lm_texts(6))))
    model = katz.fit(docs)
    new = F.udf(lambda: str(random.SystemRandom().random())).asNondeterministic()
    other = docs.withColumn("text", F.concat_ws(" ", "text", new()))
    with pytest.raises(Exception, match="in another order"):
        katz.score(other, model).collect()


def test_katz_of_nothing(spark):
    docs = docs_of(spark, [(1, "a b"), (2, None)])
    model = katz.fit(docs, F.lit(False))
    got = katz.score(docs, model).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert katz.score(docs_of(spark, []), model).count() == 0


def test_katz_beats_its_base_on_held_out_texts(spark):
    got = llm_queries()["op9_lm_scoring"](spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in got)


VECTORS = "vec_id long, embedding array<float>, label int, key string, leaf string, ids string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "k", "l", "i") for i, v in rows], VECTORS)


def slow_nearest(rows, asked, k=10):
    good = sorted({(i, tuple(np.float32(x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    ids, x = [i for i, _ in good], np.array([v for _, v in good], float)
    out = set()
    for q, (i, v) in enumerate(good):
        if asked(i):
            far = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, far)) if ids[j] != i][:k]
            out |= {(i, rank, ids[j], float(far[j])) for rank, j in enumerate(order, 1)}
    return out


def test_nearest_is_exact_where_all_leaves_are_seen(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(150)]
    rows += [(200 + i, [1.0, 1.0, 1.0]) for i in range(60)] + [(7, None), (8, [0.0] * 3), (9, [1.0, None, 2.0]), (10, [float("nan"), 1.0, 1.0]), (11, [float("inf"), 1.0, 0.0]), (None, [1.0, 2.0, 3.0]), (200, [1.0, 1.0, 1.0]), (12, [])]
    rows = [(i, v) for i, v in rows if i != 7 or v is None]
    got = ann.nearest(vectors_of(spark, rows), F.col("vec_id") % 10 == 0, recall=1.0, leaf=10_000)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == slow_nearest(rows, lambda i: i % 10 == 0)


def test_nearest_of_few_and_none(spark):
    assert ann.nearest(vectors_of(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    few = [(0, [1.0, 0.0]), (1, [0.0, 2.0]), (2, [1.0, 0.0])]
    got = ann.nearest(vectors_of(spark, few), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(2, 0.0), (1, math.sqrt(5))]


@pytest.mark.parametrize("path", ["/root/testdata/sf0.1"])
def test_nearest_recall(spark, path):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = slow_nearest(rows, lambda i: i % 100 == 0)
    got = {(r["query_id"], r["vec_id"]): r for r in llm_queries()["op3_nearest_neighbours"](spark, path).collect()}
    assert len(got) == len(want)
    found = [(i, v) in got for i, _, v, _ in want]
    assert sum(found) / len(found) >= 0.92
    assert all(got[i, v]["score"] == pytest.approx(s, rel=1e-12) for i, _, v, s in want if (i, v) in got)
    by = defaultdict(list)
    for r in got.values():
        by[r["query_id"]].append((r["rank"], r["score"], r["vec_id"]))
    assert all([x[0] for x in sorted(v)] == list(range(1, 11)) and [x[1:] for x in sorted(v)] == sorted(x[1:] for x in v) for v in by.values())


def slow_subsequences(word):
    w, out = [toxicity.EDGE, *word, toxicity.EDGE], defaultdict(float)
    for i, j, k in combinations(range(len(w)), 3):
        if k - i < toxicity.SPAN:
            out[w[i] << 12 | w[j] << 6 | w[k]] += toxicity.DECAY ** (k - i - 2)
    return out


def test_kernel_by_definition():
    words, which, _ = toxicity.words_of(["Idiot haha a", "i d i o t! x-y", "", "été Straße"])
    assert len(words) == 6 and which[0] == which[3]
    letters = toxicity.letters_of(words)
    weights = np.random.default_rng(0).normal(size=1 << 18)
    got = toxicity.margins(letters, weights, 0.25)
    for word, value, size in zip(words, got, letters.size, strict=True):
        want = sum(w * weights[u] for u, w in slow_subsequences(word).items()) / toxicity.NORM[size] + 0.25
        assert value == pytest.approx(want)


def test_words_stay_within_rows():
    raw, at, _ = utf8(pa.array(["ab", "cd e", "", "f g", "h"]))
    letters = toxicity.Letters.of(raw, at)
    assert letters.row.tolist() == [0, 1, 1, 3, 4] and letters.size.tolist() == [4, 4, 3, 4, 3]


def test_toxic_documents_held_out(spark):
    path = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in llm_queries()["op2_toxicity"](spark, path).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[i]["predicted"], y) for i, y in labels.items() if got[i]["held_out"]]
    tp = sum(p and y for p, y in held)
    assert tp >= 0.8 * sum(y for _, y in held) and tp >= 0.9 * sum(p for p, _ in held)  # some labels have no insult behind them
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_tolerates_inserted_letters_and_odd_rows(spark):
    rng = random.Random(4)
    vocab = ["".join(rng.choice(["th", "er", "an", "on", "re"]) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    texts = [" ".join(rng.choice(vocab) for _ in range(30)) for _ in range(400)]
    labels = [int(i % 5 == 0) for i in range(400)]
    texts = [t.replace(" ", f" {rng.choice(['idiot', 'stupid'])} ", 1) if y else t for t, y in zip(texts, labels, strict=True)]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, score string")
    marks = spark.createDataFrame([(i, 0, y) for i, y in enumerate(labels)] + [(3, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    machine = toxicity.train(docs, marks)
    odd = [(0, None), (1, ""), (2, "12 !"), (3, "the idiiot here"), (4, "an i d i o t on"), (5, "st.up.id"), (6, "thaner on there"), (6, "thaner on there"), (None, "id-iot")]
    got = toxicity.score(spark.createDataFrame(odd, "doc_id long, text string"), machine).collect()
    assert len(got) == len(odd)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r["score"])
    assert min(*by[3], *by[4], *by[5], *by[None]) > 0.3 > max(*by[0], *by[1], *by[2], *by[6])
    assert by[0] == by[1] == by[2] and len(by[6]) == 2
    none = toxicity.train(docs, marks.where("false"))
    assert max(r["score"] for r in toxicity.score(docs, none).collect()) < 1e-5
