import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.functions.text import tokenize
from lodestone.operators import bm25, scoring, search
from lodestone.operators.bm25 import Index, bm25_scores, build_index, scored_cells
from lodestone.plans import derived

WORDS = "order revenue region customer the discount date_key ship supplier rate".split()


def brute_bm25(documents, query):
    """BM25 with its usual parameters, document by document."""
    bags = [text.lower().replace("_", " ").split() for _, text in documents]
    n, mean = len(bags), sum(map(len, bags)) / len(bags)
    vocabulary = {w for bag in bags for w in bag}
    idf = {}
    for w in vocabulary:
        df = sum(w in bag for bag in bags)
        idf[w] = math.log(n - df + 0.5) - math.log(df + 0.5)
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    scores = []
    for bag in bags:
        total = 0.0
        for w in query.lower().replace("_", " ").split():
            tf = bag.count(w)
            total += idf.get(w, 0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(bag) / mean))
        scores.append(total)
    return scores


def brute_cosine(vectors, doc_ids, query):
    def unit(v):
        length = math.sqrt(sum(x * x for x in v)) or 1.0
        return [x / length for x in v]

    return [
        sum(a * b for a, b in zip(unit(vectors[d]), unit(query))) if d in vectors and query else 0.0
        for d in doc_ids
    ]


def stretch(scores):
    low, high = min(scores), max(scores)
    return [0.0 if high == low else (s - low) / (high - low) for s in scores]


def best(doc_ids, scores, k):
    ranked = sorted(zip(doc_ids, scores), key=lambda p: (-round(p[1], 6), p[0]))[:k]
    return [(d, pytest.approx(s, abs=2e-6)) for d, s in ranked]


@pytest.fixture(scope="module")
def setup(spark):
    rng = random.Random(7)
    documents = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    documents += [(60, ""), (61, "Order_Order order\n\tthe"), (62, "unique term")]
    vectors = {i: [rng.uniform(-1, 1) for _ in range(4)] for i in range(0, 60, 2)}
    vectors[60] = [0.0] * 4
    queries = [(0, "order revenue order"), (1, "the the date_key"), (2, "nothing known"), (3, "UNIQUE region")]
    asked = {0: [0.2, -0.1, 0.9, 0.0], 1: [1.0, 0.0, 0.0, 0.0], 3: [0.0] * 4}
    index = build_index(
        spark.createDataFrame(documents, "doc_id bigint, text string"),
        spark.createDataFrame(list(vectors.items()), "doc_id bigint, vector array<float>"))
    return (
        documents, vectors, queries, asked, index,
        spark.createDataFrame(queries, "query_id bigint, text string"),
        spark.createDataFrame(list(asked.items()), "query_id bigint, vector array<float>"),
    )


def found(df):
    rows = {}
    for r in df.orderBy("query_id", "rank").collect():
        rows.setdefault(r.query_id, []).append((r.doc_id, r.score))
    return rows


def expected(setup, method, k):
    documents, vectors, queries, asked, *_ = setup
    ids = [d for d, _ in documents]
    result = {}
    for q, text in queries:
        words, near = brute_bm25(documents, text), brute_cosine(vectors, ids, asked.get(q))
        mixed = [0.5 * a + 0.5 * b for a, b in zip(stretch(near), stretch(words))]
        result[q] = best(ids, {"keyword": words, "vector": near, "hybrid": mixed}[method], k)
    return result


def test_tokens(spark):
    text = "Date_Key  A b\x1cc d\n"
    got = spark.range(1).select(tokenize(F.lit(text)).alias("t")).first().t
    assert got == text.lower().replace("_", " ").split() == ["date", "key", "a", "b", "c", "d"]


def test_postings_count_terms(setup):
    documents, index = setup[0], setup[4]
    got = {(r.doc_id, r.term): (r.tf, r.length) for r in index.postings.collect()}
    want = {}
    for d, text in documents:
        bag = text.lower().replace("_", " ").split()
        want.update({(d, w): (bag.count(w), len(bag)) for w in bag})
    assert got == want


@pytest.mark.parametrize("method", ("keyword", "vector", "hybrid"))
def test_search_equals_brute_force(setup, method):
    *_, index, queries, vectors = setup
    assert found(search.Retriever(index, queries, vectors).search(method, 5)) == expected(setup, method, 5)


def test_joined_scores_equal_brute_force(setup):
    documents, _, queries, _, index, asked, _ = setup
    got = {(r.query_id, r.doc_id): r.score for r in bm25_scores(index, asked).collect()}
    for q, text in queries:
        for (d, _), score in zip(documents, brute_bm25(documents, text)):
            assert got.get((q, d), 0.0) == pytest.approx(score, abs=1e-9)


@pytest.mark.parametrize("method", ("keyword", "vector", "hybrid"))
def test_more_questions_than_one_pass_takes(setup, monkeypatch, method):
    *_, index, queries, vectors = setup
    whole = found(search.Retriever(index, queries, vectors).search(method, 5))
    for name, bound in (("QUERIES_PER_PASS", 2), ("TERMS_PER_PASS", 1)):
        monkeypatch.setattr(search, name, bound)
        again = queries.unionByName(queries).unionByName(queries)
        many = search.Retriever(index, again, vectors.unionByName(vectors))
        assert many._size[1] > 1
        assert found(many.search(method, 5)) == whole


@pytest.mark.parametrize("bound", (256, 2))
def test_vector_scores_of_all_documents(setup, monkeypatch, bound):
    documents, vectors, queries, asked, index, table, given = setup
    monkeypatch.setattr(search, "QUERIES_PER_PASS", bound)
    got = {(r.query_id, r.doc_id): r.score for r in search.Retriever(index, table, given).vector_scores().collect()}
    ids = [d for d, _ in documents]
    assert len(got) == len(ids) * len(queries)
    for q, _ in queries:
        for d, score in zip(ids, brute_cosine(vectors, ids, asked.get(q))):
            assert got[q, d] == pytest.approx(score, abs=1e-6)


def rare_words(rng, n):
    """Words of which most are in few documents, so that all weights are positive."""
    return " ".join(f"w{min(int(rng.expovariate(0.02)), 400)}" for _ in range(n))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(11)
    documents = [(i, rare_words(rng, rng.randint(0, 60))) for i in range(900)] + [(900, "w1 " * 50), (901, "unique")]
    queries = [(q, rare_words(rng, rng.randint(1, 12))) for q in range(30)] + [(30, "unique"), (31, "none of these"), (32, None)]
    index = build_index(spark.createDataFrame(documents, "doc_id bigint, text string"))
    return documents, queries, index.write(str(tmp_path_factory.mktemp("i") / "index")), spark.createDataFrame(queries, "query_id bigint, text string")


@pytest.mark.parametrize("k", (1, 5, 50))
def test_keyword_search_from_postings_equals_brute_force(stored, k):
    documents, queries, index, asked = stored
    ids = [d for d, _ in documents]
    want = {q: best(ids, brute_bm25(documents, text or ""), k) for q, text in queries}
    assert index.corpus.first().mean_idf > 0
    assert found(search.Retriever(index, asked).keyword_search(k)) == want


def test_keyword_search_reads_the_buckets_of_its_terms(spark, stored):
    index = stored[2]
    plan = scored_cells(index, spark.createDataFrame([(1, "unique")], "query_id bigint, text string"), 5)._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters: [" in line and "bucket" in line]
    assert scans and all("IN (" in line or "bucket#" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    named = stored[2].blocks.where(F.col("term") == "unique").select("bucket").distinct().collect()
    assert len(named) == 1


def test_ranges_that_cannot_win_are_skipped(spark, stored):
    documents, _, index, _ = stored
    asked = spark.createDataFrame([(1, "w1 w2 unique")], "query_id bigint, text string")
    few, all_pairs = scored_cells(index, asked, 1).count(), scored_cells(index, asked, None).count()
    assert few == 1 < all_pairs  # only the range of the document that holds the rare word is scored


def test_questions_in_groups_give_the_same_scores(stored, monkeypatch):
    _, _, index, asked = stored
    whole = {(r.query_id, r.doc_id): round(r.score, 9) for r in bm25_scores(index, asked).collect()}
    monkeypatch.setattr(bm25, "GROUP_QUERIES", 4)
    monkeypatch.setattr(bm25, "SENT_ROWS", 0)
    assert {(r.query_id, r.doc_id): round(r.score, 9) for r in bm25_scores(index, asked).collect()} == whole


def test_blocks_hold_each_posting_once(stored):
    _, _, index, _ = stored
    rows = index.blocks.select("bucket", "term", "range", F.explode(F.arrays_zip("docs", "tfs", "lengths")).alias("p")).select("term", "p.docs", "p.tfs", "p.lengths").collect()
    want = sorted((r.term, r.doc_id, r.tf, r.length) for r in index.postings.collect())
    assert sorted(map(tuple, rows)) == want


def test_stored_postings_are_a_value_a_range_and_bucket(stored):
    """Shuffling and storing them does not grow with the terms of each range."""
    index = stored[2]
    chunks, blocks = index.chunks.select("bucket", "range").collect(), index.blocks.select("term", "bucket", "range").collect()
    assert len(set(chunks)) == len(chunks) == len({(b.bucket, b.range) for b in blocks}) < len(blocks)
    named = index.terms.select("term", bm25.bucket_of(index.buckets).alias("bucket")).collect()
    assert scoring.buckets_of(pa.array([r.term for r in named]), index.buckets).tolist() == [r.bucket for r in named]
    assert {r.term: r.bucket for r in named} == {b.term: b.bucket for b in blocks}


def test_terms_are_split_in_tasks_as_in_columns(spark):
    odd = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    rows = [(i, f"A{c}b_C {c}") for i, c in enumerate(odd)] + [(-1, ""), (-2, None), (-3, " _\u2003"), (-4, "ŞİS ΣΑΣ a  A\x1fa")]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = {r.doc_id: sorted(r.w) for r in documents.select("doc_id", tokenize(F.coalesce("text", F.lit(""))).alias("w")).collect()}
    got = bm25.bags(documents).collect()
    assert {r.doc_id: sorted(t for t, n in zip(r.terms, r.counts, strict=True) for _ in range(n)) for r in got} == want
    assert all(r.length == len(want[r.doc_id]) for r in got)


def test_highs_of_chunks_are_those_of_all_blocks(monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(scoring, "HELD_ROWS", 5)
    weights, batches = {}, []
    for bucket in (1, 2, 1):
        for _ in range(7):
            own = [(f"{bucket}w{i}", [rng.randint(1, 9) for _ in range(n)], [rng.randint(9, 99) for _ in range(n)]) for i, n in enumerate(rng.sample([1, 2, 40, 70], 3))]
            for term, tfs, lengths in own:
                weights.setdefault(term, []).extend(tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * n / 30.0)) for tf, n in zip(tfs, lengths, strict=True))
            table = pa.table([pa.array(c, t) for c, t in zip(zip(*own, strict=True), (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())), strict=True)], names=["term", "tfs", "lengths"])
            batches.append(pa.record_batch([pa.array([bucket], pa.int32()), pa.array([scoring._chunk(table)], pa.binary())], names=["bucket", "chunk"]))
    some = pa.Table.from_batches(list(scoring.chunk_highs(batches, 1.5, 0.75, 30.0, 32)))
    assert all(t.startswith(str(b)) for b, t in zip(some["bucket"].to_pylist(), some["term"].to_pylist(), strict=True)) and some.num_rows < 60
    got = {r["term"]: (r["df"], r["highs"]) for r in scoring.whole_terms(some.drop_columns(["bucket"]), 32).to_pylist()}
    assert got == {t: (len(w), pytest.approx(sorted(w, reverse=True)[:32])) for t, w in weights.items()}


def test_small_batches_give_the_same(spark, setup):
    *_, index, queries, vectors = setup
    whole = found(search.Retriever(index, queries, vectors).hybrid_search(5))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert found(search.Retriever(index, queries, vectors).hybrid_search(5)) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def block_and_batch(documents=5000, queries=7):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    texts = [sorted(rng.sample(words, rng.randint(0, 20))) for _ in range(documents)]
    batch = pa.record_batch({
        "doc_id": pa.array(rng.sample(range(10**6), documents)), "length": pa.array([len(t) for t in texts], pa.int32()),
        "terms": pa.array(texts, pa.list_(pa.string())), "counts": pa.array([[1] * len(t) for t in texts], pa.list_(pa.int32())),
        "vector": pa.array([None if rng.random() < 0.2 else [rng.uniform(-1, 1) for _ in range(4)] for _ in texts], pa.list_(pa.float64())),
    })
    asked = pa.table({
        "query_id": list(range(queries)), "terms": [sorted(rng.sample(words, 5)) for _ in range(queries)],
        "weights": [[rng.random() for _ in range(5)] for _ in range(queries)],
        "unit": [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(queries)],
    })
    return scoring.block_of(asked, 1.5, 0.75, 10.0), batch


def test_large_batches_are_scored_a_slice_at_a_time(monkeypatch):
    """What a task makes of its documents is bounded in rows, whatever the batch; the results are those of the whole batch."""
    block, batch = block_and_batch()
    whole = [block.cosine(batch), block.keyword(batch)]
    sizes, keyword, cosine = [], scoring.QueryBlock.keyword, scoring.QueryBlock.cosine
    monkeypatch.setattr(scoring.QueryBlock, "keyword", lambda self, b: sizes.append(b.num_rows) or keyword(self, b))
    monkeypatch.setattr(scoring.QueryBlock, "cosine", lambda self, b: sizes.append(b.num_rows) or cosine(self, b))
    near, worded = whole
    spans = [near.min(0), near.max(0), worded.min(0), worded.max(0)]
    rows = next(scoring.ranges_in_batches(block)([batch])).to_pydict()
    assert [rows[c] for c in ("v_low", "v_high", "k_low", "k_high")] == [pytest.approx(list(s)) for s in spans]
    mixed = 0.5 * scoring.stretch(near, *spans[:2]) + 0.5 * scoring.stretch(worded, *spans[2:])
    for method, scores in (("vector", near), ("keyword", worded), ("hybrid", mixed)):
        want = scoring.top_rows(block, batch.column("doc_id"), scores, 6).to_pylist()
        got = [r for b in scoring.top_in_batches(block, method, 6, 0.5, spans)([batch]) for r in b.to_pylist()]
        key = lambda r: (r["query_id"], -r["score"], r["doc_id"])
        assert sorted(got, key=key) == sorted(want, key=key)
    parts = list(scoring.cosines_in_batches(block)([batch]))
    assert sum(p.num_rows for p in parts) == near.size
    assert max(sizes) <= scoring.SLICE_ROWS < batch.num_rows


def test_highs_are_brought_together_before_the_shuffle():
    """A batch of blocks gives a row a term, not one a term and range."""
    rng = random.Random(4)
    rows = [(f"w{i % 5}", [rng.randint(1, 9) for _ in range(n)], [rng.randint(9, 99) for _ in range(n)]) for i, n in enumerate([3, 50, 1] * 20)]
    batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())), strict=True)], names=["term", "tfs", "lengths"])
    got = [r for b in scoring.term_highs([batch], 1.5, 0.75, 30.0, 32) for r in b.to_pylist()]
    want = {}
    for term, tfs, lengths in rows:
        want.setdefault(term, []).extend(tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * n / 30.0)) for tf, n in zip(tfs, lengths, strict=True))
    assert len(got) == 5 and {r["term"]: r["n"] for r in got} == {t: len(w) for t, w in want.items()}
    assert {r["term"]: r["best"] for r in got} == {t: pytest.approx(sorted(w, reverse=True)[:32]) for t, w in want.items()}


def test_texts_are_shuffled_once_to_meet_their_vectors(spark, setup):
    texts = spark.createDataFrame(setup[0], "doc_id bigint, text string")
    vectors = spark.createDataFrame(list(setup[1].items()), "doc_id bigint, vector array<float>")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = build_index(texts, vectors, laid_out=False)
        plan = index.documents._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("Exchange " in line for line in plan.splitlines()) == 2  # texts and vectors
    assert plan.index("MapInArrow") < plan.index("Exchange ")  # counted after the join
    got = {r.doc_id: (r.length, dict(zip(r.terms, r.counts, strict=True)), r.vector is not None) for r in index.documents.collect()}
    for i, text in setup[0]:
        words = text.lower().replace("_", " ").split()
        assert got[i] == (len(words), {w: words.count(w) for w in words}, i in setup[1])


def test_without_vectors_hybrid_ranks_by_keyword(setup):
    *_, index, queries, _ = setup
    by_word = found(search.Retriever(index, queries).keyword_search(5))
    alone = found(search.Retriever(index, queries).hybrid_search(5))
    assert {q: [d for d, _ in rows] for q, rows in alone.items()} == {
        q: [d for d, _ in rows] for q, rows in by_word.items()}


def test_queries_without_known_terms(spark, setup):
    *_, index, _, _ = setup
    queries = spark.createDataFrame([(1, "zzz"), (2, None)], "query_id bigint, text string")
    for method in ("keyword", "hybrid"):
        rows = search.Retriever(index, queries).search(method, 2).orderBy("query_id", "rank").collect()
        assert [(r.query_id, r.doc_id, r.score) for r in rows] == [(1, 0, 0.0), (1, 1, 0.0), (2, 0, 0.0), (2, 1, 0.0)]


def test_ids_may_be_text(spark, setup):
    documents = spark.createDataFrame([("table:b", "order line"), ("table:a", "order line"), ("m", "x y z")],
                                      "doc_id string, text string")
    queries = spark.createDataFrame([("q1", "order")], "query_id string, text string")
    rows = search.Retriever(build_index(documents), queries).keyword_search(3).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == ["table:a", "table:b", "m"]


def test_empty_inputs(spark, setup):
    *_, index, queries, vectors = setup
    assert search.Retriever(index, queries.limit(0), vectors).hybrid_search(5).count() == 0
    nothing = build_index(spark.createDataFrame([], "doc_id bigint, text string"))
    assert search.Retriever(nothing, queries).keyword_search(5).count() == 0


def test_index_survives_writing(setup, tmp_path):
    *_, index, queries, vectors = setup
    stored = index.write(str(tmp_path / "index"))
    again = Index.open(queries.sparkSession, str(tmp_path / "index"))
    want = found(search.Retriever(index, queries, vectors).hybrid_search(5))
    assert found(search.Retriever(stored, queries, vectors).hybrid_search(5)) == want
    assert found(search.Retriever(again, queries, vectors).hybrid_search(5)) == want
    rated = [{r.term: (r.df, round(r.idf, 9)) for r in i.rated_terms.collect()} for i in (index, again)]
    assert rated[0] == rated[1]


def candidates(spark, n, queries=1):
    rows = [(q, i + 1, f"doc:{i}", float(n - i)) for q in range(queries) for i in range(n)]
    return spark.createDataFrame(rows, "query_id bigint, rank int, doc_id string, score double")


@pytest.mark.parametrize("reply, n, k, docs", (
    ("3, 1, 2", 3, 3, [2, 0, 1]),
    ("1, 2, 3, 4, 5", 5, 2, [0, 1]),
    ("no idea", 3, 3, [0, 1, 2]),
    ("9, 1, 1, 2", 2, 2, [0, 1]),
    ("99999999999999999999, 2", 3, 2, [1]),
    (None, 3, 2, [0, 1]),
))
def test_reply_order(spark, reply, n, k, docs):
    replies = spark.createDataFrame([(0, reply)], "query_id bigint, reply string")
    rows = search.apply_reply_order(candidates(spark, n), replies, k).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == [f"doc:{d}" for d in docs]


def test_reply_order_scores_fall_in_steps(spark):
    replies = spark.createDataFrame([(0, "2, 1")], "query_id bigint, reply string")
    rows = search.apply_reply_order(candidates(spark, 2, queries=2), replies).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.doc_id, r.score) for r in rows] == [
        (0, "doc:1", 1.0), (0, "doc:0", 0.99), (1, "doc:0", 2.0), (1, "doc:1", 1.0)]


def test_rerank_keeps_order_of_equal_scores(spark):
    rows = search.rerank(candidates(spark, 4), F.when(F.col("doc_id") == "doc:2", 1.0).otherwise(0.0), 3)
    assert [r.doc_id for r in rows.orderBy("rank").collect()] == ["doc:2", "doc:0", "doc:1"]


def test_context_joins_texts_in_rank_order(spark):
    ranked = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 10, "c")], "query_id int, rank int, text string")
    assert search.context_blocks(ranked).first().context == "a\n\nb\n\nc"


def test_texts_are_not_shuffled_for_found_documents(spark, data):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = spark.createDataFrame([(1, 2, 1), (1, 3, 2)], "query_id bigint, doc_id bigint, rank int")
        quoted = derived.quoted_by(ranked, spark, data)
        index = derived.index(spark, data)
        retriever = search.Retriever(index, derived.questions(spark, data), derived.vectors(spark, data, "query_id"))
        schema = search.search_schema(retriever, derived.corpus(spark, data))
        for found in (quoted, schema):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin [doc_id" in plan and "SortMergeJoin [doc_id" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
