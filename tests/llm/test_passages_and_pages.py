import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestone.llm import htmltext, passages
from lodestone.llm.queries import llm_queries


def slow_chain(a, b, gram, cost=passages.GAP_COST):
    sa, sb, size, words = passages.runs(np.array(a), np.array(b), gram, 4 * gram)
    order = sorted(range(len(sa)), key=lambda i: sa[i])
    value = {}
    for i in order:
        linked = [value[j] - cost * (sa[i] - sa[j] - size[j] + sb[i] - sb[j] - size[j]) for j in value if sa[j] + size[j] <= sa[i] and sb[j] + size[j] <= sb[i]]
        value[i] = words[i] + max([0.0, *linked])
    return max(value.values())


@pytest.mark.parametrize("seed", range(30))
def test_fenwick_finds_the_best_chain(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 40)
    matches = sorted({(rng.randrange(150), rng.randrange(150)) for _ in range(n)} | {(x, x + 5) for x in range(0, rng.randrange(60), 4)})
    a, b = [m[0] for m in matches], [m[1] for m in matches]
    found = passages.chains(np.array(a), np.array(b), 6)
    _, _, size, words = passages.runs(np.array(a), np.array(b), 6, 24)
    worth = dict(zip(zip(*(x.tolist() for x in passages.runs(np.array(a), np.array(b), 6, 24)[:3]), strict=True), words.tolist(), strict=True))
    best = found[0]
    score = worth[best[0]] + sum(worth[y] - passages.GAP_COST * (y[0] - x[0] - x[2] + y[1] - x[1] - x[2]) for x, y in zip(best, best[1:], strict=False))
    assert score == pytest.approx(slow_chain(a, b, 6))
    assert all(x[0] + x[2] <= y[0] and x[1] + x[2] <= y[1] for c in found for x, y in zip(c, c[1:], strict=False))
    assert sorted(r for c in found for r in c) == sorted(worth)


DOCS = "doc_id long, text string, a string, b string, key string, words string, seed string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "1", "2", "3", "4", "5") for i, t in rows], DOCS)


def corpus(seed):
    """Documents of random words; some hold one of three passages, whole or with every eighteenth word changed."""
    rng = random.Random(seed)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(5000)}"
    passages_ = [[word() for _ in range(n)] for n in (51, 70, 120)]
    rows, planted = [], {}
    for i in range(90):
        own = [word() for _ in range(rng.randrange(0, 120))]
        if i % 3 == 0:
            which = i // 3 % 3
            p = list(passages_[which])
            if i % 2:
                for k in range(9, len(p), 18):
                    p[k] = word()
                if len(p) > 60:
                    del p[30]
            at = rng.randrange(len(own) + 1)
            own[at:at] = p
            planted[i] = (which, at, at + len(p))
        rows.append((i, " ".join(own)))
    return rows, planted


@pytest.mark.parametrize("seed", range(2))
def test_planted_passages_are_found_and_no_others(spark, seed):
    rows, planted = corpus(seed)
    rows += [(1000, "common line of nine words that many texts share"), (1001, "common line of nine words that many texts share"), (1002, None), (1003, ""), (None, rows[0][1])]
    rows += [(5000, rows[0][1]), (5000, rows[0][1])]
    planted[5000] = planted[0]
    got = passages.repeated_passages(docs_of(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == set(planted)
    texts = {i: t.split() for i, t in rows if t and i is not None}
    for r in got:
        which, s, e = planted[r["doc_id"]]
        if {r["doc_id"], r["other_id"]} != {0, 5000}:
            assert planted[r["other_id"]][0] == which
            # a passage may end before an edit that is very near its end
            assert abs(r["first_word"] - s) <= 3 and abs(r["last_word"] - e) <= 3
        assert r["last_word"] <= len(texts[r["doc_id"]]) and r["n_equal"] >= 40
    assert passages.repeated_passages(docs_of(spark, [])).count() == 0
    pairs = [(r["doc_id"], r["other_id"], r["first_word"]) for r in got]
    assert len(pairs) == len(set(pairs))


def test_whole_copies_are_one_passage(spark):
    text = " ".join(f"x{k}" for k in range(400))
    got = passages.repeated_passages(docs_of(spark, [(i, text) for i in range(6)])).collect()
    assert {(r["first_word"], r["last_word"], r["n_equal"]) for r in got} == {(0, 400, 400)}
    assert {r["doc_id"] for r in got} == set(range(6)) and len(got) == 10


@pytest.mark.parametrize("size", [60, 120])
def test_two_passages_of_the_same_texts_are_both_found_over_any_gap(spark, size):
    rng = random.Random(size)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(10**6)}"
    rows, spans = [], {}
    for i, gap in enumerate([20, 25, 31, 40, 60, 100, 140, 149, 200, 300]):
        one, two = ([word() for _ in range(size)] for _ in range(2))
        for k in (0, 1):
            head = [word() for _ in range(rng.randrange(90))]
            rows.append((10 * i + k, " ".join([*head, *one, *(word() for _ in range(gap)), *two, *(word() for _ in range(30))])))
            spans[10 * i + k] = [(len(head), len(head) + size), (len(head) + size + gap, len(head) + 2 * size + gap)]
    got = passages.repeated_passages(docs_of(spark, rows)).collect()
    assert all(r["doc_id"] // 10 == r["other_id"] // 10 for r in got)
    for i, own in spans.items():
        found = [(r["first_word"], r["last_word"]) for r in got if r["doc_id"] == i]
        assert all(any(s <= a and b <= e for s, e in found) for a, b in own)
        gap, whole = own[1][0] - own[0][1], own[1][1] - own[0][0]
        assert sorted(found) == ([(own[0][0], own[1][1])] if 2 * size >= 0.8 * whole else own), gap


def test_edited_passages_down_to_the_stated_share_are_found(spark):
    rng = random.Random(5)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(10**6)}"
    rows, kind = [], {}
    for n in (51, 60, 80, 100):
        for edits in (0.1, 0.15, 0.19, 10, 8, 7, 5):
            for _ in range(10):
                p = [word() for _ in range(n)]
                changed = range(edits - 1, n - 1, edits) if edits > 1 else rng.sample(range(1, n - 1), int(edits * n))
                q = [word() if k in set(changed) else w for k, w in enumerate(p)]
                for own in (p, q):
                    rows.append((len(rows), " ".join([*(word() for _ in range(rng.randrange(40))), *own, *(word() for _ in range(rng.randrange(40)))])))
                kind[len(rows) // 2 - 1] = (n, edits)
    got = passages.repeated_passages(docs_of(spark, rows)).collect()
    assert all(r["doc_id"] // 2 == r["other_id"] // 2 for r in got)
    assert all(min(r["last_word"] - r["first_word"], r["other_last"] - r["other_first"]) >= 50 for r in got)
    found = {r["doc_id"] // 2 for r in got}
    for which in set(kind.values()):
        assert sum(k in found for k, v in kind.items() if v == which) >= 9, which
    assert len(found) >= 0.99 * len(kind)


@pytest.mark.parametrize("held", [None, 1, 3])
def test_occurrences_are_matched_all_with_all_or_with_the_first(held):
    n = np.array([1, 2, 3, 4, 9])
    first = np.repeat(np.cumsum(n) - n, n)
    got = sorted((int(i), int(j)) for a, b in passages._pairs(first, np.repeat(n, n), held) for i, j in zip(a, b, strict=True))
    want = [(f + i, f + j) for f, size in zip(np.cumsum(n) - n, n, strict=True) for i in range(size if held is None or size <= held else 1) for j in range(i + 1, size)]
    assert got == sorted(want)


def test_matches_are_linked_in_few_batches_as_pair_by_pair(spark):
    rng = random.Random(7)
    rows, want = [], []
    for a in range(40):
        own = sorted({(x, x + rng.choice([3, 40])) for x in rng.sample(range(200), rng.randrange(1, 30))})
        rows += [(a, a + 100, *m) for m in own] * (1 + a % 2)
        own = np.array(own)
        want += [(a, a + 100, [v for r in c for v in r]) for c in passages.chains(own[:, 0], own[:, 1], 4) if len(c) > 1 or c[0][2] > 4]
    table = passages._rows(passages.MATCH, *np.array(rows).T)
    parts = [bytearray(passages._blobs(table[i::3], passages._pair_hash(table[i::3]) % np.uint64(5)).column(1)[k].as_py()) for i in range(3) for k in range(5)]
    blobs = [(k % 5, p) for k, p in enumerate(parts)]
    got = passages._chained(spark.createDataFrame(blobs, "bucket int, rows binary"), 4, 4)
    assert sorted((r["a"], r["b"], list(r["chain"])) for r in got.collect()) == sorted(want)


def test_without_a_limit_passages_are_found_beside_many_partial_quotations(spark):
    rng = random.Random(11)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(10**6)}"
    rows, want = [], set()
    for held in (40, 45, 49):
        for _ in range(4):
            p = [word() for _ in range(60)]
            for own in (p, p, *(p[k : k + held] for k in (rng.randrange(61 - held) for _ in range(20)))):
                rows.append((len(rows), " ".join([*(word() for _ in range(rng.randrange(40))), *own, *(word() for _ in range(rng.randrange(40)))])))
            want |= {(len(rows) - 22, len(rows) - 21), (len(rows) - 21, len(rows) - 22)}
    got = passages.repeated_passages(docs_of(spark, rows), held=None).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == want


def test_passages_are_found_though_each_of_their_seeds_is_common(spark):
    rng = random.Random(13)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(10**6)}"
    rows, want = [], set()
    for edits in (0, 0, 0, 0, 3, 3, 3, 3):
        p = [word() for _ in range(60)]
        q = [word() if k in set(rng.sample(range(1, 59), edits)) else w for k, w in enumerate(p)]
        for own in (p, q, *[p[:49]] * 12, *[p[11:]] * 12):  # two hold it, 24 others hold 49 of its 60 words
            rows.append((len(rows), " ".join([*(word() for _ in range(rng.randrange(40))), *own, *(word() for _ in range(rng.randrange(40)))])))
        want |= {(len(rows) - 26, len(rows) - 25), (len(rows) - 25, len(rows) - 26)}
    got = passages.repeated_passages(docs_of(spark, rows)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == want
    assert all(r["last_word"] - r["first_word"] >= 57 for r in got)


def test_common_seeds_link_what_all_pairs_of_seeds_link(spark):
    rng = random.Random(17)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(10**6)}"
    p = [word() for _ in range(140)]
    rows = []
    for i in range(60):  # stretches of one text, some with changed words, a common line, one word said many times
        first = rng.randrange(90)
        own = [word() if i % 3 and rng.random() < 0.06 else w for w in p[first : first + rng.randrange(30, 90)]]
        line = "common line of nine words that many texts share".split()
        rows.append((i, " ".join([*line, *(word() for _ in range(rng.randrange(30))), *own, *(word() for _ in range(rng.randrange(30))), *["For"] * (i % 4)])))

    got, whole = ({(r["doc_id"], r["other_id"]) for r in passages.repeated_passages(docs_of(spark, rows), held=held).collect()} for held in (passages.HELD, None))
    near = {i: {j for k, j in got if k == i} for i, _ in rows}
    # where a passage ends by a word or two decides whether a pair follows from others
    assert len(got & whole) >= 0.95 * len(whole) and len(whole) > 100
    assert all((i, j) in got or near[i] & near[j] for i, j in whole)


def test_two_common_seeds_are_left_to_the_earlier_document_of_a_passage():
    at = np.arange(2, 200, 2)
    seeds = passages._rows(passages.SEED, at.astype("u8"), np.full(len(at), 9), at)
    cover = lambda *runs: np.array([(9, 4, 0, 120, *r) for r in runs], passages.COVER)
    every = {(int(x), int(y)) for x in at for y in at if passages.LEAST_APART <= y - x <= passages.MOST_APART}
    pairs = lambda rows: {(int(x), int(y)) for x, y in zip(rows["at"], rows["then"], strict=True)}
    assert pairs(passages._two_by_two(seeds, cover()[:0], 4)) == every
    got = passages._two_by_two(seeds, cover((0, 50, 7), (51, 120, 7)), 4)
    equal = lambda x: 0 < x < 46 or 51 < x < 116
    assert pairs(got) == {(x, y) for x, y in every if not (equal(x) and equal(y))}
    assert all((r["by"] == 4) == (r["then"] + 4 <= 120) for r in got)
    other = passages._two_by_two(seeds, cover((0, 50, 7), (51, 120, 8)), 4)
    assert pairs(other) == pairs(got) | {(x, y) for x, y in every if x < 46 and 51 < y < 116}
    none = np.zeros(0, bool)
    assert list(passages._across(none, none)) == []
    group, part = np.array([1, 0, 0, 0, 1, 1, 0], bool), np.array([1, 0, 1, 1, 1, 1, 1], bool)
    assert sorted((int(x), int(y)) for i, j in passages._across(group, part) for x, y in zip(i, j, strict=True)) == [(0, 2), (0, 3), (1, 2), (1, 3), (2, 3), (5, 6)]


def test_places_of_common_seeds_grow_with_the_documents_that_quote_the_same(spark, monkeypatch):
    rng = random.Random(19)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(10**6)}"
    p, sizes, written = [word() for _ in range(45)], {}, passages.written

    def weighed(df, name, *args):
        out = written(df, name, *args)
        if name == "passage-joint":
            sizes[n] = out.agg(F.sum(F.octet_length("rows"))).first()[0]
        return out

    monkeypatch.setattr(passages, "written", weighed)
    for n in (60, 240):
        rows = [(i, " ".join([*(word() for _ in range(20)), *p, *(word() for _ in range(20))])) for i in range(n)]
        assert passages.repeated_passages(docs_of(spark, rows)).count() == 0
    assert 0 < sizes[240] < 5 * sizes[60]


def test_places_are_matched_across_two_sides_whatever_is_matched_at_a_time(monkeypatch):
    rng = np.random.default_rng(3)
    n = 400
    rows = passages._rows(passages.JOINT, rng.integers(0, 9, n), rng.integers(0, 4, n), rng.integers(-15, 15, n), rng.integers(0, 50, n), rng.integers(50, 99, n))
    side = rows["key"] % 2 == 0
    for one, two in ((side, ~side), (side, side), (side[:0], side[:0])):
        own = rows[: len(one)]
        want = set()
        for x in own[one]:
            for y in own[two]:
                if x["code"] == y["code"] and x["by"] != y["by"] and x["key"] != y["key"]:
                    a, b = sorted((x, y), key=lambda r: r["key"])
                    want |= {tuple(int(v) for v in (a["key"], b["key"], a[at], b[at])) for at in ("at", "then")}
        for at_once in (7, 100, 1 << 19):
            monkeypatch.setattr(passages, "MATCHES", at_once)
            found = [{tuple(map(int, r)) for r in part} for part in passages._met(own, one, two)]
            assert set().union(*found) == want
            whole = [(r[:2], k) for k, part in enumerate(found) for r in part]
            assert len({pair for pair, _ in whole}) == len(set(whole))  # a pair of documents comes at one time


def test_only_chains_without_a_passage_are_left_out_by_bytes_of_words():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 32, 300, dtype="u8").astype("<u4")
    kept = 0
    for k in range(300):
        y = np.where(rng.random(300) < rng.choice([0.1, 0.2, 0.3, 0.6]), rng.integers(0, 1 << 32, 300, dtype="u8"), x).astype("<u4")
        first, size = int(rng.integers(0, 260)), int(rng.integers(4, 40))
        size = min(size, 300 - first)
        y[first : first + size] = x[first : first + size]
        chain = [(first, first, size)] if k % 2 or size < 9 else [(first, first, 4), (first + size - 4, first + size - 4, 4)]
        found = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([[v for r in chain for v in r]], pa.list_(pa.int32()))], names=["a", "b", "chain"])
        left = len(passages._Bytes({1: x.astype("u1"), 2: y.astype("u1")}).chains(found, 50, 0.8))
        b, e = max(0, first - passages.MARGIN), first + size + passages.MARGIN
        shift = [(s - b, t - b, n) for s, t, n in chain]
        parts = [q for cost in (passages.MISMATCH, 1) for q in passages.alike_parts(*passages.path(x[b:e], y[b:e], shift, cost), 50, 0.8)]
        assert left or not parts
        kept += left
    assert 0 < kept < 300


def test_pairs_that_follow_from_an_earlier_document_are_told_as_one_by_one(spark):
    rng = random.Random(23)
    rows = {(*sorted(rng.sample(range(12), 2)), f, f + n, g, g + n) for _ in range(900) for f, g, n in [(rng.randrange(40), rng.randrange(40), rng.randrange(50, 90))]}
    pairs = passages._rows(passages.PAIR, *np.array(sorted(rows)).T)
    legs = passages._rows(passages.LEG, *(np.array([(b, a, fa - fb, fb, tb) for a, b, fa, _, fb, tb in sorted(rows)]).T))
    want = []
    for a, b, fa, ta, fb, tb in sorted(rows):
        one, two = ([(c, x - s) for c, d, x, _, s, e in rows if d == side and s <= f and t <= e] for side, f, t in ((a, fa, ta), (b, fb, tb)))
        want.append(any(c == d and abs(fa + p - fb - q) <= (1 - 0.8) * (ta - fa) for c, p in one for d, q in two))
    assert passages._told(pairs, legs, 0.8).tolist() == want and 100 < sum(want) < 800
    assert not passages._told(pairs, legs[:0], 0.8).any()
    table = spark.createDataFrame([(*r, k) for k, r in enumerate(sorted(rows))], "key_a long, key_b long, from_a long, to_a long, from_b long, to_b long, k long")
    got = {r["k"] for r in passages._first_pairs(table, 0.8).collect()}
    assert got == {k for k, told in enumerate(want) if not told}


@pytest.mark.parametrize("quoting", [1, 5])
def test_a_passage_is_found_beside_partial_quotations(spark, quoting):
    rng = random.Random(quoting)
    word = lambda: f"{rng.choice('bcdfg')}{rng.randrange(10**6)}"
    rows, want = [], set()
    for held in (36, 40, 45, 49):
        for _ in range(15):
            p = [word() for _ in range(60)]
            at = [rng.randrange(61 - held) for _ in range(quoting)]
            for own in (p, p, *(p[k : k + held] for k in at)):
                rows.append((len(rows), " ".join([*(word() for _ in range(rng.randrange(40))), *own, *(word() for _ in range(rng.randrange(40)))])))
            whole = len(rows) - quoting - 2
            want |= {(whole, whole + 1), (whole + 1, whole)}
    got = passages.repeated_passages(docs_of(spark, rows)).collect()
    assert {(r["doc_id"], r["other_id"]) for r in got} == want
    assert all(r["last_word"] - r["first_word"] == r["n_equal"] == 60 for r in got)


def test_registered_passages(spark, data):
    got = llm_queries()["op4_substring_dedup"](spark, data).collect()
    words = {r["doc_id"]: r["text"].lower().split() for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    seen, want = {}, set()
    for i, own in words.items():
        for k in range(len(own) - 49):
            seen.setdefault(tuple(own[k : k + 50]), set()).add(i)
    for ids in seen.values():
        if len(ids) > 1:
            want |= ids
    assert want and want <= {r["doc_id"] for r in got}
    for r in got:
        assert r["last_word"] - r["first_word"] >= 40 and r["n_equal"] >= 40


ARTICLE = "<h1>Title &amp; more</h1><p><b>First\n  bold.<br>line</b><p>Second &eacute;&#33;</p><ul><li>one<li>two</ul>"


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p><p>no';</script></head><body>{body}</body></html>"


def site(n, body=ARTICLE):
    return page(f"<nav><ul><li><a href='/a>b'>Home</a></ul></nav><!-- <p>x</p> --><div class='ad'>Buy now and save a lot of money</div><div class='cookie-notice'><p>We use cookies</p></div><div class='post-{n} main'>{body}<form><p>Sign up</p></form></div><div id='comments'><p>I liked this article very much, thank you for it, really much.</p></div><aside><p>aside</p></aside><footer>&copy; me</footer>")


WANT = "Title & more\n\nFirst bold. line\n\nSecond é!\n\none\n\ntwo"


def test_pages_by_consensus(spark):
    short = "<p>Tiny.</p>"
    other = "<div class='side-story'><p>A teaser that is far longer than the short text of this very page, and goes on.</p></div>"
    rows = [(i, f"https://Host.example/{i}", site(i)) for i in range(5)]
    rows += [(5, "https://host.example:80/x", site(5, short).replace("<aside>", other + "<aside>"))]
    rows += [(6, "http://alone.example/", page("<p>Only.</p>")), (7, None, None), (8, "not a url", ""), (9, "http://e.example", "<p>unclosed <b>text &lt;x&gt;"), (9, "http://e.example", "<p>unclosed <b>text &lt;x&gt;"), (None, "http://f.example/", page("<nav>menu</nav>"))]
    pages = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "page_id long, url string, html string, host string, path string, text string")
    got = [(r["page_id"], r["url"], r["text"]) for r in htmltext.extract(pages).collect()]
    want = [(i, f"https://Host.example/{i}", WANT) for i in range(5)]
    want += [(5, "https://host.example:80/x", "Tiny."), (6, "http://alone.example/", "Only."), (7, None, ""), (8, "not a url", ""), (9, "http://e.example", "unclosed text <x>"), (9, "http://e.example", "unclosed text <x>"), (None, "http://f.example/", "")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert htmltext.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("start", ["main class='has-sidebar'", "article class='post tag social'", "div id='content-with-sidebar'", "div class='no-comments'", "div class='page sidebar-right'"])
def test_articles_in_elements_named_for_other_things_are_kept(start):
    rest = "" if "right" in start else "<div class='sidebar'><p>Aside.</p></div>"
    whole = page(f"<nav>menu</nav><{start}>{ARTICLE}</{start.split()[0]}>{rest}<footer>me</footer>")
    assert htmltext.page_text(htmltext.blocks(whole), None) == WANT


def test_registered_pages_hold_their_article(spark, data):
    import html
    import re

    for r in llm_queries()["op5_html_extraction"](spark, data).collect():
        assert r["n_chars"] == len(r["text"])
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    for r in llm_queries()["op5_html_extraction"](spark, data).collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " " if p.startswith("<br") else "", p)).split()) for p in re.split(r"(?=<p>|<h1>)|</p>|</h1>", body.replace("<br>", " "))]
        parts = [p for p in parts if p]
        assert r["text"] == "\n\n".join(parts)


@pytest.mark.parametrize("body, want", [
    ("<article><h1>The title</h1><p>A lead that says what comes.</p><div class='body'>{A}</div><p>The closing words.</p></article>", "The title|A lead that says what comes.|{W}|The closing words."),
    ("<div class='post'><h2>The title</h2><p>A lead that says what comes.</p><div class='body'>{A}</div></div><div class='teasers'><p>Other text of the site.</p></div>", "The title|A lead that says what comes.|{W}"),
    ("<div class='body'>{A}</div><p>Our site.</p>", "{W}"),
    ("<article><section>{A}</section><section><p>More of it.</p></section></article>", "{W}|More of it."),
    ("<div class='post notice-board'>{A}</div><p>A side text</p>", "{W}"),
    ("<div class='post notice-board'>{A}<div class='comments'><p>I say so too.</p></div></div><p>A side text</p>", "{W}"),
    ("<div class='post'><p>Short but whole.</p></div><div class='comments'><p>A comment that is far longer than what it speaks of.</p><p>And one more.</p></div>", "Short but whole."),
    ("<form action='/'><input type=hidden name=state><div id=top><a href=/>Home</a></div><div class=post>{A}</div></form>", "{W}"),
    ("<div>{A}<form><input><p>Sign up for news</p></form></div>", "{W}"),
    ("<div>{A}<p title=it's>One of two.</p><p>It's two of two.</p></div>", "{W}|One of two.|It's two of two."),
    ("<div>{A}<p title=\"5\" tall\">Three feet.</p><p class='a'b'>Four.</p></div>", "{W}|Three feet.|Four."),
    ("<div>{A}<p title=\"open>One.</p></div>", "{W}|One."),
])
def test_whole_articles_of_odd_pages(body, want):
    whole = page(f"<nav>menu</nav>{body.replace('{A}', ARTICLE)}<footer>me</footer>")
    assert htmltext.page_text(htmltext.blocks(whole), None) == want.replace("{W}", WANT).replace("|", "\n\n")


@pytest.mark.parametrize("body, n_words", [
    ("<div>" * 30_000 + "word " + "</div>" * 30_000, 1), ("<b>" * 30_000 + "<h2>one</h2>" * 30_000, 30_000),
    ("<div class='comment'>" * 30_000 + "word", 1), ("<p title='" + "<a title=" * 30_000 + " word", 0), ("<a " * 100_000 + "word", 0),
    ("<div>" + "</p></i>text <i>" * 50_000, 50_000), ("<div>" * 20_000 + "<p>word</p></div>" * 20_000, 20_000), ("w " * 2_000_000, 2_000_000),
    ("<p x=\"'" * 50_000 + "'\">" * 50_000, 0), ("<!" * 200_000, 200_000),
])
def test_deep_long_and_broken_pages_take_linear_time(body, n_words):
    import time

    started = time.perf_counter()
    found = htmltext.blocks(body)
    path, _ = htmltext._scored(found)
    text = htmltext.page_text(htmltext.blocks(body), path)
    assert time.perf_counter() - started < 20 and (not n_words or len(text.split()) >= min(n_words, 1))
