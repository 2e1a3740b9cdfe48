import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SF, clashing, docs, odd_rows
from pyspark.sql import functions as F

from sluice.llm.queries import QUERIES

# ordinal regression


def test_quality_on_held_out_rows(spark):
    from sluice.llm.quality import grade

    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in grade(d, labels.filter("doc_id % 4 <> 0"), "case when toxic = 1 then 0 else 1 + quality end").collect()}
    held = labels.filter("doc_id % 4 = 0").collect()
    y = np.array([0 if r.toxic else 1 + r.quality for r in held])
    s = np.array([got[r.doc_id].expected_grade for r in held])
    assert len(got) == d.count() and all(0 <= r.tails[1] <= r.tails[0] <= 1 for r in got.values())
    assert s[y == 2].mean() > s[y == 1].mean() > 0 and s[y == 2].mean() > s[y == 0].mean() + 0.05


def test_quality_gradient_matches_differences():
    from sluice.llm.quality import tails

    draw, k = np.random.default_rng(2), 2
    score, theta, y = draw.normal(size=30), np.array([-0.5, 0.7]), draw.integers(0, 3, 30)

    def loss(s, t):
        p = tails(s, t)
        return np.log(p[np.arange(30), y] - p[np.arange(30), y + 1]).sum()

    p = tails(score, theta)
    slope, i = p * (1 - p), np.arange(30)
    own = p[i, y] - p[i, y + 1]
    up, down = slope[i, y] / own, slope[i, y + 1] / own
    links = (np.bincount(y + 1, down, minlength=k + 2) - np.bincount(y, up, minlength=k + 2))[1 : k + 1]
    for j in range(k):
        step = np.eye(k)[j] * 1e-5
        assert links[j] == pytest.approx((loss(score, theta + step) - loss(score, theta - step)) / 2e-5, rel=1e-4)
    assert (up - down).sum() == pytest.approx((loss(score + 1e-5, theta) - loss(score - 1e-5, theta)) / 2e-5, rel=1e-4)


def test_quality_of_odd_rows(spark):
    from sluice.llm.quality import grade

    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (7, 2), (None, 1), (9, None), (6, 9), (77, 1)], "doc_id long, rating int")
    got = grade(clashing(docs(spark)), labels, "rating").collect()
    assert len(got) == len(odd_rows()) and len({r.expected_grade for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert len(grade(docs(spark), labels.limit(0), "rating").select("expected_grade").distinct().collect()) == 1
    assert grade(docs(spark, []), labels, "rating").collect() == []


# packing

def _check_packing(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_packing_query(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, texts = QUERIES["op9_best_fit_packing"](spark, SF).collect(), {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sequences = _check_packing(got)
    assert sequences <= 1.02 * -(-sum(r.length for r in got) // 2048)
    pieces = {}
    for r in sorted(got, key=lambda r: r.piece):
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(texts)
    for d, own in pieces.items():
        ids, at = bpe.encode(texts[d], add_special_tokens=False).ids + [0], 0
        for i, r in enumerate(own):
            assert (r.piece, r.start) == (i, at) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            assert i == 0 or r.length == 2048
            at += r.length
        assert at == len(ids) and len(own) == -(-len(ids) // 2048)


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_over_counts_is_best_fit_over_pieces(seed):
    from collections import Counter

    from sluice.llm.packing import best_fit

    draw = random.Random(seed)
    pieces = [draw.randint(1, 50) if seed % 2 else draw.choice([3, 7, 20, 50]) for _ in range(200)]
    runs = best_fit(Counter(pieces), 50)
    place, ranks = {}, Counter()
    for length, a, b, first, offset in runs:
        assert a == ranks[length]
        ranks[length] = b
        for r in range(a, b):
            place.setdefault(first + r - a, []).append((offset, length))
    assert ranks == Counter(pieces)
    for own in place.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 50
    free = []
    for p in sorted(pieces, reverse=True):
        fit = [f for f in free if f >= p]
        if fit:
            free.remove(min(fit))
            free.append(min(fit) - p)
        else:
            free.append(50 - p)
    assert len(place) == len(free)


def test_fast_ids_equal_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from sluice.llm.packing import ByteBpe

    own, bpe = ByteBpe(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(4)
    texts = ["", " ", "\n\n  x", "a<|endoftext|>b", "don't I'LL 123abc ½ 漢字🙂́", "x" * 3000, "\t\r\n   "]
    texts += ["".join(chr(draw.choice([32, 10, 39, draw.randrange(33, 127), draw.randrange(160, 0x2FFF), draw.randrange(0x1F300, 0x1F6FF)])) for _ in range(60)) for _ in range(300)]
    for t in texts:
        assert own.ids(t) == bpe.encode(t, add_special_tokens=False).ids


def test_packing_of_odd_rows(spark):
    from sluice.llm.packing import pack

    got = pack(clashing(docs(spark)), with_ids=True).collect()
    _check_packing(got)
    assert sum(r.doc_id == 4 for r in got) == 2 and sum(r.doc_id is None for r in got) == 2
    assert all((r.length, r.ids) == (1, [0]) for r in got if r.doc_id in (1, 2))
    long = [r for r in got if r.doc_id == 7]
    assert len(long) > 10 and sorted(r.piece for r in long) == list(range(len(long))) and all(len(r.ids) == r.length for r in got)
    assert pack(docs(spark, [])).collect() == []


# decontamination

def _distance(pattern, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        cur = [i]
        for j, x in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != x)))
        prev = cur
    return prev[1:]


def test_bit_parallel_distance():
    from sluice.llm.decontam import scores

    draw = random.Random(1)
    for _ in range(300):
        p = "".join(draw.choice("abc") for _ in range(draw.randint(1, 90)))
        t = "".join(draw.choice("abc") for _ in range(draw.randint(0, 60)))
        assert scores(p, t) == _distance(p, t)


def test_leaks_match_brute_force():
    from sluice.llm.decontam import Items, normalised

    draw = random.Random(6)
    text = lambda n: "".join(draw.choice("abcdef ") for _ in range(n))
    items = [(i, normalised("x" + text(60) + "y")) for i in range(8)]
    block = Items(items, 0.1)
    for _ in range(120):
        own = list(draw.choice(items)[1])
        for _ in range(draw.randrange(10)):
            at = draw.randrange(len(own))
            own[at : at + 1] = draw.choice([[], [draw.choice("abcdef")], [own[at], "z"]])
        t = text(draw.randrange(60)) + " " + "".join(own).upper() + "\n " + text(draw.randrange(60))
        norm = normalised(t)
        want = {i for i, item in items if min(_distance(item, norm)) <= len(item) // 10}
        found = block.leaks(t)
        assert {f["item_id"] for f in found} == want
        for f in found:
            stretch = normalised(t[f["start"] : f["end"]])
            item = dict(items)[f["item_id"]]
            assert _distance(item, stretch)[-1] <= f["distance"] + 1 and f["distance"] <= len(item) // 10


def test_decontamination_query_matches_brute_force(spark):
    from sluice.llm.decontam import normalised

    got = QUERIES["op10_decontamination"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: normalised(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    exact = {(d, i) for d, t in texts.items() for i, item in items.items() if item in normalised(t)}
    assert exact <= {(r.doc_id, r.item_id) for r in got}
    assert all(r.distance <= len(items[r.item_id]) // 10 for r in got)
    for r in got:
        if r.distance == 0:
            assert normalised(texts[r.doc_id][r.start : r.end]) == items[r.item_id]


def test_leaks_of_odd_rows(spark, monkeypatch):
    from sluice.llm import decontam as D

    items = spark.createDataFrame([(1, "word0 word1 word2 word3 word4 word5"), (1, "word0 word1 word2 word3 word4 word5"), (2, None), (3, ""), (None, "word7 word8 word9 word10 word11"), (4, "short")], "item_id long, text string")
    for size in (D.BLOCK_CHARS, 20):  # one block, several
        monkeypatch.setattr(D, "BLOCK_CHARS", size)
        got = D.contamination(clashing(docs(spark)), clashing(items)).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(7, 1), (8, 1), (7, None), (8, None)}
        assert sum(r.doc_id == 7 and r.item_id == 1 and r.start == 0 for r in got) == 2
    assert D.contamination(docs(spark, []), items).collect() == []
    assert D.contamination(docs(spark), items.limit(0)).collect() == []


def test_short_items_are_found_at_word_edges(spark):
    from sluice.llm.decontam import contamination

    items = spark.createDataFrame([(1, "Paris"), (2, "the blue whale"), (3, "42"), (4, "東京"), (5, " \n"), (6, "C++")], "item_id long, text string")
    texts = ["(PARIS), of course", "comparison", "the  blue\nwhale!", "a tha blue whale swims", "the blue whalers' ships", "142 420", "is 42.", "私は東京に住む", "c++ code", "the blue whale the blue whale", ""]
    got = contamination(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id, texts[r.doc_id][r.start : r.end], r.distance) for r in got} == {
        (0, 1, "PARIS", 0), (2, 2, "the  blue\nwhale", 0), (3, 2, "tha blue whale", 1), (6, 3, "42", 0), (7, 4, "東京", 0), (8, 6, "c++", 0), (9, 2, "the blue whale", 0)}
    assert sorted(r.start for r in got if r.doc_id == 9) == [0, 15]


def _whole(a, b):
    prev = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        cur = [i]
        for j, x in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (c != x)))
        prev = cur
    return prev[-1]


def test_short_leaks_match_brute_force():
    from sluice.llm.decontam import Items, normalised

    draw = random.Random(8)
    text = lambda n: " ".join("".join(draw.choice("abc") for _ in range(draw.randint(1, 4))) for _ in range(n))
    items = [(i, text(draw.randint(1, 6))[:24].strip()) for i in range(30)]
    block = Items(items, 0.1)
    for _ in range(150):
        t = normalised(text(draw.randrange(12)) + " " + draw.choice(items)[1] + " " + text(draw.randrange(6)))
        starts, ends = [m.start() for m in re.finditer(r"\S+", t)], [m.end() for m in re.finditer(r"\S+", t)]
        want = {i for i, item in items if any(s < e <= s + len(item) + 3 and _whole(item, t[s:e]) <= len(item) // 10 for s in starts for e in ends)}
        found = block.leaks(t)
        assert {f["item_id"] for f in found} == want
        assert all(_whole(dict(items)[f["item_id"]], t[f["start"] : f["end"]]) == f["distance"] for f in found)


# top k

def test_wand_matches_full_scores(monkeypatch):
    from sluice.llm import topk
    from sluice.llm.topk import DIGITS, Postings, wand

    draw = np.random.default_rng(5)
    for trial in range(60):
        monkeypatch.setattr(topk, "PIVOTS", 1 + trial % 3)
        lists, full = [], {}
        for _ in range(draw.integers(1, 6)):
            d = np.sort(draw.choice(600, draw.integers(1, 400), replace=False))
            s = draw.integers(1, 900, len(d)) / draw.choice([64, 64, 8])  # sums are exact in any order
            lists.append(Postings(d, s))
            for a, b in zip(d.tolist(), s.tolist()):
                full[a] = full.get(a, 0) + b
        docs, scores = wand(lists, 10)
        assert list(zip(scores.tolist(), docs.tolist())) == sorted(((round(s, DIGITS), d) for d, s in full.items()), key=lambda x: (-x[0], x[1]))[:10]


def test_topk_blocks_hold_like_documents():
    """Documents of two vocabularies in turn: most blocks have words of one alone, so that queries leave half of them out."""
    from sluice.llm.topk import BLOCK, Index

    draw = np.random.default_rng(7)
    rows, words = 16 * BLOCK, 40
    has = draw.random((words, rows)) < 0.5
    has[: words // 2, ::2] = has[words // 2 :, 1::2] = False
    scores = np.where(has, draw.integers(1, 600, has.shape) / 64, 0)
    at, docs = np.append(0, np.cumsum(has.sum(1))), np.nonzero(has)[1]
    index = Index(at, docs, scores[has], rows)
    assert (index.tops > 0).mean() < 0.6
    asked = [np.arange(words // 2), np.arange(words // 2, words), np.arange(0, words, 3)] * 50
    query = np.repeat(np.arange(len(asked)), [len(x) for x in asked])
    q, doc, value = index.best(query, np.concatenate(asked), len(asked), 10)
    for i, x in enumerate(asked):
        full = scores[x].sum(0)
        best = np.lexsort((np.arange(rows), -full))[:10]
        assert doc[q == i].tolist() == best.tolist() and value[q == i].tolist() == np.round(full[best], 6).tolist()


def test_topk_asks_for_all_words_of_a_row(spark, monkeypatch):
    """Rows of 40 words, rare ones among them: all of them count, not the first dozen nor those of many rows alone."""
    from sluice.llm import topk as T

    draw = random.Random(3)
    texts = [" ".join(f"w{min(draw.randrange(300), draw.randrange(300))}" for _ in range(40)) for _ in range(160)]
    words, n = [t.split() for t in texts], len(texts)
    df = Counter(w for own in words for w in set(own))
    idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    norm = T.K1 * (1 - T.B + T.B * 1)  # all rows are of average length
    want = []
    for q in range(0, n, 20):
        sums = {d: sum(idf[w] * own.count(w) * (T.K1 + 1) / (own.count(w) + norm) for w in set(words[q]) & set(own)) for d, own in enumerate(words)}
        best = sorted(((round(x, T.DIGITS), d) for d, x in sums.items() if x), key=lambda x: (-x[0], x[1]))[:10]
        want += [(q, i + 1, d, x) for i, (x, d) in enumerate(best)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block, shard, added in ((64, 1_500_000, 2_000_000), (4, 400, 50)):
        for name, value in (("BLOCK", block), ("SHARD", shard), ("ADDED", added), ("PIVOTS", 2)):
            monkeypatch.setattr(T, name, value)
        got = sorted(tuple(r) for r in T.search(frame, F.col("doc_id") % 20 == 0).collect())
        assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=2e-6)


def test_topk_blocks_and_odd_rows(spark, monkeypatch):
    from sluice.llm import topk as T

    rows = odd_rows() + [(20 + i, f"x{i % 3} y{i % 4} z{i} common", "en", "a", 5) for i in range(40)] + [(20, "x0 x0 again", "en", "a", 5)]
    df = clashing(docs(spark, rows))
    one = sorted(tuple(r) for r in T.search(df, F.col("doc_id") % 20 == 0, least_df=2).collect())
    monkeypatch.setattr(T, "QUERIES", 1)
    monkeypatch.setattr(T, "SHARD", 30)
    assert sorted(tuple(r) for r in T.search(df, F.col("doc_id") % 20 == 0, least_df=2).collect()) == one
    assert {q for q, *_ in one} == {20, 40} and all(r <= 10 for _, r, *_ in one)
    assert T.search(docs(spark, []), F.col("doc_id") % 20 == 0).collect() == []


def test_topk_reads_each_text_once(spark, monkeypatch, tmp_path):
    """However many blocks the queries make: the words are looked up in written lists."""
    from sluice.llm import topk as T

    real, folder = T._hashes, str(tmp_path)

    def counted(data, bounds, powers):
        import uuid
        with open(f"{folder}/{uuid.uuid4().hex}", "w"):
            return real(data, bounds, powers)

    frame = spark.createDataFrame([(i, f"a{i % 7} b{i % 5} c{i}") for i in range(120)], "doc_id long, text string").repartition(3)
    whole = sorted(tuple(r) for r in T.search(frame, F.col("doc_id") % 20 == 0).collect())
    monkeypatch.setattr(T, "_hashes", counted)
    monkeypatch.setattr(T, "QUERIES", 2)
    assert sorted(tuple(r) for r in T.search(frame, F.col("doc_id") % 20 == 0).collect()) == whole
    assert len(list(tmp_path.iterdir())) == 3


def test_topk_keeps_what_reaches_the_least(monkeypatch):
    """Sums in single precision and skipped blocks lose no row and no digit, whatever is known of the k-th best."""
    from sluice.llm import topk as T

    for name, value in (("BLOCK", 8), ("REGION", 4), ("GROUP", 16), ("PIVOTS", 2), ("FREQUENT", 60), ("TABLE", 20), ("SHARE", 8)):
        monkeypatch.setattr(T, name, value)
    draw, rows, words, k = np.random.default_rng(11), 333, 200, 10
    for trial in range(12):
        monkeypatch.setattr(T, "CELL", (1e-6, 0.01, 10.0)[trial % 3])
        has = draw.random((words, rows)) < draw.random((words, 1)) ** 3 * draw.random(rows)
        scores = np.where(has, draw.random(has.shape) * draw.choice([1e-6, 1, 40], (words, 1)), 0)
        scores[:, 100:130] = scores[:, :30]  # equals
        index = T.Index(np.append(0, np.cumsum((scores > 0).sum(1))), np.nonzero(scores)[1], scores[scores > 0], rows)
        asked = [np.sort(draw.choice(words, draw.integers(1, words), replace=False)) for _ in range(16)]
        full = np.stack([np.round(scores[x].sum(0), T.DIGITS) for x in asked])
        kth = np.sort(full, 1)[:, -k] * (trial % 2)
        q, doc, value = index.best(np.repeat(np.arange(16), [len(x) for x in asked]), np.concatenate(asked), 16, k, kth)
        for i in range(16):
            best = [d for d in np.lexsort((np.arange(rows), -full[i]))[:k] if scores[asked[i], d].any()]
            assert doc[q == i].tolist() == best and value[q == i] == pytest.approx(full[i, best], abs=1.1e-6)


def test_topk_equal_queries_are_answered_each(spark):
    from sluice.llm import topk as T

    rows = [(i, "the same words" if i in (0, 20, 60) else f"other words {i}") for i in range(80)] + [(100, "words SAME the the")]
    got = T.search(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 20 == 0).collect()
    by = {q: sorted((r.rank, r.doc_id, r.score) for r in got if r.query_id == q) for q in (0, 20, 40, 60, 100)}
    assert by[0] == by[20] == by[60] == by[100] and len(by[0]) == 10 and {d for _, d, _ in by[0][:4]} == {0, 20, 60, 100}
    assert by[40][0][1] == 40 and len(by[40]) == 10


# html

def test_html_query_keeps_the_article(spark):
    from sluice.llm.html_crf import blocks

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op4_html_extraction"](spark, SF).collect()}
    assert set(got) == set(pages)
    for p, html in pages.items():  # in these tables the article element holds the main text
        want = "\n".join(b.text for b in blocks(html) if any(t == "article" for t, _ in b.path))
        assert got[p].text == want and got[p].n_chars == len(want)


def test_html_on_held_out_layouts():
    from sluice.llm.html_crf import blocks, features, labelled_pages, train

    texts = ["Some plain words of a first text, with a comma.", "Other words; longer than those before, and going on for a while until they end.", "Third &amp; last."]
    field, right, n, aligned = train(texts, 400), 0, 0, 0
    for html, y in labelled_pages(texts, 150, seed=77):
        page = blocks(html)
        if len(page) == len(y):
            aligned += 1
            right += sum(a == b for a, b in zip(field.viterbi(features(page)), y))
            n += len(y)
    assert aligned > 100 and right / n > 0.98


def test_viterbi_is_the_best_labelling():
    from itertools import product

    from sluice.llm.html_crf import Field

    draw = np.random.default_rng(3)
    field = Field(list("abcd"))
    for _ in range(30):
        field.w, field.first, field.step = draw.normal(size=(4, 2)), draw.normal(size=2), draw.normal(size=(2, 2))
        page = [[str(x) for x in draw.choice(list("abcd"), 2, replace=False)] for _ in range(6)]
        s = [field.w[[field.names[f] for f in b]].sum(0) for b in page]
        value = lambda y: field.first[y[0]] + sum(s[i][y[i]] for i in range(6)) + sum(field.step[a, b] for a, b in zip(y, y[1:]))
        assert field.viterbi(page) == list(max(product((0, 1), repeat=6), key=value))


def test_html_blocks_and_odd_pages(spark):
    from sluice.llm.html_crf import blocks, main_text

    html = "<body><nav>Menu</nav><article><h1>A &amp; B</h1><p>one<br>two <b>three</b>\n\n four<p>five<script>var x='<p>no';</script><!-- no --></article><footer>&copy; me"
    assert [b.text for b in blocks(html)] == ["Menu", "A & B", "one two three four", "five", "© me"]
    rows = [(1, None, None), (2, "u", ""), (3, "u", "   "), (4, "u", html), (4, "u", html), (None, None, html), (5, "u", "no markup < at & all"), (6, "u", "<p" * 2000), (7, "u", "<article>" + "<p>word word.</p>" * 5000 + "</article>")]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = df.select("page_id", main_text(df).alias("text")).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == len(rows) and by[1] == by[2] == by[3] == "" and by[4] == by[None] == "A & B\none two three four\nfive"
    assert by[7].count("\n") == 4999
    empty = df.limit(0)
    assert empty.select(main_text(empty)).collect() == []


def test_html_sample_takes_one_page_of_equal_ones(spark, monkeypatch):
    from sluice.llm import html_crf as H

    lent, train = [], H.train
    monkeypatch.setattr(H, "train", lambda texts: lent.append(list(texts)) or train(texts, 50))
    rows = [(i, "<p>the same words</p>") for i in range(40)] + [(40 + i, f"<p>page {i}</p>") for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, html string").repartition(4)
    assert df.select(H.main_text(df, sample=100)).count() == 43
    assert sorted(lent[0]) == ["page 0", "page 1", "page 2", "the same words"]


# language model

def test_training_tasks_follow_the_tokens_not_the_splits(spark, monkeypatch, tmp_path):
    """Each task of a round sends the whole model once: twelve partitions of a few tokens make two tasks, not twelve."""
    from sluice.llm import lm_maxent as L

    real, folder = L._train, str(tmp_path)

    def counted(model):
        run = real(model)

        def one(batches):
            import uuid
            with open(f"{folder}/{uuid.uuid4().hex}", "w"):
                yield from run(batches)
        return one

    monkeypatch.setattr(L, "_train", counted)
    monkeypatch.setattr(L, "FEW_TASKS", 2)
    monkeypatch.setattr(L, "ROUNDS", 1)
    texts = spark.createDataFrame([(i, f"word{i % 7} again and again") for i in range(120)], "doc_id long, text string").repartition(12)
    L.fit(texts)
    assert len(list(tmp_path.iterdir())) == 2
