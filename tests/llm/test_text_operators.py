import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SF, clashing, docs, odd_rows, words
from pyspark.sql import functions as F

from sluice.llm.queries import QUERIES


# language identification

def test_language_query_is_right_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SF).collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [d for d in lang if zlib.crc32(str(d).encode()) % 5 == 0]
    assert set(got) == set(lang) and all(got[d].held_out == (d in held) for d in lang)
    assert np.mean([got[d].lang_pred == lang[d] for d in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_forward_sums_all_segmentations():
    from sluice.llm.langid import STRANGE, Pieces, normal, word_scores

    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    finder, draw = Pieces(pieces), np.random.default_rng(0)
    probs = normal(draw.random((len(pieces), 2)) * 5, len(pieces))

    def brute(word, g):
        if not word:
            return 1.0
        total = sum(probs[i, g] * brute(word[len(p):], g) for i, p in enumerate(pieces) if word.startswith(p))
        return total + (STRANGE * brute(word[1:], g) if word[0] not in pieces else 0)

    items = ["a", "ab", "abba", "bab", "axb", "aaaaaaaa"]
    want = [[math.log(brute("▁" + w, g)) for g in (0, 1)] for w in items]
    assert np.allclose(word_scores(items, finder, probs), want)


def test_language_of_odd_rows(spark):
    from sluice.llm.langid import identify

    got = identify(clashing(docs(spark)), F.col("key") > 0).select("doc_id", "text", "language.*").collect()
    assert len(got) == len(odd_rows())
    for r in got:
        assert (r.lang_pred == "und" and r.score == 0) == (not any(c.isalpha() for c in r.text or ""))
    nothing = identify(docs(spark), F.lit(False)).select("language.*").collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert identify(docs(spark, []), F.lit(True)).collect() == []


# line dedup

def _line_dedup(rows, window=3):
    """rows in (id, text) order; the kept texts."""
    seen, out = set(), []
    for _, text in rows:
        lines = (text or "").split("\n")
        gone = set()
        for i in range(len(lines) - window + 1):
            w = tuple(lines[i : i + window])
            if "".join(w):
                if w in seen:
                    gone.update(range(i, i + window))
                seen.add(w)
        out.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def test_line_dedup_matches_brute_force(spark):
    from sluice.llm.line_dedup import dedup_lines

    draw = random.Random(3)
    rows = [(i, "\n".join(draw.choice("abc") + draw.choice(["", "", "x"]) for _ in range(draw.randrange(12)))) for i in range(60)]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == _line_dedup(rows)


def test_line_dedup_of_odd_rows(spark):
    from sluice.llm.line_dedup import dedup_lines

    rows = [(1, "a\nb\nc\nd", "en", "s", 7), (1, "a\nb\nc\nd", "en", "s", 7), (2, "x\na\nb\nc\nb", None, None, None), (3, None, None, None, None), (4, "", "en", "s", 0), (None, "a\nb\nc", "en", "s", 5),
            (5, "\n\n\n\n", "en", "s", 4), (6, "\n\n\n\n", "en", "s", 4), (7, "\n".join(map(str, range(20_000))), "en", "s", 1)]
    got = dedup_lines(clashing(docs(spark, rows)))
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and got.count() == len(rows)
    got = got.collect()
    assert sorted((r.text, r.n_removed) for r in got if r.doc_id == 1) == [("", 4), ("d", 3)]  # the null id comes first
    assert {r.doc_id: r.text for r in got if r.doc_id in (2, 3, 4, 5, 6)} == {2: "x\nb", 3: None, 4: "", 5: "\n\n\n\n", 6: "\n\n\n\n"}
    assert next(r for r in got if r.doc_id is None).n_removed == 0 and next(r for r in got if r.doc_id == 7).n_lines == 20_000
    assert dedup_lines(docs(spark, [])).collect() == []


# repeated strings

def _spans(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        own = []
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                if own and i <= own[-1][1]:
                    own[-1][1] = i + length
                else:
                    own.append([i, i + length])
        out.append(own)
    return out


def _check_strings(spark, texts, **kw):
    from sluice.llm.suffix_dedup import LENGTH, dedup_strings

    length = kw.get("length", LENGTH)
    got = {r.doc_id: r for r in dedup_strings(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **kw).collect()}
    raw = [(t or "").encode() for t in texts]
    for i, (t, want) in enumerate(zip(raw, _spans(raw, length))):
        assert [[s.start, s.end] for s in got[i].spans] == want
        edges = [0, *(x for s in want for x in s), len(t)]
        assert bytes(got[i].kept) == b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2])) and got[i].n_bytes == len(t)


@pytest.mark.parametrize("members", [50_000, 3])
def test_strings_match_brute_force(spark, members):
    draw = random.Random(members)
    text = lambda n, a="abcdefgh é": "".join(draw.choice(a) for _ in range(n))
    shared = [text(k) for k in (60, 64, 65, 90, 300)]
    texts = [text(draw.randrange(200)) + draw.choice(shared) + text(draw.randrange(80)) + draw.choice(shared) for _ in range(40)]
    texts += ["", None, "a" * 500, text(300, "ab"), text(700, "ab") * 2, shared[0], shared[0]]
    _check_strings(spark, texts, length=64, spread=20, members=members)


def test_strings_query_matches_brute_force(spark):
    import hashlib

    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op5_suffix_dedup"](spark, SF).collect()}
    for r, want in zip(rows, _spans([r.text.encode() for r in rows], 400)):
        t, g = r.text.encode(), got[r.doc_id]
        edges = [0, *(x for s in want for x in s), len(t)]
        kept = b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2]))
        assert (g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256) == (len(t), len(t) - len(kept), len(want), hashlib.sha256(kept).hexdigest())


def test_strings_of_odd_rows(spark):
    from sluice.llm.suffix_dedup import dedup_strings

    got = dedup_strings(clashing(docs(spark))).collect()
    assert len(got) == len(odd_rows()) and all(r.n_bytes == 0 and not r.spans for r in got if r.doc_id in (1, 2))
    assert all(len(r.spans) == 1 and len(r.kept) < 100 for r in got if r.doc_id in (7, 8))
    assert dedup_strings(docs(spark, [])).collect() == []


# language model

def _base(rows, learn):
    tokens = {r.doc_id: [*words(r.text), None] for r in rows}
    c = Counter(w for d, ws in tokens.items() if learn(d) for w in ws)
    n, v = sum(c.values()), len(c)
    return {d: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for d, ws in tokens.items()}


def test_lm_query_matches_counts_and_beats_the_base(spark, monkeypatch):
    from sluice.llm import lm_maxent

    monkeypatch.setattr(lm_maxent, "KNOWN", 500)  # most counts go through the join
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = _base(rows, lambda d: zlib.crc32(str(d).encode()) % 7 != 2)
    got = {r.doc_id: r for r in QUERIES["op6_lm_scoring"](spark, SF).collect()}
    for d, w in want.items():
        assert (got[d].n_tokens, got[d].n_known, got[d].train_tokens) == w[:3] and got[d].base_score == pytest.approx(w[3])
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_probabilities_sum_to_one(spark):
    from sluice.llm import lm_maxent as L
    from sluice.llm.common import Powers

    train = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog"] * 20
    counts, (total, distinct), model, (known, c) = L.fit(spark.createDataFrame(list(enumerate(train)), "doc_id long, text string"))
    assert (total, distinct) == (20 * (6 + 6 + 5) + 60, 10)
    assert c.sum() == total and len(known) == distinct and (np.diff(known.astype(float)) > 0).all()
    data = np.frombuffer(b"the cat", np.uint8)
    f = L.Tokens(np.array([0, len(data)]), data, Powers(0x9E3779B97F4A7C15)).features()
    p = L.softmax((f % np.uint64(L.ROWS)).astype(np.uint16), model.bias, model.weights)
    live = -(-len(model.head) // L.WIDTH)
    assert np.allclose(p.sum(1), 1) and (p[:, live : L.HEAD // L.WIDTH] < 1e-6).all()
    cls = np.zeros(f.shape[1], np.int64)
    q = L.softmax(L.word_rows(f[L.NEAR], cls), model.word_bias[cls], model.word_weights)
    assert np.allclose(q.sum(1), 1) and (q[:, len(model.head) :] < 1e-6).all()


def test_lm_gradients_are_added_up_by_run_to_the_last_bit():
    from sluice.llm.lm_maxent import _put, _runs, _summed

    draw = np.random.default_rng(4)
    for width, values, n in ((64, 3, 4096), (64, 900, 4096), (16, 100_000, 9000), (16, 1, 1), (16, 40, 8), (16, 9000, 60_000)):
        r = (draw.random(n) ** 3 * values).astype(np.uint32)  # some values fill long runs, others stand alone
        g = draw.standard_normal((n, width)).astype(np.float32)
        order, at, size, hit = _runs(r)
        by = np.argsort(r, kind="stable")
        value, first = np.unique(r[by], return_index=True)
        assert sorted(hit.tolist()) == value.tolist() and (np.diff(np.minimum(size, 9)) <= 0).all()
        want = np.zeros((values, width), np.float32)
        want[value] = np.add.reduceat(g[by], first, axis=0)
        got = np.zeros((values, width), np.float32)
        _put(got, hit, _summed(g, order, at, size))
        assert (got == want).all()


def test_lm_of_odd_rows(spark):
    from sluice.llm.lm_maxent import score

    got = score(clashing(docs(spark)), F.col("doc_id") > 3).collect()
    assert len(got) == len(odd_rows()) and all(r.n_tokens == 1 for r in got if r.doc_id in (1, 2, 3)) and all(r.score <= 0 for r in got)
    nothing = score(docs(spark), F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in nothing)
    assert score(docs(spark, []), F.lit(True)).collect() == []


def test_lm_every_word_above_a_count_has_a_softmax(spark):
    from sluice.llm import lm_maxent as L
    from sluice.llm.common import Powers

    pairs = [(f"l{i}x", f"r{i}x") for i in range(500)]  # all of one ending class
    draw = random.Random(1)
    text = [" ".join(w for i in draw.sample(range(500), 500) for w in pairs[i]) for _ in range(150)]
    train = [*text, "seldom"]
    _, _, model, (known, c) = L.fit(spark.createDataFrame(list(enumerate(train)), "doc_id long, text string"))
    assert L.CLASSES == 64 and len(L.NEAR) == 5 and len(model.head) == 1001 and model.depth >= 2  # 1,000 words of 150 and the end
    data = np.frombuffer(" ".join(a + " " + b for a, b in pairs).encode(), np.uint8)
    t = L.Tokens(np.array([0, len(data)]), data, Powers(0x9E3779B97F4A7C15))
    cls, rank = model.targets(t)
    assert (rank >= 0).sum() == len(cls) and len(set(rank)) == 1001
    # all leaves after one context: their probabilities sum to one
    ranks = np.concatenate([np.arange(len(model.head)), np.full(L.ENDINGS, -1)])
    of = np.zeros(len(model.head), np.int64)
    of[rank] = cls
    classes = np.concatenate([of, L.HEAD // L.WIDTH + np.arange(L.ENDINGS)])
    f = np.repeat(t.features()[:, 1:2], len(ranks), axis=1)
    p = L.softmax((f % np.uint64(len(model.weights))).astype(np.uint32), model.bias, model.weights)[np.arange(len(ranks)), classes]
    token, node, slot = model.path(classes, ranks)
    q = L.softmax(L.word_rows(f[:, token], node, len(model.word_weights)), model.word_bias[node], model.word_weights)[np.arange(len(token)), slot]
    np.multiply.at(p, token, q)
    assert p.sum() == pytest.approx(1, abs=1e-3)


def test_lm_context_counts_for_words_below_the_head(spark):
    from sluice.llm.lm_maxent import score

    draw = random.Random(1)
    rows = [(n, " ".join(f"l{i}x r{i}x" for i in draw.sample(range(500), 500))) for n in range(150)]
    rows += [(1000 + i, f"l{i}x r{i}x") for i in range(500)] + [(2000 + i, f"l{i}x r{(i + 7) % 500}x") for i in range(500)]
    got = {r.doc_id: r.score for r in score(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") < 1000).collect()}
    assert np.mean([got[1000 + i] > got[2000 + i] for i in range(500)]) > 0.95
