"""Texts that would never end with work that grows faster than the text, and blocks of items."""

import math
import time

import numpy as np
from helpers import docs
from pyspark.sql import functions as F

from sluice.llm.decontam import Items, contamination
from sluice.llm.langid import Pieces, long_score, normal, word_scores, words_of


def test_short_item_repeated_through_a_long_text():
    text = "yes it is so " * 80_000  # 1 MB
    began = time.time()
    got = Items([(1, "yes it is so"), (2, "no it isnt")], 0.1).leaks(text)
    assert time.time() - began < 30
    assert len(got) == 80_000 and got[0] == {"item_id": 1, "start": 0, "end": 12, "distance": 0}


def test_items_of_many_blocks_find_what_one_block_finds(spark):
    items = spark.createDataFrame([(i, f"the benchmark question number {i * 37} asks for the {i}th answer") for i in range(30)], "item_id long, text string")
    rows = [(i, f"before the benchmark question number {i * 37} asks for the {i}th answer after", "en", "s", 1) for i in range(0, 60, 2)]
    found = lambda **kw: sorted(map(tuple, contamination(docs(spark, rows), items, **kw).collect()))
    whole = found()
    assert found(block_chars=300) == whole and {r[0] for r in whole} >= set(range(0, 30, 2))


def test_letters_are_letters():
    assert words_of("½ ² ① x2y é漢 aªb 5th") == ["x", "y", "é漢", "aªb", "th"]


def test_long_words_sum_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "abababababababab"]
    finder, draw = Pieces(pieces), np.random.default_rng(0)
    probs = normal(draw.random((len(pieces), 3)) * 5, len(pieces))
    for w in ("a", "abba", "ab" * 30, "abababababababab" * 3):
        assert np.allclose(long_score(w, finder, probs), word_scores([w[:64]], finder, probs)[0]) or len(w) > 64

    def plain(word, g):
        word, alpha = "▁" + word, [1.0]
        for i in range(1, len(word) + 1):
            alpha.append(sum(alpha[i - len(p)] * probs[k, g] for k, p in enumerate(pieces) if word[:i].endswith(p)))
        return math.log(alpha[-1])

    w = "ab" * 40 + "a" + "b" * 20
    assert np.allclose(long_score(w, finder, probs, step=7), [plain(w, g) for g in range(3)])
    assert np.allclose(word_scores([w, "ab"], finder, probs)[0], [plain(w, g) for g in range(3)])
    assert np.all(np.isfinite(long_score("ab" * 50_000, finder, probs)))


def test_whole_vocabulary_is_used():
    from sluice.llm.langid import vocabulary

    pieces = vocabulary()
    assert max(map(len, pieces)) == 16 and len(pieces) > 23_000


def test_language_of_a_text_without_letters(spark):
    from sluice.llm.langid import identify

    rows = [(1, "the house", "en", "s", 1), (2, "das haus", "de", "s", 1), (3, "½ ² ① 12", None, "s", 1), (4, "x" * 100_000, None, "s", 1)]
    got = {r.doc_id: r.language for r in identify(docs(spark, rows), F.lit(True)).collect()}
    assert got[3].lang_pred == "und" and got[3].score == 0 and got[4].lang_pred in ("en", "de")


def test_pages_that_never_end():
    """A megabyte each of what made the work grow with the square."""
    from sluice.llm.html_crf import blocks, features

    pages = {"<a ": "<a " * 350_000, "divs": "<div>x" * 170_000, "names": "".join(f"<div class=n{i}>x" for i in range(50_000)), "ends": "<div>" * 100_000 + "</p>" * 100_000,
             "quotes": '<a href="x ' * 90_000, "comments": "<!-- " * 200_000, "inline": "<b>" * 100_000 + "<p>x" * 100_000, "cells": "<td><li>" * 120_000}
    for name, html in pages.items():
        began = time.time()
        page = blocks(html)
        features(page, {"in div", "in p"})
        assert time.time() - began < 25, name
        assert len(page) == {"divs": 170_000, "names": 50_000, "inline": 100_000}.get(name, 0), name


def test_tags_that_need_care():
    from sluice.llm.html_crf import blocks

    texts = lambda html: [b.text for b in blocks(html)]
    assert texts("a < b <c>d</c> 1<2") == ["a < b", "d", "1<2"] and texts("x<p title='a>b'>y<p title=\"it's\">z") == ["x", "y", "z"]
    assert texts("<!DOCTYPE html><?xml?>a<!-- <p>b --></ c>d") == ["ad"] and texts("a<script>if (a < b) '<p>'</SCRIPT >b<style>c") == ["a", "b"]
    assert texts("one<br/>two<div/>three &amp;amp; &lt;p&gt;") == ["one two", "three &amp; <p>"] and texts("a<p class='x") == ["a"]
    deep = blocks("<html><body><div id=Main class='a-b c9'><p><b>t</b>")[0]
    assert deep.path == (("html", ()), ("body", ()), ("div", ("main", "a", "b", "c")), ("p", ()))
