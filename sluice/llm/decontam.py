"""Benchmark passages in documents, within a number of edits, by the pigeonhole principle.

A test item with an error budget of k edits is cut into k + 1 pieces: any occurrence within the budget holds
one of them unchanged. One Aho-Corasick pass over each text finds the exact piece hits; the stretch around each
hit, unless it lacks more than k of the item's disjoint short grams (an edit spoils one at most), is verified with Myers' bit-parallel edit distance. A short
item must besides begin and end at word edges. Items go to the tasks in blocks of bounded size, one pass over the documents checking each block.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edits allowed per character of an item.
RATE = 0.1
#: Items of fewer normalised characters are found at word edges only.
MIN_CHARS = 25
#: Characters of items sent to a task at once.
BLOCK_CHARS = 2_000_000
GRAM = 5
LEAKS = "array<struct<item_id:bigint,start:bigint,end:bigint,distance:bigint>>"


def lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalised(text: str) -> str:
    """Lower case, every run of white space one space."""
    return " ".join(lower(text).split())


def scores(pattern: str, text: str, anchored: bool = False) -> list[int]:
    """Least edit distance of ``pattern`` to a stretch of ``text`` that ends at each character.

    anchored: the stretch starts where ``text`` does. Bit-parallel: one step a character, whatever the pattern's length.
    """
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, high, score, out = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1), len(pattern), []
    plus, minus = full, 0
    for c in text:
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up = (up << 1 | anchored) & full
        down = down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        out.append(score)
    return out


def matches(pattern: str, text: str, budget: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, distance) of the best stretch of every run of ends within the budget."""
    ends = scores(pattern, text)
    i = 0
    while i < len(ends):
        if ends[i] > budget:
            i += 1
            continue
        j = i
        while j < len(ends) and ends[j] <= budget:
            j += 1
        best = min(range(i, j), key=lambda e: ends[e])
        back = scores(pattern[::-1], text[max(0, best + 1 - len(pattern) - budget) : best + 1][::-1], anchored=True)
        yield best - back.index(min(back)), best + 1, ends[best]
        i = j


def inner(c: str) -> bool:
    """Whether ``c`` is a letter or digit of a script that parts words by spaces."""
    return c.isalnum() and not ("\u0e00" <= c < "\u0f00" or "\u1000" <= c < "\u10a0" or "\u1780" <= c < "\u1800" or "\u2e80" <= c < "\uac00" or c >= "\ud7b0")


def word_matches(pattern: str, text: str, budget: int, a: int, b: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, distance) of the best stretch of every group of overlapping ones within the budget, in ``text[a:b]`` and between word edges of ``text``."""
    edges = [p for p in range(a, b + 1) if p in (0, len(text)) or not (inner(text[p - 1]) and inner(text[p]))]
    least, most, found = max(1, len(pattern) - budget), len(pattern) + budget, []
    for s in edges:
        if s == len(text) or text[s] == " ":
            continue
        near_ends = edges[bisect_left(edges, s + least) : bisect_right(edges, s + most)]
        ends = [e for e in near_ends if text[e - 1] != " "]
        if not ends:
            continue
        if budget:
            to = scores(pattern, text[s : ends[-1]], anchored=True)
            found += [(s, e, to[e - s - 1]) for e in ends if to[e - s - 1] <= budget]
        elif text.startswith(pattern, s):
            found.append((s, s + len(pattern), 0))
    i = 0
    while i < len(found):
        j, upto = i, found[i][1]
        while j < len(found) and found[j][0] < upto:
            upto = max(upto, found[j][1])
            j += 1
        yield min(found[i:j], key=lambda m: (m[2], m[0], m[1]))
        i = j


def near(grams: list[str], text: str, budget: int) -> bool:
    """Whether ``text`` lacks at most ``budget`` of the grams."""
    for g in grams:
        if g not in text:
            budget -= 1
            if budget < 0:
                return False
    return True


class Items:
    """Automaton over the pieces of a block of items."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_chars: int = MIN_CHARS):
        self.min_chars = min_chars
        self.items = [(i, t, int(len(t) * rate)) for i, t in items]
        self.grams = [[t[i : i + GRAM] for i in range(0, len(t) - GRAM + 1, GRAM)] for _, t, _ in self.items]
        pieces = defaultdict(list)
        for n, (_, text, budget) in enumerate(self.items):
            cuts = [len(text) * p // (budget + 1) for p in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces[text[a:b]].append((n, b))
        self.automaton = ahocorasick.Automaton()
        for piece, own in pieces.items():
            self.automaton.add_word(piece, own)
        if pieces:
            self.automaton.make_automaton()

    def leaks(self, text: str | None) -> list[dict]:
        if not text or not self.items:
            return []
        norm = normalised(text)
        spans = defaultdict(list)
        for end, own in self.automaton.iter(norm):
            for n, upto in own:
                _, item, budget = self.items[n]
                spans[n].append((max(0, end + 1 - upto - budget), min(len(norm), end + 1 - upto + len(item) + budget)))
        found = []
        for n, windows in spans.items():
            item_id, item, budget = self.items[n]
            windows.sort()
            merged = [list(windows[0])]
            for a, b in windows[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            for a, b in merged:
                if len(item) < self.min_chars:
                    found += [(s, e, n, d) for s, e, d in word_matches(item, norm, budget, a, b)]
                elif near(self.grams[n], norm[a:b], budget):
                    found += [(a + s, a + e, n, d) for s, e, d in matches(item, norm[a:b], budget)]
        if not found:
            return []
        at = [m.start() + i for m in re.finditer(r"\S+", text) for i in range(len(m[0]) + 1)]  # place of every normalised character, and of the space after a word
        return [{"item_id": self.items[n][0], "start": at[s], "end": at[e - 1] + 1, "distance": d} for s, e, n, d in sorted(found)]


def _finder(items: list[tuple[int | None, str]], rate: float, min_chars: int):
    @F.arrow_udf(LEAKS)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = Items(items, rate, min_chars)
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("item_id", "start", "end", "distance")]))
        for part in texts:
            yield pa.array((block.leaks(t.as_py()) for t in part), kind)

    return find


def leaks(text: Column, items: DataFrame, **kw) -> Column:
    """Array of (item_id, start, end, distance): where the text comes within ``rate`` edits a character of an item.

    All blocks of items in one column, for items of a few blocks; see :func:`leaks_by_block`, which takes the same
    arguments.
    """
    found = list(leaks_by_block(text, items, **kw))
    return F.concat(*found) if len(found) > 1 else found[0]


def leaks_by_block(text: Column, items: DataFrame, item_id: str = "item_id", item_text: str = "text", rate: float = RATE,
                   min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> Iterator[Column]:
    """A column for each block of items, so that driver and task hold one block at a time; one at least.

    Edits are counted on lower-case text with single spaces; start and end are character offsets in the
    original. For each item and each run of neighbouring ends within the budget the nearest stretch (the first of equals)
    is given. Null and empty texts, and an empty item table, give an empty array. Repeated items are each reported; items
    with a null or blank text are not searched. An item of fewer than ``min_chars`` characters has the same budget, but
    counts only where the stretch begins and ends at word edges (places not between two letters or digits; in scripts
    written without spaces every place); of overlapping stretches the nearest, then the first, is given.
    """
    spaced = F.length(F.regexp_replace(F.trim(F.col(item_text)), r"\s+", " "))
    own = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"), spaced.alias("n")).filter("n > 0")
    total = own.agg(F.sum("n")).first()[0] or 0
    blocks = 1 + total // block_chars
    for b in range(blocks):
        part = own.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).select("i", "t").collect()
        texts = [(r["i"], t) for r in part if (t := normalised(r["t"]))]
        yield _finder(texts, rate, min_chars)(text)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per leak: ``doc_id, item_id, start, end, distance``; see :func:`leaks_by_block`. Repeated rows repeat theirs.

    The documents are read once for each block of items, by tasks of their own.
    """
    found = []
    for own in leaks_by_block(F.col(text_col), items, **kw):
        rows = docs.select(F.col(id_col).alias("doc_id"), own.alias("leaks"))
        # an outer explode: for a plain one Spark would run the search once more to filter empty arrays
        found.append(rows.select("doc_id", F.explode_outer("leaks").alias("l")).filter("l is not null").select("doc_id", "l.*"))
    return reduce(DataFrame.unionAll, found)
