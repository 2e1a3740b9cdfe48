"""Brute-force versions and small frames for the operators' tests."""

import random
import re
from collections import Counter

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", lower(text))


def odd_rows():
    """Nulls in every column, empty, blank, wordless, long, repeated and tied rows."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", "en", "b", 3), (4, "one", "en", "b", 3), (None, "one", "en", None, 3),
            (5, "a b c d e f g", "en", "b", 13), (6, "A B c D e f G", None, "b", 13), (7, long, "en", "b", len(long)), (8, long + " tail", "en", "b", len(long) + 5),
            (9, "1234 5678 !!!", "en", None, 13), (10, "ÄÖÜ ß é ñ 漢字 🙂", "de", "c", 16), (None, None, None, None, None)]
    return rows


def docs(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)


def clashing(df):
    """The frame with columns named as the operators name theirs."""
    from pyspark.sql import functions as F

    for c in ("row", "fp", "sketch", "component", "h", "n", "kept", "gone", "length", "piece", "part", "found", "score", "rank", "leaks", "row_", "language", "word"):
        df = df.withColumn(c, F.lit("x"))
    return df


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def components(texts, num=80, den=100):
    """Component label of each text: the least index reachable by links."""
    sets = [shingles(t) for t in texts]
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    held = {}
    for i, s in enumerate(sets):
        for g in s:
            held.setdefault(g, []).append(i)
    common = Counter((a, b) for own in held.values() for k, b in enumerate(own) for a in own[:k])
    for (a, b), both in common.items():
        if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((root(a), root(b)))
            label[b] = a
    return [root(i) for i in range(len(sets))]


def family(seed, copies, size=120, edits=6, vocabulary=400):
    """Near copies of one text: each with up to ``edits`` words replaced, and unrelated texts that hold one passage."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(vocabulary)}"
    base = [word() for _ in range(size)]
    passage = [word() for _ in range(size // 2)]
    out = []
    for _ in range(copies):
        own = list(base)
        for _ in range(draw.randrange(edits + 1)):
            own[draw.randrange(size)] = word()
        out.append(" ".join(own))
    for _ in range(copies):
        out.append(" ".join([word() for _ in range(size // 2)] + passage))
    return out
