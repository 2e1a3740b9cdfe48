import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import SF, clashing, docs, lower, odd_rows

from sluice.llm.phrases import collocations
from sluice.llm.queries import ORACLE


def _brute(rows, least, longest=5, first=2000):
    """(lang, rank, phrase, a, l, r, n, score) of rows (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in range(1, longest + 1):
                for i in range(len(w) - size + 1):
                    f[lang or "und", tuple(w[i : i + size])] += 1
    found = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = {}
    for (lang, w), a in found.items():
        if any(g == lang and len(v) > len(w) and b >= a and any(v[i : i + len(w)] == w for i in range(len(v))) for (g, v), b in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [(g, i + 1, p.decode(), -a, x, y, n[g], -s) for g, own in out.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[:first])]


def _texts(seed, rows=60):
    draw = random.Random(seed)
    phrases = [["alpha", "beta"], ["New", "york", "city"], ["a", "b", "c", "d", "e"], ["x", "x", "x"], ["é", "漢", "z"], ["a", "b", "c", "d", "f"]]
    out = []
    for _ in range(rows):
        words = []
        for _ in range(draw.randrange(40)):
            words += draw.choice(phrases) if draw.random() < 0.5 else [draw.choice("pqrstuvw") + draw.choice(["", "", ".", ",", "\n", "!"])]
        out.append((draw.choice(["en", "en", "de", None]), draw.choice([" ", "  ", "\t"]).join(words)))
    return out


@pytest.mark.parametrize("least, longest, first, shards", [(4, 5, 2000, 4), (3, 3, 5, 1)])
def test_collocations_match_brute_force(spark, least, longest, first, shards):
    rows = _texts(least)
    frame = spark.createDataFrame([(i, t, g, "s", 1) for i, (g, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in collocations(frame.repartition(3), least=least, longest=longest, first=first, shards=shards).collect()]
    want = _brute(rows, least, longest, first)
    assert sorted(got) == sorted(want) and len(want) > 10


def test_slots_shared_by_phrases_change_nothing(spark, monkeypatch):
    from sluice.llm import phrases

    monkeypatch.setattr(phrases, "FEWEST_BITS", 3)
    monkeypatch.setattr(phrases, "MOST_BITS", 3)
    rows = _texts(9)
    frame = spark.createDataFrame([(g, t) for g, t in rows], "lang string, text string")
    assert sorted(tuple(r) for r in collocations(frame, least=4, shards=2).collect()) == sorted(_brute(rows, 4))


def test_a_phrase_starts_no_sooner_than_its_subphrases():
    """The pairs share slots with pairs found in step 1, but their words are found in step 2: no scan before step 3 meets the phrase."""
    from sluice.llm import phrases as P

    data = np.frombuffer(b"x y z q", np.uint8)
    chunk = P.Chunk(["en"], np.array([0, len(data)]), data, P.Powers(P.BASE))
    steps = [np.full(1 << 12, P.NEVER, np.uint8), np.full(1 << 12, 1, np.uint8), np.full(1 << 12, 1, np.uint8)]
    steps[0][P.slot(chunk.h, 12)] = 2
    assert {size: start.tolist() for size, _, _, start in P.grams(chunk, steps, 12)} == {1: [0] * 4, 2: [2] * 3, 3: [2] * 2, 4: [2]}


def test_a_task_that_merges_often_counts_the_same(spark, monkeypatch):
    from sluice.llm import phrases

    monkeypatch.setattr(phrases, "HELD", 16)
    rows = _texts(11)
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in collocations(frame, least=4, shards=2).collect()) == sorted(_brute(rows, 4))


def test_collocations_of_odd_rows(spark):
    rows = odd_rows() + [(20, "und und", None, None, 1), (21, "und und", "und", None, 1), (22, " . , ; ", "fr", None, 1)]
    got = sorted(tuple(r) for r in collocations(clashing(docs(spark, rows)), least=2, shards=2).collect())
    assert got == sorted(_brute([(r[2], r[1]) for r in rows], 2)) and got
    assert collocations(docs(spark, []), least=2).collect() == []
    assert collocations(docs(spark, [(1, None, None, None, None)]), least=2).collect() == []


def test_long_counts_stay_exact(spark):
    """One word over and over: overlapping occurrences count, products pass 2^31."""
    rows = [("en", " ".join(["ha"] * 30_000))] * 3
    got = [tuple(r) for r in collocations(spark.createDataFrame(rows, "lang string, text string"), shards=1).collect()]
    assert sorted(got) == sorted(_brute(rows, 100)) and len(got) == 4


def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = con.execute(ORACLE["op12_phrase_collocation"].replace("f >= 100", "f >= 12")).fetchall()
    got = [tuple(r) for r in collocations(spark.read.parquet(f"{SF}/documents.parquet"), least=12, shards=2).collect()]
    assert sorted(got) == sorted(want) and len(want) > 50


def test_a_task_hands_its_counts_over_in_small_batches(monkeypatch):
    """The rows that a task has merged reach the JVM in batches of ROWS_OUT, not in one as large as all that it held."""
    import pyarrow as pa

    from sluice.llm import phrases

    monkeypatch.setattr(phrases, "ROWS_OUT", 50, raising=False)
    texts = [" ".join(f"w{i % 331}" for i in range(7 * k, 7 * k + 90)) for k in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array(texts), pa.array(np.arange(40))], names=["lang", "text", "row"])
    steps = phrases.Steps(12, 3)
    steps.add(1, np.arange(1 << 12), 1)
    out = list(phrases._scan(steps, 2, 4)(iter([batch])))
    assert max(map(len, out)) <= 50 < sum(map(len, out))
    rows = [r for b in out for r in b.to_pylist()]
    assert len({r["h"] for r in rows}) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r["tag"] // 256] += r["n"]
    assert sizes == {1: 40 * 90, 2: 40 * 89}
