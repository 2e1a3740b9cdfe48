import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import SF, clashing, docs, odd_rows

from sluice.llm.cutting_stock import CAPACITY, END, Plan, classes, pack_tightly, priced, solve
from sluice.llm.queries import QUERIES
from sluice.llm.word_bpe import WordBpe


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def words():
    return WordBpe("word_bpe_49k")


# token ids

def test_ids_equal_those_of_tokenizers(spark, tokenizer, words):
    draw = random.Random(1)
    letters = "abcdeABCÄÖÜßéñçİıſΣσςЖж059½²①'’.,!?-_ \t\n\x0b\x0c\r\x1c\x1f\x85\xa0\xad́̈—€#<|>/w漢🙂‍"
    vocabulary = [t.replace("</w>", "") for t in tokenizer.get_vocab()]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(30))) for _ in range(5000)]
    texts += ["".join(draw.choice(vocabulary) for _ in range(draw.randrange(1, 5))) for _ in range(5000)]
    texts += ["", "a<|endoftext|>b", "<|startoftext|>", "don't we'll I'M 's", "a" * 3000, "x" * 5 + "." * 400]
    texts += [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t in texts:
        assert np.frombuffer(words.ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_forgotten_words_are_found_again(monkeypatch, words):
    from sluice.llm import word_bpe

    few = WordBpe("word_bpe_49k")
    monkeypatch.setattr(word_bpe, "KEPT", 3)
    text = "one two three four one two five six one"
    assert few.ids(text) == words.ids(text)


# the plan

def test_a_pattern_is_the_best_knapsack():
    draw = np.random.default_rng(2)
    for _ in range(30):
        sizes = sorted(draw.choice(np.arange(1, 40), 6, replace=False).tolist(), reverse=True)
        values = draw.random(6) * sizes
        best = [0.0] * 61
        for c in range(1, 61):
            best[c] = max([best[c - 1]] + [best[c - s] + v for s, v in zip(sizes, values) if s <= c])
        worth, items = priced(values, sizes, 60)
        assert worth == pytest.approx(best[60]) and items @ sizes <= 60 and items @ values == pytest.approx(worth)


def test_linear_program_holds_the_demand_near_its_bound():
    draw = np.random.default_rng(3)
    sizes = sorted(draw.choice(np.arange(20, 900), 40, replace=False).tolist(), reverse=True)
    demand = draw.integers(50, 500, 40)
    held = np.zeros(40)
    total = 0.0
    for pattern, n in solve(demand, sizes, 1000):
        assert sum(sizes[k] * a for k, a in pattern) <= 1000
        for k, a in pattern:
            held[k] += a * n
        total += n
    assert np.allclose(held, demand)
    alone = sum(n / (1000 // s) for n, s in zip(demand, sizes))
    assert total < 0.93 * alone and total >= demand @ sizes / 1000 - 1e-6


def test_textbook_cutting_stock():
    """Rolls of 100; 97 of 45, 610 of 36, 395 of 31, 211 of 14: the optimum of the relaxed program is 452.25."""
    assert sum(n for _, n in solve(np.array([97, 610, 395, 211]), [45, 36, 31, 14], 100)) == pytest.approx(452.25, rel=1e-3)


@pytest.mark.parametrize("kind", ["documents", "one", "none", "ones", "same", "each", "short", "long", "full", "many"])
def test_every_token_has_one_place_and_all_but_the_last_sequences_are_full(kind):
    draw = np.random.default_rng(4)
    lengths = {"documents": [min(int(x), 4096) for x in draw.lognormal(6, 1.2, 3000)], "one": [777], "none": [], "ones": [1] * 5000,
               "same": [3000] * 50, "each": list(range(1, 400)) * 2, "short": draw.integers(1, 30, 4000).tolist(),
               "long": draw.integers(2100, 4000, 900).tolist(), "full": [4096] * 7, "many": [1500] * 200_000 + [1000] * 100_000 + [97]}[kind]
    counts = Counter(lengths)
    plan, held = Plan(dict(counts)), defaultdict(list)
    whole = 0
    if kind != "many":
        for length, n in counts.items():
            for rank in range(n):
                sequence, at = plan.whole(length, rank)
                whole += sequence >= 0
                for a, size, s, offset in [(0, length, sequence, at)] if sequence >= 0 else plan.pieces(at, length):
                    held[s].append((offset, size))
        assert len(held) == plan.sequences and sum(size for own in held.values() for _, size in own) == sum(lengths)
        for own in held.values():
            assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) and min(own)[0] == 0
        filled = [sum(n for _, n in own) for own in held.values()]
        partial = [f for f in filled if f != CAPACITY]
        assert all(f & (f - 1) == 0 for f in partial) and len(partial) == len(set(partial))  # one of each power at most
    else:
        assert sum(map(len, plan.places.values())) < 50 and plan.sequences <= sum(lengths) // CAPACITY + 13
    if kind == "documents":
        assert whole > 0.95 * len(lengths)


def test_classes_are_few_and_cover_every_length():
    counts = Counter(np.random.default_rng(5).integers(1, 4097, 20_000).tolist())
    for limit in (1, 2, 30, 160):
        found = classes(counts, limit)
        assert len(found) <= limit and found[0] == max(counts) and found == sorted(set(found), reverse=True)
    assert classes({5: 1, 9: 2}) == [9, 5]


# whole frames

def _check(rows, got, tokenizer, capacity=CAPACITY):
    """Pieces of every document in order, with the ids of ``tokenizers``, and sequences without gaps or padding."""
    want = Counter()
    for r in rows:
        want[r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + (END,)] += 1
    own, sequences = defaultdict(Counter), defaultdict(list)
    for r in got:
        own[r.doc_id][r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    for (key, ids), n in want.items():
        left = Counter({p: k for p, k in own[key].items() if p[3] == len(ids)})
        assert sum(p[1] * k for p, k in left.items()) >= n * len(ids)
        for start, length, crc, _ in left:
            if sum(1 for k, i in want if k == key and len(i) == len(ids)) == 1:
                assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end == capacity or end & (end - 1) == 0


def test_query_packs_every_token_once(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op11_packing"](spark, SF).collect()
    _check(rows, got, tokenizer)
    places = defaultdict(list)
    for r in got:
        places[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for doc_id, own in places.items():  # ids are unique in this table
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] == own[-1][2]
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= total // CAPACITY + 12


@pytest.mark.parametrize("capacity", [64, 100, 4096])
def test_packing_of_odd_rows(spark, tokenizer, capacity):
    rows = odd_rows()
    got = pack_tightly(clashing(docs(spark, rows)).repartition(3), capacity=capacity).collect()
    _check(rows, got, tokenizer, capacity)
    for r in got:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
    assert pack_tightly(docs(spark, []), capacity=capacity).collect() == []
