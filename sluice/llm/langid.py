"""Language of a text: unigram piece models with all segmentations summed.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all ways to
cut it into pieces, by the forward algorithm; a text's is the product over its words. The piece
probabilities come from expectation maximisation over the words of a bounded sample of labelled
documents: forward-backward runs in the tasks, the driver adds up one expected count for each piece and language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, mix

VOCABULARY = "piece_bpe_32k.model"
#: Labelled documents of a language to learn from, in expectation.
SAMPLE = 2000
ROUNDS = 3
#: Count every piece has in every language beforehand.
SMOOTH = 0.05
#: Probability of a letter that is no piece, in every language.
STRANGE = 1e-4
SCALE = 30.0
#: Words whose scores a task remembers.
REMEMBERED = 200_000
UNDETERMINED = "und"
#: Words are runs of letters, by Unicode's categories: digits of other kinds, such as halves and superscripts, are none.
LETTERS = regex.compile(r"\p{L}+")
#: Longer words are scored letter by letter, with scaled probabilities; they teach nothing.
LONG = 64


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def vocabulary(model: str = VOCABULARY) -> list[str]:
    """Lower-case pieces of letters, with the mark of a word's start where they have it."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model) if "/" not in model else model)
    pieces = {sp.id_to_piece(i).lower() for i in range(sp.vocab_size()) if not sp.is_byte(i) and not sp.is_control(i) and not sp.is_unknown(i)}
    return sorted(p for p in pieces if (bare := p.removeprefix("▁")) and LETTERS.fullmatch(bare)) + ["▁"]


def _letters(items: list[str]) -> np.ndarray:
    width = max(map(len, items))
    return np.array(items, f"U{width}").view(np.uint32).reshape(len(items), width)


class Pieces:
    """Finds the vocabulary's pieces in many words at once."""

    BASE, SLOTS = np.uint64(0x9E3779B97F4A7C15), 1 << 22

    def __init__(self, pieces: list[str]):
        self.longest, self.n = max(map(len, pieces)), len(pieces)
        h = np.empty(len(pieces), np.uint64)
        sizes = np.array([len(p) for p in pieces])
        for size in range(1, self.longest + 1):
            own = np.flatnonzero(sizes == size)
            if len(own):
                h[own] = self.hashes(_letters([pieces[i] for i in own]), size)[-1][:, -1]
        self.order = np.argsort(h)
        self.sorted = h[self.order]
        self.slots = np.zeros(self.SLOTS, bool)
        self.slots[h & np.uint64(self.SLOTS - 1)] = True

    def hashes(self, letters: np.ndarray, longest: int) -> list[np.ndarray]:
        """For each size the hash of the piece that ends at each letter."""
        with np.errstate(over="ignore"):
            one = mix(letters.astype(np.uint64), 5)
            out = [one]
            for _ in range(min(longest, letters.shape[1]) - 1):
                longer = np.zeros_like(one)
                longer[:, 1:] = out[-1][:, :-1] * self.BASE + one[:, 1:]
                out.append(longer)
        return [mix(h, 50 + k) for k, h in enumerate(out)]

    def found(self, letters: np.ndarray) -> list[np.ndarray]:
        """For each size the number of the piece that ends at each letter; n: none, n + 1: a strange letter."""
        out = []
        for k, h in enumerate(self.hashes(letters, self.longest)):
            got = np.full(h.shape, self.n, np.int32)
            rows, cols = np.nonzero(self.slots[h & np.uint64(self.SLOTS - 1)])
            keep = cols >= k
            rows, cols = rows[keep], cols[keep]
            own = h[rows, cols]
            at = np.minimum(np.searchsorted(self.sorted, own), self.n - 1)
            real = self.sorted[at] == own
            got[rows[real], cols[real]] = self.order[at[real]]
            if k == 0:
                got[got == self.n] = self.n + 1
            out.append(got)
        return out


def batches_by_length(items: list[str], cells: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, letters) of words of one length, marked at their start."""
    sizes = np.array([len(w) for w in items])
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        step = max(1, cells // (int(size) + 1))
        for a in range(0, len(own), step):
            yield own[a : a + step], _letters(["▁" + items[i] for i in own[a : a + step]])


def forward(found: list[np.ndarray], probs: np.ndarray) -> list[np.ndarray]:
    """alpha[i][word, language]: probability of the first i letters, times SCALE**i."""
    n, width = found[0].shape
    alpha, ends = [np.ones((n, probs.shape[1]))], hits(found, probs)
    for i in range(width):
        own = [alpha[i - k] * (probs[found[k][:, i]] * SCALE ** (k + 1)) for k in range(min(len(found), i + 1)) if ends[k][i]]
        alpha.append(sum(own, np.zeros_like(alpha[0])))
    return alpha


def hits(found: list[np.ndarray], probs: np.ndarray) -> list[np.ndarray]:
    """For each size and letter, whether a piece ends there in any of the words."""
    return [(f != len(probs) - 2).any(0) for f in found]


def long_score(word: str, pieces: Pieces, probs: np.ndarray, step: int = 4096) -> np.ndarray:
    """Log probability of a word of any length in each language: the same sum, with the last few alphas only."""
    letters, past, log = _letters(["▁" + word]), [np.ones(probs.shape[1])], np.zeros(probs.shape[1])
    for a in range(0, letters.shape[1], step):
        lead = min(a, pieces.longest - 1)  # pieces that begin before this part
        found = [f[0] for f in pieces.found(letters[:, a - lead : a + step])]
        for i in range(lead, len(found[0])):
            new = np.zeros(probs.shape[1])
            for k in range(min(len(found), len(past))):
                if found[k][i] != pieces.n:
                    new += past[-1 - k] * probs[found[k][i]]
            past = [*past[1 - pieces.longest :], new]
            if i % 8 == 0:
                top = np.maximum(np.max(past, axis=0), 1e-300)
                past, log = [x / top for x in past], log + np.log(top)
    return log + np.log(np.maximum(past[-1], 1e-300))


def word_scores(items: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language."""
    out = np.empty((len(items), probs.shape[1]))
    short = np.array([i for i, w in enumerate(items) if len(w) <= LONG], np.int64)
    for i in set(range(len(items))).difference(short.tolist()):
        out[i] = long_score(items[i], pieces, probs)
    for own, letters in batches_by_length([items[i] for i in short]):
        at, width = short[own], letters.shape[1]
        out[at] = np.log(np.maximum(forward(pieces.found(letters), probs)[-1], 1e-300)) - width * np.log(SCALE)
    return out


def expected_counts(items: list[str], counts: np.ndarray, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in each language, over words with the given counts."""
    total = np.zeros((pieces.n + 2) * probs.shape[1])
    langs = np.arange(probs.shape[1])
    for at, letters in batches_by_length(items):
        found = pieces.found(letters)
        alpha, ends, width = forward(found, probs), hits(found, probs), letters.shape[1]
        beta = [np.zeros_like(alpha[0]) for _ in range(width)] + [np.ones_like(alpha[0])]
        whole = counts[at] / np.maximum(alpha[-1], 1e-300)
        for i in range(width, 0, -1):
            for k in range(min(len(found), i)):
                if not ends[k][i - 1]:
                    continue
                p = found[k][:, i - 1]
                step = probs[p] * SCALE ** (k + 1) * beta[i]
                beta[i - 1 - k] += step
                uses = alpha[i - 1 - k] * step * whole
                hit = p != pieces.n
                total += np.bincount((p[hit, None] * len(langs) + langs).ravel(), uses[hit].ravel(), minlength=len(total))
    return total.reshape(-1, len(langs))


def normal(counts: np.ndarray, n: int) -> np.ndarray:
    """Piece probabilities from counts; two more rows for no piece and a strange letter."""
    c = counts[:n] + SMOOTH
    return np.vstack([c / c.sum(0), np.zeros(c.shape[1]), np.full(c.shape[1], STRANGE)])


def _word_counts(langs: list[str]):
    place = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = Counter()
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                for w, n in Counter(w for w in words_of(text.as_py()) if len(w) <= LONG).items():
                    counts[w, place[lang]] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in counts], pa.string()), pa.array([g for _, g in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "lang", "n"])
    return run


def _expect(pieces: list[str], probs: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, total = Pieces(pieces), None
        for b in batches:
            items, place = np.unique(np.array(b.column("word").to_pylist(), object), return_inverse=True)
            if not len(items):
                continue
            counts = np.zeros((len(items), probs.shape[1]))
            np.add.at(counts, (place, b.column("lang").to_numpy()), b.column("n").to_numpy())
            part = expected_counts(list(items), counts, finder, probs)
            total = part if total is None else total + part
        if total is not None:
            p, g = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(g, pa.int32()), pa.array(total[p, g])], names=["piece", "lang", "n"])
    return run


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", key: str = "doc_id", sample: int = SAMPLE, model: str = VOCABULARY) -> tuple[list[str], list[str], np.ndarray]:
    """(languages, pieces, probabilities), from rows where ``learn`` holds and text and language are not null.

    Of a language with more rows than ``sample`` a share chosen by a hash of ``key`` is used, whole texts.
    """
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(key).alias("key")).filter(learn).filter("text is not null and lang is not null")
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs, pieces = sorted(have), vocabulary(model)
    if not langs:
        return [], pieces, np.empty((0, 0))
    share = F.create_map(*[x for g in langs for x in (F.lit(g), F.lit(sample / have[g]))])
    rows = rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * float(1 << 30))
    counts = rows.select("lang", "text").mapInArrow(_word_counts(langs), "word string, lang int, n long")
    counts = cut(counts.groupBy("word", "lang").agg(F.sum("n").alias("n")), "words")
    probs = normal(np.ones((len(pieces), len(langs))), len(pieces))
    for _ in range(ROUNDS):
        summed = np.zeros((len(pieces) + 2, len(langs)))
        for r in counts.mapInArrow(_expect(pieces, probs), "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():
            summed[r["piece"], r["lang"]] = r["n"]
        probs = normal(summed, len(pieces))
    return langs, pieces, probs


def predictor(langs: list[str], pieces: list[str], probs: np.ndarray):
    """A column function: text -> struct(lang_pred, score)."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def predict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder, place, table = Pieces(pieces), {}, np.empty((0, len(langs)), np.float32)
        for part in parts:
            pred, score = [], []
            for first in range(0, len(part), 500):
                texts = [words_of(t.as_py() or "") for t in part.slice(first, 500)]
                new = list({w for t in texts for w in t}.difference(place)) if langs else []
                if new:
                    if len(place) + len(new) > REMEMBERED:
                        new = list({w for t in texts for w in t})
                        place, table = {}, table[:0]
                    place |= {w: len(place) + i for i, w in enumerate(new)}
                    table = np.vstack([table, word_scores(new, finder, probs).astype(np.float32)])
                for t in texts:
                    if not t or not langs:
                        pred.append(UNDETERMINED)
                        score.append(0.0)
                        continue
                    total = table[np.fromiter(map(place.__getitem__, t), np.int64, len(t))].sum(0, dtype=np.float64)
                    best = int(np.argmax(total))
                    pred.append(langs[best])
                    score.append(float(1 / np.exp(np.minimum(total - total[best], 0)).sum()))
            yield pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(score, pa.float64())], fields=list(kind))

    return predict


def identify(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", key: str = "doc_id", out: str = "language", **kw) -> DataFrame:
    """The input rows with a struct column ``out`` (lang_pred, score); learns from the rows where ``learn`` holds.

    ``learn`` may use ``key``, ``text`` and ``lang``. lang_pred is a learned label, the first in order among equals; score is its
    posterior under equal priors, 0 to 1. A null text, one without letters, or an empty training set gives
    ``und`` with score 0. Long texts are read whole; repeated rows get equal results; an empty table stays empty. ``out``
    replaces an input column of that name.
    """
    langs, pieces, probs = fit(docs, learn, text_col, lang_col, key, **kw)
    return docs.withColumn(out, predictor(langs, pieces, probs)(F.col(text_col)))


def fold(key: str, parts: int) -> Column:
    """Remainder of the crc32 of the id as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts
