"""Graded quality of texts by ordinal regression: one score, ordered thresholds (cumulative links).

P(grade >= k) = sigmoid(score - threshold k), the score being linear in hashed words, word beginnings and
endings, and a few figures of the text; all thresholds share its weights. Features must be held by a share of the labelled
sample. In every round each task takes gradient steps over its rows, and the weights are averaged; the driver holds one
for each feature in use.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, ByteHash, Powers, bounded, cut, mix, text_chunks, words

#: Labelled rows to learn from, in expectation.
SAMPLE = 20_000
#: Hashed words and beginnings; hashed endings; figures of the text.
WORDS, ENDINGS, FIGURES = 1 << 18, 1 << 12, 4
DIMENSIONS = WORDS + ENDINGS + FIGURES
#: A feature counts if one in so many labelled rows holds it.
ONE_IN = 300
ROUNDS, STEPS, RATE, RIDGE = 6, 25, 0.3, 1e-4
#: Tasks that share the bounded sample.
LEARNERS = 6
GRADES = 3


def text_features(bounds: np.ndarray, data: np.ndarray, powers: Powers) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, values) of each row of a chunk."""
    low = LOWER[data]
    start, end, at = words(low, bounds)
    if len(start):
        h = ByteHash(low, powers).ranges(start, end)
        size = end - start
        letter = lambda place, have: np.where(have, low[np.clip(place, 0, len(low) - 1)], 0).astype(np.uint64)
        first = [letter(start + k, size > k) << np.uint64(8 * k) for k in range(5)]
        four = sum(first[1:4], first[0])
        last = [letter(end - 1 - k, size > k) << np.uint64(8 * k) for k in range(3)]
        named = [(mix(x, 31 + i) % np.uint64(WORDS)).astype(np.int64) for i, x in enumerate((h, four, four + first[4]))]
        ending = (mix(last[0] + last[1] + last[2], 34) % np.uint64(ENDINGS)).astype(np.int64) + WORDS
        upper = np.concatenate([[0], np.cumsum(data != low)])
    for a, z in zip(at[:-1], at[1:]):
        n = z - a
        if not n:
            yield np.empty(0, np.int64), np.empty(0)
            continue
        w = np.unique(np.concatenate([x[a:z] for x in named]))
        e, count = np.unique(ending[a:z], return_counts=True)
        figures = [3 * (upper[end[z - 1]] - upper[start[a]]) / (end[z - 1] - start[a]), 3 * float(np.mean(h[a + 1 : z] == h[a : z - 1])) if n > 1 else 0.0, 3 * len(np.unique(h[a:z])) / n, min(n, 1000) / 300]
        yield np.concatenate([w, e, DIMENSIONS - FIGURES + np.arange(FIGURES)]), np.concatenate([np.full(len(w), (1 + len(w) / 50) ** -0.25), 3 * count / n, figures])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers(0x9E3779B97F4A7C15)
    for b in batches:
        grade, done = b.column(2), 0
        for ids, bounds, data in text_chunks(iter([b])):
            rows = list(text_features(bounds, data, powers))
            yield pa.RecordBatch.from_arrays([grade.slice(done, len(ids)), pa.array([f for f, _ in rows], pa.list_(pa.int64())), pa.array([v for _, v in rows], pa.list_(pa.float64()))], names=["grade", "f", "v"])
            done += len(ids)


def tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k = 0 .. K + 1: 1 first, 0 last."""
    p = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -500, 500)))
    return np.hstack([np.ones((len(score), 1)), p, np.zeros((len(score), 1))])


def _climb(place: np.ndarray, x: np.ndarray, square: np.ndarray, used: int, steps: int):
    """A task's gradient steps over its rows, from weights and thresholds ``x``: (rows, x, square) afterwards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        t = pa.Table.from_batches(parts).combine_chunks()
        f, y = t.column("f").chunk(0), t.column("grade").to_numpy().astype(np.int64)
        row, at, v = np.repeat(np.arange(len(y)), np.diff(f.offsets.to_numpy())), place[f.flatten().to_numpy()], t.column("v").chunk(0).flatten().to_numpy()
        row, at, v = row[at >= 0], at[at >= 0], v[at >= 0]
        own, squares, i, k = x.copy(), square.copy(), np.arange(len(y)), len(x) - used
        for _ in range(steps):
            p = tails(np.bincount(row, own[at] * v, minlength=len(y)), own[used:])
            slope, of = p * (1 - p), np.maximum(p[i, y] - p[i, y + 1], 1e-9)
            up, down = slope[i, y] / of, slope[i, y + 1] / of
            links = np.bincount(y + 1, down, minlength=k + 2) - np.bincount(y, up, minlength=k + 2)
            g = np.concatenate([np.bincount(at, (up - down)[row] * v, minlength=used), links[1 : k + 1]]) / len(y)
            g[:used] -= RIDGE * own[:used]
            squares += g * g
            own += RATE * g / np.sqrt(squares + 1e-12)
            own[used:] = np.maximum.accumulate(own[used:])
        yield pa.RecordBatch.from_pydict({"n": [len(y)], "x": [own], "square": [squares]}, pa.schema([("n", pa.int64()), ("x", pa.list_(pa.float64())), ("square", pa.list_(pa.float64()))]))
    return run


def fit(labelled: DataFrame, grades: int = GRADES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(weight of every hashed feature, thresholds) from (id, text, grade) rows."""
    rows = cut(labelled.mapInArrow(_featured, "grade long, f array<long>, v array<double>").repartition(LEARNERS), "features")
    thresholds, n = np.linspace(-2, 0, grades - 1), rows.count()
    held = rows.select(F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("n")).filter(F.col("n") >= max(3, n / ONE_IN)).collect()
    used = np.array(sorted(r["f"] for r in held), np.int64)  # of DIMENSIONS at most
    place = np.full(DIMENSIONS, -1, np.int64)
    place[used] = np.arange(len(used))
    x = np.concatenate([np.zeros(len(used)), thresholds])
    square = np.zeros_like(x)
    for _ in range(rounds if n else 0):
        got = rows.mapInArrow(_climb(place, x, square, len(used), STEPS), "n long, x array<double>, square array<double>").collect()
        x, square = (np.average([r[c] for r in got], axis=0, weights=[r["n"] for r in got]) for c in ("x", "square"))
    weights = np.zeros(DIMENSIONS)
    weights[used] = x[: len(used)]
    return weights, x[len(used) :]


def _graded(weights: np.ndarray, thresholds: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(0x9E3779B97F4A7C15)
        for ids, bounds, data in text_chunks(batches):
            p = tails(np.array([float(weights[f] @ v) for f, v in text_features(bounds, data, powers)]), thresholds)[:, 1:-1]
            yield pa.RecordBatch.from_arrays([ids, pa.array(p.sum(1)), pa.array(list(p), pa.list_(pa.float64()))], names=["doc_id", "expected_grade", "tails"])
    return run


def grade(docs: DataFrame, labels: DataFrame, rating: str, id_col: str = "doc_id", text_col: str = "text", grades: int = GRADES, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, expected_grade, tails`` (P(grade >= k), k from 1 to grades - 1).

    ``rating`` is an SQL expression over ``labels`` giving a grade from 0 to grades - 1; rows where it is null or
    out of range, or whose id is null or not in ``docs``, teach nothing; one that repeats teaches as often. Of more than
    ``sample`` labels a share chosen by a hash of the id is used. A null, empty or wordless text scores 0, so its tails
    follow from the thresholds; without labels every text does. Long texts are read whole; extra columns are not
    read; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    own = labels.select(F.col(id_col).alias("doc_id"), F.expr(rating).cast("long").alias("grade")).filter((F.col("grade") >= 0) & (F.col("grade") < grades))
    share = min(1.0, sample / max(1, own.count()))
    own = cut(own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))), "labels")
    weights, thresholds = fit(docs.join(bounded(own), "doc_id").select("doc_id", "text", "grade"), grades)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_graded(weights, thresholds), f"doc_id {id_type}, expected_grade double, tails array<double>")
