"""Log probability of texts under a hashed maximum-entropy model.

Tokens are lower-case words and one end per text. A token's probability is that of its class given the
context, times that of the word in its class. The ``HEAD`` most frequent words sit in classes of ``WIDTH`` words; all others
are classed by a hash of their ending, and there each word of at least ``LEAST`` occurrences is a leaf of a tree of softmaxes of
``WIDTH`` slots, as deep as the class has words. The rarer words of a class share one leaf, in which a word with training count c has
(c + 1) / (T + 1), T being the sum of c + 1 over them, and an unseen word 1 / (T + 1). All softmaxes are linear in the same
hashed features of the context: the word before, the one before that (skip), the two together, the last ending, and the two endings before that. They start at the words' shares.

Training counts cover every training text. The weights come from distributed gradient updates in ``ROUNDS`` rounds, each over
a hash share of the texts: each task runs minibatch steps over its texts from the last round's weights, and the tasks' weights are
averaged block by block. A round has a task for so many tokens (``TASK_TOKENS``), however the input is split.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, ByteHash, Powers, cut, first_of_pairs, mix, text_chunks, words

#: Most frequent words, in classes of so many; also the slots of a softmax in a class.
HEAD, WIDTH = 256, 16
#: Classes of all other words, by their last two bytes.
ENDINGS = 48
CLASSES = HEAD // WIDTH + ENDINGS
#: Every word of at least so many occurrences has a softmax in its class.
LEAST = 100
#: Least rows of the hashed class weights, and of the word weights for each head class; with the words they grow to MOST_ROWS, which bound a task's memory.
ROWS, HEAD_ROWS = 1 << 14, 1 << 12
MOST_ROWS = (1 << 16, 1 << 18)
#: The templates that words within a class have: all five.
NEAR = [0, 1, 2, 3, 4]
#: So many words' counts, and those of at least LEAST, travel to every task; the counts of rarer ones are joined by a shuffle.
KNOWN = 200_000
BATCH, RATE = 4096, 0.25
BLOCKS, ROUNDS = 32, 4
#: Runs of more rows with one feature are added up by themselves.
LONG = 8
#: Training tokens for each task of a round, whose weights travel once: they grow with the input, not with its splits; a few tasks in any case.
TASK_TOKENS, FEW_TASKS = 20_000_000, 8
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


class Tokens:
    """Token hashes and ending classes of a chunk's rows; ``first`` is where each row's tokens begin (and the total)."""

    def __init__(self, bounds: np.ndarray, data: np.ndarray, powers: Powers):
        data = LOWER[data]
        start, end, at = words(data, bounds)
        rows = len(bounds) - 1
        self.first = at + np.arange(rows + 1)
        place = np.arange(len(start)) + np.repeat(np.arange(rows), np.diff(at))
        self.hash = np.full(len(start) + rows, END, np.uint64)
        self.ending = np.zeros(len(self.hash), np.int64)
        if len(start):
            self.hash[place] = ByteHash(data, powers).ranges(start, end)
            last, before = data[end - 1].astype(np.uint64), np.where(end - start > 1, data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
            self.ending[place] = (mix(last | before << np.uint64(8), 11) % np.uint64(ENDINGS)).astype(np.int64)
        self.row = np.repeat(np.arange(rows), np.diff(self.first))

    def found(self, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each token's hash in a sorted list, whether it is there); each distinct hash is looked up once, in order."""
        if not hasattr(self, "distinct"):
            self.distinct, self.which = np.unique(self.hash, return_inverse=True)
        at = np.minimum(np.searchsorted(among, self.distinct), max(len(among) - 1, 0))
        have = among[at] == self.distinct if len(among) else np.zeros(len(at), bool)
        return at[self.which], have[self.which]

    def back(self, a: np.ndarray, steps: int, outside: np.generic) -> np.ndarray:
        """The value ``steps`` tokens earlier in the same row."""
        out = np.full_like(a, outside)
        out[steps:] = a[: len(a) - steps]
        out[np.arange(len(a)) - self.first[self.row] < steps] = outside
        return out

    def features(self) -> np.ndarray:
        """Hashes of the context features: one row for each template."""
        one, two = self.back(self.hash, 1, START), self.back(self.hash, 2, START)
        e = [self.back(self.ending, i, ENDINGS).astype(np.uint64) for i in (1, 2, 3)]
        with np.errstate(over="ignore"):
            return np.stack([mix(one, 21), mix(two, 22), mix(one * np.uint64(3) + two, 23), mix(e[0], 24), mix(e[1] * np.uint64(64) + e[2], 25)])


def _log_share(mass: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Log of each slot's share of its row; slots that no word has are out."""
    mass = np.where(live, mass + 1.0, 0)
    return np.where(live, np.log(np.maximum(mass, 1) / np.maximum(mass.sum(-1, keepdims=True), 1)), -1e9).astype(np.float32)


def _rows(least: int, wanted: float, most: int) -> int:
    while least < min(wanted, most):
        least *= 2
    return least


class Model:
    """Weights and the classes they speak of.

    head: hashes of the words with a softmax, by falling count, with their ``ending`` classes and counts; mass: by ending class, the
    sums of c and of c + 1 over all other words.
    """

    def __init__(self, head: np.ndarray, ending: np.ndarray, count: np.ndarray, mass: np.ndarray):
        self.order = np.argsort(head)
        self.head = head[self.order]  # sorted hashes of the frequent words
        self.share = np.log10(mass[1] + 1.0)
        # leaf 0 of an ending class is its rare words, the others are its words by falling count
        deep, self.place = ending[HEAD:], np.zeros(len(head), np.int64)
        self.size = np.bincount(deep, minlength=ENDINGS)
        by = np.argsort(deep, kind="stable")
        self.place[HEAD + by] = 1 + np.arange(len(by)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.depth = 0
        while len(deep) and WIDTH**self.depth <= self.size.max():
            self.depth += 1
        tops = HEAD // WIDTH
        first, near = tops, np.zeros(HEAD)
        near[: len(count)] = count[:HEAD]
        slots = np.arange(HEAD).reshape(-1, WIDTH) < len(head)
        biases, self.base = [_log_share(near.reshape(-1, WIDTH), slots)], []
        for level in range(self.depth):
            span = WIDTH ** (self.depth - level - 1)  # leaves below a slot
            nodes = self.size // (span * WIDTH) + 1
            self.base.append(first + np.cumsum(nodes) - nodes)
            at = (np.concatenate([self.base[-1][deep], self.base[-1]]) - first) * WIDTH + np.concatenate([self.place[HEAD:], np.zeros(ENDINGS, np.int64)]) // span
            weight = np.bincount(at, np.concatenate([count[HEAD:], mass[0]]), minlength=nodes.sum() * WIDTH)
            live = np.arange(nodes.sum() * WIDTH) - np.repeat(self.base[-1] - first, nodes * WIDTH) * WIDTH
            live = live * span <= np.repeat(self.size, nodes * WIDTH)
            biases.append(_log_share(weight.reshape(-1, WIDTH), live.reshape(-1, WIDTH)))
            first += nodes.sum()
        self.word_bias = np.concatenate(biases)
        classes = np.concatenate([near.reshape(-1, WIDTH).sum(1), np.bincount(deep, count[HEAD:], minlength=ENDINGS) + mass[0]])
        self.bias = _log_share(classes, np.concatenate([slots.any(1), np.ones(ENDINGS, bool)]))
        self.weights = np.zeros((_rows(ROWS, len(head) / 2, MOST_ROWS[0]), CLASSES), np.float32)
        self.word_weights = np.zeros((_rows(HEAD_ROWS * tops, len(head) * 4, MOST_ROWS[1]), WIDTH), np.float32)
        self.square, self.word_square = np.zeros(len(self.weights), np.float32), np.zeros(len(self.word_weights), np.float32)

    def parts(self) -> dict[str, np.ndarray]:
        return {k: getattr(self, k) for k in ("bias", "weights", "square", "word_bias", "word_weights", "word_square")}

    def targets(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """(class, rank or -1 for words without a softmax) of each token."""
        at, have = t.found(self.head)
        rank = np.where(have, self.order[at], -1)
        return np.where((rank >= 0) & (rank < HEAD), rank // WIDTH, HEAD // WIDTH + t.ending), rank

    def path(self, cls: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token, softmax within its class, slot there) for every softmax on the way to each token."""
        top = np.flatnonzero(cls < HEAD // WIDTH)
        token, node, slot = [top], [cls[top]], [rank[top] % WIDTH]
        if self.depth:
            rest = np.flatnonzero(cls >= HEAD // WIDTH)
            place, ending = np.where(rank[rest] >= 0, self.place[rank[rest]], 0), cls[rest] - HEAD // WIDTH
            for level, base in enumerate(self.base):
                span = WIDTH ** (self.depth - level - 1)
                token.append(rest)
                node.append(base[ending] + place // (span * WIDTH))
                slot.append(place // span % WIDTH)
        return np.concatenate(token), np.concatenate(node), np.concatenate(slot)


def softmax(rows: np.ndarray, bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    logits = weights.take(rows[0], axis=0) + bias
    for r in rows[1:]:
        logits += weights.take(r, axis=0)
    np.minimum(logits, 60, out=logits)  # exp stays finite
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[1], np.float32))[:, None]
    return logits


def _runs(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order that sorts r; where each run of one value begins in it, its length and its value, the longest runs first)."""
    key = r.astype(np.int64) << 20 | np.arange(len(r))  # one sort of plain numbers; a batch has fewer than 2**20 rows
    key.sort()
    value = key >> 20
    at = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.append(at, len(r)))
    by = np.argsort(255 - np.minimum(size, 255).astype(np.uint8), kind="stable")
    return key & ((1 << 20) - 1), at[by], size[by], value[at[by]]


def _summed(g: np.ndarray, order: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The rows of g added up by run: those after the first one by one and for all runs at once, then the first; the few long runs by themselves.

    Each sum is rounded like ``np.add.reduceat``'s, which takes a step for every run and column.
    """
    out = g.take(order.take(at), axis=0)
    upto = np.cumsum(np.bincount(np.minimum(size, LONG + 1), minlength=LONG + 2)[::-1])[::-1].tolist()  # runs of at least so many rows
    long = upto[LONG + 1]
    if long:
        n = size[:long]
        first = np.cumsum(n) - n
        place = np.repeat(at[:long] - first, n)
        place += np.arange(len(place))
        out[:long] = np.add.reduceat(g.take(order.take(place), axis=0), first, axis=0)
    if upto[2] > long:
        rest = g.take(order.take(at[long : upto[2]] + 1), axis=0)
        for j in range(2, LONG):
            if upto[j + 1] == long:
                break
            rest[: upto[j + 1] - long] += g.take(order.take(at[long : upto[j + 1]] + j), axis=0)
        out[long : upto[2]] += rest
    return out


def _put(rows: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """rows[at] = values, each row copied as one item."""
    whole = np.dtype((np.void, rows.itemsize * rows.shape[1]))
    np.put(rows.view(whole).reshape(-1), at, values.view(whole).reshape(-1))


def step(rows: np.ndarray, target: np.ndarray, bias: np.ndarray, weights: np.ndarray, square: np.ndarray, own_bias: np.ndarray | None = None) -> None:
    """One minibatch update; a row's rate falls with the squares of its gradients. own_bias: which bias row each example uses."""
    g, n = softmax(rows, bias if own_bias is None else bias[own_bias], weights), len(target)
    g[np.arange(n), target] -= 1
    if own_bias is None:
        bias -= RATE * g.mean(0)
    else:
        order, at, size, hit = _runs(own_bias)
        bias[hit] -= RATE / n * _summed(g, order, at, size)
    for r in rows:
        order, at, size, hit = _runs(r)
        summed = _summed(g, order, at, size)
        squares = square[hit] + np.einsum("ij,ij->i", summed, summed) / summed.shape[1]
        square[hit] = squares
        summed *= (RATE / np.sqrt(squares + 1))[:, None]
        _put(weights, hit, weights.take(hit, axis=0) - summed)


def word_rows(f: np.ndarray, node: np.ndarray, rows: int = HEAD_ROWS * (HEAD // WIDTH)) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((f ^ (node.astype(np.uint64) * END)) * START) >> np.uint64(65 - rows.bit_length())).astype(np.uint32)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word hash, ending class, count) of a task's texts, added up a few chunks at a time."""
    powers, held, size = Powers(0x9E3779B97F4A7C15), [], 0

    def added() -> pa.RecordBatch:
        h, e, n = (np.concatenate(x) for x in zip(*held))
        u, at, inv = np.unique(h, return_index=True, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(e[at]), pa.array(np.bincount(inv, n).astype(np.int64))], names=["h", "ending", "c"])

    for _, bounds, data in text_chunks(batches):
        t = Tokens(bounds, data, powers)
        u, at, n = np.unique(t.hash, return_index=True, return_counts=True)
        held.append((u, t.ending[at], n))
        size += len(u)
        if size > 1_000_000:
            b = added()
            held, size = [(b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy(), b.column(2).to_numpy())], len(b)
            if size > 500_000:
                yield b
                held, size = [], 0
    if held:
        yield added()


def _train(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen = Powers(0x9E3779B97F4A7C15), 0
        own = {k: v.copy() for k, v in model.parts().items()}
        for _, bounds, data in text_chunks(batches):
            t = Tokens(bounds, data, powers)
            f, (cls, rank) = t.features(), model.targets(t)
            rows = (f % np.uint64(len(model.weights))).astype(np.uint32)
            for a in range(0, len(cls), BATCH):
                s = slice(a, a + BATCH)
                step(rows[:, s], cls[s], own["bias"], own["weights"], own["square"])
                token, node, slot = model.path(cls[s], rank[s])
                if len(token):
                    step(word_rows(f[:, s].take(token, axis=1), node, len(model.word_weights)), slot, own["word_bias"], own["word_weights"], own["word_square"], node)
            seen += len(cls)
        if seen:
            task = TaskContext.get().partitionId()
            for name, a in own.items():
                for i, part in enumerate(np.array_split(a.ravel(), BLOCKS if a.size > 10_000 else 1)):
                    yield pa.RecordBatch.from_pydict({"part": [name], "block": [i], "task": [task], "n": [float(seen)], "w": [part.tobytes()]}, BLOCK_SCHEMA)
    return run


BLOCK_SCHEMA = pa.schema([("part", pa.string()), ("block", pa.int32()), ("task", pa.int32()), ("n", pa.float64()), ("w", pa.binary())])


def _mean(t: pa.Table) -> pa.Table:
    """Average of one block's weights, by the tokens each was trained on."""
    n = t.column("n").to_numpy()
    w = sum(np.frombuffer(x.as_buffer(), np.float32) * np.float32(k / n.sum()) for x, k in zip(t.column("w"), n))
    return pa.Table.from_pydict({"part": t.column("part")[:1], "block": t.column("block")[:1], "task": pa.array([t.column("task")[0].as_py() // 32], pa.int32()),
                                 "n": [float(n.sum())], "w": [w.astype(np.float32).tobytes()]}, BLOCK_SCHEMA)


def fit(train: DataFrame) -> tuple[DataFrame, tuple[int, int], Model, tuple[np.ndarray, np.ndarray]]:
    """(counts of every training word, (tokens, distinct), model, (frequent words, their counts)) from an (id, text) table."""
    counts = cut(train.mapInArrow(_counts, "h long, ending long, c long").groupBy("h").agg(F.max("ending").alias("ending"), F.sum("c").alias("c")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # the least count of the words that travel: from a histogram over powers of 2 ** (1 / 16), a few hundred rows
    level, least, left = F.floor(F.log2("c") * 16), None, KNOWN
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        least = r["level"]
    travels = F.col("c") >= LEAST if least is None else (F.col("c") >= LEAST) | (level >= least)
    known = counts.filter(travels).select("h", "ending", "c").toPandas()
    end = int(END.view(np.int64))
    top = known[known["h"] != end].sort_values(["c", "h"], ascending=[False, True])
    top = top[: max(HEAD - 1, int((top["c"] >= LEAST).sum()))]
    mass = np.zeros((2, ENDINGS), np.int64)
    for r in counts.filter(F.col("h") != end).groupBy("ending").agg(F.sum("c").alias("c"), F.sum(F.col("c") + 1).alias("t")).collect():
        mass[:, r["ending"]] = r["c"], r["t"]
    top_ending, top_count = top["ending"].to_numpy(np.int64), top["c"].to_numpy(np.int64)
    for i in (0, 1):
        np.subtract.at(mass[i], top_ending, top_count + i)
    ends = int(known["c"][known["h"] == end].sum())
    model = Model(np.concatenate([[end], top["h"].to_numpy(np.int64)]).astype(np.int64).view(np.uint64), np.append(0, top_ending), np.append(ends, top_count), mass)
    schema = "part string, block int, task int, n double, w binary"
    tasks = max(FEW_TASKS, math.ceil(total / TASK_TOKENS))
    for n in range(ROUNDS):
        part = train.filter(F.pmod(F.xxhash64(*train.columns), F.lit(ROUNDS)) == n).coalesce(tasks)
        blocks = part.mapInArrow(_train(model), schema)
        if tasks > 32:  # in two steps, so that no group is large
            blocks = blocks.groupBy("part", "block", F.expr("task div 32")).applyInArrow(_mean, schema)
        blocks = blocks.groupBy("part", "block").applyInArrow(_mean, schema).collect()
        for name, a in model.parts().items():
            got = sorted((r["block"], bytes(r["w"])) for r in blocks if r["part"] == name)
            if got:
                setattr(model, name, np.frombuffer(b"".join(w for _, w in got), np.float32).reshape(a.shape))
    model.square = model.word_square = np.empty(0, np.float32)  # not needed to score
    known = known.sort_values("h", key=lambda h: h.to_numpy(np.int64).view(np.uint64))
    return counts, (total, distinct), model, (known["h"].to_numpy(np.int64).view(np.uint64), known["c"].to_numpy(np.float64))


def _score(model: Model, known: np.ndarray, c: np.ndarray, base: float):
    """Row 0 of each text: its sums so far; further rows: its words whose counts are elsewhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, task, seen, log_c = Powers(0x9E3779B97F4A7C15), TaskContext.get().partitionId() << 40, 0, np.log10(c + 1.0)
        for ids, bounds, data in text_chunks(batches):
            t = Tokens(bounds, data, powers)
            f, (cls, rank) = t.features(), model.targets(t)
            logp = np.empty(len(cls))
            rows = (f % np.uint64(len(model.weights))).astype(np.uint32)
            for a in range(0, len(cls), BATCH):
                s = slice(a, a + BATCH)
                p = softmax(rows[:, s], model.bias, model.weights)
                logp[s] = np.log10(np.maximum(p[np.arange(len(p)), cls[s]], 1e-30))
                token, node, slot = model.path(cls[s], rank[s])
                if len(token):
                    p = softmax(word_rows(f[:, s].take(token, axis=1), node, len(model.word_weights)), model.word_bias[node], model.word_weights)
                    logp[s] += np.bincount(token, np.log10(np.maximum(p[np.arange(len(p)), slot], 1e-30)), minlength=len(logp[s]))
            other = np.flatnonzero(rank < 0)
            logp[other] -= model.share[t.ending[other]]
            at, have = t.found(known)
            count = np.where(have, log_c[at] if len(known) else 0, 0)
            sums = [np.add.reduceat(x, t.first[:-1]) for x in (have & (c[at] > 0) if len(known) else have.astype(np.int64), count - base, logp + np.where(rank >= 0, 0, count))]
            n, row = len(ids), task + seen + np.arange(len(ids))
            seen += n
            rare = np.flatnonzero(~have)
            at, tf = first_of_pairs(t.row[rare], t.hash[rare])
            rare = rare[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row), ids, pa.nulls(n, pa.int64()), pa.array(np.diff(t.first)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names=SUMS)
            if len(rare):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[t.row[rare]]), pa.nulls(len(tf), ids.type), pa.array(t.hash[rare].view(np.int64)), pa.array(tf.astype(np.int64))]
                    + [pa.nulls(len(tf), x) for x in (pa.int64(), pa.float64(), pa.float64())], names=SUMS)
    return run


SUMS = ["row", "doc_id", "h", "n", "known", "base", "score"]


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``; learns where ``learn`` holds.

    ``learn`` may use doc_id and text. base_score is the sum of log10((c + 1) / (N + V + 1)) over the tokens, score the
    model's log10 probability. Null and empty texts are the end token alone; rows with a null id are scored
    like others; repeated rows get equal results; a long text is one row and read whole. Without training rows
    every base term is log10(1) = 0 and the model is uniform over its classes. Extra columns are not read. An empty table
    gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts, (total, distinct), model, (known, c) = fit(docs.filter(learn))
    run = _score(model, known, c, float(np.log10(total + distinct + 1)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = cut(docs.mapInArrow(run, f"row long, doc_id {id_type}, h long, n long, known long, base double, score double"), "scores")
    rare = found.filter("h is not null").select("row", "h", "n").join(counts.select("h", "c"), "h")
    rare = rare.groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("part"))
    more = lambda c: F.coalesce(c, F.lit(0))
    return found.filter("h is null").join(rare, "row", "left").select(
        "doc_id", F.col("n").alias("n_tokens"), (F.col("known") + more("more")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + more("part")).alias("base_score"), (F.col("score") + more("part")).alias("score"))
