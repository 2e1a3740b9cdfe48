"""Packing with little padding, as a cutting-stock problem solved by column generation on the length histogram.

A document longer than a sequence gives full sequences and a rest; rests and shorter documents are items. The driver
sees the histogram of item lengths (at most ``capacity`` numbers), groups it into classes, and solves the linear program
"how often is each pattern of classes used" with a revised simplex method; new patterns are priced by a knapsack dynamic
program. The solution is rounded, the patterns are spelled out over exact lengths as runs "so many sequences, with the
items of these lengths and ranks", and items take their places by rank within length. Sequences with most room are then
dissolved, and their items are cut to fill the others exactly; what is left over at last makes sequences whose length is
a power of two. So only these few items are cut, all other sequences are full, and nothing is padded.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_chunks
from .packing import best_fit
from .word_bpe import kept

CAPACITY = 4096
END = 2
TOKENIZER = "word_bpe_49k"
#: Rows of the linear program; longer histograms are grouped, the longest item standing for its class.
CLASSES = 160
#: Column generation ends when the program is proven to be this close to its optimum, or after so many steps a row.
CLOSE, STEPS = 1e-3, 4
#: Share of the best bound's values in the values that patterns are priced at.
SMOOTH = 0.5

Pattern = tuple[tuple[int, int], ...]  # (class, items) pairs


# the linear program

def classes(counts: dict[int, int], limit: int = CLASSES) -> list[int]:
    """The largest length of each class, falling; at most ``limit`` classes of about equal loss (their items' shortfall)."""
    lengths = sorted(counts, reverse=True)
    if len(lengths) <= limit:
        return lengths

    def grouped(loss: float) -> list[int]:
        out, held = [], 0.0
        for length in lengths:
            held += counts[length] * (out[-1] - length) if out else 0
            if not out or held > loss:
                out.append(length)
                held = 0.0
        return out

    low, high = 0.0, float(sum(counts.values())) * lengths[0]
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if len(grouped(mid)) > limit else (low, mid)
    return grouped(high)


def priced(values: np.ndarray, sizes: list[int], capacity: int) -> tuple[float, np.ndarray]:
    """(value, items of each class) of the pattern of most value within ``capacity`` tokens.

    Unbounded knapsack: ``best[c]`` is the most value of at most c tokens, ``took`` and ``many`` the class put in last and
    how often; 1, 2, 4, ... more items of a class at a time reach every number of them.
    """
    best, took, many = np.zeros(capacity + 1), np.full(capacity + 1, -1), np.zeros(capacity + 1, np.int64)
    for k, (size, value) in enumerate(zip(sizes, values)):
        n = 1
        while value > 0 and n * size <= capacity:
            new = best[: capacity + 1 - n * size] + n * value
            better = np.flatnonzero(new > best[n * size :] + 1e-12)
            at = better + n * size
            best[at], took[at], many[at] = new[better], k, n
            n *= 2
    items, room = np.zeros(len(sizes)), capacity
    while took[room] >= 0:
        k, n = took[room], many[room]
        items[k] += n
        room -= sizes[k] * n
    return float(best[capacity]), items


def solve(demand: np.ndarray, sizes: list[int], capacity: int) -> list[tuple[Pattern, float]]:
    """(pattern, uses) of a solution of the linear program: fewest sequences that hold ``demand`` exactly.

    Revised simplex from patterns of one class each, so that every step has a whole solution. Patterns are priced at a
    mean of the duals and of the feasible duals that gave the best bound, which keeps the former from swinging; the mean
    is given up in steps where the pattern found doesn't improve the program.
    """
    m = len(sizes)
    columns = np.diag([float(capacity // size) for size in sizes])
    inverse = np.linalg.inv(columns)
    x = inverse @ demand
    centre = np.array(sizes, float) / capacity  # worth 1 for a full sequence: a bound by tokens
    bound = float(centre @ demand)
    for step in range(STEPS * m):
        if x.sum() <= bound * (1 + CLOSE):
            break
        if step % 50 == 49:  # rounding is not carried on
            inverse = np.linalg.inv(columns)
            x = np.maximum(inverse @ demand, 0)
        duals = inverse.sum(0)
        for share in (SMOOTH, 0.0):
            values = share * centre + (1 - share) * duals
            worth, column = priced(values, sizes, capacity)
            if worth > 0 and values @ demand / worth > bound:
                centre, bound = values / worth, float(values @ demand / worth)
            if duals @ column > 1 + 1e-9:
                break
        else:
            break  # no pattern improves the program
        change = inverse @ column
        rising = change > 1e-9
        ratio = np.where(rising, x / np.where(rising, change, 1), np.inf)
        out = int(np.argmin(ratio))
        pivot = inverse[out] / change[out]
        inverse = inverse - np.outer(change, pivot)
        inverse[out] = pivot
        x = np.maximum(x - ratio[out] * change, 0)
        x[out] = ratio[out]
        columns[:, out] = column
    return [(tuple((int(k), int(c[k])) for k in np.flatnonzero(c)), float(n)) for c, n in zip(columns.T, x) if n > 1e-9]


def rounded(solution: list[tuple[Pattern, float]], demand: np.ndarray, sizes: list[int], capacity: int) -> list[tuple[Pattern, int]]:
    """Whole uses of patterns that hold ``demand`` exactly: rounded down, then up where items are left, then best fit."""
    left, uses = [int(n) for n in demand], []

    def use(pattern: Pattern, n: int) -> None:
        n = min([n, *(left[k] // a for k, a in pattern)])
        if n > 0:
            uses.append((pattern, n))
            for k, a in pattern:
                left[k] -= a * n

    for pattern, n in solution:
        use(pattern, int(n + 1e-6))
    for pattern, n in sorted(solution, key=lambda s: s[1] - int(s[1] + 1e-6), reverse=True):
        use(pattern, 1)
    rest: dict[int, list] = defaultdict(list)  # a few items a class
    for length, a, b, first, _ in best_fit({sizes[k]: n for k, n in enumerate(left) if n}, capacity):
        for i in range(b - a):
            rest[first + i].append(sizes.index(length))
    for items in rest.values():
        use(tuple(sorted(Counter(items).items())), 1)
    return uses


# the plan: runs over exact lengths and ranks

class Plan:
    """Where the item of any length and rank goes. Its size follows the distinct lengths, not the items.

    ``places[length]``: runs (first rank, items, first sequence, offset); a run of dissolved items has sequence -1 and
    the place of its first token on the tape of cut items as offset. ``tape``: runs (place on the tape, room of each
    sequence, sequences, first sequence, offset there).
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, limit: int = CLASSES):
        sizes = classes(counts, limit)
        of, queues = {}, [[] for _ in sizes]
        for length in sorted(counts):
            of[length] = next(k for k in range(len(sizes) - 1, -1, -1) if sizes[k] >= length)
            queues[of[length]].append([length, 0, counts[length]])
        demand = np.array([sum(n for _, _, n in q) for q in queues], np.int64)
        uses = rounded(solve(demand, sizes, capacity), demand, sizes, capacity) if sizes else []
        runs = [run for pattern, n in uses for run in self._spelled(pattern, n, queues)]
        self.places: dict[int, list] = defaultdict(list)
        self.tape: list[tuple[int, int, int, int, int]] = []
        self._number(runs, capacity)
        for own in self.places.values():
            own.sort()
        self.starts = {length: [r[0] for r in own] for length, own in self.places.items()}
        self.tape_starts = [t[0] for t in self.tape]

    @staticmethod
    def _spelled(pattern: Pattern, n: int, queues: list[list]) -> Iterator[tuple[int, list]]:
        """Runs (sequences, [(length, first rank) of each item]) of n uses of a pattern."""
        slots = []
        for k, a in pattern:
            for _ in range(a):
                own, need = [], n
                while need:
                    length, rank, have = head = queues[k][0]
                    take = min(have, need)
                    own.append([length, rank, take])
                    head[1], head[2] = rank + take, have - take
                    need -= take
                    if not head[2]:
                        queues[k].pop(0)
                slots.append(own)
        while slots and slots[0]:
            step = min(own[0][2] for own in slots)
            yield step, [(own[0][0], own[0][1]) for own in slots]
            for own in slots:
                own[0][1] += step
                own[0][2] -= step
                if not own[0][2]:
                    own.pop(0)

    def _number(self, runs: list[tuple[int, list]], capacity: int) -> None:
        runs = sorted(((capacity - sum(length for length, _ in items), n, items) for n, items in runs), key=lambda r: r[0])
        space, have, dissolved = sum(room * n for room, n, _ in runs), 0, []
        while have < space:  # the run with most room gives its items to be cut
            room, n, items = runs.pop()
            k = min(n, -(-(space - have) // capacity))
            have, space = have + k * (capacity - room), space - k * room
            dissolved.append((k, [(length, rank + n - k) for length, rank in items]))
            if k < n:
                runs.append((room, n - k, items))
        sequence = place = 0
        for room, n, items in runs:
            offset = 0
            for length, rank in items:
                self.places[length].append((rank, n, sequence, offset))
                offset += length
            if room:
                self.tape.append((place, room, n, sequence, offset))
                place += room * n
            sequence += n
        rest, tokens = have - place, 0
        for end in [capacity, *(1 << i for i in range(capacity.bit_length(), -1, -1) if 1 << i < capacity)]:
            if n := rest // end:
                self.tape.append((place, end, n, sequence, 0))
                place, sequence, rest = place + n * end, sequence + n, rest - n * end
        for k, items in dissolved:
            for length, rank in items:
                self.places[length].append((rank, k, -1, tokens))
                tokens += length * k
        self.sequences = sequence

    def whole(self, length: int, rank: int) -> tuple[int, int]:
        """(sequence, offset) of an item, or (-1, place on the tape) of one that is cut."""
        first, _, sequence, at = self.places[length][bisect_right(self.starts[length], rank) - 1]
        return (-1, at + (rank - first) * length) if sequence < 0 else (sequence + rank - first, at)

    def pieces(self, at: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the pieces of the ``length`` tokens from place ``at`` of the tape on."""
        done = 0
        while done < length:
            first, room, _, sequence, offset = self.tape[bisect_right(self.tape_starts, at + done) - 1]
            k, inside = divmod(at + done - first, room)
            take = min(room - inside, length - done)
            yield done, take, sequence + k, offset + inside
            done += take

    def cut_ranks(self) -> list[tuple[int, int, int]]:
        """(length, first rank, end rank) of the items that are cut."""
        return [(length, rank, rank + n) for length, own in self.places.items() for rank, n, sequence, _ in own if sequence < 0]


# the tasks

ITEM = "start long, length long, ids_crc32 long, doc_tokens long, rank long"


def _items(capacity: int, tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, ranks, end = kept(tokenizer), TaskContext.get().partitionId(), defaultdict(int), np.array([END], "<u4").tobytes()
        for ids, bounds, data in text_chunks(batches):
            data, take, cols = data.tobytes(), [], defaultdict(list)
            for i in range(len(ids)):
                tokens = bpe.ids(data[bounds[i] : bounds[i + 1]].decode()) + end
                total = len(tokens) // 4
                for start in range(0, total, capacity):
                    own = tokens[4 * start : 4 * (start + capacity)]
                    length = len(own) // 4
                    take.append(i)
                    for name, value in (("start", start), ("length", length), ("ids_crc32", zlib.crc32(own)), ("doc_tokens", total), ("rank", ranks[length])):
                        cols[name].append(value)
                    cols["ids"].append(own)
                    ranks[length] += 1
            out = [ids.take(pa.array(take, pa.int64())), pa.array([part] * len(take), pa.int32())]
            out += [pa.array(cols[c], pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "rank")] + [pa.array(cols["ids"], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "part", "start", "length", "ids_crc32", "doc_tokens", "rank", "ids"])
    return run


def _placed(plan: Plan):
    """The items that stay whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            at = np.array([plan.whole(n, r) for n, r in zip(t.column("length").to_pylist(), t.column("rank").to_pylist())], np.int64).reshape(-1, 2)
            whole = pa.array(at[:, 0] >= 0)
            out = t.drop_columns("rank").append_column("sequence_id", pa.array(at[:, 0])).append_column("offset", pa.array(at[:, 1]))
            yield out.filter(whole)
    return run


def _cut_up(plan: Plan, names: list[str]):
    """The pieces of the items that are cut; the ids come last and are cut with them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            take, cols = [], defaultdict(list)
            for i, (start, length, rank, ids) in enumerate(zip(*(t.column(c).to_pylist() for c in ("start", "length", "rank", "ids")))):
                for a, n, sequence, offset in plan.pieces(plan.whole(length, rank)[1], length):
                    own = ids[4 * a : 4 * (a + n)]
                    take.append(i)
                    for name, value in (("start", start + a), ("length", n), ("ids_crc32", zlib.crc32(own)), ("sequence_id", sequence), ("offset", offset), ("ids", own)):
                        cols[name].append(value)
            place = pa.array(take, pa.int64())
            made = {c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in cols.items()}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else t.column(c).take(place) for c in names], names=names)
    return run


def pack_tightly(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER,
                 with_ids: bool = True, limit: int = CLASSES) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``, little-endian
    unsigned 32-bit).

    A document is its token ids, then one end id. One of more than ``capacity`` tokens is cut into full sequences and a
    rest; few others are cut (see above). Each sequence is full or holds a power of two of tokens. A null or empty text
    is the end id alone. Repeated rows and null ids are packed like any other row; extra columns are not read; an empty
    table gives an empty result. ``tokenizer`` names a public vocabulary with word ends or gives the path of one without its
    suffix. What is sent to the tasks depends on the distinct lengths alone, at most ``capacity`` of them.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    items = cut(docs.mapInArrow(_items(capacity, tokenizer), f"doc_id {id_type}, part int, {ITEM}, ids binary"), "items")
    parts = cut(items.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    plan = Plan({r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity, limit)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = items.join(parts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    fields = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
    whole = ranked.select(*names[:5], *names[7:], "rank").mapInArrow(_placed(plan), fields + ", ids binary" * with_ids + ", sequence_id long, offset long")
    spark = docs.sparkSession
    cuts = F.broadcast(spark.createDataFrame(plan.cut_ranks(), "length long, first long, stop long"))  # as many rows as runs at most
    chosen = ranked.join(cuts, "length").filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop")))
    small = chosen.select(*names[:5], "ids", "rank").mapInArrow(_cut_up(plan, names), fields + ", sequence_id long, offset long" + ", ids binary" * with_ids)
    return whole.select(*names).unionByName(small)
