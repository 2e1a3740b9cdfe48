"""Collocations by dynamic itemset counting: phrases of several lengths are counted in the same cyclic shard scans.

The texts lie in SHARDS shards. Step s scans shard (s - 1) mod SHARDS. Words are counted from step 1 on; a longer
phrase becomes active in the step after both its subphrases (all words but the last, all but the first) have reached
the least count, and is counted for the SHARDS steps that follow, that is over every text once. The scans end when
every active phrase has had its cycle. Counts are kept in a table that every step merges with its own.

What a scan must know, the step in which each phrase reached the least count, is sent to the tasks as bounded tables of
slots, one for each length: a slot holds the earliest such step of the phrases that hash to it. So a phrase starts in a
step that its own hashes determine, never later than its subphrases demand, and its count is whole in any case; a
shared slot only lets some phrases be counted that cannot reach the least count. Phrases are counted by 64-bit hashes;
each occurrence draws a mark, the least of which is kept, and a last scan spells every phrase found at the occurrences
with its least mark, so once or a few times each, however many tasks meet it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, ByteHash, Powers, bounded, cut, mix, text_chunks, words

LEAST = 100
LONGEST = 5
FIRST = 2000
SHARDS = 4
#: Slots of a length: SLOTS_A_PHRASE for each phrase that could reach the least count, 2^MOST_BITS at most.
SLOTS_A_PHRASE, FEWEST_BITS, MOST_BITS = 4, 12, 24
#: Hashes that a task holds before it merges equal ones, and merged rows that it hands over at once.
HELD, ROWS_OUT = 1 << 21, 1 << 16
NEVER = 255
BASE = 0x9E3779B97F4A7C15

#: ``[.,;:!?\x0A-\x0D]`` end a piece; these, space and tab end a word.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
BREAKS = ENDS.copy()
BREAKS[[0x20, 9]] = True


def join(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its two subphrases."""
    with np.errstate(over="ignore"):
        return mix(mix(first, 61) + last, 62)


def slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


class Chunk:
    """Words of a chunk of rows: bounds, hashes mixed with the row's language, and whether the next word follows in the same piece."""

    def __init__(self, langs: list[str], bounds: np.ndarray, data: np.ndarray, powers: Powers):
        self.data = LOWER[data]
        self.start, self.end, self.at = words(self.data, bounds, BREAKS)
        self.row = np.repeat(np.arange(len(langs)), np.diff(self.at))
        own = {g: int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "little") for g in set(langs)}
        seeds = np.array([own[g] for g in langs], np.uint64)
        with np.errstate(over="ignore"):
            self.h = mix(ByteHash(self.data, powers).ranges(self.start, self.end) + seeds[self.row], 63) if len(self.start) else np.empty(0, np.uint64)
        pieces = np.concatenate([[0], np.cumsum(ENDS[self.data])])[self.start]
        self.follows = np.zeros(len(self.start), bool)
        if len(self.start):
            self.follows[:-1] = (pieces[1:] == pieces[:-1]) & (self.row[1:] == self.row[:-1])

    def marks(self, rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A draw of 16 bits for each of the words ``at``, the same in every scan: from its row's id and its place there."""
        with np.errstate(over="ignore"):
            own = rows[self.row[at]].astype(np.uint64) * np.uint64(BASE) + (at - self.at[self.row[at]]).astype(np.uint64)
        return (mix(own, 64) >> np.uint64(48)).astype(np.int32)

    def text(self, i: int, size: int) -> str:
        return b" ".join(self.data[self.start[j] : self.end[j]].tobytes() for j in range(i, i + size)).decode()


def grams(chunk: Chunk, steps: list[np.ndarray], bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, places, hashes, starts) of the phrases whose subphrases have reached the least count; start: the later one's step.

    A subphrase's slot may hold an earlier step than its own start, so a phrase starts no sooner than its subphrases do: no
    scan before that meets it.
    """
    at, h = np.arange(len(chunk.h)), chunk.h
    start = np.zeros(len(h), np.uint8)
    yield 1, at, h, start
    for size in range(2, len(steps) + 2):
        if len(at) < 2:
            return
        t = np.maximum(steps[size - 2][slot(h, bits)], start)
        later = np.maximum(t[:-1], t[1:])
        pair = (at[1:] == at[:-1] + 1) & (later != NEVER)
        if size == 2:
            pair &= chunk.follows[at[:-1]]
        pair = np.flatnonzero(pair)
        at, h, start = at[pair], join(h[pair], h[pair + 1]), later[pair]
        yield size, at, h, start


class Steps:
    """The slots of each length that are in use, with their steps: small to send, spread out in a task."""

    def __init__(self, bits: int, lengths: int):
        self.bits, self.used = bits, [(np.empty(0, np.int64), np.empty(0, np.uint8)) for _ in range(lengths)]

    def add(self, length: int, slots: np.ndarray, step: int) -> None:
        at, t = self.used[length - 1]
        new = np.setdiff1d(slots, at)
        self.used[length - 1] = np.concatenate([at, new]), np.concatenate([t, np.full(len(new), step, np.uint8)])

    def tables(self, lengths: int | None = None) -> list[np.ndarray]:
        """The tables of the first ``lengths`` lengths, or of all."""
        out = [np.full(1 << self.bits, NEVER, np.uint8) for _ in self.used[:lengths]]
        for table, (at, t) in zip(out, self.used):
            table[at] = t
        return out


def _shards(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for b in batches:
            rows = np.arange(done, done + len(b))
            yield b.append_column("shard", pa.array((rows + part) % shards, pa.int32())).append_column("row", pa.array((part << 40) + rows))
            done += len(b)
    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], Chunk, np.ndarray]]:
    """(languages, words, ids of the rows) of consecutive rows of (lang, text, row) batches."""
    powers = Powers(BASE)
    for b in batches:
        at = 0
        for own, bounds, data in text_chunks(iter([b])):
            langs = own.to_pylist()
            yield langs, Chunk(langs, bounds, data, powers), b.column(2).slice(at, len(langs)).to_numpy()
            at += len(langs)


def _scan(steps: Steps, step: int, shards: int):
    """Counts of the phrases that are active in ``step``, with their least marks: tag = 256 * size + start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, held, size_of = steps.tables(-1), [], 0
        for _, chunk, rows in _chunks(batches):
            for size, at, h, start in grams(chunk, tables, steps.bits):
                if size == 1 and step > shards:
                    continue
                now = start + np.int64(shards) >= step
                marks = chunk.marks(rows, at[now]) if size > 1 else np.zeros(int(now.sum()), np.int32)
                held.append((h[now], (256 * size + start[now].astype(np.int32)).astype(np.uint16), marks.astype(np.uint16)))
                size_of += len(held[-1][0])
            if size_of > HELD:
                yield from merged(held)
                size_of = 0
        if size_of:
            yield from merged(held)
    return run


def merged(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    """The distinct hashes of what a task held, in batches of ROWS_OUT rows: the JVM takes each batch in one piece. Empties ``held``."""
    h, tags, marks = (np.concatenate(c) for c in zip(*held))
    held.clear()
    order = np.argsort(h)
    h, marks = h[order], marks[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    h, tags, marks = h[first], tags[order[first]], np.minimum.reduceat(marks, first)
    n = np.diff(np.append(first, len(order)))
    del order, first
    for i in range(0, len(h), ROWS_OUT):
        own = slice(i, i + ROWS_OUT)
        columns = [h[own].view(np.int64), tags[own].astype(np.int32), n[own], marks[own].astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h", "tag", "n", "mark"])


def _spelled(steps: Steps, least_marks: list[tuple[np.ndarray, np.ndarray]]):
    """(h, lang, phrase) of occurrences whose mark is within that of their slot, and (null, lang, null, words of the language).

    least_marks: for each length the sorted slots of the phrases found, and their marks."""
    schema = pa.schema([("h", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, total, seen = steps.tables(), {}, set()
        for langs, chunk, rows in _chunks(batches):
            out = []
            for g, n in zip(langs, np.diff(chunk.at).tolist()):
                total[g] = total.get(g, 0) + n
            for size, at, h, _ in grams(chunk, tables[:-1], steps.bits):
                slots, marks = least_marks[size - 1]
                if size > 1 and len(slots):
                    known = np.flatnonzero(tables[size - 1][slot(h, steps.bits)] != NEVER)  # only these slots have marks
                    place = np.minimum(np.searchsorted(slots, slot(h[known], steps.bits)), len(slots) - 1)
                    met = (slots[place] == slot(h[known], steps.bits)) & (chunk.marks(rows, at[known]) <= marks[place])
                    own = known[met]
                    for i, key in zip(at[own].tolist(), h[own].view(np.int64).tolist()):
                        if key not in seen:
                            seen.add(key)
                            out.append((key, langs[chunk.row[i]], chunk.text(i, size), None))
            if len(seen) > HELD:
                seen.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        sums = [[None] * len(total), list(total), [None] * len(total), list(total.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(sums, schema)], schema=schema)
    return run


def frequent_phrases(texts: DataFrame, least: int, longest: int, shards: int) -> DataFrame:
    """``lang, phrase, size, f`` of all phrases of 2 to ``longest`` words that occur ``least`` times in a language, of the
    words in them, and, with size 0 and a null phrase, of all words. ``texts``: ``lang`` (not null), ``text``."""
    parts = cut(texts.mapInArrow(_shards(shards), "lang string, text string, shard int, row long"), "shards", "shard")
    size = parts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    bits = min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(1 + size / 4 / least * SLOTS_A_PHRASE))))
    place = F.shiftrightunsigned("h", 64 - bits).alias("slot")
    steps, state, over, step, last = Steps(bits, longest), None, [], 0, 0
    while step < last + shards:
        step += 1
        if step >= NEVER:
            raise ValueError(f"{shards} shards and phrases of {longest} words take {NEVER} steps or more")
        shard = parts.filter(F.col("shard") == (step - 1) % shards).select("lang", "text", "row")
        found = shard.mapInArrow(_scan(steps, step, shards), "h long, tag int, n long, mark int").withColumn("t", F.lit(None).cast("int"))
        if state is not None:  # phrases whose cycle is over stay behind
            found = found.unionByName(state.filter(F.col("tag") % 256 + shards >= step))
        merged = found.groupBy("h", "tag").agg(F.sum("n").alias("n"), F.min("mark").alias("mark"), F.min("t").alias("t"))
        state = cut(merged.withColumn("t", F.when(F.col("n") >= least, F.coalesce("t", F.lit(step)))), "counts")
        over.append(state.filter(F.col("t").isNotNull() & (F.col("tag") % 256 + shards == step)))
        reached = state.filter(F.col("t") == step).select(F.shiftright("tag", 8).alias("size"), place)
        blocks = reached.groupBy("size", F.shiftright("slot", 6).alias("block")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
        for length, own in _slots(blocks.collect()):  # 2^bits / 64 rows for each length at most
            steps.add(length, own, step)
            last = step if length < longest else last
    whole = cut(reduce(DataFrame.unionByName, over).select("h", F.shiftright("tag", 8).alias("size"), F.col("n").alias("f"), "mark"), "found")
    least_marks = [(np.empty(0, np.int64), np.empty(0, np.int32))] * longest
    marks = whole.filter("size > 1").groupBy("size", place).agg(F.max("mark").alias("mark")).collect()  # a row a slot at most
    for length in {r["size"] for r in marks}:
        own = sorted((r["slot"], r["mark"]) for r in marks if r["size"] == length)
        least_marks[length - 1] = np.array([s for s, _ in own], np.int64), np.array([m for _, m in own], np.int32)
    spelled = cut(parts.select("lang", "text", "row").mapInArrow(_spelled(steps, least_marks), "h long, lang string, phrase string, n long"), "spelled")
    texts_of = spelled.filter("h is not null").groupBy("h").agg(F.min(F.struct("lang", "phrase")).alias("x")).select("h", "x.*")
    phrases = cut(texts_of.join(whole.filter("size > 1"), "h").select("lang", "phrase", "size", "f"), "phrases")
    words_in = phrases.select("lang", F.explode(F.split("phrase", " ")).alias("phrase")).distinct()
    hashed = words_in.mapInArrow(_hashed, "lang string, phrase string, h long")
    singles = hashed.join(whole.filter("size = 1"), "h").select("lang", "phrase", "size", "f")
    totals = spelled.filter("h is null").groupBy("lang").agg(F.sum("n").alias("f")).select("lang", F.lit(None).cast("string").alias("phrase"), F.lit(0).alias("size"), "f")
    return phrases.unionByName(singles).unionByName(totals)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers(BASE)
    for b in batches:
        at = 0
        for langs, bounds, data in text_chunks(iter([b])):
            h = Chunk(langs.to_pylist(), bounds, data, powers).h
            yield pa.RecordBatch.from_arrays([langs, b.column(1).slice(at, len(langs)), pa.array(h.view(np.int64))], names=["lang", "phrase", "h"])
            at += len(langs)


def _slots(blocks: list) -> Iterator[tuple[int, np.ndarray]]:
    """(length, slots) of rows (size, block of 64 slots, bits)."""
    for length in {r["size"] for r in blocks}:
        own = [r for r in blocks if r["size"] == length]
        bits = np.array([r["bits"] for r in own], "<i8").view(np.uint8).reshape(-1, 8)
        at, place = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))
        yield length, np.array([r["block"] for r in own], np.int64)[at] * 64 + place


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                 first: int = FIRST, shards: int = SHARDS) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score`` (numbers are longs).

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\x0A-\x0D]`` and these into words ``[^\x20\x09]+``. A null
    text is empty, a null language is ``und``. Candidates have 2 to ``longest`` words and occur ``a >= least`` times. The cut
    of least floor(1000 * a * n / (l * r)) counts (n: words of the language; l, r: occurrences of its parts), among equals
    the first. A candidate inside a longer one that occurs as often is left out. The ``first`` best of a language are returned by
    score, then a, then phrase. Repeated rows count as often as they are there; ids and extra columns are not read; an
    empty table gives an empty result.
    """
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    phrases = frequent_phrases(texts, least, longest, shards)
    totals = phrases.filter("size = 0").select("lang", F.col("f").alias("n"))
    known = phrases.filter("size > 0").select("lang", "phrase", "f")
    whole = phrases.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    inner = whole.filter("size > 2").select("lang", "a", "w", "size", F.explode(F.expr("sequence(2, size - 1)")).alias("k"))
    inner = inner.select("lang", "a", "w", "k", F.explode(F.expr("sequence(1, size - k + 1)")).alias("i"))
    inner = inner.groupBy("lang", F.expr("array_join(slice(w, i, k), ' ')").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = whole.join(inner, ["lang", "phrase"], "left").filter("longer is null or longer < a")
    halves = kept.select("lang", "phrase", "a", "w", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    halves = halves.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"),
                           F.expr("array_join(slice(w, k + 1, size - k), ' ')").alias("right"))
    for part, count in (("left", "l"), ("right", "r")):
        halves = halves.join(known.select("lang", F.col("phrase").alias(part), F.col("f").alias(count)), ["lang", part])
    halves = halves.join(bounded(totals), "lang")
    wide = {c: f"cast({c} as decimal({p}, 0))" for c, p in (("a", 16), ("n", 17), ("l", 18), ("r", 18))}
    score = F.expr(f"cast(1000BD * {wide['a']} * {wide['n']} div ({wide['l']} * {wide['r']}) as long)")
    scored = halves.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same in DuckDB's SQL, with the default parameters.
ORACLE_SQL = """
with pieces as (
  select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece
  from (select coalesce(lang, 'und') as lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
        from documents)),
worded as (
  select lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from worded group by lang),
places as (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i
           from worded, (select unnest(range(1, 6)) as size) where len(w) >= size),
counted as (select lang, size, array_to_string(w[i : i + size - 1], ' ') as phrase, count(*) as f from places group by all),
known as (select lang, size, phrase, f, string_split(phrase, ' ') as w from counted where f >= 100),
spans as (select lang, f, w, size, unnest(range(2, size)) as k from known where size > 2),
inner_ as (select lang, f, array_to_string(w[i : i + k - 1], ' ') as phrase
           from (select *, unnest(range(1, size - k + 2)) as i from spans)),
covered as (select lang, phrase, max(f) as longer from inner_ group by all),
kept as (select c.lang, c.phrase, c.f as a, c.w, c.size from known c left join covered v on c.lang = v.lang and c.phrase = v.phrase
         where c.size > 1 and (v.longer is null or 100 * v.longer < 100 * c.f)),
halves as (select *, array_to_string(w[1 : k], ' ') as lhs, array_to_string(w[k + 1 : size], ' ') as rhs
           from (select *, unnest(range(1, size)) as k from kept)),
cuts as (select h.lang, h.phrase, h.a, h.k, x.f as l, y.f as r, t.n,
                cast((1000::hugeint * h.a * t.n) // (x.f::hugeint * y.f) as bigint) as score
         from halves h join known x on x.lang = h.lang and x.phrase = h.lhs join known y on y.lang = h.lang and y.phrase = h.rhs
         join totals t on t.lang = h.lang),
scored as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from scored qualify rank <= 2000
"""
