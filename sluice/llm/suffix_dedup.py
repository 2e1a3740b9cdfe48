"""Byte strings of a fixed length that occur more than once, by column-wise suffix sorting.

All starts of ``length``-byte windows are dealt to small collections in which equal windows must meet in the same
column: a window's anchor is its least 32-byte gram by hash, starts at like distance from an anchor share a *core* of
bytes that all their windows hold, and a collection is the set of stretches with one core. A stretch has up to ``SPREAD - 1``
bytes on either side of its core; the core itself is one symbol to its collection.

Each collection is then built column by column from the right, one symbol of every stretch inserted each
round: the order of the suffixes (the collection's Burrows-Wheeler order) is updated by one stable sort on
the new symbol, their common prefixes by minima over the ranges in between. A window repeats where two neighbours
agree for ``length`` bytes. Rounds over whole documents would rewrite the entire transform once for every byte of the longest
document; collections of anchored stretches need at most ``2 * (SPREAD - 1)`` rounds and split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, ByteHash, Powers, cut, mix, text_chunks

LENGTH, GRAM, SPREAD = 400, 32, 100
#: Stretches a bucket holds on average, when cores are met and when collections are built.
MEET_ROWS, BUILD_ROWS = 500_000, 50_000
#: A core of more stretches is resolved by counting its windows' hashes, combined on the map side.
MEMBERS = 50_000
FLUSH = 500_000
STRETCH = (("row", np.int64), ("at", np.int32), ("lo", np.uint8), ("hi", np.uint8))
SPANS = "array<struct<start:bigint,end:bigint>>"


def least_grams(data: np.ndarray, hashed: ByteHash, width: int) -> np.ndarray:
    """For each start the place of the least of ``width`` grams, the first of equals."""
    n = len(data) - GRAM + 1
    with np.errstate(over="ignore"):
        h = mix((hashed.prefix[GRAM:] - hashed.prefix[:n]) * hashed.powers.down[:n])
    least = (h & ~np.uint64(0xFFFFFFFF)) | np.arange(n, dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[: n - width + 1], least[width - reach : width - reach + n - width + 1])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def stretches(bounds: np.ndarray, data: np.ndarray, powers: Powers, length: int, spread: int) -> tuple[np.ndarray, ...]:
    """(row, core's start, lo, hi, core's hash): windows start lo to hi bytes before the core."""
    none = (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    if len(data) < length:
        return none
    hashed = ByteHash(data, powers)
    anchor = least_grams(data, hashed, length - GRAM + 1)
    lens = np.maximum(np.diff(bounds) - length + 1, 0)
    if not lens.sum():
        return none
    row = np.repeat(np.arange(len(lens)), lens)
    start = np.arange(lens.sum()) + np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens)
    anchor = anchor[start]
    part = (anchor - start) // spread
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    core = anchor[first] - part[first] * spread
    with np.errstate(over="ignore"):
        key = mix(hashed.ranges(core, core + length - spread + 1), 60) + part[first].astype(np.uint64)
    return row[first], core - bounds[row[first]], core - start[last], core - start[first], key


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with a row number of their own, compressed."""
    task, seen = TaskContext.get().partitionId() << 40, 0
    for ids, bounds, data in text_chunks(batches):
        data, zip_ = data.tobytes(), zstandard.ZstdCompressor(3)
        yield pa.RecordBatch.from_arrays(
            [pa.array(task + seen + np.arange(len(ids))), ids, pa.array(np.diff(bounds)), pa.array([zip_.compress(data[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary())],
            names=["row", "doc_id", "n_bytes", "z"])
        seen += len(ids)


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of some MB with (bounds, bytes) of their texts."""
    for b in batches:
        sizes = np.cumsum(b.column("n_bytes").to_numpy())
        first = 0
        while first < len(b):
            last = max(first + 1, int(np.searchsorted(sizes, (sizes[first - 1] if first else 0) + CHUNK_BYTES, side="right")))
            part, unzip = b.slice(first, last - first), zstandard.ZstdDecompressor()
            texts = [unzip.decompress(z.as_buffer()) for z in part.column("z")]
            yield part, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), np.frombuffer(b"".join(texts), np.uint8)
            first = last


def _cores(length: int, spread: int, buckets: int):
    """Stretches packed by bucket of their core. Of a core that a task holds often one stands for all; these are repeated for sure."""
    def pack(held):
        key, *fields = (np.concatenate(x) for x in zip(*held))
        fields = [x.astype(kind) for x, (_, kind) in zip(fields, STRETCH)]
        order = np.argsort(key, kind="stable")
        key, fields = key[order], [x[order] for x in fields]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        many = np.diff(np.append(np.flatnonzero(new), len(key)))[np.cumsum(new) - 1] > 1
        for sure, pick in ((True, many), (False, new)):
            bucket = (key[pick] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, q, own = bucket[order], (key[pick] // np.uint64(buckets)).astype(np.uint32)[order], [x[pick][order] for x in fields]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
            for a, b in zip(cuts, np.append(cuts[1:], len(bucket)).astype(int)):
                yield pa.RecordBatch.from_arrays([pa.array([sure]), pa.array([int(bucket[a])], pa.int64()), pa.array([q[a:b].tobytes()], pa.binary())] + [pa.array([x[a:b].tobytes()], pa.binary()) for x in own],
                                                 names=["sure", "bucket", "q", *(c for c, _ in STRETCH)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(0x9E3779B97F4A7C15), [], 0
        for part, bounds, data in _open(batches):
            row, at, lo, hi, key = stretches(bounds, data, powers, length, spread)
            held.append((key, part.column("row").to_numpy()[row], at, lo, hi))
            size += len(row)
            if size >= FLUSH:
                yield from pack(held)
                held, size = [], 0
        if size:
            yield from pack(held)
    return run


def _fields(t: pa.Table | pa.RecordBatch) -> dict[str, np.ndarray]:
    return {c: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t.column(c)]) for c, kind in STRETCH}


def _repeated(t: pa.Table) -> pa.Table:
    """Stretches whose core's hash two tasks' parts of a bucket hold."""
    own, q = _fields(t), np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in t.column("q")])
    _, inv, n = np.unique(q, return_inverse=True, return_counts=True)
    return pa.table({c: x[n[inv] > 1].astype(np.int64) for c, x in own.items()})


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if len(b):
            yield pa.RecordBatch.from_pydict({c: x.astype(np.int64) for c, x in _fields(b).items()})


def _sides(length: int, spread: int):
    """Each stretch's core, named by two hashes, and the bytes beside it (0: beyond the document; else the byte + 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, size = Powers(0x9E3779B97F4A7C15), length - spread + 1
        for part, bounds, data in _open(batches):
            one, two = ByteHash(data, powers), ByteHash(data, powers, 2)
            wide = np.zeros(len(data) + 2 * spread, np.uint8)
            wide[spread : spread + len(data)] = np.minimum(data, 254) + 1  # no UTF-8 byte is larger
            for i in range(len(part)):
                own = part.column("found")[i].values
                at, lo, hi = (own.field(c).to_numpy() for c in ("at", "lo", "hi"))
                core = at + bounds[i]
                left = np.arange(-spread + 1, 0)
                place = np.concatenate([left, np.arange(spread - 1) + size])[None, :] + core[:, None]
                side = wide[place + spread]
                side[(place < bounds[i]) | (place >= bounds[i + 1])] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.ranges(core, core + size).view(np.int64)) for h in (one, two)] + [pa.array(np.full(len(at), part.column("row")[i].as_py())), pa.array(at), pa.array(lo), pa.array(hi),
                     pa.array([x.tobytes() for x in side], pa.binary())], names=["h", "g", "row", "at", "lo", "hi", "side"])
    return run


def range_minima(a: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(a[first:last + 1]) for each pair, last >= first."""
    out, span = np.empty(len(first), a.dtype), last - first + 1
    level, table = 1, a
    while len(first):
        own = np.flatnonzero((span >= level) & (span < 2 * level))
        out[own] = np.minimum(table[first[own]], table[last[own] - level + 1])
        if not (span >= 2 * level).any():
            return out
        table = np.minimum(table[:-level], table[level:])
        level *= 2
    return out


def insert(order: np.ndarray, common: np.ndarray, group: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round: a symbol goes in front of every suffix.

    order: suffixes, sorted within their groups; common[p]: least common length between the suffixes at p - 1 and p.
    Returns the new order, the least ``common`` on the way from each suffix to the one now before it, and where that has the same group and symbol.
    """
    key = group[order].astype(np.int64) << 16 | symbol[order]
    moved = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[moved][1:] == key[moved][:-1]])
    low = np.zeros(len(order), common.dtype)
    p = np.flatnonzero(same)
    low[p] = range_minima(common, moved[p - 1] + 1, moved[p])
    return order[moved], low, same


def repeats(group: np.ndarray, sides: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which windows of each stretch occur in another of its group: [stretch, bytes before the core]."""
    reach = sides.shape[1] // 2
    out = np.zeros((len(group), reach + 1), bool)
    order, common = np.argsort(group, kind="stable"), np.zeros(len(group), np.int32)
    for column in range(2 * reach - 1, reach - 1, -1):  # right of the core: common prefixes grow
        order, low, same = insert(order, common, group, sides[:, column])
        common = np.where(same, low + 1, 0).astype(np.int32)
    label = group
    for before in range(reach + 1):
        if before:  # left of the core: suffixes stay together while all inserted symbols are equal
            order, low, same = insert(order, common, label, sides[:, reach - before])
            common = np.where(same, low, -1).astype(np.int32)
        else:
            same = np.concatenate([[False], group[order][1:] == group[order][:-1]])
            common = np.where(same, common, -1)
        met = common >= reach - before
        met[:-1] |= met[1:]
        x = order[met]
        out[x[(lo[x] <= before) & (before <= hi[x])], before] = True
        ahead = np.concatenate([same[1:], [False]])
        keep = (same | ahead) & (hi[order] > before)  # alone, or at its last window: done
        if not keep.any():
            break
        label = np.empty(len(group), np.int64)
        label[order] = np.cumsum(~same)
        kept = np.flatnonzero(keep)
        fresh = np.concatenate([[True], label[order[kept]][1:] != label[order[kept]][:-1]])
        common = np.concatenate([common[kept[:1]], range_minima(common, kept[:-1] + 1, kept[1:])]) if len(kept) > 1 else common[kept]
        common[fresh] = -1
        order = order[kept]
    return out


def _build(t: pa.Table) -> pa.Table:
    """(row, first, last): runs of repeated windows' starts, from one bucket of collections."""
    cores = np.stack([t.column("h").to_numpy(), t.column("g").to_numpy()])
    group = np.unique(cores, axis=1, return_inverse=True)[1].ravel()
    row, at, lo, hi = (t.column(c).to_numpy() for c in ("row", "at", "lo", "hi"))
    sides = np.frombuffer(b"".join(x.as_py() for x in t.column("side")), np.uint8).reshape(len(row), -1)
    found = repeats(group, sides, lo, hi)
    edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    x, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return pa.table({"row": row[x], "first": at[x] - b + 1, "last": at[x] - a})


def _windows(length: int):
    """(hash, row, start) of every window of the stretches given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(0x9E3779B97F4A7C15)
        for part, bounds, data in _open(batches):
            one, two = ByteHash(data, powers), ByteHash(data, powers, 2)
            for i in range(len(part)):
                own = part.column("found")[i].values
                at, lo, hi = (own.field(c).to_numpy() for c in ("at", "lo", "hi"))
                start = np.concatenate([np.arange(a - h, a - low + 1) for a, low, h in zip(at, lo, hi)])
                s = start + bounds[i]
                yield pa.RecordBatch.from_arrays([pa.array(h.ranges(s, s + length).view(np.int64)) for h in (one, two)] + [pa.array(np.full(len(s), part.column("row")[i].as_py())), pa.array(start)], names=["h", "g", "row", "start"])
    return run


def _kept(length: int):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, kept, unzip = [], [], zstandard.ZstdDecompressor()
            for z, found in zip(b.column("z"), b.column("found")):
                text, own = unzip.decompress(z.as_buffer()), []
                for r in sorted((r["first"], r["last"] + length) for r in found.as_py() or ()):
                    if own and r[0] <= own[-1][1]:
                        own[-1][1] = max(own[-1][1], r[1])
                    else:
                        own.append(list(r))
                spans.append([{"start": s, "end": e} for s, e in own])
                edges = [0, *(x for r in own for x in r), len(text)]
                kept.append(b"".join(text[s:e] for s, e in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])
    return run


def dedup_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, spread: int = SPREAD, members: int = MEMBERS) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, spans, kept``.

    spans are the maximal runs of UTF-8 bytes covered by ``length``-byte strings that start somewhere else too,
    in any row or the same one (overlaps count), judged on the input; kept are all other bytes. Null texts are
    empty; texts shorter than ``length`` have no span. Repeated rows are rows of their own and so repeat each
    other; null ids are kept. Extra columns are not read. An empty table gives an empty result. Equal strings are told by hashes of 128 bits.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    stored = cut(docs.mapInArrow(_stored, f"row long, doc_id {id_type}, n_bytes long, z binary"), "texts")
    texts = stored.select("row", "n_bytes", "z")
    total = stored.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    fields = "row long, at long, lo long, hi long"
    cores = cut(texts.mapInArrow(_cores(length, spread, max(8, total // 80 // MEET_ROWS)), "sure boolean, bucket long, q binary, " + ", ".join(f"{c} binary" for c, _ in STRETCH)), "cores")
    met = cores.filter("not sure").drop("sure").groupBy("bucket").applyInArrow(_repeated, fields)
    sure = cores.filter("sure").select(*(c for c, _ in STRETCH)).mapInArrow(_unpacked, fields)
    found = cut(met.union(sure).groupBy("row").agg(F.array_distinct(F.collect_list(F.struct("at", "lo", "hi"))).alias("found")), "found")
    n = found.agg(F.coalesce(F.sum(F.size("found")), F.lit(0))).first()[0]

    sides = cut(texts.join(found, "row").mapInArrow(_sides(length, spread), "h long, g long, row long, at long, lo long, hi long, side binary"), "sides")
    hot = cut(sides.groupBy("h", "g").count().filter(F.col("count") > members).drop("count"), "hot")
    runs = sides.join(hot, ["h", "g"], "left_anti").groupBy(F.pmod(F.col("h"), F.lit(max(8, n // BUILD_ROWS)))).applyInArrow(_build, "row long, first long, last long")
    if not hot.isEmpty():
        own = sides.join(hot, ["h", "g"], "left_semi").groupBy("row").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("found"))
        windows = cut(texts.join(own, "row").mapInArrow(_windows(length), "h long, g long, row long, start long"), "windows")
        often = windows.groupBy("h", "g").count().filter("count > 1").drop("count")
        runs = runs.union(windows.join(often, ["h", "g"], "left_semi").select("row", F.col("start").alias("first"), F.col("start").alias("last")))
    runs = cut(runs.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("found")), "runs")
    return stored.join(runs, "row", "left").select("doc_id", "n_bytes", "z", "found").mapInArrow(_kept(length), f"doc_id {id_type}, n_bytes long, spans {SPANS}, kept binary")
