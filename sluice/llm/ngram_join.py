"""Exact Jaccard self-join of documents on word shingles, by parity sketches.

A document's set of 64-bit shingle hashes is folded into a wide, sparse bit sketch: every shingle flips one
bit, so the Hamming distance of two sketches is at most the symmetric difference of the sets. Sets are
compared within overlapping size bands; a band's linked pairs differ in at most ``d`` shingles, so of a sketch cut
into ``m = d + k`` blocks at least ``k`` agree in full (pigeonhole). A block's parity bits, folded to one
signature, are the join key:

* a document whose sketch has ``k`` or more empty blocks in a band is dealt anew with another seed, up to
  ``LEVELS`` times, so that its partner cannot agree with it in empty blocks alone;
* signatures shared by few documents give candidate pairs at once;
* signatures shared by many (copies, common passages) are set aside. A document stays safe while its empty
  and shared blocks are fewer than ``k``, since then every partner also agrees in a rare one. The others
  are compared with a pivot of each shared signature. Pairs that are then still in different components meet
  as sketches, star by star and in cells of bounded size, unless the triangle inequality of the symmetric difference parts them.

Candidates first meet as dense parity sketches of a bit or two a shingle, whose Hamming distance throws out most of them;
what is left is verified on the full sets, so the links are exact up to 64-bit hash collisions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, ByteHash, Powers, bounded, cut, mix, text_chunks, words
from .components import connected_components

SHINGLE = 5
LEVELS = 8
#: A signature held by more distinct sets than this is set aside.
RARE = 8
#: Members of a star that are compared in one task with each other, or with as many more.
CELL = 4000
#: Nearest partners that a member of a star first gives; all of them before the end.
BEST = 32
#: Signatures a bucket holds on average; they take some 60 bytes each while it is sorted.
BUCKET_ROWS = 2_000_000
#: Signatures that a task holds before it sends them on.
FLUSH = 1_000_000


def bands(largest: int, num: int, den: int, growth: float = 1.7) -> list[tuple[int, int, int, int]]:
    """(smallest size, largest size, blocks m, spare blocks k) of each band up to ``largest``.

    Any two sets a <= b of similarity num/den or more have den * a >= num * b and lie in one band with
    a < the next band's smallest size; their symmetric difference is at most (den - num)/(den + num) * (a + b).
    """
    out, low = [], 1
    while low <= largest:
        after = max(low + 1, int(low * growth))
        top = (after - 1) * den // num
        d = (den - num) * (after - 1 + top) // (den + num)
        if d:  # else only equal sets link
            k = max(2, d // 10) + 1
            out.append((low, top, d + k, k))
        low = after
    return out if len(out) <= 32 else bands(largest, num, den, growth * 1.2)  # a tag has five bits for the band


def shingle_sets(bounds: np.ndarray, data: np.ndarray, powers: Powers, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a chunk."""
    data = LOWER[data]
    start, end, at = words(data, bounds)
    if not len(start):
        return [np.empty(0, np.uint64)] * (len(bounds) - 1)
    h = ByteHash(data, powers).ranges(start, end)
    mult = mix(np.arange(size, dtype=np.uint64), 7) | np.uint64(1)
    with np.errstate(over="ignore"):
        full = mix(reduce(np.add, (h[i : len(h) - size + 1 + i] * mult[i] for i in range(size)))) if len(h) >= size else h[:0]
        out = []
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= size:
                s = full[a : b - size + 1].copy()
                s.sort()
                out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif b > a:
                out.append(mix(np.array([np.sum(h[a:b] * mult[: b - a])], np.uint64), 100 + int(b - a)))
            else:
                out.append(h[:0])
    return out


def fingerprint(s: np.ndarray) -> int:
    """Signed 64-bit name of a shingle set: equal sets, equal names."""
    with np.errstate(over="ignore"):
        return int(mix(np.array([np.sum(mix(s, 3)) + np.uint64(len(s))], np.uint64), 4).view(np.int64)[0])


def sketch(s: np.ndarray) -> bytes:
    """Dense parity sketch: a power of two of bits, one to two a shingle; folds to any smaller power by XOR."""
    bits = max(64, 1 << (len(s) - 1).bit_length())
    return np.packbits((np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def hamming(x: bytes, y: bytes) -> int:
    """Hamming distance at the smaller sketch's size: at most the symmetric difference of the sets."""
    x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(0x9E3779B97F4A7C15)
        for ids, bounds, data in text_chunks(batches):
            sets = shingle_sets(bounds, data, powers, size)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())], names=["doc_id", "n_shingles", "fp", "sketch"])
    return run


def signatures(s: np.ndarray, all_bands: list[tuple[int, int, int, int]]) -> Iterator[tuple[np.ndarray, int, int]]:
    """(signatures, slack, tag) of one set for each band and level it takes part in; tag names these.slack: how many
    of the set's signatures may be shared widely before a partner could be missed.
    """
    n = len(s)
    for band, (low, top, m, k) in enumerate(all_bands):
        if not low <= n <= top:
            continue
        for level in range(LEVELS):
            tag = band << 3 | level
            h = mix(s, 16 + tag)
            block = (h >> np.uint64(32)) % np.uint64(m)
            bit = mix((h & np.uint64(0xFFFFF)) | (block << np.uint64(20)), 9)  # one of 2**20 bits of its block
            sig = np.zeros(m, np.uint64)
            np.bitwise_xor.at(sig, block, bit)  # equal bits cancel: parity
            slack = k - int(np.count_nonzero(sig == 0))
            name = mix(sig ^ mix(np.arange(m, dtype=np.uint64), 1000 + tag))
            last = level == LEVELS - 1
            yield (name if last and slack <= 0 else name[sig != 0]), (max(slack, 0) if not last or slack > 0 else k), tag
            if slack > 0:
                break


RUN = (("fp", np.int64), ("n", np.uint32), ("slack", np.uint8), ("tag", np.uint8))


def _emit(all_bands: list, buckets: int, size: int):
    """Signatures of a task's documents, packed by bucket; equal sets of a task count once.

    A bucket's signatures are 32-bit quotients; runs of one set, band and level share their other fields.
    """
    def pack(sigs, runs):
        sig, run = np.concatenate(sigs), np.repeat(np.arange(len(sigs)), [len(x) for x in sigs])
        fields = [np.array([r[i] for r in runs], kind) for i, (_, kind) in enumerate(RUN)]
        key = sig >> np.uint64(8)
        bucket = key % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, run, key = bucket[order], run[order], (key[order] // np.uint64(buckets)).astype(np.uint32)
        cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            own, held = np.unique(run[a:b], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(bucket[a])], pa.int64()), pa.array([key[a:b].tobytes()], pa.binary()), pa.array([held.astype(np.uint32).tobytes()], pa.binary())]
                + [pa.array([x[own].tobytes()], pa.binary()) for x in fields], names=["bucket", "key", "held", *(c for c, _ in RUN)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, seen, sigs, runs, rows = Powers(0x9E3779B97F4A7C15), set(), [], [], 0
        for _, bounds, data in text_chunks(batches):
            for s in shingle_sets(bounds, data, powers, size):
                if not len(s) or (fp := fingerprint(s)) in seen:
                    continue
                seen.add(fp)
                for sig, slack, tag in signatures(s, all_bands):
                    sigs.append(sig)
                    runs.append((fp, len(s), min(slack, 255), tag))  # less slack is safe, only slower
                    rows += len(sig)
            if rows >= FLUSH:
                yield from pack(sigs, runs)
                sigs, runs, rows = [], [], 0
        if rows:
            yield from pack(sigs, runs)
    return run


def _meet(num: int, den: int):
    """Candidates of one bucket: kind 0 (a, b) a pair, kind 1 (a = set, sig, b = slack) a shared signature's member."""
    def run(t: pa.Table) -> pa.Table:
        def all_of(name, kind):
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in t.column(name)])

        held = all_of("held", np.uint32)
        fp, n, slack, tag = (np.repeat(all_of(c, kind), held) for c, kind in RUN)
        sig = tag.astype(np.uint64) << np.uint64(32) | all_of("key", np.uint32)
        order = np.lexsort((fp, sig))
        sig, fp, n, slack = sig[order], fp[order], n[order], slack[order]
        keep = np.ones(len(sig), bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (fp[1:] != fp[:-1])
        sig, fp, n, slack = sig[keep], fp[keep], n[keep].astype(np.int64), slack[keep]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        held = np.diff(np.append(first, len(sig)))
        many = np.repeat(held > RARE, held)
        left = np.where(many, 0, np.repeat(first + held, held) - np.arange(len(sig)) - 1)  # later members of a rare signature
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for step in range(1, RARE):
            i = np.flatnonzero(left >= step)
            i = i[den * np.minimum(n[i], n[i + step]) >= num * np.maximum(n[i], n[i + step])]
            a.append(fp[i])
            b.append(fp[i + step])
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        none = np.zeros(pairs.shape[1], np.int64)
        sig = sig[many].astype(np.int64) | t.column("bucket")[0].as_py() << 40
        return pa.table({"kind": np.concatenate([none, np.ones(len(sig), np.int64)]).astype(np.int32), "a": np.concatenate([pairs[0], fp[many]]),
                         "b": np.concatenate([pairs[1], slack[many].astype(np.int64)]), "sig": np.concatenate([none, sig])})
    return run


def _near(num: int, den: int):
    """Pairs with their Hamming distance, and whether it lets them link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            low = [hamming(x.as_py(), y.as_py()) for x, y in zip(t.column("sa"), t.column("sb"))]
            n = np.asarray(t.column("na")) + np.asarray(t.column("nb"))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(low, pa.int64()), pa.array((den + num) * np.array(low, np.int64) <= (den - num) * n)], names=["a", "b", "low", "near"])
    return run


def _across(num: int, den: int, best: int):
    """Pairs of one star's two cells (or one cell) in different components whose sketches allow a link.

    Every member gives its ``best`` nearest; a row with ``more`` says that some have further ones, and names the star.
    """
    def run(t: pa.Table) -> pa.Table:
        fp, n, low, high, comp, cell = (t.column(c).to_numpy() for c in ("fp", "n", "low", "high", "component", "cell"))
        sketches = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("sketch")]
        size = min(map(len, sketches))
        bits = np.stack([np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) for x in sketches])
        x, y = (t.column(c)[0].as_py() for c in "xy")
        rows, cols = np.flatnonzero(cell == x), np.flatnonzero(cell == y)
        a, b, more = [np.empty(0, np.int64)], [np.empty(0, np.int64)], False
        for first in range(0, len(rows), 256):
            r = rows[first : first + 256]
            within = (den - num) * (n[r][:, None] + n[cols][None, :])
            may = (comp[r][:, None] != comp[cols][None, :]) & (den * np.minimum(n[r][:, None], n[cols][None, :]) >= num * np.maximum(n[r][:, None], n[cols][None, :]))
            may &= ((den + num) * (low[cols][None, :] - high[r][:, None]) <= within) & ((den + num) * (low[r][:, None] - high[cols][None, :]) <= within)
            for i in np.flatnonzero(may.any(1)):
                j = np.flatnonzero(may[i])
                apart = np.bitwise_count(bits[cols[j]] ^ bits[r[i]]).sum(1, dtype=np.int64)
                near = (den + num) * apart <= within[i, j]
                j, apart = j[near], apart[near]
                if len(j) > best:
                    j, more = j[np.argsort(apart, kind="stable")[:best]], True
                a.append(np.minimum(fp[r[i]], fp[cols[j]]))
                b.append(np.maximum(fp[r[i]], fp[cols[j]]))
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
        flag = np.array([[t.column("pivot")[0].as_py()], [0]], np.int64)[:, : int(more)]
        a, b = np.concatenate([pairs, flag], axis=1)
        return pa.table({"a": a, "b": b, "more": np.arange(len(a)) >= pairs.shape[1]})
    return run


def _packed(size: int):
    """(fp, compressed text) of every text with words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, pack = Powers(0x9E3779B97F4A7C15), zstandard.ZstdCompressor(3)
        for _, bounds, data in text_chunks(batches):
            own = [(fingerprint(s), pack.compress(data[a:b].tobytes())) for s, a, b in zip(shingle_sets(bounds, data, powers, size), bounds, bounds[1:]) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in own], pa.int64()), pa.array([z for _, z in own], pa.binary())], names=["fp", "z"])
    return run


def _verify(num: int, den: int, size: int):
    """The symmetric difference of each pair, and whether it links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, unpack = Powers(0x9E3779B97F4A7C15), zstandard.ZstdDecompressor()

        @lru_cache(64)  # a pivot's pairs come one after another
        def shingles(fp: int, z: bytes) -> np.ndarray:
            data = np.frombuffer(unpack.decompress(z), np.uint8)
            return shingle_sets(np.array([0, len(data)]), data, powers, size)[0]

        for t in batches:
            diff, link = [], []
            for a, b, za, zb in zip(*(t.column(c).to_pylist() for c in ("a", "b", "za", "zb"))):
                x, y = shingles(a, za), shingles(b, zb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                diff.append(len(x) + len(y) - 2 * both)
                link.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(diff, pa.int64()), pa.array(link, pa.bool_())], names=["a", "b", "diff", "link"])
    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 80, den: int = 100, size: int = SHINGLE) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Two rows link when ``den * |A & B| >= num * |A | B|`` over their sets of distinct ``size``-word shingles
    (A-Z lower-cased; fewer words: the whole sequence as one). Equal sets, repeated rows included, are one
    node throughout. Null or wordless texts have an empty set, link with nothing and are a component of
    their own. component_id is the least non-null id reachable; rows with a null id keep a null doc_id and
    still link. Extra columns are not read. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(docs.mapInArrow(_digests(size), f"doc_id {id_type}, n_shingles long, fp long, sketch binary"), "shingles")
    total, largest = rows.agg(F.sum("n_shingles"), F.max("n_shingles")).first()
    sets = rows.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch"))
    sets, rows = cut(sets, "sets"), rows.drop("sketch")
    all_bands = bands(largest or 0, num, den)
    if not all_bands:
        return _labelled(rows, sets.select("fp", F.col("fp").alias("component"), "least"))
    buckets = max(8, total // (2 * BUCKET_ROWS))
    met = docs.select("doc_id", "text").mapInArrow(_emit(all_bands, buckets, size), "bucket long, key binary, held binary, " + ", ".join(f"{c} binary" for c, _ in RUN))
    met = cut(met.groupBy("bucket").applyInArrow(_meet(num, den), "kind int, a long, b long, sig long"), "met")

    # members of widely shared signatures whose rare blocks do not suffice; a signature's pivot is its member that shares most
    shared = met.filter("kind = 1").select("sig", F.col("a").alias("fp"), F.col("b").alias("slack"), F.expr("shiftright(sig, 32) & 255").alias("tag"))
    unsafe = shared.groupBy("fp", "tag").agg(F.count("*").alias("held"), F.max("slack").alias("slack")).filter("held >= slack").select("fp", "tag", "held")
    shared = cut(shared.drop("slack").join(unsafe, ["fp", "tag"]).select("sig", "fp", "held"), "shared")
    pivots = shared.groupBy("sig").agg(F.max(F.struct("held", "fp"))["fp"].alias("pivot"))
    stars = cut(shared.join(pivots, "sig").select("pivot", "fp").distinct(), "stars")

    def compared(p: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(pairs with the Hamming distance, those near enough with the symmetric difference and whether they link)."""
        side = lambda x: sets.select(F.col("fp").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
        met = cut(p.join(side("b"), "b").join(side("a"), "a").mapInArrow(_near(num, den), "a long, b long, low long, near boolean"), "near")
        near = met.filter("near").select("a", "b")
        named = near.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
        ids = cut(sets.join(named, "fp").select(F.col("least").alias("wanted"), "fp"), "wanted")
        only = bounded(ids)
        found = docs.join(only, docs["doc_id"].eqNullSafe(only["wanted"]), "left_semi")
        packed = cut(found.mapInArrow(_packed(size), "fp long, z binary").join(ids.select("fp"), "fp", "left_semi").dropDuplicates(["fp"]), "texts")
        side = lambda x: packed.select(F.col("fp").alias(x), F.col("z").alias(f"z{x}"))
        return met, cut(near.join(side("b"), "b").join(side("a"), "a").mapInArrow(_verify(num, den, size), "a long, b long, diff long, link boolean"), "checked")

    starred = stars.filter("fp <> pivot").select(F.least("pivot", "fp").alias("a"), F.greatest("pivot", "fp").alias("b"))
    near, checked = compared(met.filter("kind = 0").select("a", "b").union(starred).distinct())
    links, done = checked.filter("link").select("a", "b"), near.select("a", "b")
    comp = connected_components(links, "a", "b")

    # what pairs of one star's members are still apart, and not parted by their distances to its pivot
    away = near.join(checked.select("a", "b", "diff"), ["a", "b"], "left").select("a", "b", F.coalesce("diff", "low").alias("low"), F.col("diff").alias("high"))
    away = away.unionByName(away.select(F.col("a").alias("b"), F.col("b").alias("a"), "low", "high")).select(F.col("a").alias("pivot"), F.col("b").alias("fp"), "low", "high")
    cells = stars.groupBy("pivot").agg(F.expr(f"cast(ceil(count(*) / {CELL}) as int)").alias("cells"))
    members = cut(stars.join(cells, "pivot").join(away, ["pivot", "fp"], "left").select(
        "pivot", "fp", "cells", F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int").alias("cell"), F.coalesce("low", F.lit(0)).alias("low"),
        F.when(F.col("fp") == F.col("pivot"), 0).otherwise(F.coalesce("high", F.lit(1 << 40))).alias("high")), "members")
    best = BEST
    while True:
        members = cut(members.drop("component").join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "members")
        apart = members.groupBy("pivot").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least <> most").select("pivot")
        members = cut(members.join(apart, "pivot", "left_semi"), "apart")
        dealt = members.join(sets.select("fp", "n", "sketch"), "fp").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        dealt = dealt.withColumn("x", F.least("cell", "other")).withColumn("y", F.greatest("cell", "other"))
        across = cut(dealt.groupBy("pivot", "x", "y").applyInArrow(_across(num, den, best), "a long, b long, more boolean"), "across")
        new = cut(across.filter("not more").select("a", "b").distinct().join(done, ["a", "b"], "left_anti"), "new")
        if not new.isEmpty():
            done = cut(done.union(new), "done")
            links = links.union(compared(new)[1].filter("link").select("a", "b"))
            comp = connected_components(links, "a", "b")
        # a star none of whose members had further partners has been compared whole
        again = cut(across.filter("more").select(F.col("a").alias("pivot")).distinct(), "again")
        if again.isEmpty():
            break
        members, best = members.join(again, "pivot", "left_semi"), 4 * best
    return _labelled(rows, sets.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
                     .select("fp", F.coalesce("component", "fp").alias("component"), "least"))


def _labelled(rows: DataFrame, sets: DataFrame) -> DataFrame:
    names = sets.groupBy("component").agg(F.min("least").alias("component_id"))
    named = sets.join(names, "component").select("fp", "component_id")
    # rows without a set meet nobody
    return (rows.filter("fp is not null").join(named, "fp").select("doc_id", "n_shingles", "component_id")
            .unionByName(rows.filter("fp is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))
