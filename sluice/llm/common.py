"""Helpers shared by the operators: written cuts, Arrow text chunks, 64-bit hashing in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that numpy works on at once inside a task; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

#: Rows of an id or two that may be broadcast; joins of more are shuffled.
BROADCAST_ROWS = 500_000

#: ``[^\x20\x09-\x0D]+`` are words: these bytes part them.
SPACES = np.zeros(256, bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder, a folder for each value of ``by``, and read it back: the lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first longer name that ``df`` does not have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of narrow rows) marked for broadcast if its count is within ``rows``; else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column that names each row, the same whenever it is computed.

    Rows read straight from files are named by file and place there; other frames are written once, numbered.
    """
    try:
        return df.withColumn(name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")))
    except AnalysisException:
        return cut(df.withColumn(name, F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place"))), "rows")


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser of splitmix64; ``seed`` gives independent functions."""
    with np.errstate(over="ignore"):
        x = x + _GOLD * np.uint64(seed + 1)
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def first_of_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first of each distinct pair of 64-bit values, how often it occurs)."""
    with np.errstate(over="ignore"):
        _, at, n = np.unique(mix(mix(a.astype(np.uint64), 71) + b.astype(np.uint64), 72), return_index=True, return_counts=True)
    return at, n


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n + 1:
            with np.errstate(over="ignore"):
                size = max(n + 1, 2 * len(self.up))
                for name, b in (("up", self.base), ("down", self.inverse)):
                    a = np.full(size, np.uint64(b))
                    a[0] = 1
                    setattr(self, name, np.cumprod(a))


class ByteHash:
    """Polynomial hash of any byte range of a chunk, from one prefix sum."""

    def __init__(self, data: np.ndarray, powers: Powers, seed: int = 1):
        powers.upto(len(data) + 1)
        letters = mix(np.arange(256, dtype=np.uint64), seed)
        self.powers = powers
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(letters[data] * powers.up[: len(data)], out=self.prefix[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.prefix[end] - self.prefix[start]) * self.powers.down[start])


def text_chunks(batches: Iterator[pa.RecordBatch], max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(first column, bounds, bytes) of consecutive rows of (id, text) batches.

    Row i's UTF-8 text is ``bytes[bounds[i]:bounds[i + 1]]``; a null text is empty.
    """
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary())
        if not len(ids):
            continue
        off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.empty(0, np.uint8)
        lens = np.diff(off)
        if texts.null_count:  # a null slot may span bytes
            lens = np.where(np.asarray(texts.is_null()), 0, lens)
        total, first = np.concatenate([[0], np.cumsum(lens)]), 0
        while first < len(ids):
            last = max(first + 1, int(np.searchsorted(total, total[first] + max_bytes, side="right")) - 1)
            if texts.null_count:
                part = np.concatenate([data[off[i] : off[i] + lens[i]] for i in range(first, last)])
            else:
                part = data[off[first] : off[last]]
            yield ids.slice(first, last - first), total[first : last + 1] - total[first], part
            first = last


def words(data: np.ndarray, bounds: np.ndarray, breaks: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of a chunk, and the word count before each row (one more entry than rows).

    ``breaks`` says of each byte whether it parts words.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~breaks[data]
    cuts = bounds[1:-1]  # a word ends with its row
    start = inside[1:-1] & ~inside[:-2]
    cuts = cuts[cuts < len(data)]
    start[cuts] = inside[1:-1][cuts]
    starts = np.flatnonzero(start)
    end = inside[1:-1] & ~inside[2:]
    end[cuts[cuts > 0] - 1] = inside[1:-1][cuts[cuts > 0] - 1]
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, bounds)
