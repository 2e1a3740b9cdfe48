"""Best-fit packing of tokenised documents into fixed-length sequences, planned on the length histogram.

Documents are tokenised once; each piece carries its rank among the pieces of its length in its task. The
driver sees only how many pieces there are of each length (at most ``capacity`` numbers), runs best fit
decreasing over these counts, and gets runs of slots: "ranks [from, to) of length L start at offset o of the
sequences from s on". Pieces take their slots by global rank within length, which is the task's offset for that length plus
the rank within the task, so no task ever holds all pieces of one length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_chunks

CAPACITY = 2048
END = 0
TOKENIZER = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


class ByteBpe:
    """Token ids of the byte-level vocabulary.

    ``tiktoken`` reads the same vocabulary as ranks and gives the same ids as ``tokenizers`` (tested), several
    times faster; a text that holds the special token's string is left to ``tokenizers`` itself.
    """

    def __init__(self, folder_file: str = TOKENIZER):
        import base64

        import tiktoken

        self.json = public_tokenizers.path(f"{folder_file}.json") if "/" not in folder_file else f"{folder_file}.json"
        with open(self.json.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast, self.whole = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), None

    def ids(self, text: str) -> list[int]:
        if SPECIAL not in text:
            return self.fast.encode_ordinary(text)
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.json)
        return self.whole.encode(text, add_special_tokens=False).ids


def _pieces(capacity: int, tokenizer: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, ranks = ByteBpe(tokenizer), TaskContext.get().partitionId(), defaultdict(int)
        for ids, bounds, data in text_chunks(batches):
            data, take, cols = data.tobytes(), [], defaultdict(list)
            for i in range(len(ids)):
                tokens = np.array([*bpe.ids(data[bounds[i] : bounds[i + 1]].decode()), END], np.uint32)
                ends = list(range(len(tokens), 0, -capacity))[::-1]
                for piece, (a, b) in enumerate(zip([0, *ends], ends)):
                    take.append(i)
                    cols["piece"].append(piece)
                    cols["start"].append(a)
                    cols["length"].append(b - a)
                    cols["ids_crc32"].append(zlib.crc32(tokens[a:b].astype("<u4").tobytes()))
                    cols["rank"].append(ranks[b - a])
                    ranks[b - a] += 1
                    if with_ids:
                        cols["ids"].append(tokens[a:b].astype(np.int32))
            out = [ids.take(pa.array(take, pa.int64())), pa.array([part] * len(take), pa.int32()), pa.array(cols["piece"], pa.int32())]
            out += [pa.array(cols[c], pa.int64()) for c in ("start", "length", "ids_crc32", "rank")]
            out += [pa.array(cols["ids"], pa.list_(pa.int32()))] * with_ids
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "part", "piece", "start", "length", "ids_crc32", "rank"] + ["ids"] * with_ids)
    return run


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, end rank, first sequence, offset) of best fit decreasing over the counts.

    Sequences of equal free space are kept as blocks of consecutive numbers, so the work follows the
    number of distinct lengths, not of pieces.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    runs, opened = [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = next((r for r in range(length, capacity + 1) if free[r]), None)
            if room is None:
                new = -(-left // (capacity // length))
                free[capacity].append((opened, new))
                opened += new
                continue
            first, held = free[room].pop()
            used = min(held, left)
            runs.append((length, rank, rank + used, first, capacity - room))
            if used < held:
                free[room].append((first + used, held - used))
            free[room - length].append((first, used))
            rank += used
            left -= used
    return runs


def _placed(runs: list[tuple[int, int, int, int, int]], names: list[str]):
    by: dict[int, list] = defaultdict(list)
    for run in runs:
        by[run[0]].append(run)
    starts = {length: [r[1] for r in own] for length, own in by.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            seq, off = [], []
            for length, rank in zip(t.column("length").to_pylist(), t.column("rank").to_pylist()):
                r = by[length][bisect_right(starts[length], rank) - 1]
                seq.append(r[3] + rank - r[1])
                off.append(r[4])
            yield pa.RecordBatch.from_arrays([*(t.column(c) for c in names), pa.array(seq, pa.int64()), pa.array(off, pa.int64())], names=[*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A document is its token ids, then one end id; only one longer than ``capacity`` is cut, and then the
    first piece takes the remainder. A null or empty text is the end id alone. Repeated rows and null
    ids are packed like any other row. ``tokenizer`` names a public vocabulary or gives the path of one without its
    suffix. Extra columns are not read. An empty table gives an empty result. The plan broadcast to tasks depends on the distinct
    lengths alone, at most ``capacity`` of them.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, part int, piece int, start long, length long, ids_crc32 long, rank long"
    pieces = cut(docs.mapInArrow(_pieces(capacity, tokenizer, with_ids), schema + ", ids array<int>" * with_ids), "pieces")
    parts = cut(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    runs = best_fit({r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = pieces.join(parts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.select(*names).schema)
    return ranked.select(*names, "rank").mapInArrow(_placed(runs, names), f"{fields}, sequence_id long, offset long")
