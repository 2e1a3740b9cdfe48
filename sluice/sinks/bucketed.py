"""Keyed tables on plain parquet that rewrite only the buckets a batch touches.

Layout under ``root``::

    definition/                  one row: keys, number of buckets, schema
    data/_bucket=<n>/_batch=<b>/ rows whose key hashes to bucket n

A batch reads and rewrites the buckets of its own keys, by dynamic partition
overwrite; all other files stay as they are.  Every write is idempotent (an
upsert, a type 1 re-rank, a de-duplicated change log), so a batch that failed
half-way, or is replayed, is simply applied again; no commit log and no clock is
involved.  What that means for readers: while a batch is being written, or after
a crash until its retry, they may see some of its buckets new and others old.

``buckets`` is stored with the table when it is created.  A batch of many random
keys still touches every bucket; where the catalog supports row-level operations,
:func:`sluice.operators.upsert.merge_into_table` is the answer.  Rows with a NULL
key never match, so an upsert always inserts them (S9): they go to a partition
named after their batch, which a replay overwrites.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import CHANGE_TYPE, _any_null, assert_unique_keys, change_feed, change_images, same_row
from ..session import path_exists
from ..sources.literal import literal_rows

BUCKET, BATCH, VOID = "_bucket", "_batch", "_void"
#: A batch's rows beside the table's, the part of a bucket they are in, whether they stay or are set,
#: what was there before, whether the batch sets a row of the key.
NEW, SLICE, PUT, WAS, ANY = "_merge_new", "_merge_slice", "_merge_put", "_merge_was", "_merge_any"
#: Parts of a bucket's keys that tasks of their own merge and write.
SLICES = 16
#: Default number of buckets: choose it so that one bucket is some hundred MB.
BUCKETS = 32


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self._wanted = spark, root.rstrip("/"), list(keys), buckets

    # -- definition
    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.root}/definition")

    def _definition(self):
        return self.spark.read.parquet(f"{self.root}/definition").first()

    def _create(self, schema: T.StructType) -> None:
        """The first batch creates the table from its own schema."""
        if not self.exists():
            (literal_rows(self.spark, [(self.keys, self._wanted, schema.json())], "keys array<string>, buckets int, schema string")
                 .write.mode("overwrite").parquet(f"{self.root}/definition"))

    @property
    def buckets(self) -> int:
        return self._definition()["buckets"] if self.exists() else self._wanted

    def _all(self) -> DataFrame:
        d = self._definition()
        schema = T.StructType.fromJson(json.loads(d["schema"]))
        full = T.StructType([*schema.fields, T.StructField(VOID, T.BooleanType()), T.StructField(BUCKET, T.IntegerType()),
                             T.StructField(BATCH, T.StringType())])
        path = f"{self.root}/data"
        return self.spark.read.schema(full).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], full)

    # -- reads
    def read(self) -> DataFrame:
        if not self.exists():
            raise ValueError(f"no table at {self.root}")
        return self._all().filter(F.col(VOID).isNull()).drop(VOID, BUCKET, BATCH)

    def bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(n)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows' keys: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket(self.buckets)).distinct().collect())

    def part(self, touched: Sequence[int]) -> DataFrame:
        """Rows of some buckets (pruned to their folders)."""
        return self._all().filter(F.col(BUCKET).isin(list(touched)) & F.col(VOID).isNull()).drop(VOID, BUCKET, BATCH)

    # -- writes
    def _write(self, rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, BATCH).parquet(f"{self.root}/data")

    def _beside(self, old: DataFrame, batch: DataFrame) -> DataFrame:
        """The table's rows and those of a batch (all with a key), shuffled once: a key's rows meet in one task, which holds
        few buckets and so can write them as they are."""
        both = old.withColumn(NEW, F.lit(False)).unionByName(batch.withColumn(NEW, F.lit(True)))
        bucket, piece = self.bucket(self.buckets), F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(SLICES))
        return both.repartition(bucket, piece).withColumn(BUCKET, bucket).withColumn(SLICE, piece)  # both are made anew behind the shuffle

    def _by_key(self):
        return Window.partitionBy(BUCKET, SLICE, *self.keys)

    def _loose(self, rows: DataFrame, version: str) -> DataFrame:
        """Rows without a key, for their batch's partition."""
        return rows.withColumn(BUCKET, F.lit(-1)).withColumn(BATCH, F.lit(version)).withColumn(VOID, F.lit(None).cast("boolean")).hint("rebalance")

    def replace(self, rows: DataFrame, touched: Sequence[int]) -> None:
        """Make ``rows`` the content of the touched buckets.  A marker row in each keeps a bucket that
        became empty from showing its old files."""
        self._create(rows.schema)
        marks = (self.spark.range(len(touched)).select(F.element_at(F.array(*[F.lit(int(b)) for b in touched]), (F.col("id") + 1).cast("int")).alias(BUCKET), F.lit(True).alias(VOID))
                 if touched else self.spark.createDataFrame([], f"{BUCKET} int, {VOID} boolean"))
        keyed = rows.withColumn(BUCKET, self.bucket(self.buckets)).withColumn(VOID, F.lit(None).cast("boolean"))
        self._write(keyed.unionByName(marks, allowMissingColumns=True).withColumn(BATCH, F.lit("-")).hint("rebalance", BUCKET, BATCH))

    def upsert(self, source: DataFrame, version: str, check: bool = True, feed: str | None = None) -> None:
        """replace rows whose key ``source`` carries, insert the others.  Repeated keys raise
        unless the caller knows they are unique.  With ``feed``, the changes go there first, as :meth:`write_feed`
        stores them; they come from the pass that also makes the table's rows."""
        if check:
            assert_unique_keys(source, self.keys)
        replay = feed is not None and path_exists(self.spark, f"{feed}/_SUCCESS")
        tell = feed is not None and not replay
        if tell and not self.exists():  # all rows are inserts
            self.write_feed(source, feed)
            tell = False
        self._create(source.schema)
        null = _any_null(self.keys)
        keyed, loose = source.filter(~null), source.filter(null)
        touched = self.touched(keyed)
        if replay and self._holds(keyed, touched):  # its work has been done
            self._write(self._loose(loose, version))
            return
        both = self._beside(self.part(touched), keyed)
        both = both.withColumn(PUT, F.col(NEW) | ~F.max(NEW).over(self._by_key()))
        if tell:
            both = self._with_was(both, source.columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if tell:
                self._images(both, source).write.mode("overwrite").option("compression", "zstd").parquet(feed)
            rows = both.filter(PUT).drop(NEW, PUT, SLICE, WAS).withColumn(BATCH, F.lit("-")).withColumn(VOID, F.lit(None).cast("boolean"))
            self._write(rows.unionByName(self._loose(loose, version)))
        finally:
            if tell:
                both.unpersist()

    def _holds(self, keyed: DataFrame, touched: Sequence[int]) -> bool:
        """Whether the table has every one of these rows already (and so would be rewritten as it is)."""
        old = self.part(touched).select(*[F.col(f"`{k}`") for k in self.keys], F.struct(*[F.col(f"`{c}`") for c in keyed.columns]).alias(WAS))
        kinds = {f.name: f.dataType for f in keyed.schema.fields}
        return keyed.join(old, self.keys, "left").filter(~same_row(WAS, kinds)).isEmpty()

    def _with_was(self, both: DataFrame, columns: Sequence[str]) -> DataFrame:
        """With each new row the table's row of its key."""
        row = F.struct(*[F.col(f"`{c}`") for c in columns])
        return both.withColumn(WAS, F.first(F.when(~F.col(NEW), row), ignorenulls=True).over(self._by_key()))

    def _images(self, both: DataFrame, source: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in source.schema.fields}
        cols = [c for c in source.columns if c not in self.keys]
        row = lambda of: F.struct(*[F.col(f"{of}`{c}`") for c in [*self.keys, *cols]])
        now = both.filter(NEW).select(F.when(F.col(WAS).isNotNull(), row(f"{WAS}.")).alias("was"), row("").alias("now"))
        loose = source.filter(_any_null(self.keys)).select(F.lit(None).cast(now.schema["was"].dataType).alias("was"), row("").alias("now"))
        return change_images(now.unionByName(loose), kinds, cols, F.col("was").isNull(), F.lit(False))

    def changes(self, source: DataFrame) -> DataFrame:
        """The row-level changes an upsert of ``source`` makes, from the touched buckets alone."""
        if not self.exists():
            return change_feed(source.limit(0), source, self.keys)
        keyed = source.filter(~_any_null(self.keys))
        return self._images(self._with_was(self._beside(self.part(self.touched(keyed)).select(*source.columns), keyed), source.columns), source)

    def write_feed(self, source: DataFrame, path: str) -> None:
        """Store the changes that an upsert of ``source`` makes, before it is made. What a finished earlier try of the
        same batch stored stays: the table may hold its rows by now, and would show no change."""
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            self.changes(source).write.mode("overwrite").option("compression", "zstd").parquet(path)

    def apply_feed(self, feed: DataFrame, version: str) -> None:
        """Apply one batch's changes, as :meth:`changes` gives them, to this copy of the table.

        Keys that the feed names take the new image (``insert``, ``update_postimage``) or go (``delete``); pre-images
        say nothing more. Batches must come in order; one that comes again, or whose try failed half-way, changes nothing
        twice, as it sets the same keys to the same rows. Inserts without a key go to their batch's partition."""
        put = F.col(CHANGE_TYPE).isin("insert", "update_postimage")
        images = feed.filter(put).drop(CHANGE_TYPE)
        self._create(images.schema)
        null = _any_null(self.keys)
        keyed = feed.filter(~null)
        touched = self.touched(keyed)
        # a row that only names its key travels without the rest
        named = keyed.select(*[F.col(f"`{c}`") if c in self.keys else F.when(put, F.col(f"`{c}`")).alias(c) for c in images.columns], F.coalesce(put, F.lit(False)).alias(PUT))
        both = self._beside(self.part(touched).select(*images.columns, F.lit(False).alias(PUT)), named)
        by, kinds = self._by_key(), {f.name: f.dataType for f in images.schema.fields}
        both = self._with_was(both, images.columns).withColumn(ANY, F.max(PUT).over(by)).withColumn(PUT, F.when(F.col(NEW), F.col(PUT)).otherwise(~F.max(NEW).over(by)))
        both = both.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            news = F.when(F.col(PUT), ~same_row(WAS, kinds)).otherwise(F.col(WAS).isNotNull() & ~F.col(ANY))
            changed = sorted(r[0] for r in both.filter(F.col(NEW) & news).select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
            rows = both.filter(F.col(PUT) & F.col(BUCKET).isin(changed)).select(*images.columns, BUCKET).withColumn(VOID, F.lit(None).cast("boolean"))
            marks = literal_rows(self.spark, [(b, True) for b in changed], f"{BUCKET} int, {VOID} boolean")  # a bucket may become empty
            rows = rows.unionByName(marks, allowMissingColumns=True).withColumn(BATCH, F.lit("-"))
            self._write(rows.unionByName(self._loose(images.filter(null), version)))
        finally:
            both.unpersist()


def batch_version(batch_id: int, query: str = "q") -> str:
    """Sortable version tag of a micro-batch of one writer query."""
    return f"{query}-{batch_id:012d}"


__all__ = ["BucketedTable", "batch_version"]
