"""Type 2 history by splicing: a batch rewrites the versions beside its changes, not those of whole keys.

The stored form (*runs*) keeps deleted stretches too: a run is a maximal stretch of equal states of one key, with the
row that began it, ``__start_at``, ``__end_at`` and ``__deleted``. A change can begin a run, and it can make the row after
it begin one or cease to. So the rows of the batch and their successors in the log are looked at, each against its
predecessor; runs at these places are dropped or put, and the run before each takes its new end. All other runs pass
through as they are.

Neighbours are found in windows by ``(key, bucket of the sequence)``; what lies over a bucket's edge comes from one row
a bucket (:func:`beside`), so a hot key is spread over tasks. Columns travel in structs, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .scd import DELETED, END, SEQ, START, TIEBREAK, all_keys_small, scd2_from_prepared, sequence_bucket


def _matched(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Null-safe join on columns both sides have; the right side's come once, renamed away."""
    other = right.select(*[F.col(c).alias(f"r_{c}") if c in on else F.col(c) for c in right.columns])
    joined = left.join(other, reduce(lambda a, b: a & b, [left[c].eqNullSafe(other[f"r_{c}"]) for c in on]), how)
    return joined.drop(*[f"r_{c}" for c in on])


def beside(rows: DataFrame, keys: Sequence[str], bucket: str, place: str, what: Column, name: str, after: bool = False) -> DataFrame:
    """Adds ``what`` (never null) of the row before, or after, in order of ``place`` among the rows of a key."""
    edge = rows.groupBy(*keys, bucket).agg((F.min_by if after else F.max_by)(what, place).alias("edge"))
    over = Window.partitionBy(*keys).orderBy(bucket)
    carry = edge.select(*keys, bucket, (F.lead("edge") if after else F.lag("edge")).over(over).alias("carry"))
    inside = Window.partitionBy(*keys, bucket).orderBy(place)
    near = (F.lead(what) if after else F.lag(what)).over(inside)
    return _matched(rows.withColumn(name, near), carry, [*keys, bucket], "inner").withColumn(name, F.coalesce(name, "carry")).drop("carry")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scd2_runs(prepared: DataFrame, keys: Sequence[str], track_columns: Sequence[str] | None = None) -> DataFrame:
    """The runs of a whole change log."""
    return scd2_from_prepared(prepared, keys, track_columns, keep_deleted=True)


def scd2_view(runs: DataFrame) -> DataFrame:
    """The history as a user sees it."""
    return runs.filter(~F.col(DELETED)).drop(DELETED, TIEBREAK)


def scd2_splice(runs: DataFrame, log: DataFrame, prepared: DataFrame, keys: Sequence[str],
                track_columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(runs', changes)`` of :func:`scd2_splice_fresh`."""
    return scd2_splice_fresh(runs, log, prepared, keys, track_columns)[:2]


def scd2_splice_fresh(runs: DataFrame, log: DataFrame, prepared: DataFrame, keys: Sequence[str],
                      track_columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(runs', changes, fresh)`` after a batch, given runs and log before it.

    ``changes`` has the runs that were put (``__put`` true) or dropped: all that differs between ``runs`` and ``runs'``.
    Of rows that tie on key and sequence the one of largest row hash counts, whenever it came. A batch that was applied
    already, to the runs alone or to the log as well, changes nothing. The log may be compacted: it needs, per key, the
    rows from the earliest change on and the one before it. ``fresh`` has the batch's rows that the log has not, once each.

    Where no key has more than ``ROWS_A_KEY`` rows, log and batch are shuffled once, by key, and only what the batch
    touches is written; else keys are split into buckets of the sequence.
    """
    values = [c for c in prepared.columns if c not in (SEQ, DELETED, TIEBREAK)]
    tracked = list(track_columns) if track_columns is not None else [c for c in values if c not in keys]
    ks = [f"k{i}" for i in range(len(keys))]
    own = lambda df, s: df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, ks)], F.struct(*[F.col(f"`{c}`") for c in values]).alias("v"),
                                  F.col(s).alias("s"), F.col(DELETED).alias("d"), F.col(TIEBREAK).alias("tb"), *([F.col(END).alias("e")] if s == START else []))
    batch, logged, old = own(prepared, SEQ), own(log, SEQ), own(runs, START)
    touched = _written(batch.select(*ks).distinct(), "touched")
    state = F.struct("d", F.when(~F.col("d"), F.struct(*[F.col(f"v.`{c}`").alias(f"t{i}") for i, c in enumerate(tracked)]) if tracked else F.lit(True)).alias("t"))
    begins = F.col("before").isNull() | ~F.col("state").eqNullSafe(F.col("before.state"))
    whole = bool(ks) and all_keys_small(logged.select(*ks).unionByName(batch.select(*ks)), ks)
    if whole:  # one shuffle serves all: equal rows, ties, neighbours
        rows = logged.withColumn("new", F.lit(False)).unionByName(batch.withColumn("new", F.lit(True))).repartition(*ks)
        rows = rows.groupBy(*ks, "s", "tb").agg(F.max_by(F.struct("v", "d"), "tb").alias("x"), F.bool_and("new").alias("new"))
        rows = rows.select(*ks, "s", "x.*", "tb", "new")
        fresh = F.collect_list(F.when(F.col("new"), F.struct("v", "d", "tb"))).alias("fresh")
        best = rows.groupBy(*ks, "s").agg(F.max_by(F.struct("v", "d", "tb", "new"), "tb").alias("x"), fresh).select(*ks, "s", "x.*", "fresh")
        near = F.lag(F.struct("state", "new")).over(Window.partitionBy(*ks).orderBy("s"))
        rows = best.withColumn("state", state).withColumn("before", near).withColumn("begins", begins)
        rows = rows.withColumn("look", F.col("new") | F.coalesce(F.col("before.new"), F.lit(False)))
        met = _written(rows.filter(F.col("look") | (F.size("fresh") > 0)).select(*ks, "s", "v", "d", "tb", "begins", "look", "fresh"), "seen")
        seen = met.filter("look").drop("look", "fresh")
        new = met.select(*ks, "s", F.explode("fresh").alias("x")).select(*ks, "s", "x.*")
        bucket = F.lit(0)
    else:
        new = _matched(batch.dropDuplicates([*ks, "s", "tb"]), logged.select(*ks, "s", "tb"), [*ks, "s", "tb"], "left_anti")
        new = _written(new, "fresh")
        rows = _matched(logged, touched, ks, "left_semi").withColumn("new", F.lit(False)).unionByName(new.withColumn("new", F.lit(True)))
        best = rows.groupBy(*ks, "s").agg(F.max_by(F.struct("v", "d", "tb", "new"), "tb").alias("x")).select(*ks, "s", "x.*")
        best = _written(best, "merged")
        bucket = sequence_bucket(best, column="s", least=1)
        rows = beside(best.withColumn("b", bucket).withColumn("state", state), ks, "b", "s", F.struct("state", "new"), "before")
        seen = rows.filter(F.col("new") | F.coalesce(F.col("before.new"), F.lit(False)))
        seen = _written(seen.select(*ks, "s", "v", "d", "tb", begins.alias("begins")), "seen")

    old = _written(_matched(old, touched, ks, "left_semi"), "runs")
    kept = _matched(old, seen.select(*ks, "s"), [*ks, "s"], "left_anti").drop("e")
    starts = kept.unionByName(seen.filter("begins").drop("begins")).withColumn("b", bucket)
    if whole:
        ended = starts.withColumn("e", F.lead("s").over(Window.partitionBy(*ks).orderBy("s"))).drop("b")
    else:
        ended = beside(starts, ks, "b", "s", F.struct(F.col("s").alias("s")), "next", after=True).withColumn("e", F.col("next.s")).drop("b", "next")
    ended = _written(ended, "spliced")

    out = lambda df, *more: df.select("v.*", F.col("s").alias(START), F.col("e").alias(END), F.col("d").alias(DELETED), F.col("tb").alias(TIEBREAK), *more)
    mark = [*ks, "s", "tb", "e"]
    puts, drops = _matched(ended, old.select(*mark), mark, "left_anti"), _matched(old, ended.select(*ks, "s"), [*ks, "s"], "left_anti")
    changes = out(puts, F.lit(True).alias("__put")).unionByName(out(drops, F.lit(False).alias("__put")))
    others = _matched(own(runs, START), touched, ks, "left_anti")
    fresh = new.select("v.*", F.col("s").alias(SEQ), F.col("d").alias(DELETED), F.col("tb").alias(TIEBREAK)).select(*prepared.columns)
    return out(others).unionByName(out(ended)), changes, fresh


def compacted(log: DataFrame, keys: Sequence[str], bound: Column) -> DataFrame:
    """What a log must keep when no change before ``bound`` can come any more: rows from the bound on, and each key's last before."""
    open_ = F.coalesce(F.col(SEQ) >= bound, F.lit(False))
    rest = [c for c in log.columns if c not in keys]
    closed = log.filter(~open_)
    place = F.struct(F.col(SEQ), F.col(TIEBREAK))
    last = closed.groupBy(*keys).agg(F.max_by(F.struct(*rest), place).alias("x")).select(*keys, "x.*").select(*log.columns)
    return log.filter(open_).unionByName(last)
