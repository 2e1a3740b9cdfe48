"""Change application: slowly-changing dimensions type 1 and type 2.

Input is a change stream: rows carrying the key, the columns, a sequence
(``sequence_by``) that orders changes of a key, and optionally a delete marker
(``delete_when``).  Out-of-order (late) changes are resolved by the sequence,
not by arrival.

* Type 1 keeps the latest state per key.  Its stored form keeps ``__seq`` and a
  ``__deleted`` tombstone, so a late, older row can neither overwrite a newer one
  nor revive a deleted key.
* Type 2 keeps every version as an interval ``[__start_at, __end_at)``; a change
  equal to the previous version on the tracked columns is a no-op, a delete
  closes the open interval.  Incremental application keeps the full change log
  and rebuilds only the keys a batch touches (rebuilding from collapsed history
  is wrong once late rows arrive).

Rows of a key that tie on the sequence are one change: the one of largest row
hash stays (:func:`one_per_sequence`, map-side combined), so results do not depend
on partitioning and no version has length zero; ``strict=True`` raises instead when
such rows differ.  Type 2 windows by ``(key, bucket of the sequence)`` with bucket
edges taken from the data (:func:`sequence_bucket`), so a hot key is spread over
many tasks whatever the type of its sequence; type 1 ranks with a partial ``WindowGroupLimit`` before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import set_aside
from ..session import scratch_path
from .dedupe import dedupe_latest

SEQ, DELETED, TIEBREAK = "__seq", "__deleted", "__tb"
START, END = "__start_at", "__end_at"
BUCKET = "_seq_bucket"
#: Names that the type 2 plan uses inside; input columns of these names are set aside.
HELPERS = [BUCKET, "_st", "_pos", "_mk", "_m", "_prev_st", "_start", "_end", "_rk", "_cand", "_best", "lo", "hi", "first_st", "first_lo", "second_lo",
           "last_st", "prev_last", "next_change"]


def prepare_changes(changes: DataFrame, keys: Sequence[str], sequence_by: str | Sequence[str],
                    columns: Sequence[str] | None = None, except_columns: Sequence[str] = (),
                    delete_when: str | Column | None = None) -> DataFrame:
    """Project a change stream to ``keys + columns + __seq + __deleted + __tb`` (F5: ``except_columns``)."""
    seq_cols = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    cols = list(columns) if columns is not None else [c for c in changes.columns if c not in seq_cols]
    cols = [c for c in dict.fromkeys([*keys, *cols]) if c not in set(except_columns) or c in keys]
    seq = F.col(seq_cols[0]) if len(seq_cols) == 1 else F.struct(*[F.col(c) for c in seq_cols])
    if delete_when is None:
        deleted = F.lit(False)
    else:
        d = F.expr(delete_when) if isinstance(delete_when, str) else delete_when
        deleted = F.coalesce(d, F.lit(False))
    out = changes.select(*cols, seq.alias(SEQ), deleted.alias(DELETED))
    return out.withColumn(TIEBREAK, F.xxhash64(*[F.col(c) for c in out.columns]))


def one_per_sequence(p: DataFrame, keys: Sequence[str], strict: bool = False) -> DataFrame:
    """One prepared row per (key, sequence): the largest row hash of those that tie."""
    rest = [c for c in p.columns if c not in (*keys, SEQ, TIEBREAK)]
    ident = [*keys, SEQ]
    if strict:
        tie = p.groupBy(*ident).agg(F.min(TIEBREAK).alias("a"), F.max(TIEBREAK).alias("b")).filter("a <> b").limit(1).collect()
        if tie:
            raise ValueError(f"different changes of one key tie on their sequence: {tie[0].asDict()}")
    best = p.groupBy(*ident).agg(F.max_by(F.struct(TIEBREAK, *rest), TIEBREAK).alias("_best"))
    return best.select(*ident, "_best.*").select(*p.columns)


#: Buckets of the sequence: so many, or more if that makes them larger than so many rows, but this many at most; and
#: values (in expectation) that the edges are taken from.
SEQUENCE_BUCKETS, ROWS_A_BUCKET, MOST_BUCKETS, EDGE_SAMPLE = 64, 500_000, 4096, 40_000
#: Rows of a key up to which it is windowed as a whole.
ROWS_A_KEY = 4_000


def sequence_bucket(p: DataFrame, rows_a_bucket: int = ROWS_A_BUCKET, sample: int = EDGE_SAMPLE, column: str = SEQ,
                    least: int = SEQUENCE_BUCKETS) -> Column:
    """A non-decreasing bucket of the sequence for any orderable type (structs, strings and decimals too).

    Edges are quantiles of a bounded sample of the values, and there are as many as the rows ask for, so the buckets
    follow the data. They only steer how work is split, never the result. ``p`` is read twice, for its count and for its
    sequence: pass a written frame.
    """
    n = p.count()
    buckets = min(MOST_BUCKETS, max(least, -(-n // rows_a_bucket)))
    if buckets < 2 or not n:
        return F.lit(0)
    values = p.select(column).filter(F.col(column).isNotNull()).sample(min(1.0, sample / n), seed=7).distinct()
    cut = values.select(column, F.ntile(buckets).over(Window.orderBy(column)).alias("b")).groupBy("b").agg(F.min(column).alias("edge"))
    edges = [r["edge"] for r in cut.orderBy("b").collect()][1:]
    if not edges:
        return F.lit(0)
    kind = p.schema[column].dataType

    def literal(value) -> Column:
        if hasattr(kind, "fields"):
            return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])
        return F.lit(value).cast(kind)

    below = lambda own: F.size(F.filter(F.array(*[literal(e) for e in own]), lambda e: e <= F.col(column)))
    step = max(1, int(len(edges) ** 0.5))  # of many edges, first the group, then the place in it
    groups = [edges[i : i + step] for i in range(0, len(edges), step)]
    if len(groups) == 1:
        return below(edges)
    group = below([g[0] for g in groups])
    out = F.lit(0)
    for i, own in enumerate(groups):
        out = F.when(group == i + 1, F.lit(i * step) + below(own)).otherwise(out)
    return out


def all_keys_small(rows: DataFrame, keys: Sequence[str], rows_a_bucket: int | None = None) -> bool:
    """Whether no key (NULL is one) has more rows than a bucket may hold, so that each key fits one task and needs no buckets.
    One map-side combined count; reads the keys alone."""
    most = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).count().agg(F.max("count")).first()[0]
    return (most or 0) <= (ROWS_A_KEY if rows_a_bucket is None else rows_a_bucket)


# ---------------------------------------------------------------- type 1

def _keyed(df: DataFrame, keys: Sequence[str], touched: DataFrame, how: str) -> DataFrame:
    """Semi / anti join with the batch's distinct keys, NULL-safe so that a NULL key
    is one key, as in the windows.  The key set is small per batch; AQE broadcasts
    it when its measured size is under the threshold, so the state is not shuffled."""
    left, right = df.alias("_s"), touched.alias("_t")
    cond = reduce(lambda a, b: a & b, [F.col(f"_s.{k}").eqNullSafe(F.col(f"_t.{k}")) for k in keys])
    return left.join(right, cond, how).select(*[F.col(f"_s.{c}") for c in df.columns])


def _latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dedupe_latest(rows, keys, [F.col(SEQ).desc(), F.col(TIEBREAK).desc()], tiebreak=False)


def scd1_state(prepared: DataFrame, keys: Sequence[str], state: DataFrame | None = None) -> DataFrame:
    """New stored state (with ``__seq``/``__deleted``) after applying a prepared batch.

    Only keys present in the batch are re-ranked: ``state ▷ touched`` passes through,
    ``latest(state ⋉ touched ∪ batch)`` replaces the rest."""
    if state is None:
        return _latest(prepared, keys)
    touched = prepared.select(*keys).distinct()
    untouched = _keyed(state, keys, touched, "left_anti")
    return untouched.unionByName(_latest(_keyed(state, keys, touched, "left_semi").unionByName(prepared), keys))


def scd1_view(state: DataFrame) -> DataFrame:
    """Visible rows: tombstones hidden, helper columns dropped."""
    return state.filter(~F.col(DELETED)).drop(SEQ, DELETED, TIEBREAK)


def scd1(changes: DataFrame, keys: Sequence[str], sequence_by: str | Sequence[str],
         columns: Sequence[str] | None = None, except_columns: Sequence[str] = (),
         delete_when: str | Column | None = None, state: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """F2 (+F4, F5) in one call: returns the new stored state."""
    p = prepare_changes(changes, keys, sequence_by, columns, except_columns, delete_when)
    if strict:
        p = one_per_sequence(p, keys, strict)
    return scd1_state(p, keys, state)


# ---------------------------------------------------------------- type 2

def scd2_from_prepared(p: DataFrame, keys: Sequence[str], track_columns: Sequence[str] | None = None,
                       bucket: Column | None = None, strict: bool = False, keep_deleted: bool = False) -> DataFrame:
    """Versions with ``__start_at``/``__end_at`` from prepared change rows; with ``keep_deleted`` the deleted
    stretches too, marked, and the row hash of the row that began each (the stored form of :mod:`.splice`).

    A row's *state* is ``(deleted, tracked columns)`` (all deletes share one state).
    A version starts at a row whose state differs from the previous row's and
    ends at the next such row.  Both are found in one window over
    ``(key, bucket)``; the window sees the neighbouring buckets through two
    marker rows per bucket, built from an aggregate of the raw rows:

    * per ``(key, bucket, state)`` the first and last position (map-side partial);
    * per ``(key, bucket)``: first state, first position, the first position of
      any *other* state (the bucket's first change), and the last state;
    * per key over buckets: the previous bucket's last state (head marker) and the
      first change after the bucket (tail marker) - a bucket whose rows all keep
      the carried state is skipped.

    So a key holding a third of the rows is split by bucket, and the change rows
    are shuffled once for the window (no second pass, no join).

    Where no key has more than ROWS_A_KEY rows, none is split: the rows are shuffled once, by key, for all steps.
    """
    p, aside = set_aside(p, HELPERS)
    keys, track_columns = [aside.get(k, k) for k in keys], track_columns and [aside.get(c, c) for c in track_columns]
    value_cols = [c for c in p.columns if c not in (SEQ, DELETED, TIEBREAK)]
    tracked = list(track_columns) if track_columns is not None else [c for c in value_cols if c not in keys]
    whole = bucket is None and bool(keys) and all_keys_small(p, keys)
    p = one_per_sequence(p.repartition(*[F.col(f"`{k}`") for k in keys]) if whole else p, keys, strict)
    if bucket is None and not whole:  # counted, sampled and windowed: computed once
        path = scratch_path(p.sparkSession, "changes")
        p.write.parquet(path)
        p = p.sparkSession.read.schema(p.schema).parquet(path)
        bucket = sequence_bucket(p)
    state = F.struct(F.col(DELETED).alias("d"),
                     *[F.when(~F.col(DELETED), F.col(c)).alias(c) for c in tracked])
    pos = F.struct(F.col(SEQ).alias("seq"), F.col(TIEBREAK).alias("tb"))
    given = {now: name for name, now in aside.items()}
    values = [F.col(f"`{c}`").alias(given.get(c, c)) for c in value_cols]

    def out(kept: DataFrame) -> DataFrame:
        return (kept.filter(F.lit(keep_deleted) | ~F.col(DELETED))
                .select(*values, F.col(SEQ).alias(START), F.col("_end.seq").alias(END), *([DELETED, TIEBREAK] if keep_deleted else [])))
    if whole:
        w = Window.partitionBy(*keys).orderBy("_pos")
        d = p.withColumn("_st", state).withColumn("_pos", pos).withColumn("_prev_st", F.lag("_st").over(w))
        starts = d.filter(F.col("_prev_st").isNull() | ~F.col("_st").eqNullSafe(F.col("_prev_st")))
        return out(starts.withColumn("_end", F.lead("_pos").over(w)))
    d = p.withColumn(BUCKET, bucket).withColumn("_st", state).withColumn("_pos", pos)

    # bucket summary from the raw rows
    per_state = d.groupBy(*keys, BUCKET, "_st").agg(F.min("_pos").alias("lo"), F.max("_pos").alias("hi"))
    wb = Window.partitionBy(*keys, BUCKET).orderBy("lo")
    wb_all = wb.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_bucket = (per_state
                  .withColumn("_rk", F.row_number().over(wb))
                  .withColumn("second_lo", F.nth_value("lo", 2).over(wb_all))
                  .withColumn("last_st", F.max_by("_st", "hi").over(Window.partitionBy(*keys, BUCKET)))
                  .filter(F.col("_rk") == 1)
                  .select(*keys, BUCKET, F.col("_st").alias("first_st"), F.col("lo").alias("first_lo"),
                          "second_lo", "last_st"))
    wk = Window.partitionBy(*keys).orderBy(BUCKET)
    prev_last = F.lag("last_st").over(wk)
    per_bucket = per_bucket.withColumn("prev_last", prev_last)
    # first change in this bucket relative to the state carried in from before it
    cand = F.when(F.col("prev_last").isNull() | ~F.col("first_st").eqNullSafe(F.col("prev_last")),
                  F.col("first_lo")).otherwise(F.col("second_lo"))
    per_bucket = per_bucket.withColumn("_cand", cand).withColumn(
        "next_change", F.first("_cand", ignorenulls=True).over(
            wk.rowsBetween(1, Window.unboundedFollowing)))

    # one window over data rows plus head / tail markers
    st_type = d.schema["_st"].dataType
    pos_type = d.schema["_pos"].dataType
    others = [c for c in d.columns if c not in keys and c not in (BUCKET, "_st", "_pos")]
    nulls = [F.lit(None).cast(d.schema[c].dataType).alias(c) for c in others]
    marks = per_bucket.select(*keys, BUCKET, F.explode(F.array(
        F.struct(F.lit(0).alias("mk"), F.col("prev_last").cast(st_type).alias("st"),
                 F.lit(None).cast(pos_type).alias("pos")),
        F.struct(F.lit(2).alias("mk"), F.lit(None).cast(st_type).alias("st"),
                 F.col("next_change").cast(pos_type).alias("pos")))).alias("_m"))
    marks = marks.select(*keys, BUCKET, *nulls, F.col("_m.st").alias("_st"), F.col("_m.pos").alias("_pos"),
                         F.col("_m.mk").alias("_mk"))
    u = d.select(*keys, BUCKET, *others, "_st", "_pos", F.lit(1).alias("_mk")).unionByName(marks)
    w = Window.partitionBy(*keys, BUCKET).orderBy("_mk", "_pos")
    u = u.withColumn("_prev_st", F.lag("_st").over(w))
    starts = F.when(F.col("_mk") == 2, F.lit(True)).otherwise(
        F.col("_prev_st").isNull() | ~F.col("_st").eqNullSafe(F.col("_prev_st")))
    u = u.withColumn("_start", starts & (F.col("_mk") > 0))
    u = u.withColumn("_end", F.first(F.when(F.col("_start"), F.col("_pos")), ignorenulls=True).over(
        w.rowsBetween(1, Window.unboundedFollowing)))
    return out(u.filter((F.col("_mk") == 1) & F.col("_start")))


def scd2(changes: DataFrame, keys: Sequence[str], sequence_by: str | Sequence[str],
         columns: Sequence[str] | None = None, except_columns: Sequence[str] = (),
         delete_when: str | Column | None = None, track_columns: Sequence[str] | None = None,
         bucket: Column | None = None, strict: bool = False) -> DataFrame:
    """F3 (+F4, F5), batch form: the full history of every key."""
    p = prepare_changes(changes, keys, sequence_by, columns, except_columns, delete_when)
    return scd2_from_prepared(p, keys, track_columns, bucket, strict)


def scd2_apply(log: DataFrame | None, history: DataFrame | None, prepared: DataFrame, keys: Sequence[str],
               track_columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Incremental type 2: returns ``(log', history')``.

    Only keys present in the batch are rebuilt, from their full change log; a
    replayed batch adds nothing to the log (anti join on key, sequence and row
    hash), so applying it twice gives the same history.
    """
    return scd2_log_append(log, prepared, keys), scd2_history_update(log, history, prepared, keys, track_columns)


def _fresh(log: DataFrame, prepared: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(log rows of the batch's keys, batch rows not yet in the log)``."""
    ident = [*keys, SEQ, TIEBREAK]
    touched = prepared.select(*keys).distinct()
    log_touched = _keyed(log, keys, touched, "left_semi")
    fresh = _keyed(prepared.dropDuplicates(ident), ident, log_touched.select(*ident), "left_anti")
    return log_touched, fresh


def scd2_log_append(log: DataFrame | None, prepared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The change log after a batch (replay adds nothing)."""
    if log is None:
        return prepared.dropDuplicates([*keys, SEQ, TIEBREAK])
    return log.unionByName(_fresh(log, prepared, list(keys))[1])


def scd2_history_update(log: DataFrame | None, history: DataFrame | None, prepared: DataFrame,
                        keys: Sequence[str], track_columns: Sequence[str] | None = None) -> DataFrame:
    """The history after a batch, given the log and history *before* it."""
    keys = list(keys)
    if log is None:
        return scd2_from_prepared(prepared, keys, track_columns)
    log_touched, fresh = _fresh(log, prepared, keys)
    rebuilt = scd2_from_prepared(log_touched.unionByName(fresh), keys, track_columns)
    kept = _keyed(history, keys, prepared.select(*keys).distinct(), "left_anti")
    return kept.unionByName(rebuilt)
