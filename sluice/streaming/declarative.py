"""The declarative path as a stream: expectations, then change application per
target (SURVEY §3.2; D7-D9, F2-F5, I5).

Per micro-batch: warn/drop expectations, counted by the same pass that keeps the
rows (one metrics row per rule), then for every target the kept rows are applied
as type 1 or type 2 changes to bucketed tables, touching the buckets of the
batch's keys only:

* type 1: one table holding the latest state per key with tombstones;
* type 2: the versions beside the changes, spliced into the history of the touched
  buckets, then the de-duplicated change log.

Both are idempotent, so a replayed batch changes nothing and a crashed one is
redone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, validate_rules
from ..operators.expectations import apply_expectations, observe_expectations
from ..operators.scd import END, SEQ, START, prepare_changes, scd1_state, scd1_view, scd2_log_append
from ..operators.splice import compacted, scd2_runs, scd2_splice_fresh, scd2_view
from ..session import path_exists
from ..sinks.bucketed import BUCKETS, BucketedTable
from ..sources.literal import literal_rows
from .bronze_to_silver import _query_tag


@dataclass
class ChangeTarget:
    """A table that changes are applied to.

    Type 2 keeps the change log and the history as runs, and splices each batch in (:mod:`sluice.operators.splice`).
    ``lateness`` (SQL over ``{seq}``, the largest sequence of all earlier batches, such as ``'{seq} - interval 2 days'``)
    bounds both: changes before that bound go to ``too_late`` and are not applied; of the log, the rows from the bound
    on and each key's last before it are kept; runs that ended before it are final and move to ``frozen``, which is
    only added to. Without it late changes are always applied and log and history grow.
    """

    name: str
    root: str
    keys: Sequence[str]
    sequence_by: str | Sequence[str]
    columns: Sequence[str] | None = None
    scd_type: int = 1
    delete_when: str | Column | None = None
    except_columns: Sequence[str] = field(default_factory=tuple)
    track_columns: Sequence[str] | None = None

    buckets: int = BUCKETS
    lateness: str | None = None

    def tables(self, spark) -> dict[str, BucketedTable]:
        names = ["state"] if self.scd_type == 1 else ["log", "history"]
        return {n: BucketedTable(spark, f"{self.root}/{n}", self.keys, self.buckets) for n in names}

    def read(self, spark) -> DataFrame:
        """The target as a user sees it: current state (type 1) or full history (type 2)."""
        t = self.tables(spark)
        if self.scd_type == 1:
            return scd1_view(t["state"].read())
        runs = t["history"].read()
        if path_exists(spark, f"{self.root}/frozen"):  # a run that a crash left in both is one
            runs = runs.unionByName(self._stored(spark, "frozen").select(*runs.columns)).dropDuplicates([*self.keys, START])
        return scd2_view(runs)

    def too_late(self, spark) -> DataFrame:
        return self._stored(spark, "too_late")

    def _stored(self, spark, name: str) -> DataFrame:
        return spark.read.option("basePath", f"{self.root}/{name}").parquet(f"{self.root}/{name}/_batch=*")

    def _bound(self, spark, batch_id: int) -> Column | None:
        """The bound that the batches before ``batch_id`` set; the same when it is replayed."""
        if self.lateness is None or not path_exists(spark, f"{self.root}/latest"):
            return None
        top = self._stored(spark, "latest").filter(F.col("_batch") < batch_id).agg(F.max(SEQ).alias("seq"))
        low = top.select(F.expr(self.lateness.format(seq="seq")).cast(top.schema["seq"].dataType).alias("b"))
        value, kind = low.first()["b"], low.schema["b"].dataType
        if value is None:
            return None
        return F.struct(*[F.lit(value[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields]) if hasattr(kind, "fields") else F.lit(value).cast(kind)

    def apply(self, kept: DataFrame, batch_id: int = 0) -> None:
        """One batch of changes. The history is written before the log, which says what has been applied."""
        spark = kept.sparkSession
        changes = prepare_changes(kept, self.keys, self.sequence_by, self.columns, self.except_columns, self.delete_when)
        t = self.tables(spark)
        if self.scd_type == 1:
            state = t["state"]
            touched = state.touched(changes)
            state.replace(scd1_state(changes, self.keys, state.part(touched) if state.exists() else None), touched)
            return
        log, history = t["log"], t["history"]
        bound = self._bound(spark, batch_id)
        if self.lateness is not None:
            changes.agg(F.max(SEQ).alias(SEQ)).write.mode("overwrite").parquet(f"{self.root}/latest/_batch={batch_id}")
        if bound is not None:
            late = F.coalesce(F.col(SEQ) < bound, F.lit(True))
            changes.filter(late).write.mode("overwrite").parquet(f"{self.root}/too_late/_batch={batch_id}")
            changes = changes.filter(~late)
        touched = log.touched(changes)
        before = log.part(touched) if log.exists() else None
        if before is None:
            runs, rows = scd2_runs(changes, self.keys, self.track_columns), scd2_log_append(None, changes, self.keys)
        else:
            runs, _, fresh = scd2_splice_fresh(history.part(touched), before, changes, self.keys, self.track_columns)
            rows = before.unionByName(fresh)
        if bound is not None:
            over = F.coalesce(F.col(END) <= bound, F.lit(False))
            runs.filter(over).write.mode("append").parquet(f"{self.root}/frozen/_batch={batch_id}")
            runs, rows = runs.filter(~over), compacted(rows, self.keys, bound)
        history.replace(runs, touched)
        log.replace(rows, touched)


def apply_changes_batch(batch_df: DataFrame, batch_id: int, tag: str, expectations: Sequence[Rule],
                        targets: Sequence[ChangeTarget], metrics_path: str | None = None) -> None:
    spark = batch_df.sparkSession
    validate_rules(batch_df, expectations)
    counted, seen = observe_expectations(batch_df, expectations)
    kept, rules = apply_expectations(counted, expectations)
    kept = kept.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for t in targets:
            t.apply(kept, batch_id)
        if metrics_path:
            if not targets:
                kept.count()
            got = seen.get
            rows = [(r.name, r.action, got["rows"] - got[f"failed_{r.name}"], got[f"failed_{r.name}"], batch_id) for r in rules]
            (literal_rows(spark, rows, "rule_name string, action string, passed_rows bigint, failed_rows bigint, batch_id bigint")
                 .write.mode("overwrite").parquet(f"{metrics_path}/_query={tag}/_batch_id={batch_id}"))
    finally:
        kept.unpersist()


def apply_changes_stream(source: DataFrame, expectations: Sequence[Rule], targets: Sequence[ChangeTarget],
                         checkpoint: str, metrics_path: str | None = None, available_now: bool = True):
    """Start the declarative-path query; returns the ``StreamingQuery``."""
    fallback = "-".join(t.name for t in targets)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        apply_changes_batch(batch_df, batch_id, _query_tag(batch_df, fallback), expectations, targets,
                            metrics_path)

    w = source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
