"""Bronze -> silver streams.

``bronze_to_silver`` is the reference's main path as one Structured Streaming
query: a stream over the bronze table, projected to the target's columns, and a
``foreachBatch`` function that per micro-batch

1. reads the rules (each batch, so rule edits apply - S10),
2. dedupes and judges the batch (:func:`sluice.plans.silver.silver_batch`),
   persisted once because three sinks consume it,
3. overwrites the batch's own quarantine folder (replay-safe - S6),
4. upserts the valid rows into the buckets of their keys (idempotent on replay),
5. writes one metrics row for the batch: one aggregate over the persisted pass,
   with the rows that came in observed by that same pass, so that rows removed
   by dedupe are reported.

``first_wins=True`` adds the reference's stream-level ``dropDuplicates`` with
never-expiring state (S4); ``watermark=(col, delay)`` bounds that state.  The rows
it removes never reach the batch: :func:`source_rows` tells how many came in.
``bronze_to_silvers`` serves several targets from one stream, so the bronze is
scanned once per batch instead of once per target (I6).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.rules import Rule, validate_rules
from ..operators.dedupe import dedupe_stream
from ..operators.split import FAILED_COL, STATUS_COL, UNKNOWN_COL, quality_metrics
from ..plans.silver import silver_batch
from ..sinks.bucketed import BucketedTable, batch_version
from ..sinks.quarantine import QuarantineSink

RulesLike = Sequence[Rule] | Callable[[], Sequence[Rule]]


@dataclass
class SilverTarget:
    name: str
    table: BucketedTable
    columns: Sequence[str]
    keys: Sequence[str]
    rules: RulesLike
    quarantine: QuarantineSink
    order_by: Sequence[str | Column] | None = None
    carry: Sequence[str] = ()
    null_policy: str = "quarantine"
    validate_first: bool = False
    metrics_path: str | None = None
    feed_path: str | None = None  # each batch's row-level changes of the table go below it

    def current_rules(self) -> list[Rule]:
        return list(self.rules() if callable(self.rules) else self.rules)


def _query_tag(batch_df: DataFrame, fallback: str) -> str:
    """The running query's id (stable across restarts on one checkpoint)."""
    try:
        qid = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    except Exception:  # e.g. no local properties on this client
        qid = None
    return qid or fallback


def process_batch(target: SilverTarget, batch_df: DataFrame, batch_id: int, tag: str) -> None:
    """The per-batch plan for one target (also usable on a plain batch DataFrame)."""
    cols = list(dict.fromkeys([*target.columns, *target.carry]))
    rules = target.current_rules()
    validate_rules(batch_df.select(*cols), rules)  # analysis only: a bad rule fails by name, before any write
    came = Observation()
    judged = silver_batch(batch_df.select(*cols).observe(came, F.count(F.lit(1)).alias("rows")), target.columns, target.keys, rules,
                          order_by=target.order_by, null_policy=target.null_policy,
                          validate_first=target.validate_first, carry=target.carry)
    judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        quarantined = judged.filter(F.col(STATUS_COL) == "quarantine").drop(STATUS_COL, UNKNOWN_COL)
        target.quarantine.write(quarantined.withColumn("_failed_rules", F.col(FAILED_COL)), tag, batch_id)
        valid = judged.filter(F.col(STATUS_COL) == "valid").drop(FAILED_COL, STATUS_COL, UNKNOWN_COL)
        feed = {"feed": f"{target.feed_path}/_query={tag}/_batch_id={batch_id}"} if target.feed_path else {}
        target.table.upsert(valid, batch_version(batch_id, tag), check=False, **feed)  # the dedupe has made keys unique
        if target.metrics_path:
            rows_in = came.get["rows"]  # before dedupe (S7), counted by the pass above
            (quality_metrics(judged)
                .withColumn("input_rows", F.lit(rows_in))
                .withColumn("removed_by_dedupe", F.lit(rows_in) - F.col("total_rows"))
                .withColumn("batch_id", F.lit(batch_id)).withColumn("query", F.lit(tag))
                .write.mode("overwrite").parquet(f"{target.metrics_path}/_query={tag}/_batch_id={batch_id}"))
    finally:
        judged.unpersist()


def bronze_to_silvers(source: DataFrame, targets: Sequence[SilverTarget], checkpoint: str,
                      first_wins_keys: Sequence[str] | None = None, watermark: tuple[str, str] | None = None,
                      available_now: bool = True, query_name: str | None = None, parallel_targets: bool = True):
    """Start one streaming query feeding every target; returns the ``StreamingQuery``.

    The micro-batch is persisted once; with ``parallel_targets`` the targets'
    jobs are submitted from one driver thread each, so they share the cluster
    instead of queueing behind each other.  Each target's sinks are replay-safe
    on their own, so a failure in one target fails the batch and the retry
    re-applies all of them idempotently."""
    needed = list(dict.fromkeys(c for t in targets for c in [*t.columns, *t.carry]))
    df = source.select(*needed)
    if first_wins_keys:
        df = df.observe("source", F.count(F.lit(1)).alias("rows"))
        ts, delay = watermark if watermark else (None, None)
        df = dedupe_stream(df, first_wins_keys, ts, delay)

    fallback = query_name or "-".join(t.name for t in targets)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        tag = _query_tag(batch_df, fallback)
        if len(targets) == 1:
            process_batch(targets[0], batch_df, batch_id, tag)
            return
        cached = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if parallel_targets:
                from concurrent.futures import ThreadPoolExecutor

                with ThreadPoolExecutor(max_workers=len(targets)) as pool:
                    for f in [pool.submit(process_batch, t, cached, batch_id, tag) for t in targets]:
                        f.result()
            else:
                for t in targets:
                    process_batch(t, cached, batch_id, tag)
        finally:
            cached.unpersist()

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def bronze_to_silver(source: DataFrame, target: SilverTarget, checkpoint: str, first_wins: bool = False,
                     watermark: tuple[str, str] | None = None, available_now: bool = True):
    """One target, as in the reference's ``process_bronze_to_silver``."""
    return bronze_to_silvers(source, [target], checkpoint, list(target.keys) if first_wins else None,
                             watermark, available_now)


def run_to_end(query) -> None:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def source_rows(query) -> dict[int, int]:
    """Rows that entered each recent batch of a ``first_wins`` query, before the stream-level dedupe."""
    return {p["batchId"]: p["observedMetrics"]["source"]["rows"] for p in query.recentProgress if "source" in p["observedMetrics"]}


def batch_folder_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function writing each micro-batch to ``path/_batch_id=<n>``
    (overwrite, so a replayed batch replaces its own output)."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")
    return write
