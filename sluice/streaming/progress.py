"""Metrics of a stream from its progress events (D6, D7): no job of their own, one small file per batch.

Counts are attached to the streaming plan with ``observe``; Spark reports them when a batch ends, and a
``StreamingQueryListener`` writes them, by query and batch id. A batch that is replayed after a crash reports again
under its id and replaces what it wrote before.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.rules import Rule, as_rules, one_per_name
from ..operators.expectations import passes
from ..sources.literal import literal_rows

METRICS = "expectations"
SCHEMA = "batch_id bigint, rule_name string, action string, passed_rows bigint, failed_rows bigint"


def observed_expectations(stream: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """The stream with rows and failures per rule observed, by place of the rule, so that any rule name will do."""
    rules = one_per_name(as_rules(rules))
    failed = [F.count_if(~passes(r)).alias(f"failed_{i}") for i, r in enumerate(rules)]
    return stream.observe(METRICS, F.count(F.lit(1)).alias("rows"), *failed)


class ExpectationsListener(StreamingQueryListener):
    """Writes the observed counts of every batch of one query to ``path/_query=<id>/_batch_id=<n>``.

    Events come in order and after their batch; ``failures`` holds what went wrong while writing, as an exception here
    could not reach the query.
    """

    def __init__(self, spark: SparkSession, rules: Iterable[Rule], path: str):
        self.spark, self.rules, self.path = spark, one_per_name(as_rules(rules)), path.rstrip("/")
        self.failures: list[Exception] = []
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        seen = progress.get("observedMetrics", {}).get(METRICS)
        if not seen or not progress.get("numInputRows"):
            return
        batch, rows = progress["batchId"], seen["rows"]
        out = [(batch, r.name, r.action, rows - seen[f"failed_{i}"], seen[f"failed_{i}"]) for i, r in enumerate(self.rules)]
        try:
            literal_rows(self.spark, out, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_query={progress['id']}/_batch_id={batch}")
        except Exception as e:
            self.failures.append(e)

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def read(self) -> DataFrame:
        if self.failures:
            raise self.failures[0]
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/_query=*/_batch_id=*")
