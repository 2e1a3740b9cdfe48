"""Quarantined rows, one folder per ``(query, batch)``, overwritten on replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import path_exists


class QuarantineSink:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, rows: DataFrame, query: str, batch_id: int) -> None:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/_query={query}/_batch_id={batch_id}")

    def read(self, schema=None) -> DataFrame:
        """All quarantined rows with ``_query`` and ``_batch_id``.  Before anything was
        quarantined there is no file to take a schema from: pass ``schema`` to get
        an empty frame instead of an error."""
        if schema is not None and not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", self.root).parquet(f"{self.root}/_query=*/_batch_id=*")
