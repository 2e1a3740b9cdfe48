"""Stored slices of mergeable profiles (G5): one folder per version of the source.

Layout under ``root``::

    slices/_version=<n>/   the slices that version n added (see :mod:`sluice.operators.sketches`)

``add`` reads the added rows only. ``replace`` is for deletions, which no sketch can undo: it computes the windows that
changed rows fall into from the whole current source, and its slices stand for all earlier ones of these windows. Both
overwrite their own version's folder, so a version that failed half-way or is replayed is simply written again.
Versions must rise with the source; ``compact`` merges the slices up to a version into one per window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import window_start
from ..operators.sketches import ITEMS, merged, slices
from .monitor import in_windows


class SketchStore:
    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str], ts_col: str, granularity: str, mode_columns: Sequence[str] = ()):
        self.spark, self.root, self.columns = spark, root.rstrip("/"), list(columns)
        self.ts_col, self.granularity, self.mode_columns = ts_col, granularity, list(mode_columns)

    def _slices(self, rows: DataFrame) -> DataFrame:
        return slices(rows, self.columns, self.ts_col, self.granularity, self.mode_columns)

    def _write(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/slices/_version={version:012d}")

    def add(self, rows: DataFrame, version: int) -> None:
        """New rows of the source."""
        self._write(self._slices(rows).withColumn("whole", F.lit(False)), version)

    def replace(self, source: DataFrame, changed: DataFrame, version: int) -> None:
        """Changes of other kinds: ``changed`` holds the rows that came and those that went, ``source`` all there are now."""
        touched = changed.select(window_start(F.col(self.ts_col), self.granularity).alias("window_start")).distinct()
        now = self._slices(in_windows(source, self.ts_col, touched, self.granularity))
        left = touched.join(now.select(F.col("window_start").alias("w")).distinct(), F.col("window_start").eqNullSafe(F.col("w")), "left_anti")
        gone = left.select("window_start", F.explode(F.array(*[F.lit(c) for c in self.columns])).alias("column_name"))
        self._write(now.unionByName(gone, allowMissingColumns=True).withColumn("whole", F.lit(True)), version)

    def parts(self) -> DataFrame:
        """The slices that count: none from before the last ``replace`` of their window."""
        stored = self.spark.read.option("basePath", f"{self.root}/slices").parquet(f"{self.root}/slices/_version=*")
        last = stored.filter("whole").groupBy(F.col("window_start").alias("w"), F.col("column_name").alias("c")).agg(F.max("_version").alias("since"))
        same = F.col("window_start").eqNullSafe(F.col("w")) & (F.col("column_name") == F.col("c"))
        valid = stored.join(last, same, "left").filter("since is null or _version >= since")
        return valid.filter("row_count > 0").drop("w", "c", "since", "whole", "_version")

    def read(self, granularity: str | None = None) -> DataFrame:
        return merged(self.parts(), granularity)

    def compact(self, version: int) -> None:
        """One slice a window and column instead of all so far; written as ``version``, which must be new."""
        group = ["window_start", "column_name"]
        own = self.parts()
        mean = F.sum(F.col("numbers") * F.col("mean")) / F.sum(F.nullif("numbers", F.lit(0)))
        means = own.groupBy(*group).agg(mean.alias("all_mean"))
        joined = own.join(means.select(F.col("window_start").alias("w"), F.col("column_name").alias("c"), "all_mean"),
                          F.col("window_start").eqNullSafe(F.col("w")) & (F.col("column_name") == F.col("c")))
        spread = F.col("square") + F.col("numbers") * F.pow(F.col("mean") - F.col("all_mean"), 2)
        once = joined.groupBy(*group).agg(
            *[F.sum(c).alias(c) for c in ("row_count", "num_nulls", "num_zeros", "numbers", "sum_length")], F.min("min").alias("min"),
            F.max("max").alias("max"), F.first("all_mean").alias("mean"), F.sum(spread).alias("square"), F.min("min_length").alias("min_length"),
            F.max("max_length").alias("max_length"), F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double("ranks").alias("ranks"),
            F.expr(f"approx_top_k_combine(items, {ITEMS})").alias("items"))
        self._write(once.withColumn("whole", F.lit(True)), version)


__all__ = ["SketchStore"]
