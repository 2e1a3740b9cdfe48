"""A table monitor kept as plain tables: definition, profile, refresh log.

Layout under ``root``::

    definition/   one row: table, timestamp column, granularity, columns
    profile/      the long profile, partitioned by window (``_wkey``), or by the day that windows of less than a day begin in
    refreshes/    the refresh log, one row per refresh

A full refresh replaces the whole profile.  ``run_refresh(changed=...)`` recomputes
only the windows that changed rows fall into, over the whole current source, and
overwrites exactly those window partitions (dynamic partition overwrite);
``changed`` must also hold deleted rows, so that windows they leave empty vanish.  The profile is derived data: a
refresh that fails half-way is repaired by running it again.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import GRANULARITIES, UNITS, micros, profile, window_start, window_starts
from ..sources.literal import literal_rows

WKEY = "_wkey"
DAY = UNITS["day"]


# The length of each granularity as an interval.
INTERVALS = {"1 hour": "INTERVAL 1 HOUR", "1 day": "INTERVAL 1 DAY", "1 week": "INTERVAL 7 DAY",
             "1 month": "INTERVAL 1 MONTH", "1 year": "INTERVAL 1 YEAR"}


def in_windows(source: DataFrame, ts_col: str, touched: DataFrame, granularity: str, slide: str | None = None) -> DataFrame:
    """Rows of ``source`` in the windows of ``touched`` (one ``window_start`` column).

    The least and last window become one range on the raw column, which the
    scan can push down; a null-safe semi join picks the windows in between, if they don't overlap.
    """
    ts, kind = F.col(ts_col), source.schema[ts_col].dataType
    length = INTERVALS[granularity] if granularity in GRANULARITIES else f"INTERVAL {micros(granularity) / 1e6:.6f} SECOND"
    lo, hi, null = touched.agg(F.min("window_start").cast("string"),
                               (F.max("window_start") + F.expr(length)).cast("string"),
                               F.max(F.col("window_start").isNull())).first()
    within = F.lit(False) if lo is None else (ts >= F.lit(lo).cast(kind)) & (ts < F.lit(hi).cast(kind))
    if null:
        within = within | ts.isNull()
    own = source.filter(within)
    if slide is not None:
        return own
    own, keys = own.withColumn(WKEY, window_start(ts, granularity)), touched.select(F.col("window_start").alias("_w"))
    return own.join(keys, own[WKEY].eqNullSafe(keys["_w"]), "left_semi").drop(WKEY)


class Monitor:
    def __init__(self, spark: SparkSession, root: str, table_name: str, ts_col: str | None = None,
                 granularity: str = "1 day", columns: Sequence[str] | None = None, exact: bool = False,
                 mode_columns: Sequence[str] = (), slide: str | None = None):
        self.slide = slide
        self.spark, self.root, self.table_name = spark, root.rstrip("/"), table_name
        self.ts_col, self.granularity = ts_col, granularity
        self.columns, self.exact, self.mode_columns = list(columns) if columns else None, exact, list(mode_columns)

    # -- definition (create / get)
    def create(self) -> "Monitor":
        row = [(self.table_name, self.ts_col, self.granularity, self.columns, self.exact, self.slide)]
        (literal_rows(self.spark, row, "table_name string, ts_col string, granularity string, "
                                       "columns array<string>, exact boolean, slide string")
             .write.mode("overwrite").parquet(f"{self.root}/definition"))
        return self

    def get(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/definition")

    # -- refresh
    def run_refresh(self, source: DataFrame, changed: DataFrame | None = None) -> str:
        """Full refresh when ``changed`` is None, else only the windows ``changed`` touches."""
        refresh_id, started = uuid.uuid4().hex, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        if changed is not None and self.ts_col:
            starts = F.transform(window_starts(F.col(self.ts_col), self.granularity, self.slide), self._part)
            touched = changed.select(F.explode(starts).alias("window_start")).distinct().persist()
            try:
                prof = self._profiled(self._rows_of(source, touched))
                if self._short() or self.slide:  # windows beside the touched ones have not all their rows here
                    only = touched.select(F.col("window_start").alias("_w"))
                    prof = prof.join(only, self._part(prof["window_start"]).eqNullSafe(only["_w"]), "left_semi")
                columns = F.array(*[F.lit(c) for c in self.columns or source.columns if c != self.ts_col])
                gone = touched.select("window_start", F.explode(columns).alias("column_name"),
                                      F.lit(0).cast("long").alias("row_count"))
                # a touched part without rows leaves a row_count of 0, which readers do not see
                have = prof.select(self._part(F.col("window_start")).alias("_w")).distinct()
                gone = gone.join(have, gone["window_start"].eqNullSafe(have["_w"]), "left_anti")
                self._write(prof.unionByName(gone, allowMissingColumns=True), "dynamic")
                windows = touched.count()
            finally:
                touched.unpersist()
        else:
            windows = None
            self._write(self._profiled(source), "static")
        log = [(refresh_id, self.table_name, started, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None),
                "SUCCESS", "full" if changed is None else "incremental", windows)]
        (literal_rows(self.spark, log, "refresh_id string, table_name string, started_at timestamp_ntz, "
                                       "finished_at timestamp_ntz, state string, kind string, windows int")
             .write.mode("append").parquet(f"{self.root}/refreshes"))
        return refresh_id

    def _short(self) -> bool:
        """Windows of less than a day, which share the folder of the day they begin in."""
        return self.granularity == "1 hour" or self.granularity not in GRANULARITIES and micros(self.granularity) < DAY

    def _part(self, start: Column) -> Column:
        return F.date_trunc("day", start) if self._short() else start

    def _rows_of(self, source: DataFrame, touched: DataFrame) -> DataFrame:
        """All rows of the windows that lie in the touched parts."""
        if not self._short():
            return in_windows(source, self.ts_col, touched, self.granularity, self.slide)
        if self.slide or DAY % micros(self.granularity):  # a window may go on after midnight
            after = touched.select((F.col("window_start") + F.expr("INTERVAL 1 DAY")).alias("window_start")).filter("window_start is not null")
            touched = touched.unionByName(after).distinct()
        return in_windows(source, self.ts_col, touched, "1 day")

    def _profiled(self, source: DataFrame) -> DataFrame:
        return profile(source, self.columns, self.ts_col, self.granularity, self.exact, self.mode_columns, slide=self.slide)

    def _write(self, prof: DataFrame, overwrite: str) -> None:
        (prof.withColumn(WKEY, self._part(F.col("window_start")).cast("string"))
             .write.mode("overwrite").option("partitionOverwriteMode", overwrite)
             .partitionBy(WKEY).parquet(f"{self.root}/profile"))

    # -- reads
    def read_profile(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/profile").drop(WKEY).filter("row_count > 0")

    def list_refreshes(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/refreshes")
