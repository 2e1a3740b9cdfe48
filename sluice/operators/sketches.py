"""Profiles that merge: bounded sketches per window and column, added to without reading what is already in them.

A slice holds, for each ``(window_start, column_name)`` of some rows, counts, sums about the mean, extremes, an HLL sketch
of the values (distinct counts), a KLL sketch of the numbers (percentiles) and a frequent-items sketch (mode). Slices of
other rows, and windows that make up a coarser one, merge by union. Stated errors, about three standard deviations:
``DISTINCT_ERROR`` of the distinct count, ``RANK_ERROR`` of the rows for the rank of a percentile; a mode is exact as
long as a column has no more than three quarters of ``ITEMS`` values, and otherwise right where it leads by that share.
Counts, extremes and lengths are exact, averages and deviations up to rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import GRANULARITIES, POINTS, _numeric, in_own_windows

LOG_REGISTERS, KLL_K, ITEMS = 12, 400, 1024
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.02


def _parts(i: int, t: T.DataType, mode: bool) -> dict[str, Column]:
    c = f"c{i}"
    num = f"cast({c} as double)" if _numeric(t) else "cast(null as double)"
    length = f"length({c})" if isinstance(t, T.StringType) else "cast(null as int)"
    parts = {
        "num_nulls": f"count_if({c} is null)", "num_zeros": f"count_if({num} = 0)", "min": f"min({num})", "max": f"max({num})",
        "numbers": f"count({num})", "mean": f"avg({num})", "square": f"var_pop({num}) * count({num})",
        "min_length": f"min({length})", "max_length": f"max({length})", "sum_length": f"sum(cast({length} as long))",
        "values": f"hll_sketch_agg(cast({c} as string), {LOG_REGISTERS})", "ranks": f"kll_sketch_agg_double({num}, {KLL_K})",
        "items": f"approx_top_k_accumulate(cast({c} as string), {ITEMS}) filter (where {c} is not null and {'true' if mode else 'false'})",
    }
    return {name: F.expr(sql) for name, sql in parts.items()}


def slices(df: DataFrame, columns: Sequence[str], ts_col: str | None, granularity: str, mode_columns: Sequence[str] = ()) -> DataFrame:
    """One row per ``(window_start, column_name)``: what these rows add. One scan, one aggregate with a map-side step."""
    types = [df.schema[c].dataType for c in columns]
    rows = in_own_windows(df, columns, ts_col, granularity)
    parts = [_parts(i, t, c in mode_columns) for i, (c, t) in enumerate(zip(columns, types))]
    wide = rows.groupBy("window_start").agg(F.count(F.lit(1)).alias("row_count"), *[p.alias(f"{name}_{i}") for i, own in enumerate(parts) for name, p in own.items()])
    cells = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{name}_{i}").alias(name) for name in parts[i]]) for i, c in enumerate(columns)]
    return wide.select("window_start", "row_count", F.explode(F.array(*cells)).alias("x")).select("window_start", "row_count", "x.*")


def merged(parts: DataFrame, granularity: str | None = None) -> DataFrame:
    """The profile of all rows that went into the slices, by their windows or by a coarser calendar unit."""
    if granularity is not None:
        parts = parts.withColumn("window_start", F.date_trunc(GRANULARITIES[granularity], "window_start"))
    group = ["window_start", "column_name"]
    every = Window.partitionBy(*group)
    mean = F.sum(F.col("numbers") * F.col("mean")).over(every) / F.sum(F.nullif("numbers", F.lit(0))).over(every)
    spread = F.col("square") + F.col("numbers") * F.pow(F.col("mean") - F.col("all_mean"), 2)
    out = parts.withColumn("all_mean", mean).groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in ("row_count", "num_nulls", "num_zeros", "numbers", "sum_length")],
        F.min("min").alias("min"), F.max("max").alias("max"), F.first("all_mean").alias("avg"), F.sum(spread).alias("square"),
        F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("num_distinct"), F.kll_merge_agg_double("ranks").alias("ranks"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(items, {ITEMS}), 64)").alias("items"))
    points = F.array(*[F.lit(p) for p in POINTS])
    q = F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("ranks", points))
    first = F.element_at("items", 1)["count"]
    top = F.array_min(F.transform(F.filter("items", lambda x: x["count"] == first), lambda x: x["item"]))
    texts = F.nullif(F.col("row_count") - F.col("num_nulls"), F.lit(0))
    return out.select(
        *group, "row_count", "num_nulls", (F.col("num_nulls") / F.col("row_count")).alias("percent_null"), "num_distinct", "num_zeros", "min", "max",
        "avg", F.when(F.col("numbers") > 1, F.sqrt(F.col("square") / (F.col("numbers") - 1))).alias("stddev"),
        "min_length", "max_length", (F.col("sum_length") / texts).alias("avg_length"), F.when(F.size("items") > 0, top).alias("mode"),
        *[q[i].alias(f"p{int(100 * p)}") for i, p in enumerate(POINTS)])
