"""Table profiles: time-series (per window) and snapshot (whole table).

All bounded metrics of all columns come from one aggregate per window: one scan, no row per column, a map-side partial
step, so a hot window is combined before the shuffle. Rows with a NULL timestamp form their own window.

Metrics are raw values, never rounded: row_count, num_nulls, percent_null, num_distinct, num_zeros, min, max, avg,
stddev, p25, p50, p75 (numeric types, decimals included, as doubles); min_value and max_value in the column's own type,
as text (integers and decimals of any precision and scale exactly, dates and timestamps in ISO form, strings by byte
order); min/max/avg length of strings; the most frequent value (ties -> smallest) of the columns named in
``mode_columns``. ``exact=False`` (default) uses bounded-memory sketches for distinct counts and percentiles;
``exact=True`` takes them, and modes, from counts per value (:mod:`.selection`), which no single task holds.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .selection import percentiles

# Calendar granularities -> date_trunc unit.
GRANULARITIES = {"1 hour": "hour", "1 day": "day", "1 week": "week", "1 month": "month", "1 year": "year"}
# Microseconds of the units that windows of any length are given in.
UNITS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}

EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)
POINTS = (0.25, 0.5, 0.75)


def micros(length: str) -> int:
    """Microseconds of ``'15 minutes'`` and the like."""
    parsed = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", length.lower())
    if not parsed or parsed[2] not in UNITS or int(parsed[1]) < 1:
        raise ValueError(f"{length!r} is neither one of {sorted(GRANULARITIES)} nor a number of {', '.join(UNITS)}s")
    return int(parsed[1]) * UNITS[parsed[2]]


def window_starts(ts: Column, granularity: str, slide: str | None = None) -> Column:
    """Array of the starts of all windows a time lies in; ``[NULL]`` for a NULL time, which is a window of its own.

    Windows of any fixed length are counted from 1970-01-01 in the session's time zone; with ``slide`` they overlap, each
    beginning that much after the one before. The five calendar granularities are truncations.
    """
    if slide is None and granularity in GRANULARITIES:
        return F.array(F.date_trunc(GRANULARITIES[granularity], ts))
    size = micros(granularity)
    step = size if slide is None else micros(slide)
    if step > size:
        raise ValueError(f"windows of {granularity} that begin every {slide} leave gaps")
    at = F.unix_micros(ts.cast("timestamp"))
    last = at - F.pmod(at, F.lit(step))
    starts = F.filter(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(-(-size // step) - 1).cast("long")), lambda i: last - i * F.lit(step).cast("long")), lambda s: s + size > at)
    starts = F.transform(starts, lambda s: F.timestamp_micros(s))
    return F.when(ts.isNull(), F.array(F.lit(None).cast("timestamp"))).otherwise(starts)


def window_start(ts: Column, granularity: str) -> Column:
    """The start of the one window a time lies in."""
    return F.element_at(window_starts(ts, granularity), 1)


def in_own_windows(df: DataFrame, columns: Sequence[str], ts_col: str | None, granularity: str, slide: str | None = None) -> DataFrame:
    """``window_start`` and the columns as ``c0, c1, ...``: names of the input can't clash with names of the profile."""
    if ts_col is None:
        window = F.lit(None).cast("timestamp")
    elif slide is None:
        window = window_start(F.col(ts_col), granularity)
    else:
        window = F.explode(window_starts(F.col(ts_col), granularity, slide))
    return df.select(window.alias("window_start"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def _numeric(t: T.DataType) -> bool:
    return isinstance(t, (*EXACT, T.FloatType, T.DoubleType))


def _text(c: Column, t: T.DataType) -> Column:
    """A value as text: decimals without trailing zeros, floats as doubles; null for types without an order of their own."""
    if isinstance(t, T.DecimalType):
        return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return c.cast("double").cast("string")
    if isinstance(t, (*EXACT, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("string")
    return F.lit(None).cast("string")


def _ordered(t: T.DataType) -> bool:
    return _numeric(t) or isinstance(t, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _metrics(i: int, t: T.DataType, exact: bool, mode: bool, accuracy: int) -> dict[str, Column]:
    """Aggregates of one column; those that don't apply to its type are null."""
    c, none = F.col(f"c{i}"), F.lit(None)
    num, length = c.cast("double") if _numeric(t) else None, F.length(c) if isinstance(t, T.StringType) else None
    of_num = lambda f, kind: f(num) if num is not None else none.cast(kind)
    of_length = lambda f, kind: f(length).cast(kind) if length is not None else none.cast(kind)
    bound = lambda f: _text(f(c), t) if _ordered(t) else none.cast("string")
    out = {
        "num_nulls": F.count_if(c.isNull()),
        "num_zeros": F.count_if(num == 0) if num is not None else F.lit(0).cast("long"),
        "min": of_num(F.min, "double"), "max": of_num(F.max, "double"), "avg": of_num(F.avg, "double"), "stddev": of_num(F.stddev_samp, "double"),
        "min_value": bound(F.min), "max_value": bound(F.max),
        "min_length": of_length(F.min, "int"), "max_length": of_length(F.max, "int"), "avg_length": of_length(F.avg, "double"),
    }
    if not exact:
        out["num_distinct"] = F.approx_count_distinct(c.cast("string"))
        out["mode"] = F.mode(c.cast("string"), deterministic=True) if mode else none.cast("string")
        out["q"] = of_num(lambda x: F.percentile_approx(x, list(POINTS), accuracy), "array<double>")
    return out


def _bounded(rows: DataFrame, columns: Sequence[str], types: Sequence[T.DataType], exact: bool, mode_columns: Sequence[str], accuracy: int) -> DataFrame:
    """One aggregate per window, then a row per column."""
    metrics = [_metrics(i, t, exact, c in mode_columns, accuracy) for i, (c, t) in enumerate(zip(columns, types))]
    wide = rows.groupBy("window_start").agg(F.count(F.lit(1)).alias("row_count"),
                                            *[m.alias(f"{name}_{i}") for i, own in enumerate(metrics) for name, m in own.items()])
    cells = [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{name}_{i}").alias(name) for name in metrics[i]]) for i, c in enumerate(columns)]
    long = wide.select("window_start", "row_count", F.explode(F.array(*cells)).alias("x")).select("window_start", "row_count", "x.*")
    return long.withColumn("percent_null", F.col("num_nulls") / F.col("row_count"))


def value_counts(rows: DataFrame, columns: Sequence[str], types: Sequence[T.DataType]) -> DataFrame:
    """``window_start, column_name, val`` (text), ``num`` (double or null), ``n``: map-side combined counts per value."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").cast("string").alias("val"),
                      (F.col(f"c{i}") if _numeric(t) else F.lit(None)).cast("double").alias("num")) for i, (c, t) in enumerate(zip(columns, types))]
    long = rows.select("window_start", F.explode(F.array(*cells)).alias("x")).select("window_start", "x.*")
    return long.groupBy("window_start", "column_name", "val", "num").agg(F.count(F.lit(1)).alias("n"))


def _from_counts(counts: DataFrame, mode_columns: Sequence[str]) -> DataFrame:
    """Distinct count, mode and percentiles of each group, from its counts per value."""
    group = ["window_start", "column_name"]
    some = counts.filter(F.col("val").isNotNull())
    distinct = some.groupBy(*group).agg(F.count(F.lit(1)).alias("num_distinct"))
    if mode_columns:
        most = some.filter(F.col("column_name").isin(list(mode_columns))).groupBy(*group).agg(F.max("n").alias("most"))
        modes = _joined(some, most, group).filter("n = most").groupBy(*group).agg(F.min("val").alias("mode"))
        distinct = _joined(distinct, modes, group)
    else:
        distinct = distinct.withColumn("mode", F.lit(None).cast("string"))
    return _joined(distinct, percentiles(counts, group, "num", POINTS), group)


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe left join on the keys, which stay once."""
    others = right.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = [left[k].eqNullSafe(others[f"r_{k}"]) for k in keys]
    return left.join(others, cond, "left").drop(*[f"r_{k}" for k in keys])


def profile(df: DataFrame, columns: Sequence[str] | None = None, ts_col: str | None = None,
            granularity: str = "1 day", exact: bool = False, mode_columns: Sequence[str] = (),
            accuracy: int = 10000, slide: str | None = None) -> DataFrame:
    """Long profile: one row per ``(window_start, column_name)``.

    ``ts_col=None`` gives a snapshot profile (``window_start`` NULL). ``granularity`` is a calendar unit or any fixed
    length (``'15 minutes'``); with ``slide`` windows overlap and a row counts in each it lies in. Without ``exact``, the
    counts of the values of ``mode_columns`` are kept per group while it is aggregated: name only columns of few values.
    """
    columns = [c for c in (columns or df.columns) if c != ts_col]
    types = [df.schema[c].dataType for c in columns]
    rows = in_own_windows(df, columns, ts_col, granularity, slide)
    out = _bounded(rows, columns, types, exact, mode_columns, accuracy)
    if exact:
        out = _joined(out, _from_counts(_written(value_counts(rows, columns, types)), mode_columns), ["window_start", "column_name"])
        out = out.withColumn("num_distinct", F.coalesce("num_distinct", F.lit(0).cast("long")))
    names = ["window_start", "column_name", "row_count", "num_nulls", "percent_null", "num_distinct", "num_zeros", "min", "max", "avg", "stddev",
             "min_value", "max_value", "min_length", "max_length", "avg_length", "mode"]
    return out.select(*names, *[F.get("q", F.lit(i)).alias(f"p{int(100 * p)}") for i, p in enumerate(POINTS)])


def _written(counts: DataFrame) -> DataFrame:
    """Counts are read for several results: a written table, counted once."""
    path = scratch_path(counts.sparkSession, "value_counts")
    counts.write.parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def quantiles(df: DataFrame, columns: Sequence[str], ts_col: str | None = None, granularity: str = "1 day",
              probs: Sequence[float] = POINTS, accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles of numeric columns per window at any probabilities
    (mergeable sketch; rank error about ``n / accuracy``)."""
    rows = in_own_windows(df, columns, ts_col, granularity)
    wide = rows.groupBy("window_start").agg(*[F.percentile_approx(F.col(f"c{i}").cast("double"), list(probs), accuracy).alias(f"q{i}") for i in range(len(columns))])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"q{i}").alias("q")) for i, c in enumerate(columns)])
    return wide.select("window_start", F.explode(cells).alias("x")).select(
        "window_start", "x.column_name", *[F.col("x.q")[i].alias(f"p{int(round(p * 100))}") for i, p in enumerate(probs)])
