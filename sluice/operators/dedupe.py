"""Deduplication.

* :func:`dedupe_latest` - latest row per key.  ``ties='one'`` (default) keeps
  exactly one row, which an upsert needs; ``ties='all'`` keeps every row tied
  on the order, like ``rank() == 1``.
* :func:`dedupe_any`    - any one row per key (``dropDuplicates``; nulls are one key).
* :func:`dedupe_stream` - first row per key over a whole stream, optionally
  bounded by a watermark.

Scale: ``rank``/``row_number`` filtered to 1 is planned by Catalyst as a
``WindowGroupLimit`` that also runs *before* the shuffle, so a hot key (e.g.
the null key, 30% of the rows) reaches the reducer as at most one row per map
partition instead of all its rows.  ``dropDuplicates`` is an aggregate with a
map-side partial step, so it is skew-safe in the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fresh
from ..session import scratch_path


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    """Names mean 'larger is later' (descending, nulls last); Columns are used as given."""
    return [F.col(c).desc() if isinstance(c, str) else c for c in order_by]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                  ties: str = "one", tiebreak: bool = True) -> DataFrame:
    """Latest row per key.

    With ``ties='one'`` a final descending ``xxhash64`` of the whole row breaks
    any remaining tie, so the result does not depend on partitioning.  With
    ``ties='all'`` and columns given by name, the latest value per key is a map-side
    combined aggregate joined back, so the tied rows of a hot key need not meet in
    one task (AQE splits a skewed join, not a window).
    """
    if ties not in ("one", "all"):
        raise ValueError("ties must be 'one' or 'all'")
    if ties == "all" and all(isinstance(c, str) for c in order_by):
        return _all_latest(df, list(keys), list(order_by))
    order = _order_cols(order_by)
    if ties == "one" and tiebreak:
        order.append(F.xxhash64(*[F.col(c) for c in df.columns]).desc())
    w = Window.partitionBy(*keys).orderBy(*order)
    rank, name = F.row_number() if ties == "one" else F.rank(), fresh(df.columns, "_rank")
    return df.withColumn(name, rank.over(w)).filter(F.col(name) == 1).drop(name)


def _all_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every row tied with the latest of its key: in a struct NULL is the smallest value, as in a descending order.

    The input is written once and read for the latest values and for the rows.
    """
    path = scratch_path(df.sparkSession, "latest")
    df.write.parquet(path)
    df = df.sparkSession.read.schema(df.schema).parquet(path)
    top = df.groupBy(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).agg(F.max(F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)])).alias("top"))
    same = [df[f"`{k}`"].eqNullSafe(top[f"k{i}"]) for i, k in enumerate(keys)] + [df[f"`{c}`"].eqNullSafe(top["top"][f"o{i}"]) for i, c in enumerate(order)]
    return df.join(top, reduce(lambda a, b: a & b, same), "left_semi")


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row per key; null keys compare equal."""
    return df.dropDuplicates(list(keys))


def dedupe_stream(df: DataFrame, keys: Sequence[str], event_time: str | None = None,
                  delay: str | None = None, null_keys: str = "one") -> DataFrame:
    """First row per key over a stream.

    A NULL key is one key like any other (``null_keys='one'``), held by one state
    partition; ``null_keys='pass'`` lets rows with a NULL in the key by without state,
    for streams where such rows are many (an upsert never matches them anyway).

    Without ``event_time`` the state never expires (the reference's behaviour).
    With ``event_time`` + ``delay`` the state is bounded by a watermark via
    ``dropDuplicatesWithinWatermark``; ``timestamp_ntz`` event times are cast to
    ``timestamp`` first since watermarks need the latter.
    """
    if null_keys not in ("one", "pass"):
        raise ValueError("null_keys must be 'one' or 'pass'")
    if null_keys == "pass":
        null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        return dedupe_stream(df.filter(~null), keys, event_time, delay).unionByName(df.filter(null))
    if event_time is None:
        return df.dropDuplicates(list(keys))
    if delay is None:
        raise ValueError("delay is required with event_time")
    ts = fresh(df.columns, "_event_ts")
    out = (df.withColumn(ts, F.col(event_time).cast("timestamp"))
             .withWatermark(ts, delay)
             .dropDuplicatesWithinWatermark(list(keys)))
    return out.drop(ts)


def first_by_event_time(df: DataFrame, keys: Sequence[str], event_time: str, gap: str, delay: str,
                        order_by: Sequence[str] = ()) -> DataFrame:
    """The first row per key by event time, over a stream, with a defined winner and state that ends.

    Rows of a key whose times are less than ``gap`` apart are repeats of one another; of each such session the row of
    least ``(event_time, *order_by, row hash)`` wins, whatever the order of arrival and the cut into batches. State is
    one row per open session (combined before the shuffle, so a hot or NULL key is no burden); a session is put out and
    its state dropped when the watermark, ``delay`` behind the latest time seen, has passed its end. Rows later than
    the watermark are not seen. Rows without a time belong to no session and don't come out.
    """
    at, start = fresh(df.columns, "event_at"), fresh(df.columns, "session")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    place = F.struct(F.col(at), *[F.col(f"`{c}`") for c in order_by], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    timed = df.withColumn(at, F.col(f"`{event_time}`").cast("timestamp")).withWatermark(at, delay)
    named = {k: f"k{i}" for i, k in enumerate(keys)}
    groups = [F.col(f"`{k}`").alias(n) for k, n in named.items()]
    won = timed.groupBy(*groups, F.session_window(at, gap).alias(start)).agg(F.min_by(row, place).alias("row"))
    return won.select("row.*")
