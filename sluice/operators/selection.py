"""Exact order statistics of many groups without a group's values in one place.

Rows become counts per distinct value, combined before the shuffle, so a value that a third of the rows hold is one row
from then on. The counts are written in ranges of ``(group, value)``; a small table of counts per range and group says
in which range each wanted rank lies, and only these ranges are numbered, each by its own task. No aggregate buffer and
no window grows with a group: a group of many distinct values is spread over ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"r_{k}"]) for k in keys], F.lit(True))


def _renamed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in df.columns])


def written_in_ranges(counts: DataFrame, keys: Sequence[str], value: str, ranges: int | None = None) -> DataFrame:
    """``counts`` written in ranges of (keys, value), with the number of its range as ``part``: a cut of the lineage."""
    spark, order = counts.sparkSession, [*keys, value]
    ranged = counts.repartitionByRange(ranges, *order) if ranges else counts.repartitionByRange(*order)
    path = scratch_path(spark, "ranges")
    ranged.withColumn("part", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(ranged.schema.add("part", "integer")).parquet(path)


def at_ranks(ranged: DataFrame, ranks: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``ranks`` (keys, ``rank`` from 0, any other columns) with the value that holds each rank.

    ``ranged``: keys, ``value``, ``n``, ``part`` as written by :func:`written_in_ranges`; keys may be null.
    """
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy(*keys, "part").agg(F.sum("n").alias("size"))
    parts = parts.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    wanted = _renamed(ranks, keys)
    hit = parts.join(wanted, _same(parts, wanted, keys) & (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("size")))
    others = [c for c in ranks.columns if c not in keys]
    hit = hit.select(*keys, "part", "before", *others)
    spots = _renamed(hit.groupBy(*keys, "part").agg(F.first("before").alias("before"), F.collect_set("rank").alias("ranks")), [*keys, "part"])
    near = ranged.join(spots, _same(ranged, spots, [*keys, "part"])).select(*[ranged[k] for k in keys], ranged["part"], value, "n", "before", "ranks")
    upto = Window.partitionBy(*keys, "part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    numbered = near.withColumn("end", F.col("before") + F.sum("n").over(upto))
    own = F.filter("ranks", lambda r: (r >= F.col("end") - F.col("n")) & (r < F.col("end")))
    found = _renamed(numbered.select(*keys, value, F.explode(own).alias("rank")), [*keys, "rank"])
    return ranks.join(found, _same(ranks, found, [*keys, "rank"])).select(*[ranks[c] for c in ranks.columns], value)


def percentiles(counts: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], ranges: int | None = None) -> DataFrame:
    """Exact percentiles, interpolated between neighbours, as ``q`` (an array in the order of ``probabilities``).

    ``counts``: keys, ``value``, ``n`` (rows of that value); null values don't count. Groups without values are absent.
    """
    ranged = written_in_ranges(counts.filter(F.col(value).isNotNull()).select(*keys, value, "n"), keys, value, ranges)
    sizes = ranged.groupBy(*keys).agg(F.sum("n").alias("rows"))
    points = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probabilities)])).alias("x")
    places = sizes.select(*keys, "rows", points).select(*keys, "x.i", (F.col("x.p") * (F.col("rows") - 1)).alias("at"))
    ends = places.select(*keys, "i", "at", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank"))
    ends = ends.groupBy(*keys, "i", "at", "rank").agg(F.lit(0).alias("z")).drop("z")
    found = at_ranks(ranged, ends, keys, value)
    low, high = F.min_by(value, "rank"), F.max_by(value, "rank")
    share = F.first("at") - F.floor(F.first("at"))
    mixed = found.groupBy(*keys, "i").agg(F.when(F.min("rank") == F.max("rank"), low).otherwise((1 - share) * low + share * high).alias("v"))
    return mixed.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("q"))
