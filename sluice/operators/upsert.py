"""Upsert and the row-level change feed.

Open-source parquet tables have no ``MERGE``, so an upsert is expressed as
``target ▷ source-keys ∪ source``: rows of the target whose key the source
does not carry, plus every source row.  Keys compare with ``=``, so rows with a
NULL key never match: they are always inserted and never replaced (S9).

Scale: both joins here run on a struct join key ``(is_null, value)`` per key
column plus a salt.  Rows with a NULL key can never match; they get a salt from
their row hash (and a sign per side), so they spread over many reducers instead
of all hashing to the one partition of NULL - AQE cannot split a skewed full
outer join, and one key may hold a third of the rows.  Matches between non-null
keys are exact (salt 0, no NULL inside the struct).  When the catalog supports
row-level operations (``mergeInto``), :func:`merge_into_table` uses it instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import fresh

def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


NULL_SALTS = 1024


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def _zero(kind: T.DataType) -> Column:
    """A non-null stand-in of the key's type (only compared when the key is NULL,
    next to an is-null flag, so its value never decides a match)."""
    if _has_map(kind):
        raise TypeError(f"a key of type {kind.simpleString()} cannot be compared")
    if isinstance(kind, T.StructType):
        return F.struct(*[_zero(f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    fixed = {"string": F.lit(""), "boolean": F.lit(False), "binary": F.lit(bytearray()), "date": F.to_date(F.lit("1970-01-01"))}
    name = kind.simpleString()
    if name in fixed:
        return fixed[name]
    return F.lit("1970-01-01 00:00:00" if name.startswith("timestamp") else 0).cast(kind)


def join_key(df: DataFrame, keys: Sequence[str], side: int = 1) -> Column:
    """Struct join key: exact on non-null keys, salted and never matching on NULL keys.
    ``side`` (+1 / -1) keeps NULL-key rows of two different inputs apart. Maps don't enter the salt."""
    fields = []
    for i, k in enumerate(keys):
        fields += [F.col(f"`{k}`").isNull().alias(f"n{i}"), F.coalesce(F.col(f"`{k}`"), _zero(df.schema[k].dataType)).alias(f"v{i}")]
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]
    salt = F.when(_any_null(keys), (F.pmod(F.xxhash64(*hashed), F.lit(NULL_SALTS)) + 1) * F.lit(side)).otherwise(F.lit(0))
    return F.struct(*fields, salt.cast("bigint").alias("s"))


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a non-null key occurs twice (a MERGE would fail the same way).

    One distributed aggregate; only a single offending key comes back."""
    dup = (df.filter(~_any_null(keys)).groupBy(*keys).count().filter("count > 1").limit(1).collect())
    if dup:
        raise ValueError(f"source repeats key {dup[0].asDict()}; dedupe it first")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], check: bool = True) -> DataFrame:
    """Update all columns on key match, insert otherwise.  The result has the
    target's columns; the source is aligned by name.  A source that repeats a key
    raises (S1); ``check=False`` skips that pass where the source comes from a dedupe."""
    keys = list(keys)
    if check:
        assert_unique_keys(source, keys)
    src = source.select(*target.columns)
    name = fresh(target.columns, "_jk")
    tk = target.withColumn(name, join_key(target, keys))
    sk = src.filter(~_any_null(keys)).select(join_key(src, keys).alias(name))
    kept = tk.join(sk, name, "left_anti").drop(name)
    return kept.unionByName(src)


def merge_into_table(source: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Upsert into a catalog table that supports row-level operations."""
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    (source.alias("s").mergeInto(table, cond)
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge())


CHANGE_TYPE = "_change_type"


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-level changes between two versions of a keyed table.

    One full outer join on the keys and a null-safe compare of the other
    columns.  Emits the new image for ``insert`` and ``update_postimage``, the
    old image for ``delete`` and ``update_preimage``; unchanged rows are not
    emitted.  Keys are expected unique per version (a silver table); rows with
    a NULL key cannot be matched and appear as delete + insert.  A column that only
    one version has is NULL in the other.  Maps are compared by their sorted entries;
    maps inside other types are refused by name.
    """
    keys = list(keys)
    kinds = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}
    cols = [c for c in dict.fromkeys([*new.columns, *old.columns]) if c not in keys]

    def side(df: DataFrame, name: str, sign: int) -> DataFrame:
        row = [(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kinds[c])).alias(c) for c in [*keys, *cols]]
        return df.select(F.struct(*row).alias(name), join_key(df, keys, sign).alias(f"{name}_key"))

    both = side(old, "was", 1).join(side(new, "now", -1), F.col("was_key") == F.col("now_key"), "full_outer")
    return change_images(both, kinds, cols, F.col("was_key").isNull(), F.col("now_key").isNull())


def same_row(was: str, kinds: dict[str, T.DataType], now: str | None = None) -> Column:
    """Whether the struct ``was`` has the columns of the struct ``now``, or of the row itself; maps compare by their sorted entries."""
    if deep := [c for c, kind in kinds.items() if _has_map(kind) and (not isinstance(kind, T.MapType) or _has_map(kind.valueType))]:
        raise TypeError(f"columns {deep} hold maps inside other types, which cannot be compared")
    of = lambda at, c: F.array_sort(F.map_entries(f"{at}`{c}`")) if isinstance(kinds[c], T.MapType) else F.col(f"{at}`{c}`")
    there = F.col(was).isNotNull() if now is None else F.lit(True)
    return reduce(lambda a, b: a & b, [of(f"{was}.", c).eqNullSafe(of(f"{now}." if now else "", c)) for c in kinds], there)


def change_images(both: DataFrame, kinds: dict[str, T.DataType], cols: Sequence[str], inserted: Column, deleted: Column) -> DataFrame:
    """The changes between the structs ``was`` and ``now`` of each row; ``cols`` are compared, ``kinds`` has the type of every column."""
    if CHANGE_TYPE in kinds:
        raise ValueError(f"the versions already have a column named {CHANGE_TYPE}")
    same = same_row("was", {c: kinds[c] for c in cols}, "now")
    image = lambda name, kind: F.struct(F.col(name).alias("row"), F.lit(kind).alias("kind"))
    images = (F.when(inserted, F.array(image("now", "insert")))
              .when(deleted, F.array(image("was", "delete")))
              .when(~same, F.array(image("was", "update_preimage"), image("now", "update_postimage"))))
    return both.select(F.explode(images).alias("x")).select("x.row.*", F.col("x.kind").alias(CHANGE_TYPE))
