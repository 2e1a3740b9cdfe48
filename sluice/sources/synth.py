"""Deterministic generator of test tables with planted defects (A5, A5a-f, B3, G1, H2-H4).

A generator is a list of column specs applied to a DataFrame of seed ids.  Each
random draw is a hash of ``(id, column name, seed)``, not ``rand()``, so a row's
values depend only on its id: the output is the same for any partitioning, a
retried task recomputes the same rows, and another engine can reproduce it.

The hash is integer arithmetic only - three rounds of multiply modulo the prime
2**31 - 1 with xor-shifts in between, all within bigint range; what an id has beyond
31 bits enters after the first, salted xor-shift, so ids that draw alike in one column do not in the others - so it runs
inside whole-stage codegen (a string digest per draw was ~10x slower).

Seed ids come from the caller - ``spark.range(n)`` for a standalone table, or a
key column of an existing table so the generated data scales with it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import hashlib

PRIME = 2147483647  # 2**31 - 1
# Full-period multipliers modulo 2**31 - 1.
MULTIPLIERS = (48271, 69621, 16807)
SCALE = f"cast({PRIME} as double)"


def salt_of(text: str) -> int:
    """A per-column constant in [1, PRIME)."""
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big") % (PRIME - 1) + 1


@dataclass(frozen=True)
class Col:
    name: str
    type: str                      # Spark SQL type of the result
    kind: str                      # cycle | pick | int_range | float_range | date_range | expr
    values: tuple = ()
    lo: object = None
    hi: object = None
    unique_values: int | None = None   # cycle: wrap after N ids (None: no wrap)
    expr: str | None = None            # SQL over earlier columns; {u} is this column's uniform draw
    percent_nulls: float = 0.0


def cycle(name, type_="bigint", unique_values=None, min_value=0, percent_nulls=0.0):
    return Col(name, type_, "cycle", lo=min_value, unique_values=unique_values, percent_nulls=percent_nulls)


def pick(name, values, percent_nulls=0.0):
    return Col(name, "string", "pick", values=tuple(values), percent_nulls=percent_nulls)


def int_range(name, lo, hi, percent_nulls=0.0):
    return Col(name, "int", "int_range", lo=int(lo), hi=int(hi), percent_nulls=percent_nulls)


def float_range(name, lo, hi, percent_nulls=0.0):
    return Col(name, "double", "float_range", lo=float(lo), hi=float(hi), percent_nulls=percent_nulls)


def date_range(name, begin, end, percent_nulls=0.0):
    return Col(name, "date", "date_range", lo=begin, hi=end, percent_nulls=percent_nulls)


def derived(name, type_, expr, percent_nulls=0.0):
    return Col(name, type_, "expr", expr=expr, percent_nulls=percent_nulls)


def _days(begin: str, end: str) -> int:
    import datetime as dt
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(begin)).days


def _q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def xorshift(x: str, n: int) -> str:
    return f"({x} ^ shiftright({x}, {n}))"


def hash31(id_col: str, salt: str) -> str:
    """Integer hash of ``(id, salt)`` in [0, 2**31 - 1)."""
    a1, a2, a3 = MULTIPLIERS
    high = f"pmod({id_col} div {PRIME}, {PRIME})"
    x = f"((({id_col} % {PRIME}) + {PRIME} + {salt_of(salt)}) % {PRIME})"
    x = f"(({x} * {a1}) % {PRIME})"
    x = f"((({xorshift(x, 13)} + {high}) % {PRIME}) * {a2} % {PRIME})"
    return f"(({xorshift(x, 16)} * {a3}) % {PRIME})"


def column_sql(c: Col, id_col: str, seed: int) -> str:
    """SQL text of one generated column (before null injection)."""
    salt = f"{c.name}|{seed}"
    h = hash31(id_col, salt)
    u = f"(cast({h} as double) / {SCALE})"
    if c.kind == "cycle":
        base = f"{id_col}" if c.unique_values is None else f"({id_col} % {c.unique_values})"
        return f"cast({c.lo} + {base} as bigint)"
    if c.kind == "pick":
        return f"element_at(array({', '.join(_q(v) for v in c.values)}), cast({h} % {len(c.values)} + 1 as int))"
    if c.kind == "int_range":
        return f"cast({c.lo} + {h} % {c.hi - c.lo + 1} as int)"
    if c.kind == "float_range":
        return f"(cast({float(c.lo)!r} as double) + {u} * cast({float(c.hi) - float(c.lo)!r} as double))"
    if c.kind == "date_range":
        return f"date_add(date {_q(c.lo)}, cast({h} % {_days(c.lo, c.hi) + 1} as int))"
    if c.kind == "expr":
        return f"cast(({c.expr.replace('{u}', u)}) as {c.type})"
    raise ValueError(f"unknown column kind {c.kind!r}")


def with_nulls_sql(c: Col, body: str, id_col: str, seed: int) -> str:
    if not c.percent_nulls:
        return body
    u = f"(cast({hash31(id_col, f'{c.name}#null|{seed}')} as double) / {SCALE})"
    return f"case when {u} < cast({c.percent_nulls!r} as double) then null else {body} end"


def synth(seeds: DataFrame, specs: Sequence[Col], id_col: str = "id", seed: int = 42) -> DataFrame:
    """Generate one row per seed row.  Columns are added in order so ``expr``
    columns may refer to earlier ones (nulls propagate, e.g. through ``concat``)."""
    df = seeds.select(id_col)
    for c in specs:
        df = df.withColumn(c.name, F.expr(with_nulls_sql(c, column_sql(c, id_col, seed), id_col, seed)))
    return df.drop(id_col) if id_col not in {c.name for c in specs} else df


def continue_ids(existing: DataFrame, key: str, seeds: DataFrame, specs: Sequence[Col],
                 id_col: str = "id", seed: int = 42) -> DataFrame:
    """New rows whose ``key`` continues after the table's current maximum (G1).

    The maximum is one scalar aggregate; an empty table (max NULL) starts at 0 (S11).
    """
    top = existing.agg(F.max(key)).collect()[0][0]
    start = 0 if top is None else int(top) + 1
    specs = [replace(c, lo=start) if c.name == key and c.kind == "cycle" else c for c in specs]
    return synth(seeds, specs, id_col, seed)


def synth_stream(spark: SparkSession, specs: Sequence[Col], rows_per_batch: int, first_id: int = 0, seed: int = 42) -> DataFrame:
    """A1 + A5: the generator as an endless stream, ``rows_per_batch`` rows a micro-batch with ids from ``first_id`` on.

    The ids are the source's offsets, so a query restarted on its checkpoint goes on where it ended, a replayed batch
    has the same rows, and n batches equal the batch generator over the first n * rows_per_batch ids.
    """
    ids = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
           .select((F.col("value") + F.lit(first_id)).alias("id")))
    return synth(ids, specs, "id", seed)


# The reference demo's bronze generator (clean first load).
FIRST_NAMES = ["John", "Jane", "Alex", "Chris", "Katie", "James", "Sarah"]
LAST_NAMES = ["Smith", "Doe", "Johnson", "Lee", "Brown", "Williams"]
GENDERS = ["M", "F"]
STATES = ["New York", "California", "Texas", "Florida", "Illinois"]
STATES_DIRTY = ["New York", "California", "Texas", "Florida", "Illinois", "Washington"]
PRODUCT_NAMES = ["Laptop", "Phone", "Tablet", "Monitor", "Keyboard", "Mouse"]
CATEGORIES = ["Electronics", "Home", "Toys", "Clothing", "Books"]


def bronze_spec(num_clients: int = 100, num_products: int = 10, num_sales: int | None = None) -> list[Col]:
    """The clean bronze: 16 columns, ids cycling over clients / products."""
    return [
        cycle("client_id", unique_values=num_clients),
        pick("first_name", FIRST_NAMES),
        pick("last_name", LAST_NAMES),
        pick("gender", GENDERS),
        int_range("age", 18, 80),
        derived("email", "string", "concat(first_name, '.', last_name, '@example.com')"),
        date_range("signup_date", "2020-01-01", "2024-09-01"),
        pick("address", STATES),
        cycle("product_id", unique_values=num_products),
        pick("product_name", PRODUCT_NAMES),
        pick("category", CATEGORIES),
        float_range("price", 10.0, 2000.0),
        date_range("date", "2021-01-01", "2024-12-31"),
        cycle("sales_id", unique_values=num_sales),
        int_range("quantity", 1, 10),
        derived("sale_amount", "double", "quantity * {u} * 200"),
    ]


def dirty_spec(num_clients: int = 100, num_products: int = 10, num_records: int | None = None,
               first_sales_id: int = 0) -> list[Col]:
    """The dirty append: 30% / 40% / 20% null client_id / signup_date / product_id, an
    address outside the allowed list, a later date range, ids continuing the table."""
    return [
        cycle("client_id", unique_values=num_clients, percent_nulls=0.3),
        pick("first_name", FIRST_NAMES),
        pick("last_name", LAST_NAMES),
        pick("gender", GENDERS),
        int_range("age", 18, 80),
        derived("email", "string", "concat(first_name, '.', last_name, '@example.com')"),
        date_range("signup_date", "2020-01-01", "2024-12-31", percent_nulls=0.4),
        pick("address", STATES_DIRTY),
        cycle("product_id", unique_values=num_products, percent_nulls=0.2),
        pick("product_name", PRODUCT_NAMES),
        pick("category", CATEGORIES),
        float_range("price", 10.0, 2000.0),
        date_range("date", "2024-01-01", "2024-10-06"),
        cycle("sales_id", unique_values=num_records, min_value=first_sales_id),
        int_range("quantity", 1, 10),
        derived("sale_amount", "double", "quantity * {u} * 200"),
    ]
