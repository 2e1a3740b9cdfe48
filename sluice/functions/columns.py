"""Column helpers of the declarative path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, or the first longer name that is not taken (names differ by more than case)."""
    taken = {c.lower() for c in taken}
    while name.lower() in taken:
        name += "_"
    return name


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that an operator's helpers would hide renamed, and how: given name -> name for now."""
    hidden = {n.lower() for n in names}
    renamed: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in hidden:
            renamed[c] = fresh([*df.columns, *hidden, *renamed.values()], f"{c}_given")
    return df.withColumnsRenamed(renamed) if renamed else df, renamed


def with_process_timestamp(df: DataFrame, name: str = "process_timestamp") -> DataFrame:
    """Ingestion time: one value per query / micro-batch (S8), so rows of a key that
    arrive together tie on it; use a data column as ``sequence_by`` where order matters."""
    return df.withColumn(name, F.current_timestamp())
