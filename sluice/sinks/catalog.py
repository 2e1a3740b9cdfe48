"""Catalog tables with comments and properties.

Parquet catalog tables accept arbitrary table properties and a comment, which
is where declared targets and intermediate tables record their purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_table(df: DataFrame, name: str, comment: str | None = None, properties: dict[str, str] | None = None,
               mode: str = "overwrite") -> None:
    """Write ``df`` as a parquet catalog table; ``comment`` and ``properties`` are
    set on create/replace.  ``mode='append'`` adds rows to an existing table."""
    df.write.mode(mode).format("parquet").saveAsTable(name)
    if mode == "append":
        return
    props = dict(properties or {})
    if comment is not None:
        props["comment"] = comment
    if props:
        body = ", ".join(f"{_lit(k)} = {_lit(v)}" for k, v in props.items())
        df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({body})")


def _lit(s: str) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_properties(spark: SparkSession, name: str, prefix: str | None = None) -> DataFrame:
    """``SHOW TBLPROPERTIES`` as a DataFrame, optionally only keys with a prefix (C4)."""
    props = spark.sql(f"SHOW TBLPROPERTIES {name}")
    return props.filter(F.col("key").startswith(prefix)) if prefix else props
